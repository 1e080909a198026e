"""Queries for parsing and rule labelling."""

from __future__ import annotations

from pyspark.sql import functions as F

from logweave.functions import rules as R
from logweave.operators import labels as L
from logweave.operators.parse import parse_log, parsed_rows, reject_rows
from logweave.plans.catalog import register
from logweave.plans.labelling import bucket_label_table, label_lines
from logweave.plans.oracle_views import X1_LINES, X2_LINES, with_views
from logweave.sources.derived import document_lines, event_log_lines

X1 = with_views(X1_LINES)


def _logs(spark, sf_dir):
    lines = event_log_lines(spark, sf_dir)
    return {"messages": lines, "sysmonitor": lines}


@register("bucket_labels", X1 + """
SELECT LogName, TimeSlice, CAST(sum(Label) AS BIGINT) AS Label FROM (
  SELECT DISTINCT LogName, TimeSlice, Label FROM (
    SELECT 'messages' AS LogName, time_bucket AS TimeSlice,
           CASE WHEN regexp_matches(message, 'lose cover|disabled|disabling|interrupt', 'i') THEN 1 ELSE 0 END AS Label
    FROM x1
    UNION ALL
    SELECT 'sysmonitor', time_bucket,
           CASE WHEN regexp_matches(message, '(alarm.*memory)|(memory.*alarm)|(resum.*alarm)', 'i') THEN 1 ELSE 0 END
    FROM x1))
GROUP BY LogName, TimeSlice ORDER BY LogName, TimeSlice""")
def q_bucket_labels(spark, sf_dir):
    """J1 / A1 flagship: both logs, parse, label, union, distinct, sum per bucket."""
    return bucket_label_table(_logs(spark, sf_dir))


@register("parse_lines", X1 + """
SELECT line_id, epoch, time_bucket, event_type AS reason, message FROM x1""")
def q_parse_lines(spark, sf_dir):
    p = parsed_rows(parse_log(event_log_lines(spark, sf_dir)))
    return p.select("line_id", "epoch", "time_bucket", "reason", "message")


@register("parse_rejects", with_views(X2_LINES) + """
SELECT doc_id, line_no,
       CASE WHEN regexp_matches(line, '^\\s*$') THEN 'blank'
            WHEN try_strptime(substr(regexp_extract(line, '^\\s*([^\\s|]*)', 1), 1, 19), '%Y-%m-%dT%H:%M:%S') IS NULL THEN 'bad_time'
            ELSE 'no_separator' END AS reject_reason
FROM x2
WHERE regexp_matches(line, '^\\s*$')
   OR try_strptime(substr(regexp_extract(line, '^\\s*([^\\s|]*)', 1), 1, 19), '%Y-%m-%dT%H:%M:%S') IS NULL
   OR NOT (contains(line, '|') OR contains(line, ':'))""")
def q_parse_rejects(spark, sf_dir):
    """P3 rejects: document lines are not log lines, so they land in rejects with a reason."""
    return reject_rows(parse_log(document_lines(spark, sf_dir)), keys=("doc_id", "line_no")).drop("line")


@register("time_bucket", X1 + """
SELECT time_bucket, CAST(count(*) AS BIGINT) AS n_lines, CAST(min(epoch) AS BIGINT) AS first_epoch
FROM x1 GROUP BY time_bucket""")
def q_time_bucket(spark, sf_dir):
    p = parsed_rows(parse_log(event_log_lines(spark, sf_dir)))
    return p.groupBy("time_bucket").agg(F.count(F.lit(1)).alias("n_lines"), F.min("epoch").alias("first_epoch"))


@register("split_reason", X1 + """
SELECT event_type AS reason, message, CAST(count(*) AS BIGINT) AS n_lines FROM x1 GROUP BY ALL""")
def q_split_reason(spark, sf_dir):
    p = parsed_rows(parse_log(event_log_lines(spark, sf_dir)))
    return p.groupBy("reason", "message").agg(F.count(F.lit(1)).alias("n_lines"))


@register("label_messages", X1 + """
SELECT line_id, CASE WHEN regexp_matches(message, 'lose cover|disabled|disabling|interrupt', 'i') THEN 1 ELSE 0 END AS Label
FROM x1""")
def q_label_messages(spark, sf_dir):
    return label_lines(event_log_lines(spark, sf_dir), "messages").select("line_id", "Label")


@register("label_sysmonitor", X1 + """
SELECT line_id, CASE WHEN regexp_matches(message, '(alarm.*memory)|(memory.*alarm)|(resum.*alarm)', 'i') THEN 1 ELSE 0 END AS Label
FROM x1""")
def q_label_sysmonitor(spark, sf_dir):
    return label_lines(event_log_lines(spark, sf_dir), "sysmonitor").select("line_id", "Label")


@register("label_rule_table", X1 + """
SELECT line_id, rule_name, Label FROM (
  SELECT line_id, 'default' AS rule_name,
         CASE WHEN regexp_matches(message, '(alarm.*memory)|(memory.*alarm)|(resum.*alarm)', 'i') THEN 1 ELSE 0 END AS Label FROM x1
  UNION ALL
  SELECT line_id, 'alarm_or_abnormal', CASE WHEN regexp_matches(message, 'alarm|abnormal', 'i') THEN 1 ELSE 0 END FROM x1
  UNION ALL
  SELECT line_id, 'alarm_then_memory', CASE WHEN regexp_matches(message, '(alarm)*.*(memory)', 'i') THEN 1 ELSE 0 END FROM x1)""")
def q_label_rule_table(spark, sf_dir):
    """The sysmonitor log labelled by every rule set in the rule table."""
    parsed = parsed_rows(parse_log(event_log_lines(spark, sf_dir))).withColumn("log_name", F.lit("sysmonitor"))
    return R.label_with_rule_table(parsed, R.DEFAULT_RULES, None).select("line_id", "rule_name", "Label")


@register("label_projection", X1 + """
SELECT 'messages' AS LogName, time_bucket AS TimeSlice,
       CASE WHEN regexp_matches(message, 'lose cover|disabled|disabling|interrupt', 'i') THEN 1 ELSE 0 END AS Label
FROM x1""")
def q_label_projection(spark, sf_dir):
    return L.label_projection(label_lines(event_log_lines(spark, sf_dir), "messages"), "messages")


@register("union_labels", X1 + """
SELECT 'messages' AS LogName, time_bucket AS TimeSlice,
       CASE WHEN regexp_matches(message, 'lose cover|disabled|disabling|interrupt', 'i') THEN 1 ELSE 0 END AS Label FROM x1
UNION ALL
SELECT 'sysmonitor', time_bucket,
       CASE WHEN regexp_matches(message, '(alarm.*memory)|(memory.*alarm)|(resum.*alarm)', 'i') THEN 1 ELSE 0 END FROM x1""")
def q_union_labels(spark, sf_dir):
    from logweave.plans.labelling import labels_for_logs
    return labels_for_logs(_logs(spark, sf_dir))


@register("distinct_labels", X1 + """
SELECT DISTINCT * FROM (
SELECT 'messages' AS LogName, time_bucket AS TimeSlice,
       CASE WHEN regexp_matches(message, 'lose cover|disabled|disabling|interrupt', 'i') THEN 1 ELSE 0 END AS Label FROM x1
UNION ALL
SELECT 'sysmonitor', time_bucket,
       CASE WHEN regexp_matches(message, '(alarm.*memory)|(memory.*alarm)|(resum.*alarm)', 'i') THEN 1 ELSE 0 END FROM x1)""")
def q_distinct_labels(spark, sf_dir):
    from logweave.plans.labelling import labels_for_logs
    return L.distinct_labels(labels_for_logs(_logs(spark, sf_dir)))
