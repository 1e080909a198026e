"""Source / sink and bookkeeping queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from logweave.operators.order import dense_index
from logweave.operators.parse import parse_log, reject_rows
from logweave.plans import mining as MI
from logweave.plans import params as PP
from logweave.plans import path as PATH
from logweave.plans.catalog import register
from logweave.plans.detection import fused
from logweave.plans.labelling import bucket_label_table, label_lines
from logweave.plans.oracle_views import PATH_MODEL, X1_LINES, X2_LINES, with_views
from logweave.plans.q_labels import X1
from logweave.plans.q_mining import LOG_TOP_K
from logweave.plans.q_params import P
from logweave.session import materialize, scratch_path
from logweave.sources.csvio import read_csv, write_csv
from logweave.sources.derived import document_lines, event_log_lines
from logweave.sources.text import read_lines


def written_log(spark, sf_dir):
    """X1 written as text part files in line order, then scanned back."""
    path = scratch_path(spark, "x1-text")
    event_log_lines(spark, sf_dir).orderBy("line_id").select("line").write.text(path)
    return read_lines(spark, path, log_name="x1", across_files=True)


@register("scan_lines", X1 + " SELECT line_id, line FROM x1")
def q_scan_lines(spark, sf_dir):
    """Text scan with a distributed, stable 1-based line number."""
    return written_log(spark, sf_dir).select("line_id", "line")


@register("line_number")
def q_line_number(spark, sf_dir):
    """S2 per file: each part file of the written log numbered from 1 on its own."""
    path = scratch_path(spark, "x1-text-files")
    event_log_lines(spark, sf_dir).orderBy("line_id").select("line").write.text(path)
    lines = read_lines(spark, path, log_name="x1")
    return lines.select(F.element_at(F.split("file_path", "/"), -1).alias("file"), "line_id", "line")


@register("utf8_rejects")
def q_utf8_rejects(spark, sf_dir):
    """S3: lines of the scanned text that are not valid UTF-8 (reason ``bad_utf8``)."""
    lines = written_log(spark, sf_dir)
    rej = reject_rows(parse_log(lines))
    return rej.where(F.col("reject_reason") == "bad_utf8")


@register("train_test_concat", X1 + """
SELECT split, line_id, CAST(row_number() OVER (ORDER BY CASE WHEN split = 'train' THEN 0 ELSE 1 END, line_id) AS BIGINT) AS pos
FROM (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'train' ELSE 'test' END AS split FROM x1)""")
def q_train_test_concat(spark, sf_dir):
    """Train lines followed by test lines, with their position in the concatenation."""
    lines = MI.event_log_mining_input(spark, sf_dir).drop("pos")
    tr = lines.where(F.col("split") == "train")
    te = lines.where(F.col("split") == "test")
    both = tr.unionByName(te).withColumn("_s", F.when(F.col("split") == "train", 0).otherwise(1))
    return dense_index(both, ["_s", "line_id"], out="pos").select("split", "line_id", "pos")


@register("csv_roundtrip", X1 + """
SELECT LogName, TimeSlice, CAST(sum(Label) AS BIGINT) AS Label FROM (
  SELECT DISTINCT LogName, TimeSlice, Label FROM (
    SELECT 'messages' AS LogName, time_bucket AS TimeSlice,
           CASE WHEN regexp_matches(message, 'lose cover|disabled|disabling|interrupt', 'i') THEN 1 ELSE 0 END AS Label FROM x1
    UNION ALL
    SELECT 'sysmonitor', time_bucket,
           CASE WHEN regexp_matches(message, '(alarm.*memory)|(memory.*alarm)|(resum.*alarm)', 'i') THEN 1 ELSE 0 END FROM x1))
GROUP BY LogName, TimeSlice""")
def q_csv_roundtrip(spark, sf_dir):
    """The label table written as CSV with a header and read back with a schema."""
    lines = event_log_lines(spark, sf_dir)
    result = bucket_label_table({"messages": lines, "sysmonitor": lines})
    path = scratch_path(spark, "predict-csv")
    write_csv(result, path)
    return read_csv(spark, path, "LogName string, TimeSlice long, Label long")


@register("row_counts", with_views(X1_LINES, X2_LINES) + """
SELECT 'events' AS source, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) AS BIGINT) AS n_parsed,
       CAST(0 AS BIGINT) AS n_rejected FROM x1
UNION ALL
SELECT 'documents', CAST(count(*) AS BIGINT), CAST(0 AS BIGINT), CAST(count(*) AS BIGINT) FROM x2""")
def q_row_counts(spark, sf_dir):
    """Lines, parsed rows and rejects per source (parsed + rejected = lines)."""
    outs = []
    for name, lines in (("events", event_log_lines(spark, sf_dir)), ("documents", document_lines(spark, sf_dir))):
        p = parse_log(lines)
        outs.append(p.agg(F.count(F.lit(1)).alias("n_lines"),
                          F.count(F.when(F.col("reject_reason").isNull(), 1)).alias("n_parsed"),
                          F.count(F.col("reject_reason")).alias("n_rejected"))
                    .select(F.lit(name).alias("source"), "n_lines", "n_parsed", "n_rejected"))
    return outs[0].unionByName(outs[1])


@register("distinct_content", with_views(X2_LINES) + " SELECT DISTINCT line AS content FROM x2")
def q_distinct_content(spark, sf_dir):
    """Distinct message texts (document lines)."""
    return document_lines(spark, sf_dir).select(F.col("line").alias("content")).distinct()


@register("fuse_labels", P + """,
win AS (
  SELECT * FROM (
    SELECT split, LineId, seq, lag(EventId, 3) OVER w AS c1, lag(EventId, 2) OVER w AS c2, lag(EventId, 1) OVER w AS c3,
           EventId AS y FROM sl WINDOW w AS (PARTITION BY split ORDER BY seq)) WHERE seq >= 4),""" + PATH_MODEL + f"""
SELECT x.line_id, CASE WHEN x.line_id IN (SELECT LineId FROM ma WHERE mse > 1000) THEN 1
       WHEN x.line_id IN (SELECT LineId FROM scored WHERE rank IS NULL OR rank > {LOG_TOP_K}) THEN 1
       WHEN regexp_matches(x.message, '(alarm.*memory)|(memory.*alarm)|(resum.*alarm)', 'i') THEN 1 ELSE 0 END AS Label
FROM x1 x""")
def q_fuse_labels(spark, sf_dir):
    """Sysmonitor rule labels raised to 1 on lines that the parameter or the path model flagged."""
    s = materialize(MI.structured_event_log(spark, sf_dir), "structured-log")  # both detectors read it
    by_param = PP.param_value(PP.param_rows(spark, sf_dir, structured=s)).where("is_anomaly")
    by_path = PATH.log_path(s, LOG_TOP_K)
    return fused(label_lines(event_log_lines(spark, sf_dir), "sysmonitor"), by_param, by_path)
