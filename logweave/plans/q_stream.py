"""Streaming queries (R1-R3): each runs a file stream to completion
(``availableNow``) and returns its final sink state as a DataFrame."""

from __future__ import annotations

from logweave.plans.catalog import register
from logweave.plans.q_labels import X1
from logweave.streaming import labels as SL
from logweave.streaming import templates as ST


@register("stream_bucket_labels", X1 + """
SELECT LogName, TimeSlice, CAST(max(Label) AS BIGINT) AS Label FROM (
  SELECT 'messages' AS LogName, time_bucket AS TimeSlice,
         CASE WHEN regexp_matches(message, 'lose cover|disabled|disabling|interrupt', 'i') THEN 1 ELSE 0 END AS Label FROM x1
  UNION ALL
  SELECT 'sysmonitor', time_bucket,
         CASE WHEN regexp_matches(message, '(alarm.*memory)|(memory.*alarm)|(resum.*alarm)', 'i') THEN 1 ELSE 0 END FROM x1)
GROUP BY LogName, TimeSlice""")
def q_stream_bucket_labels(spark, sf_dir):
    """Streamed 5-minute flags with a watermark; final state equals the batch roll-up."""
    return SL.stream_bucket_labels(spark, sf_dir)


@register("stream_distinct", X1 + """
SELECT DISTINCT * FROM (
  SELECT 'messages' AS LogName, time_bucket AS TimeSlice,
         CASE WHEN regexp_matches(message, 'lose cover|disabled|disabling|interrupt', 'i') THEN 1 ELSE 0 END AS Label FROM x1
  UNION ALL
  SELECT 'sysmonitor', time_bucket,
         CASE WHEN regexp_matches(message, '(alarm.*memory)|(memory.*alarm)|(resum.*alarm)', 'i') THEN 1 ELSE 0 END FROM x1)""")
def q_stream_distinct(spark, sf_dir):
    """R2: distinct label rows with ``dropDuplicatesWithinWatermark``."""
    return SL.stream_distinct(spark, sf_dir)


X1_TEMPLATES = X1 + """,
tp AS (SELECT event_type || '|' || message AS template, min(line_id) AS fl, count(*) AS size FROM x1 GROUP BY 1)"""


@register("stream_templates", X1_TEMPLATES + """
SELECT CAST(row_number() OVER (ORDER BY fl) AS INTEGER) AS cluster_id, template, size FROM tp""")
def q_stream_templates(spark, sf_dir):
    """Online template mining, each micro-batch going on from the stored miner."""
    return ST.stream_templates(spark, sf_dir)


@register("stream_progress", X1_TEMPLATES + """
SELECT CAST(sum(size) AS BIGINT) AS lines, count(*) AS clusters, count(*) AS changes FROM tp""")
def q_stream_progress(spark, sf_dir):
    """Lines, clusters and changes counted per micro-batch."""
    return ST.stream_progress(spark, sf_dir)
