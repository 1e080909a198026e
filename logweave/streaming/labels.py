"""Structured Streaming versions of the rule-label roll-up.

Sources are file streams over the driver's tables (or any folder of log
files); sinks are idempotent per micro-batch, so a restarted query from its
checkpoint rewrites, never duplicates, a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.functions import rules as R
from logweave.operators.parse import parse_log, parsed_rows
from logweave.session import scratch_path
from logweave.sources.derived import body_expr
from logweave.sources.tables import table

WATERMARK_DELAY = "1 hour"
BUCKET = "5 minutes"


def event_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None,
                 pattern: str = "events.parquet", schema=None) -> DataFrame:
    """The ``events`` table as a file stream: all part files if ``pattern`` names a folder in
    ``sf_dir``, otherwise the files in ``sf_dir`` that match it."""
    schema = schema or table(spark, sf_dir, "events").schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{pattern}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    if found and any(f.isDirectory() for f in found):
        return reader.parquet(path.toString())
    return reader.option("pathGlobFilter", pattern).parquet(sf_dir)


def stream_log_lines(events: DataFrame) -> DataFrame:
    """X1 log lines from a stream of events (same text as the batch view)."""
    return events.select(
        (F.col("event_id") + 1).alias("line_id"),
        F.concat_ws("|", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.col("event_type"),
                    body_expr(F.col("event_type"))).alias("line"))


def stream_labels(lines: DataFrame) -> DataFrame:
    """Parsed, labelled stream ``(LogName, TimeSlice, Label, event_time)`` for both logs; a line is parsed once."""
    p = parsed_rows(parse_log(lines))
    logs = F.array(*[F.struct(F.lit(name).alias("LogName"), fn(F.col("message")).alias("Label"))
                     for name, fn in (("messages", R.messages_label), ("sysmonitor", R.sysmonitor_label))])
    return p.select("time_bucket", F.col("ts").cast("timestamp").alias("event_time"), F.explode(logs).alias("log")).select(
        "log.LogName", F.col("time_bucket").alias("TimeSlice"), "log.Label", "event_time")


def bucket_flags(labels: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Per (log, 5-minute window) flag; ``max`` equals dedup-then-sum of 0/1 labels."""
    return (labels.withWatermark("event_time", delay)
            .groupBy("LogName", F.window("event_time", BUCKET).alias("w"), "TimeSlice")
            .agg(F.max("Label").cast("long").alias("Label")))


def run_upsert(stream: DataFrame, keys: list[str], path: str, checkpoint: str, output_mode: str = "update"):
    """Run ``stream`` to completion with a per-batch upsert sink.

    Each micro-batch writes its changed rows to ``path/batch=<id>`` (overwrite
    of that folder only, so a replayed batch is idempotent). Readers take the
    latest version of each key (``latest_by_key``).
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    q = (stream.writeStream.outputMode(output_mode).foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def latest_by_key(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    from pyspark.sql import Window
    df = spark.read.parquet(path)
    w = Window.partitionBy(*keys).orderBy(F.col("batch").desc())
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "batch")


def stream_bucket_labels(spark: SparkSession, sf_dir: str, events: DataFrame | None = None,
                         delay: str = WATERMARK_DELAY) -> DataFrame:
    """R1 end to end: final state of the streamed bucket flags (equals batch A1
    when the delay covers the disorder of the input)."""
    base = scratch_path(spark, "stream-bucket-labels")
    events = events if events is not None else event_stream(spark, sf_dir)
    flags = bucket_flags(stream_labels(stream_log_lines(events)), delay).drop("w")
    run_upsert(flags, ["LogName", "TimeSlice"], f"{base}/out", f"{base}/checkpoint")
    return latest_by_key(spark, f"{base}/out", ["LogName", "TimeSlice"]).select("LogName", "TimeSlice", "Label")


def stream_distinct(spark: SparkSession, sf_dir: str, events: DataFrame | None = None,
                    delay: str = WATERMARK_DELAY) -> DataFrame:
    """R2: distinct label rows with ``dropDuplicatesWithinWatermark`` into a parquet file sink."""
    base = scratch_path(spark, "stream-distinct")
    labels = stream_labels(stream_log_lines(events if events is not None else event_stream(spark, sf_dir)))
    dedup = (labels.withWatermark("event_time", delay)
             .dropDuplicatesWithinWatermark(["LogName", "TimeSlice", "Label"]))
    q = (dedup.select("LogName", "TimeSlice", "Label").writeStream.format("parquet")
         .option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")
