"""Online template mining (R3) with its change feed and progress counts.

Each micro-batch goes on from the miner that the batch before it stored
(``plans.mining.fit_templates``): the state is typed tables (clusters of the
leaves so far, lines per leaf, own leaves), the lines of a leaf are sorted and
streamed by Spark and never gathered in memory, and routing and clustering are
those of the batch miner, so the final catalogue is the one that mining all
lines at once would give. A replayed micro-batch starts from the same stored
miner and replaces its own rows only.

Per batch, ``changes`` holds the clusters it made or changed, and ``progress``
its numbers of lines, clusters and changes, observed while the tables are
written (``DataFrame.observe``): counts, no clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logweave.operators import templates as T
from logweave.operators.parse import parse_log, parsed_rows
from logweave.plans import mining, models
from logweave.session import scratch_path
from logweave.streaming.labels import event_stream, stream_log_lines

PROGRESS = "batch long, lines long, clusters long, changes long"


def _fit_id(batch_id: int) -> str:
    return f"b{batch_id:012d}"


def mining_lines(lines: DataFrame) -> DataFrame:
    """``(content, pos)`` of raw log lines, in the form the miner reads (X1: the text after the time token)."""
    p = parsed_rows(parse_log(lines, split_reason=False))
    return p.select(F.col("message").alias("content"), F.col("line_id").cast("decimal(38,0)").alias("pos"))


def _stored_before(spark: SparkSession, path: str, batch_id: int) -> str | None:
    """The fit of the last micro-batch before this one that had lines."""
    if batch_id == 0 or not models.folder_exists(spark, f"{path}/mined"):
        return None
    return spark.read.parquet(f"{path}/mined").where(F.col("fit_id") < _fit_id(batch_id)).agg(F.max("fit_id")).first()[0]


def mine_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """One micro-batch: go on from the miner stored last, write the changes and the counts."""
    spark = batch.sparkSession
    if batch.isEmpty():
        return
    seen, made, held = Observation("lines"), Observation("changes"), Observation("clusters")
    lines = mining_lines(batch).observe(seen, F.count(F.lit(1)).alias("n"))
    mined = mining.fit_templates(lines, path, _fit_id(batch_id), _stored_before(spark, path, batch_id))
    changes = mined.where("kind = 'change'").select(
        "n_tokens", "leaf_token", "local_id", "pos", "change_type", F.array_join("template", " ").alias("template"), "size")
    changes.observe(made, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/changes/batch={batch_id}")
    clusters = mined.where("kind = 'cluster'").observe(held, F.count(F.lit(1)).alias("n"))
    clusters.write.format("noop").mode("overwrite").save()
    row = (batch_id, seen.get["n"], held.get["n"], made.get["n"])
    spark.createDataFrame([row], PROGRESS).drop("batch").write.mode("overwrite").parquet(f"{path}/progress/batch={batch_id}")


def run_mining(lines: DataFrame, path: str, checkpoint: str):
    """Run a stream of raw log lines through the miner to its end."""
    q = (lines.writeStream.foreachBatch(lambda batch, batch_id: mine_batch(batch, batch_id, path))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def mined_stream(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> str:
    """Mine the X1 event stream; the folder that holds the miner, its changes and its progress."""
    base = scratch_path(spark, "stream-templates")
    run_mining(stream_log_lines(events if events is not None else event_stream(spark, sf_dir)), f"{base}/out", f"{base}/checkpoint")
    return f"{base}/out"


def final_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The catalogue after the last micro-batch, numbered by first line as in the batch miner."""
    last = spark.read.parquet(f"{path}/mined").agg(F.max("fit_id")).first()[0]
    return T.catalogue(models.load_model(spark, f"{path}/mined", last))


def stream_templates(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """R3 end to end over the X1 event stream."""
    return final_catalogue(spark, mined_stream(spark, sf_dir, events)).select("cluster_id", "template", "size")


def stream_progress(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Lines and changes of all micro-batches, and clusters after the last one."""
    p = spark.read.parquet(f"{mined_stream(spark, sf_dir, events)}/progress")
    return p.agg(F.sum("lines").alias("lines"), F.max_by("clusters", "batch").alias("clusters"), F.sum("changes").alias("changes"))
