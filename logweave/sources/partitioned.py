"""Partitioned table sinks (S7, S9): one folder per key, replaced as a whole.

Rows are dealt by ranges of (keys, order), so a key that holds most rows is
written by many tasks as many files, and small keys share a task: about as many
files as tasks and keys together. Within a file rows are in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_ROWS_PER_FILE = 2_000_000


def write_partitioned(df: DataFrame, path: str, keys: list[str], order: list[str], max_rows: int = MAX_ROWS_PER_FILE) -> None:
    """Write ``df`` as Parquet below ``path`` by ``keys``. Partitions that ``df`` has rows for are replaced when
    the job commits (a failed job leaves the old ones); others stay as they are."""
    (df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_rows).partitionBy(*keys).parquet(path))


def read_partition(spark: SparkSession, path: str, **keys) -> DataFrame:
    """The rows of the given key values; only their folders are read."""
    out = spark.read.parquet(path)
    for k, v in keys.items():
        out = out.where(F.col(k) == F.lit(v))
    return out
