"""Driver table access. Every query reads these parquet tables (or data Spark
derives from them); column pruning and filters reach the parquet scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logweave.session import apply_defaults

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    apply_defaults(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Hash-repartition ``df`` by ``cols`` into the number of partitions that the
    setting ``spark.logweave.scan.partitions`` names; unchanged when unset.

    For tables of one small file with one row group, which a scan cannot split
    (the test tables). Whether rows are dealt anew is up to the setting alone,
    never to the data.
    """
    target = df.sparkSession.conf.get("spark.logweave.scan.partitions", None)
    return df.repartition(int(target), *cols) if target else df
