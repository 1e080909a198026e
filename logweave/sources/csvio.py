"""CSV sink and source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header, no index. ``single_file`` only for small result tables."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """S5 with an explicit schema (no inference pass, stable types)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_marker(spark: SparkSession, path: str) -> None:
    """One-row ``result=TRUE`` table written after the main output."""
    write_csv(spark.createDataFrame([("TRUE",)], "result string"), path, single_file=True)
