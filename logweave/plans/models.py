"""Model tables (S10 / Q17): fitted models are parquet tables keyed by an
explicit ``fit_id`` (and ``EventId`` for per-key models), never pickles.

``load_or_fit`` reuses a stored model only when the same ``fit_id`` exists,
so changed inputs under a new id always refit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def has_fit(spark: SparkSession, path: str, fit_id: str) -> bool:
    """Whether ``path`` holds the fit. A missing folder means no; any other error is raised."""
    return folder_exists(spark, path) and not spark.read.parquet(path).where(F.col("fit_id") == fit_id).isEmpty()


def save_model(model: DataFrame, path: str, fit_id: str) -> None:
    """Write ``model`` under ``path/fit_id=<id>`` (replacing only that fit)."""
    (model.withColumn("fit_id", F.lit(fit_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("fit_id").parquet(path))


def load_model(spark: SparkSession, path: str, fit_id: str, schema: str | None = None) -> DataFrame:
    """The rows of a fit; with ``schema`` a table that no fit has put a row into reads as empty."""
    reader = spark.read if schema is None else spark.read.schema(f"{schema}, fit_id string")
    return reader.parquet(path).where(F.col("fit_id") == fit_id).drop("fit_id")


def load_or_fit(spark: SparkSession, path: str, fit_id: str, fit: Callable[[], DataFrame]) -> DataFrame:
    if not has_fit(spark, path, fit_id):
        save_model(fit(), path, fit_id)
    return load_model(spark, path, fit_id)
