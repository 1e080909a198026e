"""Registry of named queries (``queries()``) and their DuckDB oracles.

Every query takes ``(spark, sf_dir)``, reads the driver tables (or views Spark
derives from them) and returns a DataFrame whose computed columns are aliased
to the same names as in the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from logweave.plans import q_freq, q_io, q_labels, q_mining, q_params, q_seq, q_stream  # noqa: F401
