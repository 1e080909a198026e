"""Wide exports (S11): one column per key value of a given list.

The scalable export is the long form itself (rows, key, value), written
partitioned by key; a wide table is for a list of keys that someone chose.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def long_form(df: DataFrame, rows: list[str], key: str, value: str) -> DataFrame:
    """``(rows, key, value)``: one value (the largest) per row and key, for any number of keys."""
    return df.groupBy(*rows, key).agg(F.max(value).alias(value))


def pivot_by_key(df: DataFrame, rows: list[str], key: str, value: str, keys: Sequence, prefix: str = "") -> DataFrame:
    """``groupBy(rows).pivot(key, keys).agg(max(value))``: a column for each of ``keys``, every row kept."""
    out = df.groupBy(*rows).pivot(key, list(keys)).agg(F.max(value))
    return out.select(*rows, *[F.col(str(i)).alias(f"{prefix}{i}") for i in keys])
