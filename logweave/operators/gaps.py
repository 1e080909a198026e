"""Numeric time gaps per event key (the number behind Q18): quantile sketches and distances from them.

With template tokens as parameters, a key's vector varies only in the rank of its gap word;
here the gap itself is the feature. The model of a key is three quantiles of its training gaps
from a mergeable sketch (``percentile_approx``: partial sketches before the shuffle, rank error
at most n / ``ACCURACY``, so exact for keys of up to ``ACCURACY`` rows). A test row is flagged
when its gap lies further from the median than ``SPREADS`` times the distance of the quartiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000
SPREADS = 3.0


def fit_gaps(train: DataFrame, gap: str = "gap", accuracy: int = ACCURACY) -> DataFrame:
    """(EventId, n_rows, low, mid, high): quartiles of the gaps; a quantile p is the value of rank ceil(p x n)."""
    q = F.percentile_approx(gap, [0.25, 0.5, 0.75], accuracy)
    return (train.groupBy("EventId").agg(F.count(gap).alias("n_rows"), q.alias("_q")).where("n_rows > 0")
            .select("EventId", "n_rows", F.col("_q")[0].alias("low"), F.col("_q")[1].alias("mid"), F.col("_q")[2].alias("high")))


def gap_distance(rows: DataFrame, model: DataFrame, gap: str = "gap", spreads: float = SPREADS) -> DataFrame:
    """Rows of keys that have a model: ``distance`` in quartile distances (at least one second) and ``is_anomaly``."""
    m = model.select("EventId", "low", "mid", "high")
    distance = F.abs(F.col(gap) - F.col("mid")) / F.greatest(F.col("high") - F.col("low"), F.lit(1))
    return (rows.join(m, "EventId").withColumn("distance", distance).drop("low", "mid", "high")
            .withColumn("is_anomaly", F.col("distance") > F.lit(spreads)))
