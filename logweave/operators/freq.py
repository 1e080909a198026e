"""Frequency tables as DataFrames.

A frequency table is a DataFrame ``(sample, cnt[, first_seen])``; every
operation is a grouped aggregate or a join on ``sample`` (partial
aggregation before the shuffle, no driver round trip). ``first_seen`` is the
smallest position at which a sample occurred; it breaks count ties the way
insertion order does in a counter (most common first, then first seen).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def freqdist(samples: DataFrame, sample: str = "sample", position: str | None = None) -> DataFrame:
    """count each sample (and keep its first position if given)."""
    aggs = [F.count(F.lit(1)).alias("cnt")]
    if position:
        aggs.append(F.min(position).alias("first_seen"))
    return samples.groupBy(F.col(sample).alias("sample")).agg(*aggs)


def totals(fd: DataFrame) -> DataFrame:
    """One row ``(N, B)``: outcomes and bins with a positive count."""
    pos = fd.where(F.col("cnt") > 0)
    return pos.agg(F.coalesce(F.sum("cnt"), F.lit(0)).cast("long").alias("N"),
                   F.count(F.lit(1)).cast("long").alias("B"))


def hapaxes(fd: DataFrame) -> DataFrame:
    """samples seen exactly once."""
    return fd.where(F.col("cnt") == 1).select("sample")


def freq_of_freq(fd: DataFrame, bins: DataFrame | int | None = None) -> DataFrame:
    """``(r, Nr)``; the ``r = 0`` row is ``bins - B`` (0 without ``bins``).

    ``bins`` is a number or a one-row DataFrame with a ``bins`` column (e.g.
    the size of a vocabulary computed by Spark); it enters as a scalar subquery.
    """
    pos = fd.where(F.col("cnt") > 0)
    nr = pos.groupBy(F.col("cnt").cast("long").alias("r")).agg(F.count(F.lit(1)).cast("long").alias("Nr"))
    b = pos.agg(F.count(F.lit(1)).alias("_B"))
    if bins is None:
        zero = b.select(F.lit(0).cast("long").alias("r"), F.lit(0).cast("long").alias("Nr"))
    else:
        bins_col = bins.select("bins").scalar() if isinstance(bins, DataFrame) else F.lit(bins)
        zero = b.select(F.lit(0).cast("long").alias("r"), (bins_col - F.col("_B")).cast("long").alias("Nr"))
    return nr.unionByName(zero)


def relative(fd: DataFrame) -> DataFrame:
    """``cnt / N`` per sample, 0 when the table is empty (N as a scalar subquery)."""
    n = totals(fd).select("N").scalar()
    return fd.select("sample", F.when(n == 0, F.lit(0.0)).otherwise(F.col("cnt") / n).alias("freq"))


def _order(fd: DataFrame):
    cols = [F.col("cnt").desc()]
    if "first_seen" in fd.columns:
        cols.append(F.col("first_seen").asc())
    cols.append(F.col("sample").asc())
    return cols


def most_common(fd: DataFrame, n: int | None = None) -> DataFrame:
    """K1 / K2: samples by count descending, ties by first seen; ``rank`` from 1.

    With ``n`` this is a top-k (Spark plans ``TakeOrderedAndProject``: a
    per-partition top-k, then a merge of ``n`` rows per partition).
    """
    ordered = fd.orderBy(*_order(fd))
    if n is not None:
        ordered = ordered.limit(n)
        w = Window.orderBy(*_order(fd))
        return ordered.withColumn("rank", F.row_number().over(w).cast("long"))
    # full ranking: a global sort (range partitioned), then a distributed rank
    return rank_sorted(fd)


def rank_sorted(fd: DataFrame) -> DataFrame:
    """Dense 1-based rank over the whole table without a single-task window."""
    from logweave.operators.order import dense_index
    keys = [c for c in ("cnt", "first_seen", "sample") if c in fd.columns]
    asc = {"cnt": False}
    return dense_index(fd, keys, ascending=[asc.get(k, True) for k in keys], out="rank")


def max_sample(fd: DataFrame) -> DataFrame:
    """the most common sample (empty result for an empty table)."""
    return most_common(fd.where(F.col("cnt") > 0), 1).select("sample", "cnt")


def cumulative(fd: DataFrame, n: int | None = None, percents: bool = False) -> DataFrame:
    """Running count from the most common sample (optionally percent)."""
    ranked = most_common(fd, n)
    from logweave.operators.order import running_sum
    out = running_sum(ranked, "rank", "cnt", "cum_cnt")
    if percents:
        total = ranked.agg(F.sum("cnt")).scalar()
        out = out.withColumn("cum_pct", F.col("cum_cnt") / total * 100)
    return out


def _outer(a: DataFrame, b: DataFrame) -> DataFrame:
    """Counts of both tables per sample (a null sample is a sample): union and one aggregate."""
    zero = F.lit(0).cast("long")
    u = (a.select("sample", F.col("cnt").cast("long").alias("a"), zero.alias("b"))
         .unionByName(b.select("sample", zero.alias("a"), F.col("cnt").cast("long").alias("b"))))
    return u.groupBy("sample").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def add(a: DataFrame, b: DataFrame) -> DataFrame:
    """F8: sum of counts, positive only (union + aggregate: one shuffle)."""
    u = a.select("sample", "cnt").unionByName(b.select("sample", "cnt"))
    return u.groupBy("sample").agg(F.sum("cnt").alias("cnt")).where(F.col("cnt") > 0)


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    """``a - b`` keeping positive counts."""
    u = a.select("sample", "cnt").unionByName(b.select("sample", (-F.col("cnt")).alias("cnt")))
    return u.groupBy("sample").agg(F.sum("cnt").alias("cnt")).where(F.col("cnt") > 0)


def union_max(a: DataFrame, b: DataFrame) -> DataFrame:
    """per-sample maximum, positive only."""
    u = a.select("sample", "cnt").unionByName(b.select("sample", "cnt"))
    return u.groupBy("sample").agg(F.max("cnt").alias("cnt")).where(F.col("cnt") > 0)


def intersect_min(a: DataFrame, b: DataFrame) -> DataFrame:
    """per-sample minimum over samples in both, positive only."""
    return _outer(a, b).select("sample", F.least("a", "b").alias("cnt")).where(F.col("cnt") > 0)


def compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row ``(le, ge, lt, gt, eq)`` of multiset inclusion.

    ``a <= b``: every sample of ``a`` is in ``b`` with a count not larger.
    Counted as violations after one union and aggregate.
    """
    o = _outer(a, b)
    agg = o.agg(
        F.sum(F.when(F.col("a") > F.col("b"), 1).otherwise(0)).alias("_a_over"),
        F.sum(F.when(F.col("b") > F.col("a"), 1).otherwise(0)).alias("_b_over"),
    )
    le = F.coalesce(F.col("_a_over"), F.lit(0)) == 0
    ge = F.coalesce(F.col("_b_over"), F.lit(0)) == 0
    return agg.select(le.alias("le"), ge.alias("ge"), (le & ~ge).alias("lt"), (ge & ~le).alias("gt"),
                      (le & ge).alias("eq"))


def set_count(fd: DataFrame, sample, cnt: int) -> DataFrame:
    """F13 ``fd[sample] = cnt``: replace or insert one entry."""
    row = fd.sparkSession.createDataFrame([(sample, cnt)], "sample string, cnt long")
    return delete(fd, sample).unionByName(row)


def delete(fd: DataFrame, sample) -> DataFrame:
    """F13 ``del fd[sample]``."""
    return fd.select("sample", "cnt").where(~F.col("sample").eqNullSafe(F.lit(sample)))


def setdefault(fd: DataFrame, sample, cnt: int) -> DataFrame:
    """F13 ``fd.setdefault(sample, cnt)``: insert only when absent (anti join)."""
    row = fd.sparkSession.createDataFrame([(sample, cnt)], "sample string, cnt long")
    have = fd.select(F.col("sample").alias("_have"))
    missing = row.join(have, F.col("sample").eqNullSafe(F.col("_have")), "left_anti")
    return fd.select("sample", "cnt").unionByName(missing)
