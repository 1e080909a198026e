"""Row order at scale: dense positions, running sums and lag windows.

Rows have no order in Spark, and ``Window.orderBy`` without a partition runs
in one task. These helpers keep the work spread out:

* ``dense_index``: global sort (range partitioning), ids inside each sorted
  partition, a per-partition count table (one row per partition, a proven
  bound) turned into offsets and broadcast back.
* ``dense_by_id``: positions of rows that are numbered with holes already, by
  chunks of the numbers; no sort of the whole.
* ``running_sum``: two-level prefix sum over fixed-size chunks of a dense index.
* ``with_lags``: lags over a dense index by fixed-size chunks plus a copied
  halo of the previous ``n`` rows, so each chunk is an independent window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.session import ensure_checkpoint_dir

DEFAULT_CHUNK = 1 << 16  # rows per window partition key (halo cost: n rows per chunk)


def _sort_cols(keys, ascending):
    if ascending is None:
        ascending = [True] * len(keys)
    return [F.col(k).asc_nulls_first() if a else F.col(k).desc_nulls_last() for k, a in zip(keys, ascending)]


def dense_index(df: DataFrame, keys, ascending=None, out: str = "seq", groups=(),
                checkpoint: bool = True, keep=None) -> DataFrame:
    """Add a dense 1-based position ``out`` in ``keys`` order (restarting per ``groups``).

    The sort key should be a total order; equal keys get an arbitrary but
    fixed order. With ``checkpoint`` the sorted, id-tagged rows are written
    once as a table in the checkpoint folder, so the count pass and the
    numbering pass read identical rows and a lost executor cannot renumber
    them. ``keep`` limits the columns carried past the sort.
    """
    from logweave.session import materialize
    groups = list(groups)
    order = _sort_cols(groups, None) + _sort_cols(list(keys), ascending)
    tagged = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    if keep is not None:
        tagged = tagged.select(*dict.fromkeys(groups + list(keep) + ["_mid"]))
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
        tagged = materialize(tagged, "dense-index")
    tagged = tagged.withColumn("_p", F.shiftright(F.col("_mid"), 33))
    # rows of one group inside one sorted partition are contiguous
    counts = tagged.groupBy("_p", *groups).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.partitionBy(*groups).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    # one row per (sorted partition, group present in it). Without groups that
    # is one row per partition, a known bound, so it is broadcast; with groups
    # the join is left to the planner
    offsets = counts.select("_p", *[F.col(g).alias(f"_g_{g}") for g in groups], "_m0",
                            F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    if not groups:
        offsets = F.broadcast(offsets)
    cond = tagged["_p"] == offsets["_p"]
    for g in groups:
        cond = cond & tagged[g].eqNullSafe(offsets[f"_g_{g}"])
    return (tagged.join(offsets, cond)
            .withColumn(out, F.col("_off") + (F.col("_mid") - F.col("_m0")) + 1)
            .drop("_p", "_m0", "_off", "_mid", *[f"_g_{g}" for g in groups]))


def dense_by_id(df: DataFrame, key: str, out: str = "seq", groups=(), counted: DataFrame | None = None,
                chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Add a dense 1-based position ``out`` in the order of the unique long ``key`` (restarting per ``groups``).

    For rows that carry a line number already (P20: what is left of numbered
    lines). Rows meet in chunks of ``chunk`` consecutive numbers; a chunk's
    rows are numbered on their own and shifted by the rows of the chunks
    before it. No sort of the whole, no sampling and no written copy: one hash
    exchange, and a table of one row per chunk (and group in it). ``counted``
    is a cheaper table with the same (groups, key) rows to count from.
    """
    groups = list(groups)
    place = F.floor(F.col(key) / chunk).alias("_c")
    counts = (counted if counted is not None else df).groupBy(*groups, place).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(*[F.col(g).alias(f"_g_{g}") for g in groups], F.col("_c").alias("_cc"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*groups, "_c").orderBy(key)
    rows = df.withColumn("_c", place).withColumn("_r", F.row_number().over(inside))
    cond = rows["_c"] == shift["_cc"]
    for g in groups:
        cond = cond & rows[g].eqNullSafe(shift[f"_g_{g}"])
    return (rows.join(shift, cond).withColumn(out, F.col("_before") + F.col("_r"))
            .drop("_c", "_r", "_cc", "_before", *[f"_g_{g}" for g in groups]))


def running_sum(df: DataFrame, idx: str, value: str, out: str, groups=(), chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Running sum of ``value`` in ``idx`` order (``idx`` dense from 1 per group)."""
    groups = list(groups)
    c = F.floor((F.col(idx) - 1) / chunk)
    t = df.withColumn("_c", c)
    tot = t.groupBy(*groups, "_c").agg(F.sum(value).alias("_ct"))
    wo = Window.partitionBy(*groups).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*groups, "_c", F.coalesce(F.sum("_ct").over(wo), F.lit(0)).alias("_coff"))
    wi = Window.partitionBy(*groups, "_c").orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)
    return (t.join(tot, groups + ["_c"])
            .withColumn(out, F.col("_coff") + F.sum(value).over(wi))
            .drop("_c", "_coff"))


def with_lags(df: DataFrame, idx: str, cols, n: int, groups=(), chunk: int = DEFAULT_CHUNK,
              suffix: str = "_lag") -> DataFrame:
    """Add ``<col><suffix><k>`` = value ``k`` rows earlier (k = 1..n) in ``idx`` order.

    ``idx`` must be dense from 1 within each group. Rows are cut into chunks of
    ``chunk`` positions; the last ``n`` rows of a chunk are copied into the
    next one as context (halo) and dropped again after the window.
    """
    groups = list(groups)
    cols = [cols] if isinstance(cols, str) else list(cols)
    pos0 = F.col(idx) - 1
    base = df.withColumn("_c", F.floor(pos0 / chunk)).withColumn("_halo", F.lit(False))
    halo = (df.where(F.pmod(pos0, F.lit(chunk)) >= chunk - n)
            .withColumn("_c", F.floor(pos0 / chunk) + 1).withColumn("_halo", F.lit(True)))
    u = base.unionByName(halo)
    w = Window.partitionBy(*groups, "_c").orderBy(idx)
    for k in range(1, n + 1):
        for c in cols:
            u = u.withColumn(f"{c}{suffix}{k}", F.lag(c, k).over(w))
    return u.where(~F.col("_halo")).drop("_c", "_halo")


def time_gap(df: DataFrame, idx: str, epoch: str = "epoch", groups=(), out: str = "time_gap",
             chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Whole seconds since the previous row; the first row of a group gets 0."""
    lagged = with_lags(df, idx, epoch, 1, groups=groups, chunk=chunk, suffix="_prev")
    return (lagged.withColumn(out, F.coalesce(F.col(epoch) - F.col(f"{epoch}_prev1"), F.lit(0)).cast("long"))
            .drop(f"{epoch}_prev1"))
