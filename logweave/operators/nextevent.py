"""Next-event model for execution paths.

The reference trains a neural classifier on (3 previous events -> next
event). Here the model is a table of context counts, fitted and applied with
joins and aggregates only:

* fit: counts of ``(c1,c2,c3,y)`` in one pass, rolled up to ``(c2,c3,y)``,
  ``(c3,y)`` and ``(y)``; candidates of each context ranked by count, then event id.
* score: each window uses the longest context seen in training; it is an
  anomaly when its true next event is not among the top ``k`` candidates
  (or was never seen after that context).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CTX = ["c1", "c2", "c3"]


def windows(grams: DataFrame) -> DataFrame:
    """4-grams ``g1..g4`` to ``(c1, c2, c3, y)``."""
    return (grams.withColumnRenamed("g1", "c1").withColumnRenamed("g2", "c2")
            .withColumnRenamed("g3", "c3").withColumnRenamed("g4", "y"))


def scale_context(win: DataFrame, k_classes: DataFrame) -> DataFrame:
    """Context divided by K (one-row DataFrame ``K``, a scalar subquery), as the model input."""
    k = k_classes.select("K").scalar()
    return win.withColumns({f"x{i}": F.col(f"c{i}") / k for i in (1, 2, 3)})


def fit(train_windows: DataFrame, weight: str = "count") -> DataFrame:
    """M1: model table ``(level, c1, c2, c3, y, cnt, rank)``.

    ``weight='distinct'`` counts each distinct 4-gram once (the reference's
    training set), ``'count'`` uses occurrence counts.
    """
    w = train_windows.select(*CTX, "y")
    if weight == "distinct":
        w = w.distinct()
    # one pass over the windows; the shorter contexts are rolled up from the
    # (small) table of distinct 4-grams
    full = w.groupBy(*CTX, "y").agg(F.count(F.lit(1)).alias("n"))
    model = (full.rollup("y", "c3", "c2", "c1")
             .agg(F.sum("n").alias("cnt"), F.grouping("y").alias("_gy"),
                  (3 - F.grouping("c1") - F.grouping("c2") - F.grouping("c3")).cast("int").alias("level"))
             .where(F.col("_gy") == 0).select("level", *CTX, "y", "cnt"))
    rank_w = Window.partitionBy("level", *CTX).orderBy(F.col("cnt").desc(), F.col("y").asc())
    return model.withColumn("rank", F.row_number().over(rank_w).cast("long"))


def score(test_windows: DataFrame, model: DataFrame, top_k: int) -> DataFrame:
    """M2: add ``level`` (longest context seen in training), ``rank`` of the
    true next event in it (null when unseen) and ``is_anomaly``.

    Each distinct 4-gram of the test windows is scored once: it is looked up
    under its four contexts together, one join for the contexts that training
    has seen and one for the rank of the next event after them; the longest
    seen one counts. The windows then meet their 4-gram's score in one join.
    ``model`` is read three times: write it first.
    """
    grams = test_windows.select(*CTX, "y").distinct()
    looked_up = F.array(*[F.struct(F.lit(level).alias("level"), *[
        (F.col(c) if i >= 3 - level else F.lit(None).cast(grams.schema[c].dataType)).alias(f"_{c}") for i, c in enumerate(CTX)])
        for level in range(4)])
    t = grams.select("*", F.inline(looked_up))
    same = lambda m: ((t["level"] == m["level"]) & t["_c1"].eqNullSafe(m["c1"])
                      & t["_c2"].eqNullSafe(m["c2"]) & t["_c3"].eqNullSafe(m["c3"]))
    # every context has one candidate of rank 1; with no context any model has been seen
    seen = model.where((F.col("rank") == 1) & (F.col("level") > 0)).select("level", *CTX)
    known = t.where(F.col("level") > 0).join(seen, same(seen), "left_semi").unionByName(t.where(F.col("level") == 0))
    ranks = model.select(F.col("level").alias("_l"), *[F.col(c).alias(f"_m{c}") for c in CTX], F.col("y").alias("_y"), "rank")
    hit = known.join(ranks, (F.col("level") == F.col("_l")) & (F.col("y") == F.col("_y")) & F.col("_c1").eqNullSafe(F.col("_mc1"))
                     & F.col("_c2").eqNullSafe(F.col("_mc2")) & F.col("_c3").eqNullSafe(F.col("_mc3")), "left")
    scored = hit.groupBy(*CTX, "y").agg(F.max(F.struct("level", "rank")).alias("_b")).select(*CTX, "y", "_b.level", "_b.rank")
    return (test_windows.join(scored, [*CTX, "y"])
            .withColumn("is_anomaly", F.col("rank").isNull() | (F.col("rank") > F.lit(top_k))))


def accuracy(scored: DataFrame, top_k: int) -> DataFrame:
    """M7: share of windows whose true next event ranks first / within top k."""
    return scored.agg(
        F.count(F.lit(1)).alias("n_windows"),
        F.sum(F.when(F.col("rank") == 1, 1).otherwise(0)).cast("long").alias("n_top1"),
        F.sum(F.when(F.col("rank") <= top_k, 1).otherwise(0)).cast("long").alias("n_topk"),
    ).select("n_windows", "n_top1", "n_topk",
             F.round(F.col("n_top1") / F.col("n_windows"), 6).alias("acc_top1"),
             F.round(F.col("n_topk") / F.col("n_windows"), 6).alias("acc_topk"))


def accuracy_on_fit(model: DataFrame, top_k: int) -> DataFrame:
    """M7 on the training windows themselves, from the model table alone.

    Every training window is one occurrence of a full 4-gram, counted in the
    level-3 rows, and its own context is always seen: summing ``cnt`` over
    level-3 rows by rank gives the same numbers as scoring each window, with
    no join back to the windows. A model of weight ``distinct`` counts each
    distinct 4-gram once, so this is its accuracy on the distinct 4-grams
    (the set it was fitted on), not on all windows.
    """
    m = model.where(F.col("level") == 3)
    return m.agg(
        F.sum("cnt").cast("long").alias("n_windows"),
        F.sum(F.when(F.col("rank") == 1, F.col("cnt")).otherwise(0)).cast("long").alias("n_top1"),
        F.sum(F.when(F.col("rank") <= top_k, F.col("cnt")).otherwise(0)).cast("long").alias("n_topk"),
    ).select("n_windows", "n_top1", "n_topk",
             F.round(F.col("n_top1") / F.col("n_windows"), 6).alias("acc_top1"),
             F.round(F.col("n_topk") / F.col("n_windows"), 6).alias("acc_topk"))
