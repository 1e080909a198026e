"""Execution-path detection job (M3) and the event sequences it runs on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.operators import nextevent as NE
from logweave.operators import nextevent_ml as ML
from logweave.operators.ngrams import row_ngrams
from logweave.operators.order import dense_by_id, dense_index
from logweave.plans.models import folder_exists
from logweave.session import materialize
from logweave.sources.derived import LINEITEM_ORDER, lineitem_events

# The split point of the lineitem sequence (ship date) and the
# reference's top-k for the path test.
LINEITEM_TRAIN_BEFORE = "1998-06-01"
PATH_TOP_K = 10


def code_ids(events: DataFrame, code: str = "code") -> DataFrame:
    """Integer event ids 1..V for the distinct codes, in code order.

    Ranked with the distributed dense index, so a large code vocabulary is
    not ranked in a single task.
    """
    ids = dense_index(events.select(code).distinct(), [code], out="EventId")
    return ids.withColumn("EventId", F.col("EventId").cast("int"))


def lineitem_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(split, seq, EventId, code, l_orderkey, l_linenumber)``, ``seq`` dense per split."""
    ev = lineitem_events(spark, sf_dir).withColumn(
        "split", F.when(F.col("l_shipdate") < F.lit(LINEITEM_TRAIN_BEFORE).cast("timestamp_ntz"), "train")
        .otherwise("test"))
    ids = code_ids(ev)
    ev = ev.join(ids, "code")
    seq = dense_index(ev.select("split", "code", "EventId", *LINEITEM_ORDER), LINEITEM_ORDER,
                      out="seq", groups=["split"], keep=["EventId", "code", "l_orderkey", "l_linenumber"])
    return seq.select("split", "seq", "EventId", "code", "l_orderkey", "l_linenumber")


def path_windows(seq: DataFrame) -> DataFrame:
    """4-gram windows per split: ``(split, seq, c1, c2, c3, y, ...)``."""
    return NE.windows(row_ngrams(seq, "seq", "EventId", 4, groups=["split"]))


def class_count(seq: DataFrame, split: str = "train") -> DataFrame:
    """K = max event id + 1 of the fit split (one row)."""
    return seq.where(F.col("split") == split).agg((F.max("EventId") + 1).alias("K"))


def execution_path(seq: DataFrame, top_k: int = PATH_TOP_K, weight: str = "count",
                   model_path: str | None = None, fit_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """M3: fit on the train split (or reuse the stored model of ``fit_id``),
    score the test split; returns (model, scored test windows)."""
    win = path_windows(seq)

    def fit():
        return NE.fit(win.where(F.col("split") == "train"), weight=weight)

    if model_path and fit_id:
        from logweave.plans.models import load_or_fit
        model = load_or_fit(seq.sparkSession, model_path, fit_id, fit)
    else:
        model = materialize(fit(), "path-model")  # scoring reads it more than once
    scored = NE.score(win.where(F.col("split") == "test"), model, top_k)
    return model, scored


def log_sequence(structured: DataFrame) -> DataFrame:
    """The structured log's known events as a sequence, renumbered per split without the unmatched lines (Q26)."""
    known = structured.where(F.col("EventId").isNotNull()).select("split", "LineId", "EventId")
    return dense_by_id(materialize(known, "log-sequence"), "LineId", out="seq", groups=["split"])


def log_path(structured: DataFrame, top_k: int = PATH_TOP_K, weight: str = "count", model_path: str | None = None,
             fit_id: str | None = None) -> DataFrame:
    """M3 on the mined log: the structured test rows whose event is not among the ``top_k``
    expected after the three events before it, with level and rank."""
    _, scored = execution_path(log_sequence(structured), top_k, weight, model_path, fit_id)
    flagged = scored.where("is_anomaly").select("split", "LineId", "level", "rank")
    return structured.join(flagged, ["split", "LineId"])


def null_events(structured: DataFrame) -> DataFrame:
    """Q26: lines without an event per split, which the path model leaves out."""
    return structured.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("EventId").isNull().cast("long")).alias("n_unmatched"))


def learnt_path(seq: DataFrame, top_k: int = PATH_TOP_K, model_path: str | None = None, fit_id: str = "default",
                iterations: int = ML.ITERATIONS) -> tuple[DataFrame, DataFrame]:
    """M1 / M2 in the learnt form: (scored test windows, accuracy of both models on them).

    With ``model_path`` a model stored as ``fit_id`` is loaded, or the new one saved."""
    win = materialize(path_windows(seq).select("split", "seq", *NE.CTX, "y"), "path-windows")
    train, test = (win.where(F.col("split") == s) for s in ("train", "test"))
    spark = seq.sparkSession
    if model_path and folder_exists(spark, f"{model_path}/fit_id={fit_id}"):
        model = ML.load(model_path, fit_id)
    else:
        classes = class_count(win.select("split", F.greatest(*NE.CTX, "y").alias("EventId"))).first()["K"]
        model = ML.fit(train, classes, iterations=iterations)
        if model_path:
            ML.save(model, model_path, fit_id)
    scored = ML.score(test, model, top_k)
    counted = NE.score(test, materialize(NE.fit(train), "path-model"), top_k)
    both = (NE.accuracy(scored, top_k).withColumn("model", F.lit("learnt"))
            .unionByName(NE.accuracy(counted, top_k).withColumn("model", F.lit("counts"))))
    return scored, both
