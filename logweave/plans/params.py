"""Parameter-value anomaly job (E3): vectors per event key, forecasts, MSE flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.operators import params as PV
from logweave.plans.mining import structured_event_log
from logweave.session import materialize


def param_rows(spark: SparkSession, sf_dir: str, mode: str = "tokens", structured: DataFrame | None = None) -> DataFrame:
    """Structured X1 rows with ``k`` (position in key) and the two parameter texts.

    ``structured``: the structured log, where the caller has it already."""
    return rows_of(structured if structured is not None else structured_event_log(spark, sf_dir), mode)


def rows_of(structured: DataFrame, mode: str = "tokens") -> DataFrame:
    """Rows of a structured log with ``k`` and parameter texts."""
    s = structured.select("split", "LineId", "seq", "EventId", "param", "values",
                                                   "time_gap", "Content")
    rows = PV.param_texts(PV.keyed_rows(s), mode)
    # read by both the vocabulary fit and the encoding: written once
    return materialize(rows.select("split", "EventId", "k", "LineId", "seq", "Content", "texts"), "param-rows")


def param_vectors(rows: DataFrame, fit_on: str = "both", vocab: DataFrame | None = None) -> DataFrame:
    """Encoded vectors, ragged rows marked (Q27); written once, as
    windows, key counts and models all read them. ``vocab``: a stored vocabulary."""
    vocab = PV.vocabulary(rows, fit_on) if vocab is None else vocab
    return materialize(PV.ragged_check(PV.encode(rows, vocab)), "param-vectors")


def fit_forecaster(vec: DataFrame, forecaster: str) -> DataFrame:
    """M5: the model table of a forecaster, one row per (EventId, dim); for ``mean`` the keys that may be scored."""
    keys = PV.trainable(vec).select("EventId")
    train = vec.where(F.col("split") == "train").join(keys, "EventId", "left_semi")
    if forecaster == "mean":
        return keys
    if forecaster == "ar1":
        return PV.fit_ar1(train)
    if forecaster == "ar3":
        return PV.fit_ar3(PV.windows(train))
    raise ValueError(forecaster)


def forecast(test: DataFrame, model: DataFrame, forecaster: str) -> DataFrame:
    """Windows of the keys that have a model, with their forecast."""
    test = test.join(model.select("EventId").distinct(), "EventId", "left_semi")
    if forecaster == "mean":
        return PV.predict_mean(test)
    return (PV.predict_ar1 if forecaster == "ar1" else PV.predict_ar3)(test, model)


def score_vectors(vec: DataFrame, forecaster: str = "mean", threshold: float = PV.MSE_THRESHOLD,
                  model: DataFrame | None = None) -> DataFrame:
    """M6: mean squared error of the test windows; ``model``: a stored forecaster."""
    ok = vec.where("ok")
    model = fit_forecaster(ok, forecaster) if model is None else model
    test = PV.windows(ok).where(F.col("split") == "test")
    return PV.mse(forecast(test, model, forecaster)).withColumn("is_anomaly", F.col("mse") > F.lit(threshold))


def param_value(rows: DataFrame, forecaster: str = "mean", threshold: float = PV.MSE_THRESHOLD, fit_on: str = "both") -> DataFrame:
    """M6: score test windows of keys that have a model; ``is_anomaly`` when MSE > threshold."""
    return score_vectors(param_vectors(rows, fit_on), forecaster, threshold)
