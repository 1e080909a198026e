"""The detection job: raw text logs to a structured log, two detectors and fused labels.

``run_detection`` reads ``sysmonitor_trainset.txt`` and ``sysmonitor_testset.txt`` and writes
below the result folder

* ``structured_log`` (S7): Parquet with nested columns, partitioned by split;
* ``event_vectors`` (S9): the vectors of each (split, EventId);
* ``models`` (S10): miner, path model, parameter vocabulary and per-key forecaster, by
  ``fit_id``; a fit that is there already is used as it is, also for new test lines (Q17):
  they are matched to its templates, so an EventId means the same in every run;
* ``path_anomalies``, ``param_anomalies`` (M3, M6): the flagged rows of the test log, as
  CSV with nested columns as JSON (S6);
* ``labels`` (P13): the rule label of every test line, raised to 1 where a detector flagged it;
* ``finished`` (S8): the marker, written last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.operators import labels as L
from logweave.operators import params as PV
from logweave.plans import mining, models, params, path
from logweave.plans.labelling import label_lines
from logweave.sources.csvio import write_csv, write_marker
from logweave.sources.partitioned import write_partitioned


def flagged_rows(structured: DataFrame, flags: DataFrame) -> DataFrame:
    """J-b: test rows whose line was flagged, nested columns as JSON text for CSV."""
    rows = structured.where(F.col("split") == "test").join(flags.select("LineId").distinct(), "LineId", "left_semi")
    nested = ["param", "values", "ParameterList"]
    return rows.withColumns({c: F.to_json(c) for c in nested})


def path_flags(structured: DataFrame, model_path: str, fit_id: str, top_k: int) -> DataFrame:
    """M3: (LineId, level, rank) of the test rows whose event was not expected; the model is stored by ``fit_id``."""
    return path.log_path(structured, top_k, model_path=f"{model_path}/path", fit_id=fit_id).select("LineId", "level", "rank")


def param_flags(structured: DataFrame, model_path: str, vectors_path: str, fit_id: str, forecaster: str,
                threshold: float) -> DataFrame:
    """M6: (EventId, LineId, mse) of the test windows over the threshold; vectors and models are written."""
    spark = structured.sparkSession
    rows = params.rows_of(structured)
    vocab = models.load_or_fit(spark, f"{model_path}/vocabulary", fit_id, lambda: PV.vocabulary(rows))
    vec = params.param_vectors(rows, vocab=vocab)
    write_partitioned(vec.where("ok").drop("ok", "dim"), vectors_path, ["split", "EventId"], ["k"])
    model = models.load_or_fit(spark, f"{model_path}/{forecaster}", fit_id, lambda: params.fit_forecaster(vec.where("ok"), forecaster))
    return params.score_vectors(vec, forecaster, threshold, model).where("is_anomaly").select("EventId", "LineId", "mse")


def fused(labelled: DataFrame, *flags: DataFrame) -> DataFrame:
    """``labelled`` (line_id, Label), raised to 1 where any detector flagged the line."""
    found = flags[0].select(F.col("LineId").alias("line_id"))
    for f in flags[1:]:
        found = found.unionByName(f.select(F.col("LineId").alias("line_id")))
    return L.fuse_labels(labelled.select("line_id", "Label"), found)


def run_detection(spark: SparkSession, train_path: str, result_path: str, test_path: str, fit_id: str = "default",
                  forecaster: str = "ar1", top_k: int = path.PATH_TOP_K, threshold: float = PV.MSE_THRESHOLD) -> str:
    """E2 and E3 end to end; returns the result folder."""
    out = result_path.rstrip("/")
    lines = mining.text_mining_input(spark, {"train": f"{train_path}/sysmonitor_trainset.txt", "test": f"{test_path}/sysmonitor_testset.txt"})
    miner = f"{out}/models/miner"
    if not models.has_fit(spark, f"{miner}/mined", fit_id):
        mining.fit_templates(lines, miner, fit_id)
    fitted = mining.stored_matcher(spark, miner, fit_id)
    write_partitioned(mining.structure(lines, fitted), f"{out}/structured_log", ["split"], ["LineId"])
    structured = spark.read.parquet(f"{out}/structured_log")

    by_path = path_flags(structured, f"{out}/models", fit_id, top_k)
    write_csv(flagged_rows(structured, by_path), f"{out}/path_anomalies")
    by_param = param_flags(structured, f"{out}/models", f"{out}/event_vectors", fit_id, forecaster, threshold)
    write_csv(flagged_rows(structured, by_param), f"{out}/param_anomalies")
    test = structured.where(F.col("split") == "test").select(F.col("LineId").alias("line_id"), "line")
    write_csv(fused(label_lines(test, "sysmonitor"), by_path, by_param), f"{out}/labels")
    write_marker(spark, f"{out}/finished")
    return out
