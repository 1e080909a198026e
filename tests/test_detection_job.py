"""The detection job on text files: its outputs, stored models, and partitioned sinks."""

import os
import random

from pyspark.sql import functions as F

from logweave.job import main
from logweave.plans import detection as D
from logweave.plans import models
from logweave.plans import params as PP
from logweave.sources.partitioned import read_partition, write_partitioned

BODIES = ["probe|fan started on unit alpha", "probe|temperature report from unit alpha now", "svc|session opened", "svc|session closed by peer beta"]


def log_text(n, seed, odd=()):
    """The bodies in turn, one line a second; ``odd`` positions repeat the body before them, 5000 seconds late."""
    rnd, out, t = random.Random(seed), [], 0
    for i in range(n):
        t += 5000 if i in odd else 1
        body = BODIES[(i - (i in odd)) % len(BODIES)]
        out.append(f"2024-01-{1 + t // 86400:02d}T{t // 3600 % 24:02d}:{t // 60 % 60:02d}:{t % 60:02d}|{body}")
        if rnd.random() < .05:
            out.append("no time at all")
    return "\n".join(out) + "\n"


def folders(tmp_path, test_text):
    for split, text in (("train", log_text(120, 1)), ("test", test_text)):
        (tmp_path / split).mkdir(exist_ok=True)
        (tmp_path / split / f"sysmonitor_{split}set.txt").write_text(text)
    return str(tmp_path / "train"), str(tmp_path / "out"), str(tmp_path / "test")


def csv(spark, path):
    return spark.read.option("header", True).csv(path).collect()


def test_detection_job_writes_all_outputs_and_reuses_its_models(spark, tmp_path):
    train, out, test = folders(tmp_path, log_text(60, 2, odd={30}))
    D.run_detection(spark, train, out, test, forecaster="ar1", top_k=1, threshold=0.0)
    s = spark.read.parquet(f"{out}/structured_log")
    assert dict(s.dtypes)["ParameterList"].startswith("struct") and {r.split for r in s.select("split").distinct().collect()} == {"train", "test"}
    ids = {r.EventId for r in s.select("EventId").distinct().collect()}
    assert len(ids) == len(BODIES)
    # the odd line repeats the event before it: it and the windows that look back on it are unexpected
    rows = {r.LineId: r for r in s.where("split = 'test'").collect()}
    order = sorted(rows)
    odd = order[30]
    assert rows[odd].Content == rows[order[29]].Content
    by_path = {int(r.LineId) for r in csv(spark, f"{out}/path_anomalies")}
    want = {r.LineId for r in D.path_flags(s, f"{out}/other", "x", 1).collect()}
    assert by_path == want and odd in by_path and not by_path & set(order[:30])
    assert all(r.ParameterList.startswith("{") for r in csv(spark, f"{out}/path_anomalies"))
    by_param = {int(r.LineId) for r in csv(spark, f"{out}/param_anomalies")}
    direct = PP.param_value(PP.rows_of(s), "ar1", threshold=0.0).where("is_anomaly")
    assert by_param == {r.LineId for r in direct.collect()}
    labels = {int(r.line_id): int(r.Label) for r in csv(spark, f"{out}/labels")}
    assert set(labels) == set(rows) and {i for i, v in labels.items() if v} == by_path | by_param
    assert [r.result for r in csv(spark, f"{out}/finished")] == ["TRUE"]
    # vectors: a folder per split and event, as many rows as the structured log
    assert sorted(os.listdir(f"{out}/event_vectors/split=test")) == sorted(f"EventId={i}" for i in ids)
    assert spark.read.parquet(f"{out}/event_vectors").count() == s.count()
    one = read_partition(spark, f"{out}/event_vectors", split="test", EventId=min(ids))
    assert one.count() == s.where(f"split = 'test' and EventId = {min(ids)}").count()

    # other test lines under the same fit: nothing is fitted again, templates keep their ids
    def stored():
        return {m: sorted(map(str, spark.read.parquet(f"{out}/models/{m}").collect()))
                for m in ("path", "vocabulary", "ar1", "miner/mined", "miner/own")}
    before = stored()
    folders(tmp_path, log_text(40, 3) + "2024-01-02T00:00:00|svc|something that nobody has seen\n")
    assert main(["detect", train, out, test, "default"]) == 0
    assert stored() == before
    again = spark.read.parquet(f"{out}/structured_log").where("split = 'test'")
    assert again.where("match = 0").select("Content").collect()[0].Content == "svc|something that nobody has seen"
    assert {(r.Content, r.EventId) for r in again.where("match = 1").collect()} == {(r.Content, r.EventId) for r in rows.values()}
    # another fit is fitted
    D.run_detection(spark, train, out, test, fit_id="second")
    assert models.has_fit(spark, f"{out}/models/path", "second") and models.has_fit(spark, f"{out}/models/path", "default")


def test_job_usage():
    assert main([]) == 2 and main(["detect", "a", "b"]) == 2


def test_a_hot_partition_is_many_files_and_a_second_run_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(20_000).select(F.when(F.col("id") < 18_000, "hot").otherwise("cold").alias("key"), "id")
    write_partitioned(df, path, ["key"], ["id"], max_rows=5_000)
    hot = [f for f in os.listdir(f"{path}/key=hot") if f.endswith(".parquet")]
    assert len(hot) >= 4
    assert max(spark.read.parquet(f"{path}/key=hot/{f}").count() for f in hot) <= 5_000
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(20_000))
    write_partitioned(df.where("key = 'hot' and id < 10"), path, ["key"], ["id"])
    assert spark.read.parquet(path).groupBy("key").count().orderBy("key").collect() == [("cold", 2_000), ("hot", 10)]


def test_a_broken_model_folder_is_an_error_not_a_refit(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "part-0.parquet").write_text("this is no parquet file")
    assert not models.has_fit(spark, str(tmp_path / "none"), "a")
    try:
        models.has_fit(spark, str(tmp_path / "m"), "a")
    except Exception:  # noqa: BLE001 - any reader error will do
        return
    raise AssertionError("a broken folder was taken for a missing one")
