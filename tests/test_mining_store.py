"""Stored miners (T12, S10) and streamed mining (R3, R4) against mining everything at once."""

import pytest
from pyspark.sql import functions as F

from logweave.operators import templates as T
from logweave.plans import mining as M
from logweave.streaming import templates as ST

from conftest import SF_SMALL


def catalogue(mined):
    return [(r.cluster_id, r.n_tokens, r.leaf_token, r.template, r.size) for r in T.catalogue(mined).orderBy("cluster_id").collect()]


def frame(spark, contents, start=0):
    return spark.createDataFrame([(c, start + i) for i, c in enumerate(contents)], "content string, pos long").withColumn(
        "pos", F.col("pos").cast("decimal(38,0)"))


def contents(n, salt):
    return [f"{w} job {i % 7} on host_{(i * salt) % 5} {'ok' if i % 3 else 'failed'}" for i in range(n)
            for w in ("alpha", "beta", f"w{chr(97 + (i * salt) % 20)}", "10.0.0.1", "")][: 4 * n]


def test_going_on_from_a_stored_fit_equals_one_fit(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "MAX_CHILDREN", 100)
    path, a, b = str(tmp_path / "store"), contents(30, 3), [*contents(40, 7), "gamma ray burst", "gamma ray gone"]
    first = catalogue(M.fit_templates(frame(spark, a), path, "a"))
    both = catalogue(M.fit_templates(frame(spark, b, len(a)), path, "ab", base="a"))
    whole = M.fit_templates(frame(spark, a + b), str(tmp_path / "whole"), "ab")
    assert both == catalogue(whole) and len(both) > len(first)
    # a fit that is run again replaces its own rows; the base stays
    assert catalogue(M.fit_templates(frame(spark, b, len(a)), path, "ab", base="a")) == both
    own, cat = M.stored_matcher(spark, path, "a")
    assert [(r.cluster_id, r.template) for r in cat.orderBy("cluster_id").collect()] == [(c[0], c[3]) for c in first]
    whole_own, _ = M.stored_matcher(spark, str(tmp_path / "whole"), "ab")
    ab_own, _ = M.stored_matcher(spark, path, "ab")
    assert sorted(ab_own.collect()) == sorted(whole_own.collect())
    lines = T.route(M.tokenized_lines(frame(spark, b)), own)
    assert T.match(lines, cat).where("match = 1").count() > 0
    with pytest.raises(ValueError, match="itself"):
        M.fit_templates(frame(spark, b), path, "a", base="a")


def test_leaves_of_the_earlier_lines_stay(spark):
    def rows(firsts, start):
        return spark.createDataFrame([(start + i, [f, "x"]) for i, f in enumerate(firsts)], "pos long, tokens array<string>")
    before = T.own_leaves(rows(["c", "b"], 0), max_children=4)
    after = T.own_leaves(rows(["a", "d", "b"], 2), max_children=4, before=before)
    assert sorted(r.first for r in after.collect()) == ["a", "b", "c"]


def test_three_triggers_equal_the_batch(spark, tmp_path):
    bodies = contents(30, 3)
    rows = [(i + 1, f"2024-01-01T00:00:{i % 60:02d}|svc|{c}") for i, c in enumerate(bodies)] + [(999, "no time"), (1000, "")]
    src = tmp_path / "in"
    for k in range(3):
        part = rows[k * 41:(k + 1) * 41]
        spark.createDataFrame(part, "line_id long, line string").coalesce(1).write.parquet(str(tmp_path / f"p{k}"))
    src.mkdir()
    import os
    import shutil
    for k in range(3):
        name = next(f for f in os.listdir(tmp_path / f"p{k}") if f.endswith(".parquet"))
        shutil.copy(tmp_path / f"p{k}" / name, src / f"{k}.parquet")
        os.utime(src / f"{k}.parquet", (1000 + k, 1000 + k))
    lines = spark.readStream.schema("line_id long, line string").option("maxFilesPerTrigger", 1).parquet(str(src))
    out = str(tmp_path / "out")
    ST.run_mining(lines, out, str(tmp_path / "checkpoint"))
    batch = M.fit_templates(ST.mining_lines(spark.createDataFrame(rows, "line_id long, line string")), str(tmp_path / "batch"), "x")
    want = catalogue(batch)
    got = ST.final_catalogue(spark, out).orderBy("cluster_id").collect()
    assert [(r.cluster_id, r.n_tokens, r.leaf_token, r.template, r.size) for r in got] == want
    progress = spark.read.parquet(f"{out}/progress").orderBy("batch").collect()
    assert [r.batch for r in progress] == [0, 1, 2] and sum(r.lines for r in progress) == len(bodies)
    assert progress[-1].clusters == len(want)
    # the change feed of the batches is the one of the batch miner
    feed = sorted((int(r.pos), r.change_type, r.template) for r in spark.read.parquet(f"{out}/changes").collect())
    assert feed == sorted((int(r.pos), r.change_type, " ".join(r.template)) for r in batch.where("kind = 'change'").collect())
    assert sum(r.changes for r in progress) == len(feed)


def test_a_replayed_micro_batch_changes_nothing(spark, tmp_path):
    rows = [(i + 1, f"2024-01-01T00:00:00|svc|{c}") for i, c in enumerate(contents(10, 3))]
    frames = [spark.createDataFrame(rows[:20], "line_id long, line string"), spark.createDataFrame(rows[20:], "line_id long, line string")]
    out = str(tmp_path / "out")
    for k in (0, 1, 1):
        ST.mine_batch(frames[k], k, out)
    assert sum(r.size for r in ST.final_catalogue(spark, out).collect()) == len(rows)
    ST.mine_batch(frames[0].limit(0), 2, out)  # a batch without lines stores nothing
    assert sum(r.size for r in ST.final_catalogue(spark, out).collect()) == len(rows)


def test_stream_queries_on_the_event_log(spark):
    got = ST.stream_templates(spark, SF_SMALL)
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert got.columns == ["cluster_id", "template", "size"] and got.agg(F.sum("size")).first()[0] == n
