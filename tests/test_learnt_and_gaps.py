"""The learnt next-event model and the numeric gap model against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from logweave.operators import gaps as G
from logweave.operators import nextevent as NE
from logweave.operators import nextevent_ml as ML
from logweave.plans import path as PATH

CTX = "split string, seq long, EventId int"


def sequence(spark):
    rnd = random.Random(4)
    rows = []
    for split, n in (("train", 600), ("test", 150)):
        for i in range(n):
            rows.append((split, i + 1, (i % 4) + 1 if rnd.random() < .95 else 5))
    return spark.createDataFrame(rows, CTX)


def test_learnt_model_ranks_saves_and_loads(spark, tmp_path):
    seq, path = sequence(spark), str(tmp_path / "mlp")
    scored, both = PATH.learnt_path(seq, top_k=2, model_path=path, fit_id="a")
    acc = {r.model: r for r in both.collect()}
    assert acc["learnt"].n_windows == acc["counts"].n_windows == 147
    assert acc["learnt"].acc_topk > 0.8 and acc["counts"].acc_top1 > 0.7
    model = ML.load(path, "a")
    assert model.numClasses == 6
    # ranks against sorting the outputs of the net in Python
    raw = {tuple(r[:3]): r.p for r in model.setRawPredictionCol("_raw").transform(
        ML._features(scored.select(*NE.CTX).distinct(), 6)).select(*NE.CTX, vector_to_array("_raw").alias("p")).collect()}
    for r in scored.collect():
        order = sorted(range(6), key=lambda c: (-raw[r.c1, r.c2, r.c3][c], c))
        assert r["rank"] == order.index(r.y) + 1 and r.is_anomaly == (r["rank"] > 2)
    again, _ = PATH.learnt_path(seq, top_k=2, model_path=path, fit_id="a")
    cols = ["seq", "rank", "is_anomaly"]
    assert sorted(again.select(cols).collect()) == sorted(scored.select(cols).collect())
    # an event id that no class stands for is unexpected
    odd = ML.score(spark.createDataFrame([(1, 2, 3, 77)], "c1 int, c2 int, c3 int, y int"), model, 6).first()
    assert odd["rank"] is None and odd.is_anomaly


def test_gap_quartiles_and_distances(spark):
    rnd = random.Random(1)
    train = [(e, rnd.choice([0, 1, 2, 3, 50]) if e < 3 else 7) for e in (1, 2, 3) for _ in range(101 * e)]
    df = spark.createDataFrame(train, "EventId int, gap long").repartition(5)
    model = {r.EventId: (r.n_rows, r.low, r.mid, r.high) for r in G.fit_gaps(df).collect()}
    for e in (1, 2, 3):
        v = sorted(g for k, g in train if k == e)
        assert model[e] == (len(v), *[v[math.ceil(p * len(v)) - 1] for p in (.25, .5, .75)])
    rows = spark.createDataFrame([(3, 7), (3, 10), (3, 11), (9, 1), (1, None)], "EventId int, gap long")
    got = {(r.EventId, r.gap): (r.distance, r.is_anomaly) for r in G.gap_distance(rows, G.fit_gaps(df)).collect()}
    assert got == {(3, 7): (0.0, False), (3, 10): (3.0, False), (3, 11): (4.0, True), (1, None): (None, None)}


def test_sketch_error_stays_in_its_bound(spark):
    n, accuracy = 200_000, 100
    df = spark.range(n).select(F.lit(1).alias("EventId"), ((F.col("id") * 7919) % n).alias("gap")).repartition(8)
    r = G.fit_gaps(df, accuracy=accuracy).first()
    for got, p in ((r.low, .25), (r.mid, .5), (r.high, .75)):
        assert abs(got - p * n) <= n / accuracy + 1


@pytest.mark.parametrize("weight", ["count", "distinct"])
def test_accuracy_on_fit_of_both_weights(spark, weight):
    win = PATH.path_windows(sequence(spark)).where("split = 'train'")
    model = NE.fit(win, weight)
    fitted = win if weight == "count" else win.select(*NE.CTX, "y").distinct()
    assert NE.accuracy_on_fit(model, 2).collect() == NE.accuracy(NE.score(fitted, model, 2), 2).collect()


def test_gradient_of_weighted_grams_matches_differences():
    rng = np.random.default_rng(5)
    layers = [3, 4, 5]
    w = rng.normal(size=4 * 4 + 5 * 5)
    context = np.array([[1, 2, 3], [4, 0, 2]])
    grams = context, np.array([0, 0, 1]), np.array([1, 4, 2]), np.array([3.0, 1.0, 2.0])
    loss, g = ML.loss_and_gradient(w, layers, *grams)
    for i in range(len(w)):
        e = np.zeros_like(w)
        e[i] = 1e-6
        hi, low = (ML.loss_and_gradient(w + s * e, layers, *grams)[0] for s in (1, -1))
        assert (hi - low) / 2e-6 == pytest.approx(g[i], abs=1e-6)
    # a weight is that many windows
    each = context[[0, 0, 0, 0, 1, 1]], np.arange(6), np.array([1, 1, 1, 4, 2, 2]), np.ones(6)
    again, h = ML.loss_and_gradient(w, layers, *each)
    assert again == pytest.approx(loss) and np.allclose(g, h)


@pytest.mark.parametrize("parts, times", [(1, 1), (3, 7)])
def test_learnt_model_steps_as_mllib_does(spark, parts, times):
    """Also where partitions end with a shorter block."""
    win = PATH.path_windows(sequence(spark)).where("split = 'train'").select(*NE.CTX, "y").withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(times))))
    win = win.repartition(parts).localCheckpoint()
    rows = ML._features(win, 6).select("_x", F.col("y").cast("double").alias("_label"))
    for steps in (0, 1, 6):
        net = MultilayerPerceptronClassifier(featuresCol="_x", labelCol="_label", layers=[3, 32, 6], maxIter=steps, seed=ML.SEED, blockSize=512)
        want = net.fit(rows).weights.toArray()
        assert np.allclose(ML.fit(win, 6, iterations=steps).weights.toArray(), want, atol=1e-6)


def test_training_reads_the_distinct_grams_alone(spark, monkeypatch):
    """fifty times the windows are the same few rows for every step."""
    read, plain = [], ML.materialize

    def noted(df, name):
        out = plain(df, name)
        read.append(sum(len(r.y) // 4 for r in out.collect()))
        return out

    monkeypatch.setattr(ML, "materialize", noted)
    win = PATH.path_windows(sequence(spark)).where("split = 'train'").select(*NE.CTX, "y").localCheckpoint()
    for times in (1, 50):
        ML.fit(win.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(times)))), 6, iterations=1)
    assert read == [win.distinct().count()] * 2 and read[0] < 300


def test_minimize_finds_the_bottom():
    f = lambda w: (float(((w - 3) ** 2 * [1, 50]).sum() + (w[0] - 3) ** 4), 2 * (w - 3) * [1, 50] + [4 * (w[0] - 3) ** 3, 0])
    assert np.allclose(ML.minimize(f, np.array([-4.0, 9.0]), 60), 3, atol=1e-2)
    assert np.array_equal(ML.minimize(f, np.array([-4.0, 9.0]), 0), [-4.0, 9.0])
