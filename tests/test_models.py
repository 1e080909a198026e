"""Detectors against plain-Python brute force on small inputs, and stream = batch."""

from collections import Counter

from pyspark.sql import functions as F

from logweave.operators import params as PV
from logweave.plans import path as PATH
from logweave.plans.labelling import bucket_label_table
from logweave.sources.derived import event_log_lines
from logweave.streaming import labels as SL

from conftest import SF_SMALL


def brute_force_path(train, test, k):
    grams = [tuple(train[i - 3:i + 1]) for i in range(3, len(train))]
    counts = {lv: Counter() for lv in (3, 2, 1, 0)}
    for g in grams:
        for lv in (3, 2, 1, 0):
            counts[lv][(g[3 - lv:3], g[3])] += 1
    ranks = {}
    for lv in (3, 2, 1, 0):
        by_ctx = {}
        for (ctx, y), c in counts[lv].items():
            by_ctx.setdefault(ctx, []).append((-c, y))
        for ctx, lst in by_ctx.items():
            for r, (_, y) in enumerate(sorted(lst), 1):
                ranks[(lv, ctx, y)] = r
    seen = {lv: {ctx for (ctx, _) in counts[lv]} for lv in (3, 2, 1, 0)}
    flags = []
    for i in range(3, len(test)):
        c, y = tuple(test[i - 3:i]), test[i]
        lv = next(lv for lv in (3, 2, 1, 0) if c[3 - lv:] in seen[lv] or lv == 0)
        r = ranks.get((lv, c[3 - lv:], y))
        if r is None or r > k:
            flags.append(i + 1)
    return flags


def test_path_model_equals_brute_force(spark):
    seq = PATH.lineitem_sequence(spark, SF_SMALL)
    rows = seq.select("split", "seq", "EventId").collect()
    by = {s: [e for _, e in sorted((r.seq, r.EventId) for r in rows if r.split == s)] for s in ("train", "test")}
    _, scored = PATH.execution_path(seq, top_k=10)
    got = sorted(r.seq for r in scored.where("is_anomaly").select("seq").collect())
    assert got == brute_force_path(by["train"], by["test"], 10)


def test_vocabulary_ranks_and_encoding(spark):
    rows = spark.createDataFrame([
        ("train", 1, 1, 10, ["b a", "7"]),
        ("train", 1, 2, 11, ["a c", "7"]),
        ("test", 1, 1, 12, ["c c", ""]),
    ], "split string, EventId int, k long, LineId long, texts array<string>")
    v = {r.word: r.word_id for r in PV.vocabulary(rows).collect()}
    # counts: a2 c3 b1 7x2 -> c(3) first; a, 7 tie at 2 -> a seen first
    assert v == {"c": 1, "a": 2, "7": 3, "b": 4}
    vec = {r.LineId: r.vec for r in PV.encode(rows, PV.vocabulary(rows)).collect()}
    assert vec == {10: [4, 2, 3], 11: [2, 1, 3], 12: [1, 1, 0]}


def test_mean_forecast_mse(spark):
    vecs = spark.createDataFrame([("test", 1, k, 100 + k, [v, 0]) for k, v in enumerate([1, 2, 3, 40, 5], 1)],
                                 "split string, EventId int, k long, LineId long, vec array<int>")
    win = PV.windows(vecs)
    out = {r.LineId: r.mse for r in PV.mse(PV.predict_mean(win)).collect()}
    assert out == {104: ((40 - 2) ** 2) / 2, 105: ((5 - 15) ** 2) / 2}


def test_stream_equals_batch(spark):
    lines = event_log_lines(spark, SF_SMALL)
    batch = sorted(tuple(r) for r in bucket_label_table({"messages": lines, "sysmonitor": lines}).collect())
    stream = sorted(tuple(r) for r in SL.stream_bucket_labels(spark, SF_SMALL).collect())
    assert batch == stream


def test_model_table_reuse(spark, tmp_path):
    from logweave.plans.models import load_or_fit
    calls = []

    def fit():
        calls.append(1)
        return spark.createDataFrame([(1, 2.0)], "EventId int, coef double")

    path = str(tmp_path / "models")
    a = load_or_fit(spark, path, "run1", fit).collect()
    b = load_or_fit(spark, path, "run1", fit).collect()
    load_or_fit(spark, path, "run2", fit)
    assert a == b and len(calls) == 2


def test_line_number_per_file(spark):
    import __spark_entry__ as E
    df = E.queries()["line_number"](spark, SF_SMALL)
    per_file = df.groupBy("file").agg(F.min("line_id").alias("lo"), F.max("line_id").alias("hi"),
                                      F.count("*").alias("n")).collect()
    assert all(r.lo == 1 and r.hi == r.n for r in per_file)
    assert sum(r.n for r in per_file) == event_log_lines(spark, SF_SMALL).count()


def test_values_mode_texts(spark):
    df = spark.createDataFrame([(["rhost=1.2.3.4", "user=root"], ["u", "<*>"], "5")],
                               "values array<string>, param array<string>, time_gap string")
    tok = PV.param_texts(df, "tokens").first().texts
    val = PV.param_texts(df, "values").first().texts
    assert tok == ["u<*>", "5"] and val == ["1234userroot", "5"]


def test_accuracy_from_model_equals_scoring(spark):
    from logweave.operators import nextevent as NE
    seq = PATH.lineitem_sequence(spark, SF_SMALL)
    train = PATH.path_windows(seq).where(F.col("split") == "train")
    model = NE.fit(train)
    assert NE.accuracy_on_fit(model, 10).collect() == NE.accuracy(NE.score(train, model, 10), 10).collect()


def test_stream_drops_rows_later_than_watermark(spark, tmp_path):
    import datetime as dt
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)
    first = [(i, t0 + dt.timedelta(minutes=10 * i), 1, "heartbeat", 0.0, "{}") for i in range(13)]  # to 14:00
    second = [(50, t0 + dt.timedelta(minutes=150), 1, "heartbeat", 0.0, "{}")]                     # 14:30
    late = [(100, t0, 1, "error", 0.0, "{}"),                                 # 2 h behind: dropped
            (101, t0 + dt.timedelta(minutes=115), 1, "error", 0.0, "{}")]     # within the delay: kept
    d = tmp_path / "ev"
    import glob
    import shutil
    # Spark drops late rows by the watermark of the previous batch, so the
    # late file comes third (one file per trigger)
    for i, rows in enumerate([first, second, late], 1):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(d / f"p{i}"))
        shutil.copy(glob.glob(str(d / f"p{i}" / "*.parquet"))[0], str(d / f"events-{i}.parquet"))
    ev = SL.event_stream(spark, str(d), max_files_per_trigger=1, pattern="events-*.parquet", schema=schema)
    out = {(r.LogName, r.TimeSlice): r.Label for r in SL.stream_bucket_labels(spark, str(d), events=ev).collect()}
    b_late = int((t0 - dt.datetime(1970, 1, 1)).total_seconds()) // 300
    b_kept = b_late + 23
    assert out[("messages", b_late)] == 0      # the late error row did not change the closed bucket
    assert out[("messages", b_kept)] == 1      # the in-watermark error row did


def test_ar3_equals_least_squares_on_all_rows(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    rows = []
    for event in (1, 2):
        series = rng.normal(size=(60, 2)).cumsum(axis=0)
        for k in range(3, 60):
            rows.append((event, *[series[k - 3 + i].tolist() for i in range(3)], series[k].tolist()))
    df = spark.createDataFrame(rows, "EventId int, x1 array<double>, x2 array<double>, x3 array<double>, y array<double>").repartition(4)
    got = {(r.EventId, r.dim): r.coef for r in PV.fit_ar3(df).collect()}
    for event in (1, 2):
        own = [r for r in rows if r[0] == event]
        for dim in (0, 1):
            x = np.array([[1.0, r[1][dim], r[2][dim], r[3][dim]] for r in own])
            y = np.array([r[4][dim] for r in own])
            assert np.allclose(got[event, dim], np.linalg.lstsq(x, y, rcond=None)[0], atol=1e-6)


def test_scores_of_distinct_windows_equal_the_rule(spark):
    from collections import Counter

    from logweave.operators import nextevent as NE
    import random
    rnd = random.Random(5)
    seq = [rnd.randint(1, 5) for _ in range(300)]
    win = [tuple(seq[i:i + 4]) for i in range(len(seq) - 3)]
    train, test = win[:200], win[200:] + [(9, 9, 9, 1), (9, 9, 9, 77), (9, 1, 2, 3)]
    cols = "c1 int, c2 int, c3 int, y int"
    model = NE.fit(spark.createDataFrame(train, cols))
    got = Counter((r.c1, r.c2, r.c3, r.y, r.level, r["rank"]) for r in NE.score(spark.createDataFrame(test, cols), model, 2).collect())
    want = Counter()
    for w in test:
        for level in (3, 2, 1, 0):
            seen = Counter(t[3] for t in train if t[3 - level:3] == w[3 - level:3])
            if seen:
                order = sorted(seen, key=lambda y: (-seen[y], y))
                want[(*w, level, order.index(w[3]) + 1 if w[3] in seen else None)] += 1
                break
    assert got == want


def test_stream_reads_a_folder_of_part_files(spark, tmp_path):
    whole = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    whole.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    got = SL.stream_bucket_labels(spark, str(tmp_path)).collect()
    assert got and sorted(got) == sorted(SL.stream_bucket_labels(spark, SF_SMALL).collect())
