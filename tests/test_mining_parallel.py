"""Chunked leaves, candidate index, discrimination tree and mining that goes on from a stored state."""

import random

import pytest
from pyspark.sql import functions as F

from logweave.operators import templates as T

PARAM = T.PARAM
STATE = "kind in ('leaf', 'open')"


def plain_best(templates, toks, sim_th):
    """Scores every cluster: the statement of the rule."""
    n, best = len(toks), None
    for c, tpl in enumerate(templates):
        sim = sum(a != PARAM and a == b for a, b in zip(tpl, toks))
        if n and sim / n < sim_th:
            continue
        key = (sim, tpl.count(PARAM), -c)
        if best is None or key > best[0]:
            best = (key, c)
    return -1 if best is None else best[1]


def plain_add(clusters, toks, size, sim_th):
    c = plain_best([t for t, _ in clusters], toks, sim_th)
    if c < 0:
        clusters.append([list(toks), size])
    else:
        clusters[c][0] = [a if a == b else PARAM for a, b in zip(clusters[c][0], toks)]
        clusters[c][1] += size


def plain_leaf(lines, sim_th, chunk_rows, fan):
    """Chunks in sequence, then a fixed tree of merges."""
    level = []
    for i in range(0, len(lines), chunk_rows):
        clusters = []
        for toks in lines[i:i + chunk_rows]:
            plain_add(clusters, toks, 1, sim_th)
        level.append(clusters)
    while len(level) > 1:
        merged = []
        for i in range(0, len(level), fan):
            clusters = [[list(t), s] for t, s in level[i]]
            for other in level[i + 1:i + fan]:
                for tpl, size in other:
                    plain_add(clusters, tpl, size, sim_th)
            merged.append(clusters)
        level = merged
    return [(" ".join(t), s) for t, s in level[0]]


def log_lines(n, seed):
    """One leaf ("hot") with nine lines in ten, and a few others."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        first = "hot" if rnd.random() < .9 else rnd.choice(["cold", "mild", "x9", "7"])
        k = 4 if first == "hot" else rnd.choice([0, 1, 2, 4])
        toks = ([first] + [rnd.choice("abcdefgh") + rnd.choice(["", "1", "2"]) for _ in range(k - 1)]) if k else []
        out += [toks] * rnd.choice([1, 1, 1, 3])
    return out


def keyed_frame(spark, lines, partitions=3, start=0, own=None):
    df = spark.createDataFrame([(start + i, t) for i, t in enumerate(lines)], "pos long, tokens array<string>").repartition(partitions)
    return T.leaf_keys(df) if own is None else T.route(df, own)


def leaf_of(toks):
    if len(toks) < 2:
        return len(toks), None
    return len(toks), PARAM if any(ch.isdigit() for ch in toks[0]) else toks[0]


def plain_catalogue(lines, chunk_rows, fan, sim_th=T.SIM_TH):
    leaves = {}
    for toks in lines:
        leaves.setdefault(leaf_of(toks), []).append(toks)
    return {k: plain_leaf(v, sim_th, chunk_rows, fan) for k, v in leaves.items()}


def mined_catalogue(mined):
    out = {}
    for r in mined.where("kind = 'cluster'").orderBy("n_tokens", "leaf_token", "local_id").collect():
        out.setdefault((r.n_tokens, r.leaf_token), []).append((" ".join(r.template), r.size))
    return out


@pytest.mark.parametrize("sim_th", [0.0, 0.3, 0.4, 0.75, 1.0])
def test_candidate_index_finds_what_scoring_all_finds(sim_th):
    rnd = random.Random(7)
    for n in (1, 2, 5, 8):
        clusters, plain = T.LeafClusters(sim_th), []
        for pos in range(300):
            toks = [rnd.choice("abcd") + rnd.choice(["", "x"]) for _ in range(n)]
            assert clusters.best(toks) == plain_best([t for t, _ in plain], toks, sim_th)
            clusters.add(pos, toks)
            plain_add(plain, toks, 1, sim_th)
        assert [(t, s) for _, _, t, s in clusters.rows()] == [(t, s) for t, s in plain]
        assert {k: v for k, v in clusters.index.items()} == {
            (i, t): {c for c, (p, _) in enumerate(plain) if p[i] == t} for i in range(n) for t in {p[i] for p, _ in plain} - {PARAM}}


def test_lines_out_of_order_are_refused():
    clusters = T.LeafClusters()
    clusters.add(5, ["a"])
    with pytest.raises(ValueError, match="position order"):
        clusters.add(4, ["a"])


@pytest.mark.parametrize("chunk_rows, fan", [(50, 2), (40, 3), (7, 4)])
def test_hot_leaf_in_chunks_equals_the_plain_rule(spark, chunk_rows, fan):
    lines = log_lines(400, chunk_rows)
    want = plain_catalogue(lines, chunk_rows, fan)
    for partitions in (1, 5):
        mined = T.mine(keyed_frame(spark, lines, partitions), chunk_rows=chunk_rows, fan=fan)
        assert mined_catalogue(mined) == want


def test_a_leaf_of_one_chunk_is_mined_in_sequence(spark):
    lines = log_lines(200, 1)
    assert mined_catalogue(T.mine(keyed_frame(spark, lines))) == plain_catalogue(lines, 10 ** 9, 2)


def test_a_hot_leaf_runs_in_many_tasks(spark):
    keyed = keyed_frame(spark, [["hot", str(i % 50), "x"] for i in range(2000)])
    sizes = keyed.groupBy("n_tokens", "leaf_token").agg(F.count("*").alias("added")).withColumn("before", F.lit(0))
    chunks = T._into_chunks(keyed, sizes, 100, 2).groupBy("piece").count().collect()
    assert len(chunks) == 20 and {r["count"] for r in chunks} == {100}


@pytest.mark.parametrize("chunk_rows, fan, cuts", [(10 ** 6, 64, (1, 250)), (50, 2, (100, 333)), (16, 3, (250,))])
def test_going_on_from_a_stored_state_equals_mining_all_at_once(spark, chunk_rows, fan, cuts):
    lines = log_lines(400, 3)
    own = T.own_leaves(keyed_frame(spark, lines))
    whole = T.mine(keyed_frame(spark, lines, own=own), chunk_rows=chunk_rows, fan=fan)
    state, at = None, 0
    for end in (*cuts, len(lines)):
        mined = T.mine(keyed_frame(spark, lines[at:end], start=at, own=own), state=state, chunk_rows=chunk_rows, fan=fan)
        state, at = mined.where(STATE), end
    assert mined_catalogue(mined) == mined_catalogue(whole) == plain_catalogue(lines, chunk_rows, fan)

    def rows(df):
        return sorted((tuple(r) for r in df.where(STATE).collect()), key=repr)
    assert rows(mined) == rows(whole)


def test_only_what_new_lines_change_is_reported(spark):
    first = [["on", "port", "1"], ["on", "port", "2"], ["off", "a", "b"]]
    state = T.mine(keyed_frame(spark, first)).where(STATE)
    got = T.mine(keyed_frame(spark, [["on", "port", "3"], ["off", "a", "c"], ["new", "x", "y"]], start=3), state=state)
    changes = sorted((int(r.pos), r.change_type, " ".join(r.template), r.size) for r in got.where("kind = 'change'").collect())
    assert changes == [(4, "cluster_template_changed", "off a <*>", 2), (5, "cluster_created", "new x y", 1)]


def test_discrimination_tree_against_comparing_all():
    rnd = random.Random(9)
    for n in (1, 3, 6):
        rows = []
        for cid in range(200):
            toks = [rnd.choice(["a", "b", "c", PARAM]) for _ in range(n)]
            rows.append((-toks.count(PARAM), cid, toks))
        tree = T.TemplateTree(rows)
        for _ in range(300):
            line = [rnd.choice("abcd") for _ in range(n)]
            fits = sorted((w, cid) for w, cid, t in rows if all(a in (PARAM, b) for a, b in zip(t, line)))
            assert tree.find(line) == (fits[0][1] if fits else None)
    assert T.TemplateTree([]).find(["a"]) is None and T.TemplateTree([(0, 4, [])]).find([]) == 4
    long = [(0, c, ["same"] * 3000 + [str(c)]) for c in range(20)]
    assert T.TemplateTree(long).find(["same"] * 3000 + ["17"]) == 17


def test_match_agrees_with_the_join_form_when_shapes_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(T, "SHAPES_PER_TASK", 8)
    keyed = keyed_frame(spark, log_lines(300, 5))
    cat = T.catalogue(T.mine(keyed, sim_th=0.7))
    a = sorted((r.pos, r.EventId, r.EventTemplate, tuple(r.param), r.match) for r in T.match(keyed, cat).collect())
    b = sorted((r.pos, r.EventId, r.EventTemplate, tuple(r.param), r.match) for r in T.match_join(keyed, cat).collect())
    assert a == b and all(r[4] for r in a)


def long_leaf(spark, tail):
    """A leaf of 32,768 equal lines and a few after them."""
    same = spark.range(32_768).select(F.col("id").alias("pos"), F.array(*map(F.lit, "hot a b c d".split())).alias("tokens"))
    more = spark.createDataFrame([(32_768 + i, t.split()) for i, t in enumerate(tail)], "pos long, tokens array<string>")
    return T.leaf_keys(same.unionByName(more))


def test_a_long_leaf_is_mined_in_sequence_like_a_short_one(spark):
    """the 32,769th line meets the clusters of the lines before it, as the second does."""
    tail = ["hot a q r s", "hot t q u v"]
    mined = T.mine(long_leaf(spark, tail))
    assert mined_catalogue(mined) == {(5, "hot"): [("hot a <*> <*> <*>", 32_769), ("hot t q u v", 1)]}
    few = T.mine(keyed_frame(spark, [["hot", "a", "b", "c", "d"], *(t.split() for t in tail)]))
    assert [t for t, _ in mined_catalogue(few)[5, "hot"]] == [t for t, _ in mined_catalogue(mined)[5, "hot"]]

    def feed(df):
        return [(r.change_type, r.cluster_id, r.template) for r in T.changes(df, T.catalogue(df)).orderBy("pos").collect()]
    assert feed(mined) == feed(few) == [("cluster_created", 1, "hot a b c d"), ("cluster_template_changed", 1, "hot a <*> <*> <*>"),
                                        ("cluster_created", 2, "hot t q u v")]


def test_going_on_after_a_long_leaf_is_mined_in_sequence(spark):
    """a micro-batch goes on from the clusters, not from an empty chunk."""
    state = T.mine(long_leaf(spark, ["hot a q r s"])).where(STATE)
    got = T.mine(keyed_frame(spark, [["hot", "t", "q", "u", "v"], ["hot", "t", "x", "y", "z"]], start=32_769), state=state)
    assert mined_catalogue(got) == {(5, "hot"): [("hot a <*> <*> <*>", 32_769), ("hot t <*> <*> <*>", 2)]}
    chunked = T.mine(keyed_frame(spark, log_lines(60, 2)), chunk_rows=20, fan=2).where(STATE)
    with pytest.raises(ValueError, match="chunks"):
        T.mine(keyed_frame(spark, [["hot", "t"]], start=10 ** 6), state=chunked)


def test_runs_go_on_from_batch_to_batch():
    import pyarrow as pa
    from decimal import Decimal

    def batch(rows):
        types = [pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.decimal128(38, 0), pa.int32(), pa.string(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=T._STREAM)
    rows = [(2, leaf, 0, take, Decimal(i), 0, text, 1, True) for i, (leaf, take, text) in enumerate(
        [("a", 0, "a b"), ("a", 1, "a b"), ("a", 1, "a b"), ("a", 1, "a c"), ("a", 1, "a c"), (None, 1, "a c"), (None, 1, "a c"), ("a", 1, "a c")])]
    for cut in range(1, len(rows)):
        got = list(T._runs([batch(rows[:cut]), batch(rows[cut:])], True))
        assert [(r[1], r[3], int(r[4]), r[6], r[7]) for r in got] == [
            ("a", 0, 0, "a b", 1), ("a", 1, 1, "a b", 2), ("a", 1, 3, "a c", 2), (None, 1, 5, "a c", 2), ("a", 1, 7, "a c", 1)]
        assert [r[7] for r in T._runs([batch(rows[:cut]), batch(rows[cut:])], False)] == [1] * 8
