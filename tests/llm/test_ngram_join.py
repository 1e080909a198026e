import random
import re

import numpy as np
import pyarrow as pa
import pytest

from logweave.llm import ngram_join as J
from logweave.llm.components import components


def brute(rows, width, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and both:
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted([(d, len(sets[i]), low.get(find(i))) for i, (d, _) in enumerate(rows)], key=repr)


def fixture():
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(300)]
    prose = lambda n: [rnd.choice(vocab) for _ in range(n)]
    common = prose(25)
    rows = [(None, "null id text here"), (1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE\ttwo")]
    k = 10
    for n in (8, 30, 60, 120, 400):
        base = prose(n)
        for _ in range(14):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, n // 25))):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            rows.append((k, " ".join(w)))
            k += 1
    for _ in range(40):
        rows.append((k, " ".join(prose(rnd.randint(1, 60)) + common + prose(rnd.randint(1, 40)))))
        k += 1
    rows += [rows[20], rows[21], (k, rows[22][1]), (k + 1, rows[23][1] + "  ")]
    return rows


@pytest.mark.parametrize("width,percent,small", [(4, 85, False), (5, 80, True), (2, 60, True)])
def test_against_brute_force(spark, monkeypatch, width, percent, small):
    if small:
        monkeypatch.setattr(J, "BUCKET_SHINGLES", 300)
        monkeypatch.setattr(J, "BLOCK_SETS", 7)
        monkeypatch.setattr(J, "FREQUENT", 50)
    rows = fixture()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, token int").repartition(3)
    got = J.ngram_join(df, width, percent).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=repr) == brute(rows, width, percent)


def test_empty_table(spark):
    assert J.ngram_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tree_finds_what_all_pairs_find():
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(25):
        base = rng.integers(0, 1 << 62, int(rng.integers(1, 400)), dtype=np.uint64)
        for _ in range(12):
            keep = rng.random(len(base)) > rng.random() * 0.3
            sets.append(np.unique(np.append(base[keep], rng.integers(0, 1 << 62, 3, dtype=np.uint64))))
    sets.sort(key=len)
    bits = np.array([J.bitmap(s) for s in sets]).view(np.uint64)
    tree = J.Tree(np.array([len(s) for s in sets]), bits, 80)
    seen = {(i, j) for a, b in tree.pairs() for i, j in zip(a.tolist(), b.tolist())}
    linked = {(i, j) for j in range(len(sets)) for i in range(j) if J.linked(sets[i], sets[j], 80)}
    assert linked <= seen and len(linked) > 100
    assert len(seen) < len(sets) * len(sets) // 4


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 7), (200, 201), (201, 202), (300, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[100] == 0 and got[202] == got[200] == 200


def crossed(sets, been, percent=85):
    """Pairs that the last traversal gives out for the holders of one shingle (ids by position, one component each)."""
    n = len(sets)
    batch = pa.RecordBatch.from_pydict({
        "token": pa.array([5] * n), "x": pa.array([0] * n), "y": pa.array([0] * n), "rid": pa.array(range(n)),
        "component": pa.array(range(n)), "n": pa.array([len(s) for s in sets]), "bits": [J.bitmap(s).tobytes() for s in sets],
        "block": pa.array([0] * n), "early": pa.array([[5]] * n, pa.list_(pa.int64())), "been": pa.array(been, pa.list_(pa.int64()))})
    return [p for b in J._cross(percent)(iter([batch])) for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]


def test_large_sets_that_share_little_are_no_candidates():
    """A bitmap that all large sets fill would leave every pair of them."""
    rng = np.random.default_rng(5)
    some = lambda n: rng.integers(0, 1 << 62, n, dtype=np.uint64)
    common = some(300)
    sets = [np.unique(np.append(some(int(n)), common)) for n in rng.integers(1000, 9000, 40)]
    # near copies, also on both sides of a size where bitmaps get longer (1,462, 2,925 and 5,851 shingles)
    for n in (1460, 2920, 5850, 8000):
        base = some(n)
        sets += [np.unique(base), np.unique(np.append(base[n // 20:], some(n // 20 + 20))), np.unique(np.append(base, some(n // 10)))]
    linked = {(i, j) for j in range(len(sets)) for i in range(j) if J.linked(sets[i], sets[j], 85)}
    got = crossed(sets, [[k, 0, k, 0] for k in range(len(sets))])
    assert linked <= set(got) and len(linked) >= 8
    assert len(got) <= 40


def test_pairs_compared_in_a_bucket_are_no_candidates():
    """Two sets that were in one bucket (shingle and part) of a round have been compared exactly."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 62, 300, dtype=np.uint64)
    sets = [np.unique(np.append(base[30:], rng.integers(0, 1 << 62, 15, dtype=np.uint64))) for _ in range(4)]
    every = {(i, j) for j in range(4) for i in range(j)}
    assert set(crossed(sets, [[k, 0, 9, k] for k in range(4)])) == every
    assert set(crossed(sets, [[8, 1, k, 0] for k in range(4)])) == set()
    assert set(crossed(sets, [[8, 0, 3, 0], [8, 1, 3, 0], [8, 0, 4, 0], [8, 1, 5, 0]])) == every - {(0, 1), (0, 2), (1, 3)}
