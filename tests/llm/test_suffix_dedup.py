import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from logweave.llm import suffix_dedup as S


def brute(texts):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + S.SPAN] for r in raws for i in range(len(r) - S.SPAN + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - S.SPAN + 1):
            if seen[r[i:i + S.SPAN]] > 1:
                gone[i:i + S.SPAN] = True
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = sum(1 for i in range(len(r)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(2, 9))) for _ in range(n))


def fixture():
    rnd = random.Random(5)
    shared = [prose(rnd, n) for n in (20, 40, 90)]
    line = prose(rnd, 16)
    texts = [None, "", "x" * 199, "x" * 200, "y" * 201, "ab" * 300, prose(rnd, 9000)]
    for i in range(60):
        parts = [prose(rnd, rnd.randint(1, 60)) for _ in range(rnd.randint(1, 4))]
        parts.insert(rnd.randrange(len(parts) + 1), rnd.choice(shared))
        if i % 2:
            parts.insert(rnd.randrange(len(parts) + 1), line)
        texts.append(" ".join(parts))
    texts += [texts[20], texts[21][:-1], texts[22], texts[22]]
    return texts


@pytest.mark.parametrize("hot", [2000, 3])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT_PIECES", hot)
    monkeypatch.setattr(S, "BUCKET_BYTES", 20_000)
    texts = fixture()
    rows = [(i, t, "src") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, starts string").repartition(3)
    got = {r.doc_id: r for r in S.remove_repeats(df).collect()}
    want = brute(texts)
    assert len(got) == len(texts)
    for i, w in enumerate(want):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == w, i
    assert sum(w[1] > 0 for w in want) > 40


def test_repeated_rows_and_null_ids(spark):
    t = "z" * 150 + prose(random.Random(1), 50)
    df = spark.createDataFrame([(1, t), (1, t), (None, t), (None, None), (2, prose(random.Random(2), 80))], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_removed) for r in S.remove_repeats(df).collect()), key=repr)
    n = len(t.encode())
    assert got == sorted([(1, n), (1, n), (None, n), (None, 0), (2, 0)], key=repr)


def test_empty_table(spark):
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_blocks_of_a_long_text(monkeypatch):
    raw = np.frombuffer(prose(random.Random(7), 4000).encode(), np.uint8)
    off = np.array([0, 5000, len(raw)])
    covered = []
    for block in (1 << 21, 3000):
        monkeypatch.setattr(S, "_BLOCK", block)
        doc, start, width, _ = S.pieces_of(raw, off)
        covered.append(sorted((int(d), int(s) + j) for d, s, w in zip(doc, start, width) for j in range(w)))
    assert covered[0] == covered[1]
    assert len(covered[0]) == sum(int(b - a) - S.SPAN + 1 for a, b in zip(off, off[1:]))


def test_far_neighbours(monkeypatch):
    rnd = random.Random(9)
    common = prose(rnd, 60).encode()
    pieces = sorted({prose(rnd, 3).encode() + common + prose(rnd, 30).encode() for _ in range(40)})
    results = []
    for near in (32, 0, 10_000):
        monkeypatch.setattr(S, "_NEAR", near)
        results.append([m.tolist() for m in S.repeated_starts(pieces, [1] * len(pieces))])
    assert results[0] == results[1] == results[2]
    seen = Counter(p[i:i + 200] for p in pieces for i in range(len(p) - 199))
    assert results[0] == [[seen[p[i:i + 200]] > 1 for i in range(len(p) - 199)] for p in pieces]
