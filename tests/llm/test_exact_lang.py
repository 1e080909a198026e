import hashlib
import random
import re

import numpy as np
import pytest

from logweave.llm import exact_dedup as X
from logweave.llm import lang_id as G


@pytest.mark.parametrize("n", [0, 1, 2, 17, 1000])
def test_rice_round_trip(n):
    rng = np.random.default_rng(n)
    v = np.unique(rng.integers(0, 1 << 45, n, dtype=np.uint64))
    assert (X.rice_decode(X.rice_encode(v)) == v).all()


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    groups = {}
    for i, n in enumerate(norm):
        groups.setdefault(n, []).append(i)
    out = []
    for i, (d, t) in enumerate(rows):
        g = groups[norm[i]]
        keep = min(g, key=lambda j: (-len(rows[j][1] or ""), rows[j][0] is None, rows[j][0] or 0))
        out.append((d, rows[keep][0], len(g), hashlib.sha256(norm[i].encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_dedup_against_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["a b", "ab", "a  b\n", "", None, "über x", "x y", "long " * 5000, str(i)]))
            for i in range(200)] + [(None, "ab"), (7, "ab"), (7, "ab"), (None, "solo")]
    df = spark.createDataFrame([(d, t, "s", 1) for d, t in rows], "doc_id long, text string, sha string, rank int")
    got = X.exact_dedup(df.repartition(5)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute(rows)
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})


def test_exact_dedup_empty(spark):
    assert X.exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


WORDS = {"aa": ["lorem", "ipsum", "dolor", "samet"], "bb": ["zquix", "wyrk", "vox", "kjell"]}


def text(lang, rnd, n=30):
    return " ".join(rnd.choice(WORDS[lang]) for _ in range(n))


def test_language_id(spark):
    rnd = random.Random(1)
    rows = [(i, text(lang, rnd), lang) for i in range(60) for lang in [("aa", "bb")[i % 2]]]
    rows += [(100, None, "aa"), (101, "", "bb"), (102, "12 !!", None), (103, "Lorem!", None), (104, "zquixx wyrkk", None)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, score int")
    model = G.train(df.filter("doc_id < 102"))
    got = {r.doc_id: r for r in G.predict(df, model).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows[:60])
    assert [got[i].lang_pred for i in (100, 101, 102, 103, 104)] == ["und", "und", "und", "aa", "bb"]
    assert got[100].score == 0 and all(0 <= r.score <= 1 for r in got.values())


def test_word_counts_are_whole_and_backoff_shortens(spark):
    df = spark.createDataFrame([("abab ab", "x"), ("cd", "y"), (None, "y"), ("q", None)], "text string, lang string")
    m = G.train(df)
    assert m.langs == ["x", "y"]
    assert m.word("ab") == m.tables[0]["ab"]
    assert m.word("zab")[0] > m.word("zab")[1]
    assert m.word("ZZ") == [0, 0]


def test_language_id_without_training_rows(spark):
    df = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    model = G.train(spark.createDataFrame([], "text string, lang string"))
    assert [(r.lang_pred, r.score) for r in G.predict(df, model).collect()] == [("und", 0.0)]


def test_every_word_of_the_training_texts_is_known(spark):
    common = " ".join(["mono"] * 50)
    df = spark.createDataFrame([(f"{common} abcd", "x"), (f"{common} abce abce abce", "y")], "text string, lang string")
    model = G.train(df, words=2)
    assert set(model.tables[0]) == {"mono"}
    got = G.predict(spark.createDataFrame([(1, "abcd"), (2, "abce"), (3, None)], "doc_id long, text string"), model).collect()
    rows = {r.doc_id: r for r in got}
    low = [51 + 0.5 * 4, 53 + 0.5 * 4]  # three different words and one more
    p = [1.5 / low[0], 0.5 / low[1]]
    assert rows[1].lang_pred == "x" and rows[1].score == pytest.approx(p[0] / sum(p))
    p = [0.5 / low[0], 3.5 / low[1]]
    assert rows[2].lang_pred == "y" and rows[2].score == pytest.approx(p[1] / sum(p))
    assert rows[3].lang_pred == "und"


def test_a_chunk_is_scored_a_batch_at_a_time():
    """Its texts never are Python objects all at once: the peak stays below the size of the texts."""
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa

    from logweave.llm import lang_id

    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(2000)]
    n = 6000
    rows = pa.table({"key": pa.array(range(n)), "sums": pa.array([[.1, .2]] * n), "words": pa.array([300] * n),
                     "rare": [" ".join(words[(i + 7 * j) % 2000] for j in range(300)) for i in range(n)]})
    counts = pa.table({"lang": ["a"] * 2000, "gram": words, "n": [2] * 2000})
    model = lang_id.Model(["a", "b"], [(1, "a", "a", 3)], {(0, "a"): 5, (0, "b"): 5}, None, 10)
    tracemalloc.start()
    out = lang_id._score_chunk(SimpleNamespace(value=model))(rows, counts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.num_rows == n and peak < rows.column("rare").nbytes


def test_a_chunk_keeps_its_known_words_out_of_python():
    """Words with counts are met as Arrow arrays: no Python string, list or array for each of them."""
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa

    from logweave.llm import lang_id

    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}{chr(97 + i // 17576)}" for i in range(40_000)]
    model = lang_id.Model(["a", "b"], [(1, "a", "x", 3)], {(0, "a"): 5, (0, "b"): 90_000, (1, "a"): 9, (1, "b"): 9}, None, 40_000)
    rare = [" ".join(words[i:i + 400]) for i in range(0, 40_000, 400)] + ["", "xx zz", "waaaa xx"]
    rows = pa.table({"key": pa.array(range(103)), "sums": pa.array([[.1, .2]] * 103),
                     "words": pa.array([400] * 100 + [0, 2, 2]), "rare": rare, "_chunk": pa.array([7] * 103)})
    found = lang_id._rare_words(rows)
    assert found.column("gram").to_pylist() == sorted({*words, "xx", "zz"}) and set(found.column("_chunk").to_pylist()) == {7}
    counts = pa.table({"lang": ["b"] * 40_000 + ["a"], "gram": [*words, words[0]], "n": [2] * 40_000 + [7]})
    tracemalloc.start()
    out = lang_id._score_chunk(SimpleNamespace(value=model))(rows, counts).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6_000_000  # 40,000 lists and strings: over 10 MB
    low = model.low
    known = np.log([0 + .5, 2 + .5]) - low
    for r, want in ((out[1], 400 * known + [.1, .2]), (out[101], np.array(model.word("xx")) + model.word("zz") + [.1, .2]),
                    (out[102], np.log([7 + .5, 2 + .5]) - low + model.word("xx") + [.1, .2])):
        assert r["lang_pred"] == "ab"[int(want.argmax())]
        assert r["score"] == pytest.approx(1 / np.exp(want - want.max()).sum())
    assert (out[100]["lang_pred"], out[100]["score"]) == ("und", 0.0)
