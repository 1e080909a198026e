import random
import re
from collections import Counter

import pytest

import corpus_pipeline as C
from logweave.llm import decontaminate, lang_id, packing
from logweave.llm.common import bucket_is

import test_line_dedup as lines
import test_ngram_join as joins
from test_decontaminate import table as edit_distance

SYLLABLES = {"aa": ["lo", "rem", "ip", "sum", "dol", "or"], "bb": ["zqu", "ix", "wyr", "kva", "jel", "hø"]}


def fixture():
    rnd = random.Random(21)

    def prose(lang, n):
        return " ".join("".join(rnd.choices(SYLLABLES[lang], k=rnd.randint(1, 3))) for _ in range(n))

    items = [(i, prose("aa", 25)) for i in range(4)]
    rows = [(900, None, "aa", 1), (901, "", None, 0), (902, "12 34 %%", "bb", 3), (903, "\n\n", "aa", 2)]
    common = prose("aa", 12)
    for i in range(60):
        lang = ("aa", "bb")[i % 2]
        parts = [prose(lang, rnd.randint(1, 40)) for _ in range(rnd.randint(1, 4))]
        if i % 5 == 0:
            parts.append(common)
        if i % 9 == 0:
            parts.insert(0, prose(lang, 3) + " " + items[i % 4][1].replace("o", "O") + " " + prose(lang, 4))
        rows.append((i, "\n".join(parts), lang if i % 7 else None, 10 + i))
    for k in range(12):  # one line of each: near copies that line dedup sees as other word sets
        w = rows[10 + k][1].split()
        rows.append((100 + k, " ".join(w), "aa", 5))
    rows += [rows[10], (None, rows[12][1], "bb", 7)]
    return rows, items


def columns(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    rows, items = fixture()
    folder = str(tmp_path_factory.mktemp("pipe"))
    (spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").repartition(3)
     .write.parquet(f"{folder}/documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs]
    for name, stage in C.STAGES:
        path = f"{folder}/{name}"
        stage(spark, seen[-1], folder).write.parquet(path)
        seen.append(spark.read.parquet(path))
    return seen, items, folder


def test_columns_stay(stages):
    seen, _, _ = stages
    assert all(s.columns == seen[0].columns for s in seen[1:-1])


def test_language_stage_keeps_what_it_can_tell(stages):
    seen, _, _ = stages
    model = lang_id.train(seen[0].filter(~bucket_is("doc_id", 4, 2)))
    predictor = lang_id.Predictor(model)
    want = [r for r in columns(seen[0]) if predictor(r[1])[0] != "und" and predictor(r[1])[1] >= 0.5]
    assert Counter(columns(seen[1])) == Counter(want)
    assert {900, 901, 902, 903}.isdisjoint({r[0] for r in want}) and len(want) >= 70


def test_line_stage(stages):
    seen, _, _ = stages
    before, after = columns(seen[1]), columns(seen[2])
    kept = Counter((d, t) for d, _, n, t in lines.brute([r[:2] for r in before]) if n == 0 or t.strip())
    assert Counter((r[0], r[1]) for r in after) == kept
    was = {r[:2]: r[3] for r in before}
    assert all(r[3] == was.get(r[:2], len(r[1])) for r in after)


def test_join_stage(stages):
    seen, _, _ = stages
    before, after = columns(seen[2]), columns(seen[3])
    groups = {}
    for d, _, c in joins.brute([r[:2] for r in before], 5, 80):
        groups.setdefault(c if c is not None else d, []).append(d)
    assert len(after) == len(groups)
    assert {r[0] for r in after} == set(groups)


def test_decontamination_stage(stages):
    seen, items, _ = stages
    plain = [decontaminate.plain(t) for _, t in items]
    want = [r for r in columns(seen[3])
            if all(edit_distance(p, decontaminate.plain(r[1])) > int(len(p) * decontaminate.RATE) for p in plain)]
    assert Counter(columns(seen[4])) == Counter(want)
    assert len(want) < seen[3].count()


def test_packing_stage(stages):
    seen, _, _ = stages
    want = Counter()
    for d, t, _, _ in columns(seen[4]):
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t)) + 1
        for s in range(-(-n // packing.MAX_LEN)):
            want[d, s, min(packing.MAX_LEN, n - s * packing.MAX_LEN)] += 1
    assert Counter((r.doc_id, r.segment, r.n_tokens) for r in seen[5].collect()) == want


def test_run_gives_the_same_and_takes_an_empty_table(spark, stages, tmp_path):
    seen, _, folder = stages
    key = lambda df: sorted(map(repr, columns(df.select("doc_id", "segment", "n_tokens"))))
    assert key(C.run(spark, folder)) == key(seen[5])
    seen[0].limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0
