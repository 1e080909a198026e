"""The caller's columns survive every filtering stage, whatever their names; repeated rows spread; settings come back."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from logweave.llm import exact_dedup, lang_id
from logweave.llm.common import table

from test_pipeline import fixture

CLASHING = ["likely", "_slot", "_bucket", "_bitmap", "_byte", "_row_key", "_chunk", "row", "row_key", "component", "copies", "stays",
            "_often", "item_id", "gram", "n", "u", "v", "bits", "keeper", "did", "number", "kept"]


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    rows, items = fixture()
    folder = str(tmp_path_factory.mktemp("clash"))
    (spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").repartition(3)
     .write.parquet(f"{folder}/documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet"), folder


@pytest.mark.parametrize("name, stage", C.STAGES[:-1])
def test_stage_keeps_clashing_columns(spark, inputs, name, stage):
    docs, folder = inputs
    plain = sorted((tuple(r) for r in stage(spark, docs, folder).collect()), key=repr)
    extra = docs.select("*", *[F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias(c) for c in CLASHING])
    got = stage(spark, extra, folder)
    assert got.columns == extra.columns and got.dtypes == extra.dtypes
    rows = got.collect()
    assert sorted((tuple(r)[:4] for r in rows), key=repr) == plain
    for r in rows:
        assert tuple(r)[4:] == tuple(f"{c}-{'null' if r.doc_id is None else r.doc_id}" for c in CLASHING)


def test_numerals_are_no_letters(spark):
    train = spark.createDataFrame([("aa", "lorem ipsum"), ("bb", "wyrk vox")], "lang string, text string")
    model = lang_id.train(train)
    docs = spark.createDataFrame([(1, "½ ² Ⅷ"), (2, "½lorem"), (3, "3½ 12"), (4, None), (5, "一")], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in lang_id.predict(docs, model).collect()}
    assert got[1] == got[3] == got[4] == ("und", 0.0) and got[2][0] != "und" and got[5][0] != "und"


def test_rows_that_repeat_are_dealt_to_several_chunks(spark):
    model = lang_id.train(spark.createDataFrame([("aa", "lorem ipsum"), ("bb", "wyrk vox")], "lang string, text string"))
    docs = spark.range(5000, numPartitions=8).select(F.lit(None).cast("long").alias("doc_id"), F.lit("lorem").alias("text"))
    rows = docs.select(F.col("doc_id").alias("key"), "text")
    sizes = [r["count"] for r in lang_id._dealt(rows, spark.sparkContext.broadcast(model)).groupBy("_chunk").count().collect()]
    assert sum(sizes) == 5000 and len(sizes) > 3
    got = lang_id.predict(docs, model).groupBy("lang_pred").count().collect()
    assert [tuple(r) for r in got] == [("aa", 5000)]


def test_the_batch_setting_of_the_session_comes_back(spark, inputs):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs, folder = inputs
    spark.conf.set(key, "7000")
    try:
        exact_dedup.exact_dedup(docs).count()
        assert spark.conf.get(key) == "500"
        table(spark, folder, "documents")
        assert spark.conf.get(key) == "7000"
    finally:
        spark.conf.set(key, "10000")


def test_scores_against_the_plain_formula(spark):
    """Label and score of every row from counts made in Python: words by frequency, others by backoff over n-grams."""
    import math
    import random
    from collections import Counter
    rnd = random.Random(8)
    syllables = {"aa": ["lo", "rem", "ip", "sum"], "bb": ["zqu", "ix", "wyr", "lo"]}
    make = lambda lang, n: " ".join("".join(rnd.choices(syllables[lang], k=rnd.randint(1, 3))) for _ in range(n))
    train = [(lang, make(lang, 30)) for lang in ("aa", "bb") for _ in range(6)]
    docs = [(i, make(rnd.choice(["aa", "bb"]), 8) + rnd.choice(["", " Über", " x1y"])) for i in range(40)]
    model = lang_id.train(spark.createDataFrame(train, "lang string, text string"), words=10)
    words = {g: Counter(w for lang, t in train if lang == g for w in lang_id.words_of(t)) for g in ("aa", "bb")}
    grams = {n: {g: Counter() for g in words} for n in lang_id.ORDERS}
    for g, c in words.items():
        for w, k in c.items():
            for n in lang_id.ORDERS:
                for x in lang_id.grams_of(w, n):
                    grams[n][g][x] += k

    def freq(tables, x):
        types = len(set().union(*tables.values()))
        return [math.log(tables[g][x] + lang_id.SMOOTH) - math.log(sum(tables[g].values()) + lang_id.SMOOTH * (types + 1)) for g in ("aa", "bb")]

    def score(w):
        if any(w in c for c in words.values()):
            return freq(words, w)
        for n in lang_id.ORDERS:
            found = [freq(grams[n], x) for x in lang_id.grams_of(w, n) if any(x in c for c in grams[n].values())]
            if found:
                return [sum(v) / len(found) for v in zip(*found)]
        return [0.0, 0.0]
    got = {r.doc_id: (r.lang_pred, r.score) for r in lang_id.predict(spark.createDataFrame(docs, "doc_id long, text string"), model).collect()}
    for i, text in docs:
        a, b = map(sum, zip(*map(score, lang_id.words_of(text))))
        lang, p = ("aa", 1 / (1 + math.exp(b - a))) if a >= b else ("bb", 1 / (1 + math.exp(a - b)))
        assert got[i][0] == lang and abs(got[i][1] - p) < 1e-9
