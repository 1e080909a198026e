"""Parameter-value vectors and their forecasters (A6, J-c, M4, M4b, W5, M5, M6).

Rows are keyed by ``EventId`` and ordered by ``k`` (dense position of the row
within its key and split). Everything stays in row form: vocabularies are
aggregates, encoding is a join, windows are chunked lags, models are
aggregates (or a grouped least-squares fit per key), scoring is a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.functions.textclean import clean_param, py_list_repr, tokenizer_words
from logweave.operators.order import dense_index, with_lags

# History length, minimum train rows for a model, error threshold.
N_STEPS = 3
MIN_TRAIN_ROWS = 9  # a key needs more than 8 rows
MSE_THRESHOLD = 1000.0


def param_texts(structured: DataFrame, mode: str = "tokens") -> DataFrame:
    """M4: ``texts = [clean(str(param list)), clean(gap)]`` per row.

    ``mode='tokens'`` uses the template tokens (parity with the reference);
    ``mode='values'`` uses the line's values at the wildcard positions.
    """
    src = F.col("param") if mode == "tokens" else F.col("values")
    return structured.withColumn("texts", F.array(clean_param(py_list_repr(src)), clean_param(F.col("time_gap"))))


def _split_order(c):
    return F.when(c == "train", 0).otherwise(1)


def _words(texts: DataFrame) -> DataFrame:
    """One row per word of ``text``: its position ``w`` and the ``word``."""
    return texts.select("*", F.posexplode(tokenizer_words(F.col("text"))).alias("w", "word"))


def vocabulary(rows: DataFrame, fit_on: str = "both") -> DataFrame:
    """Per-key word ids, ranked by count (desc) then first occurrence, from 1.

    ``fit_on='both'`` fits on train then test rows (parity, Q11);
    ``'train'`` fits on train rows only (unknown words encode to 0). Equal
    texts of a key are counted together before they are split into words, so
    a text that a key repeats on every line is one row of the word table.
    """
    if fit_on == "train":
        rows = rows.where(F.col("split") == "train")
    texts = (rows.select("EventId", F.struct(_split_order(F.col("split")).alias("s"), "k").alias("_row"),
                         F.posexplode("texts").alias("t", "text"))
             .groupBy("EventId", "t", "text").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_row")))
    first = F.struct("_row.s", "_row.k", "t", "w")
    counts = _words(texts).groupBy("EventId", "word").agg(F.sum("_n").alias("cnt"), F.min(first).alias("_first"))
    # rank inside each key with a distributed sort: a key holding most of the
    # distinct words (e.g. one id per line) is spread over many tasks
    ranked = dense_index(counts, ["cnt", "_first"], ascending=[False, True], out="word_id", groups=["EventId"])
    return ranked.withColumn("word_id", F.col("word_id").cast("int")).drop("_first")


def encode(rows: DataFrame, vocab: DataFrame) -> DataFrame:
    """J-c / M4b: word ids of each text, flattened to one vector per row.

    Every distinct (key, texts) is encoded once: its words meet the
    vocabulary on (key, word) and its vector is put together. The rows then
    take their vector in one join; no row is taken apart into words. A text
    without known words encodes to ``[0]``; an unknown word (``fit_on``
    train) to 0.
    """
    shapes = rows.select("EventId", "texts").distinct().withColumn("_shape", F.xxhash64("EventId", "texts"))
    texts = shapes.select("EventId", "_shape", "texts", F.posexplode("texts").alias("t", "text"))
    ids = (_words(texts).join(vocab.select("EventId", "word", "word_id"), ["EventId", "word"], "left")
           # the words of one row's texts: bounded by a line
           .groupBy("EventId", "_shape", "texts")
           .agg(F.sort_array(F.collect_list(F.struct("t", "w", F.coalesce("word_id", F.lit(0)).alias("id")))).alias("_e")))

    def ids_of(t):
        found = F.transform(F.filter(F.coalesce("_e", F.array().cast("array<struct<t:int,w:int,id:int>>")), lambda e: e["t"] == t),
                            lambda e: e["id"])
        return F.when(F.size(found) == 0, F.array(F.lit(0))).otherwise(found)

    vectors = ids.select(F.col("EventId").alias("_key"), F.col("_shape").alias("_hash"), F.col("texts").alias("_texts"), "_e")
    keyed = rows.withColumn("_shape", F.xxhash64("EventId", "texts"))
    # the hash comes first, so that sorting hardly ever compares texts
    out = keyed.join(vectors, (keyed["_shape"] == vectors["_hash"]) & (keyed["EventId"] == vectors["_key"])
                     & (keyed["texts"] == vectors["_texts"]), "left")
    return out.select("split", "EventId", "k", "LineId",
                      F.flatten(F.transform(F.sequence(F.lit(0), F.size("texts") - 1), ids_of)).alias("vec"))


def ragged_check(vectors: DataFrame) -> DataFrame:
    """Q27: ``ok`` when the vector length equals the modal length of its key."""
    lens = vectors.groupBy("EventId", F.size("vec").alias("_len")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("EventId").orderBy(F.col("_n").desc(), F.col("_len"))
    modal = lens.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("EventId", F.col("_len").alias("dim"))
    return vectors.join(modal, "EventId").withColumn("ok", F.size("vec") == F.col("dim"))


def keyed_rows(structured: DataFrame) -> DataFrame:
    """Dense position ``k`` of each row within (split, EventId), in ``seq`` order."""
    s = structured.where(F.col("EventId").isNotNull())
    return dense_index(s, ["seq"], out="k", groups=["split", "EventId"])


def windows(vectors: DataFrame, n_steps: int = N_STEPS) -> DataFrame:
    """Per key and split, the previous ``n_steps`` vectors (``x1`` oldest) and the next one (``y``)."""
    lagged = with_lags(vectors, "k", "vec", n_steps, groups=["split", "EventId"], suffix="_lag")
    out = lagged.select("split", "EventId", "k", "LineId",
                        *[F.col(f"vec_lag{n_steps + 1 - i}").alias(f"x{i}") for i in range(1, n_steps + 1)],
                        F.col("vec").alias("y"))
    return out.where(F.col("k") > n_steps)


def trainable(vectors: DataFrame, min_rows: int = MIN_TRAIN_ROWS) -> DataFrame:
    """A3: keys with more than 8 train rows."""
    return (vectors.where(F.col("split") == "train").groupBy("EventId")
            .agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") >= min_rows))


def predict_mean(win: DataFrame, n_steps: int = N_STEPS) -> DataFrame:
    """forecast = element-wise mean of the last ``n_steps`` vectors."""
    xs = [F.col(f"x{i}") for i in range(1, n_steps + 1)]
    z = F.arrays_zip(*[x.alias(f"a{i}") for i, x in enumerate(xs, 1)])
    mean = F.transform(z, lambda e: sum(e[f"a{i}"].cast("double") for i in range(1, n_steps + 1)) / n_steps)
    return win.withColumn("pred", mean)


def fit_ar1(train_vectors: DataFrame) -> DataFrame:
    """Per key and dimension, ``y_t = intercept + slope * y_{t-1}`` by least squares (SQL aggregates)."""
    lagged = with_lags(train_vectors, "k", "vec", 1, groups=["split", "EventId"], suffix="_lag")
    pairs = lagged.where(F.col("vec_lag1").isNotNull()).select(
        "EventId", F.posexplode(F.arrays_zip(F.col("vec").alias("y"), F.col("vec_lag1").alias("x"))).alias("dim", "p"))
    return (pairs.groupBy("EventId", "dim")
            .agg(F.regr_slope(F.col("p.y").cast("double"), F.col("p.x").cast("double")).alias("slope"),
                 F.regr_intercept(F.col("p.y").cast("double"), F.col("p.x").cast("double")).alias("intercept"),
                 F.avg(F.col("p.y").cast("double")).alias("mean_y")))


def _per_key(model: DataFrame) -> DataFrame:
    """A model of one row per (key, dimension) as one row per key, coefficients in dimension order."""
    cols = [c for c in model.columns if c not in ("EventId", "dim")]
    return model.groupBy("EventId").agg(F.sort_array(F.collect_list(F.struct("dim", *cols))).alias("_m"))


def predict_ar1(win: DataFrame, model: DataFrame, n_steps: int = N_STEPS) -> DataFrame:
    """M5b forecast from the last vector; a constant dimension falls back to its mean.

    The key's coefficients are joined in as one row; the forecast is a projection."""
    z = F.arrays_zip(F.col(f"x{n_steps}").alias("x"), F.col("_m").alias("m"))
    pred = F.transform(z, lambda e: F.when(e["m"]["slope"].isNull(), e["m"]["mean_y"])
                       .otherwise(e["m"]["intercept"] + e["m"]["slope"] * e["x"]))
    return win.join(_per_key(model), "EventId").withColumn("pred", pred).drop("_m")


AR3_SCHEMA = "EventId int, dim int, coef array<double>"


def fit_ar3(train_win: DataFrame, n_steps: int = N_STEPS) -> DataFrame:
    """Per key and dimension, least squares on the last ``n_steps`` values
    plus an intercept.

    The sums of products are SQL aggregates (partial sums before the shuffle);
    only the small system of each (key, dimension) is solved in Python.
    """
    names = [f"x{i}" for i in range(1, n_steps + 1)]
    ex = train_win.select("EventId", F.posexplode(F.arrays_zip(
        *[F.col(x).alias(x) for x in names], F.col("y").alias("y"))).alias("dim", "e"))
    flat = ex.select("EventId", "dim", F.lit(1.0).alias("x0"), *[F.col(f"e.{x}").cast("double").alias(x) for x in names],
                     F.col("e.y").cast("double").alias("y"))
    terms = ["x0", *names]
    pairs = [(a, b) for i, a in enumerate(terms) for b in terms[i:]]
    sums = flat.groupBy("EventId", "dim").agg(
        *[F.sum(F.col(a) * F.col(b)).alias(f"{a}{b}") for a, b in pairs],
        *[F.sum(F.col(a) * F.col("y")).alias(f"{a}y") for a in terms])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            coefs = []
            for row in pdf.to_dict("records"):
                xtx = np.array([[row.get(f"{a}{b}", row.get(f"{b}{a}")) for b in terms] for a in terms])
                coefs.append(np.linalg.lstsq(xtx, np.array([row[f"{a}y"] for a in terms]), rcond=None)[0].tolist())
            yield pd.DataFrame({"EventId": pdf["EventId"], "dim": pdf["dim"], "coef": coefs})

    return sums.mapInPandas(solve, schema=AR3_SCHEMA)


def predict_ar3(win: DataFrame, model: DataFrame, n_steps: int = N_STEPS) -> DataFrame:
    z = F.arrays_zip(*[F.col(f"x{i}").alias(f"x{i}") for i in range(1, n_steps + 1)], F.col("_m").alias("m"))
    pred = F.transform(z, lambda e: e["m"]["coef"][0] + sum(
        e["m"]["coef"][i] * e[f"x{i}"] for i in range(1, n_steps + 1)))
    return win.join(_per_key(model), "EventId").withColumn("pred", pred).drop("_m")


def mse(pred_win: DataFrame) -> DataFrame:
    """A5: mean squared error of each forecast."""
    z = F.arrays_zip(F.col("y").alias("a"), F.col("pred").alias("b"))
    sq = F.aggregate(z, F.lit(0.0), lambda acc, e: acc + (e["a"] - e["b"]) * (e["a"] - e["b"]))
    return pred_win.withColumn("mse", sq / F.size("y"))
