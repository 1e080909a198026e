"""n-gram / padding goldens and order-helper invariants."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from logweave.operators.ngrams import array_ngrams, pad_array, row_ngrams, row_pad
from logweave.operators.order import dense_index, running_sum, time_gap, with_lags


def seq_df(spark, items, group=0):
    return spark.createDataFrame([(group, i + 1, str(x)) for i, x in enumerate(items)], "g int, idx long, item string")


def grams(df, n):
    return [tuple(r[f"g{k}"] for k in range(1, n + 1)) for r in df.orderBy("idx").collect()]


def test_ngrams_goldens(spark):
    s = seq_df(spark, [1, 2, 3, 4, 5])
    assert grams(row_ngrams(s, "idx", "item", 3, groups=["g"]), 3) == [("1", "2", "3"), ("2", "3", "4"), ("3", "4", "5")]
    padded = row_pad(s, "idx", "item", 2, groups=["g"], pad_right=True)
    assert grams(row_ngrams(padded, "idx", "item", 2, groups=["g"]), 2)[-1] == ("5", None)
    both = row_pad(s, "idx", "item", 2, groups=["g"], pad_left=True, pad_right=True,
                   left_pad_symbol="<s>", right_pad_symbol="</s>")
    assert grams(row_ngrams(both, "idx", "item", 2, groups=["g"]), 2) == [
        ("<s>", "1"), ("1", "2"), ("2", "3"), ("3", "4"), ("4", "5"), ("5", "</s>")]
    assert row_ngrams(seq_df(spark, [1, 2]), "idx", "item", 3, groups=["g"]).count() == 0


def test_array_forms(spark):
    df = spark.createDataFrame([(["1", "2", "3", "4", "5"],), (["1"],)], "a array<string>")
    r = df.select(pad_array(F.col("a"), 2, True, True, "<s>", "</s>").alias("p"),
                  array_ngrams(F.col("a"), 3).alias("g")).collect()
    assert r[0].p == ["<s>", "1", "2", "3", "4", "5", "</s>"]
    assert r[0].g == [["1", "2", "3"], ["2", "3", "4"], ["3", "4", "5"]]
    assert r[1].g == []


def test_dense_index_and_chunked_windows_equal_global(spark):
    rnd = random.Random(7)
    data = [(rnd.choice(["a", "b"]), rnd.randint(0, 10_000), i) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, v long, uid long")
    idx = dense_index(df, ["v", "uid"], out="seq", groups=["g"])
    ref = df.withColumn("seq", F.row_number().over(Window.partitionBy("g").orderBy("v", "uid")))
    assert sorted(idx.select("g", "uid", "seq").collect()) == sorted(ref.select("g", "uid", "seq").collect())
    lag = with_lags(idx, "seq", "v", 3, groups=["g"], chunk=17)
    w = Window.partitionBy("g").orderBy("seq")
    ref2 = idx.select("g", "seq", *[F.lag("v", k).over(w).alias(f"v_lag{k}") for k in (1, 2, 3)])
    assert sorted(lag.select("g", "seq", "v_lag1", "v_lag2", "v_lag3").collect()) == sorted(ref2.collect())
    rs = running_sum(idx, "seq", "v", "cum", groups=["g"], chunk=13)
    ref3 = idx.select("g", "seq", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"))
    assert sorted(rs.select("g", "seq", "cum").collect()) == sorted(ref3.collect())
    gap = time_gap(idx.withColumn("epoch", F.col("v")), "seq", "epoch", groups=["g"], chunk=11)
    first = gap.where("seq = 1").select("time_gap").distinct().collect()
    assert [r.time_gap for r in first] == [0]
