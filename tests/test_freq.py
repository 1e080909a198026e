"""Frequency-table goldens from the reference docstrings (FIXTURES D)."""

import pytest

from logweave.operators import freq as FQ


def fd(spark, text):
    df = spark.createDataFrame([(c, i) for i, c in enumerate(text)], "sample string, pos long")
    return FQ.freqdist(df, "sample", "pos")


def as_dict(df):
    return {r.sample: r.cnt for r in df.collect()}


def test_add_sub_union_intersect(spark):
    assert as_dict(FQ.add(fd(spark, "abbb"), fd(spark, "bcc"))) == {"b": 4, "c": 2, "a": 1}
    assert as_dict(FQ.subtract(fd(spark, "abbbc"), fd(spark, "bccd"))) == {"b": 2, "a": 1}
    assert as_dict(FQ.union_max(fd(spark, "abbb"), fd(spark, "bcc"))) == {"b": 3, "c": 2, "a": 1}
    assert as_dict(FQ.intersect_min(fd(spark, "abbb"), fd(spark, "bcc"))) == {"b": 1}


@pytest.mark.parametrize("a,b,le", [("abc", "aabc", True), ("aabc", "abc", False), ("a", "abcd", True),
                                    ("abc", "xyz", False), ("xyz", "abc", False), ("a", "a", True)])
def test_le(spark, a, b, le):
    assert FQ.compare(fd(spark, a), fd(spark, b)).first().le is le


def test_totals_hapax_max_nr(spark):
    f = fd(spark, "abbbcc")
    t = FQ.totals(f).first()
    assert (t.N, t.B) == (6, 3)
    assert [r.sample for r in FQ.hapaxes(f).collect()] == ["a"]
    assert FQ.max_sample(f).first().sample == "b"
    nr = {r.r: r.Nr for r in FQ.freq_of_freq(f, 5).collect()}
    assert nr == {1: 1, 2: 1, 3: 1, 0: 2}
    assert FQ.max_sample(f.limit(0)).count() == 0


def test_most_common_ties_first_seen_and_cumulative(spark):
    f = fd(spark, "cabbcd")  # c:2 b:2 a:1 d:1 ; c seen first
    mc = FQ.most_common(f).orderBy("rank").collect()
    assert [r.sample for r in mc] == ["c", "b", "a", "d"]
    cum = FQ.cumulative(f, percents=True).orderBy("rank").collect()
    assert [r.cum_cnt for r in cum] == [2, 4, 5, 6]
    assert cum[-1].cum_pct == 100.0


def test_edit(spark):
    f = fd(spark, "aab")
    assert as_dict(FQ.set_count(f, "a", 5)) == {"a": 5, "b": 1}
    assert as_dict(FQ.delete(f, "a")) == {"b": 1}
    assert as_dict(FQ.setdefault(f, "a", 9)) == {"a": 2, "b": 1}
    assert as_dict(FQ.setdefault(f, "z", 9)) == {"a": 2, "b": 1, "z": 9}


def test_a_null_sample_is_a_sample(spark):
    a = spark.createDataFrame([("x", 3), (None, 2)], "sample string, cnt long")
    b = spark.createDataFrame([("y", 1), (None, 5)], "sample string, cnt long")
    assert as_dict(FQ.delete(a, "x")) == {None: 2}
    assert as_dict(FQ.delete(a, None)) == {"x": 3}
    assert as_dict(FQ.set_count(a, "x", 9)) == {"x": 9, None: 2}
    assert as_dict(FQ.setdefault(a, None, 7)) == {"x": 3, None: 2}
    assert as_dict(FQ.intersect_min(a, b)) == {None: 2}
    assert as_dict(FQ.add(a, b)) == {"x": 3, "y": 1, None: 7}
    assert FQ.compare(a, a).first().eq and not FQ.compare(a, b).first().le
