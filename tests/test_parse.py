"""Edge lines for the log parser (FIXTURES C) and the parsed + rejects invariant."""

from pyspark.sql import functions as F

from logweave.functions import rules as R
from logweave.operators.parse import parse_log, parsed_rows, reject_rows
from logweave.sources.derived import event_log_lines

from conftest import SF_SMALL

EDGE = [
    (1, "2021-07-01T10:00:00.1+08:00|port| link Disabled "),
    (2, "2021-07-01T10:00:00 host daemon: lose cover"),
    (3, "2021-07-01T10:00:00 a: b|c: d"),
    (4, "2021-1-2T3:4:5|r|m"),
    (5, "2021-02-30T00:00:00|r|m"),
    (6, ""),
    (7, "   \t "),
    (8, "2021-07-01T10:00:00 no separators here"),
    (9, "2021-07-01T10:00:00 : m"),
    (10, "   2021-07-01T10:00:00|r|m"),
    (11, "2021-07-01T10:00:00|r|　msg　"),
    (12, "2021-07-01T10:00:00" + "\x00" * 20 + "|r|m"),
]


def parsed_map(spark):
    df = spark.createDataFrame(EDGE, "line_id long, line string")
    return {r.line_id: r for r in parse_log(df).collect()}


def test_edge_lines(spark):
    p = parsed_map(spark)
    assert (p[1].reason, p[1].message, p[1].reject_reason) == ("port", "link Disabled", None)
    assert (p[2].reason, p[2].message) == ("daemon", "lose cover")
    assert (p[3].reason, p[3].message) == ("a: b", "c: d")
    assert p[4].reject_reason is None and p[4].epoch is not None
    assert p[5].reject_reason == "bad_time"
    assert p[6].reject_reason == "blank" and p[7].reject_reason == "blank"
    assert p[8].reject_reason == "no_separator"
    assert (p[9].reason, p[9].message, p[9].reject_reason) == (None, "m", None)
    assert (p[10].reason, p[10].message) == ("r", "m")
    assert p[11].message == "msg"
    assert p[12].reject_reason is None and (p[12].reason, p[12].message) == ("r", "m")


def test_time_bucket_utc(spark):
    df = spark.createDataFrame([(1, "1970-01-01T00:05:00|r|m")], "line_id long, line string")
    r = parse_log(df).first()
    assert r.epoch == 300 and r.time_bucket == 1


def test_labels_unicode_case(spark):
    df = spark.createDataFrame([("LOſE COVER",), ("memory alarm",), ("alarm on memory",), ("resumed alarm",),
                                ("alarm only",), (None,)], "message string")
    out = df.select(R.messages_label(F.col("message")).alias("m"), R.sysmonitor_label(F.col("message")).alias("s"))
    got = [(r.m, r.s) for r in out.collect()]
    assert got[0][0] == 1
    assert [g[1] for g in got[1:]] == [1, 1, 1, 0, 0]


def test_parsed_plus_rejects_is_input(spark):
    lines = event_log_lines(spark, SF_SMALL)
    p = parse_log(lines)
    assert parsed_rows(p).count() + reject_rows(p).count() == lines.count()
