"""End-to-end jobs and contract checks."""

import os

from pyspark.sql import functions as F

import __spark_entry__ as E
from logweave.functions.textclean import clean_param, py_list_repr, tokenizer_words
from logweave.operators import labels as L
from logweave.plans.labelling import labels_for_logs, run_label_job
from logweave.sources.derived import event_log_lines
from logweave.sources.text import read_lines

from conftest import SF_SMALL


def test_entry_and_contract(spark):
    df = E.entry(spark)
    assert df.columns == ["LogName", "TimeSlice", "Label"]
    assert df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)


def test_rollup_equals_literal_dedup_sum(spark):
    lines = event_log_lines(spark, SF_SMALL)
    labels = labels_for_logs({"messages": lines, "sysmonitor": lines})
    a = L.bucket_labels(labels).collect()
    b = L.bucket_labels_literal(labels).collect()
    assert a == b


def test_text_scan_numbering_and_bad_bytes(spark, tmp_path):
    d = tmp_path / "logs"
    d.mkdir()
    (d / "a.txt").write_bytes(b"2021-07-01T10:00:00|r|one\n2021-07-01T10:00:01|r|two\n")
    (d / "b.txt").write_bytes(b"2021-07-01T10:00:02|r|three\n\xff\xfe bad\n\n2021-07-01T10:00:03 x: four")
    per_file = read_lines(spark, str(d)).select(F.element_at(F.split("file_path", "/"), -1).alias("f"),
                                                "line_id", "utf8_ok").collect()
    got = sorted((r.f, r.line_id, r.utf8_ok) for r in per_file)
    assert got == [("a.txt", 1, True), ("a.txt", 2, True), ("b.txt", 1, True), ("b.txt", 2, False),
                   ("b.txt", 3, True), ("b.txt", 4, True)]
    glob = read_lines(spark, str(d), across_files=True).select("line_id").collect()
    assert sorted(r.line_id for r in glob) == [1, 2, 3, 4, 5, 6]
    from logweave.operators.parse import parse_log, reject_rows
    rej = {r.line_id: r.reject_reason for r in reject_rows(parse_log(read_lines(spark, str(d), across_files=True)))
           .collect()}
    assert rej == {4: "bad_utf8", 5: "blank"}


def test_label_job_writes_csv_and_marker(spark, tmp_path):
    test_dir = tmp_path / "test"
    test_dir.mkdir()
    (test_dir / "messages_testset.txt").write_text("2021-07-01T10:00:00|r|link disabled\n2021-07-01T10:01:00|r|ok\n")
    (test_dir / "sysmonitor_testset.txt").write_text("2021-07-01T10:00:00 mon: memory alarm\n")
    out = tmp_path / "result"
    res = run_label_job(spark, str(test_dir), str(out))
    assert sorted(tuple(r) for r in res.collect()) == [("messages", 5417112, 1), ("sysmonitor", 5417112, 1)]
    assert os.path.isdir(out / "predict.csv") and os.path.isdir(out / "predict_finish.csv")
    marker = spark.read.option("header", True).csv(str(out / "predict_finish.csv")).collect()
    assert [r.result for r in marker] == ["TRUE"]


def test_param_text_cleaning(spark):
    r = spark.range(1).select(
        clean_param(py_list_repr(F.array(F.lit("rhost=218.188.2.4"), F.lit("user=root"), F.lit("<:NUM:>")))).alias("c"),
        tokenizer_words(F.lit("21818824userroot<NUM>")).alias("w")).first()
    assert r.c == "21818824userroot<NUM>"
    assert r.w == ["21818824userroot", "num"]
