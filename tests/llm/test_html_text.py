import time

import pytest

from logweave.llm.html_text import extract, html_text


@pytest.mark.parametrize("source,text", [
    (None, None), ("", ""), ("plain &amp; simple", "plain & simple"),
    ("<p>one<p>two", "one\n\ntwo"), ("<div>a</div><div>b</div>c", "a\nb\nc"),
    ("a <b> b</b>c  \n d<br>e", "a bc d\ne"),
    ("<head><title>T</title><style>p{}</style></head><body>x<script>var a='</p>';</script>y", "xy"),
    ("<p>a<span hidden>b</span><i style='color:red; display : none'>c</i>d", "ad"),
    ("<ul><li>one<li>two<ul><li>in</ul></ul>", "- one\n- two\n  - in"),
    ("<ol start=3><li>x</li><li><p>y</p></li></ol>", "3. x\n\n4. y"),
    ("<table><tr><th>k<th>value<tr><td>long key<td>1</table>after", "k        | value\nlong key | 1\n\nafter"),
    ("<table><tr><td colspan=2>wide one<tr><td>a<td>b</table>", "wide one\na | b"),
    ("<table><caption>c</caption><tr><td>a<table><tr><td>x<td>y</table><td>b</table>", "c\na     | b\n\nx | y"),
    ("<pre>  a\n    b</pre>", "  a\n    b"), ("</p>x</div>y", "xy"), ("<!-- <p>no --><!doctype html>yes", "yes"),
    ("a<img alt='pic'>b<input type=hidden value=q>", "a pic b"), ("<p>unclosed <b>bold <i>it", "unclosed bold it"),
    ("1 < 2 <3 >", "1 < 2 <3 >"), ("<a href='x>y'>l</a>", "l"), ("<dl><dt>t<dd>d<dt>u</dl>", "t\nd\nu"),
    ("<meta charset=x><p>hi", "hi"), ("<p title=\"open", ""),
])
def test_rendering(source, text):
    assert extract(source) == text


@pytest.mark.parametrize("source,text", [
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a | b\n  | c"),
    ("<table><tr><td>x<td rowspan=3>y<td>z<tr><td>1<td>2<tr><td>3<td>4</table>", "x | y | z\n1 |   | 2\n3 |   | 4"),
    ("<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>", "a | b\n  | c\n  | d"),
    ("<table><tr><td>a<td colspan=2 rowspan=2>bb<td>c<tr><td>d<td>e</table>", "a | bb  | c\nd |  |  | e"),
    ("<table><tr><td>k<td><table><tr><td>1<td>22<tr><td>333<td>4</table><tr><td>long<td>v</table>",
     "k    | 1   | 22\n     | 333 | 4\nlong | v"),
    ("<table><tr><td><td>b<tr><td><td></table>", " | b"),
    ("<table><tr><td colspan=x rowspan=-1>a<td>b</table>", "a | b"),
    ("<div style='visibility:hidden'>a<b style='visibility: visible'>b<i>c</i></b>d</div>e", "bc\ne"),
    ("<p style='display:nonexistent'>shown<p style='display: none '>gone", "shown"),
    ("<p style='visibility:hiddenish'>shown", "shown"), ("<p style='visibility:collapse'>x<img alt=y></p>z", "z"),
    ("<select><option>one<option selected>two</select>", "one\ntwo"),
    ("<select><optgroup><option>a</optgroup></select>b", "a\nb"),
    ("<textarea>  typed &amp; kept\n line</textarea>", "  typed & kept\n line"),
    ("<math><mi>x</mi><mo>=</mo><mn>1</mn></math>", "x=1"),
    ("<svg><title>no</title><desc>no</desc><defs><text>no</text></defs><text>label</text></svg>", "label"),
])
def test_spans_visibility_forms_and_formulas(source, text):
    assert extract(source) == text


@pytest.mark.parametrize("page", [
    "<b>" * 150_000 + "</i>" * 150_000, "<p><button>" + "<b>" * 100_000 + "<div>x" * 60_000,
    "<li><ul>" + "<b>" * 100_000 + "</li>" * 100_000, "<table>" + "<tr><td rowspan=65534>x" * 40_000,
    "<td>" + "<i>" * 100_000 + "</b></p>" * 60_000,
])
def test_a_hostile_page_takes_linear_time(page):
    extract("<p>warm")
    start = time.process_time()
    extract(page)
    assert time.process_time() - start < 4


def test_deep_and_long_pages():
    assert extract("<div>" * 50_000 + "deep") == "deep"
    assert extract("<p>w</p>" * 20_000).count("w") == 20_000
    assert extract("<li>" * 3000 + "z").endswith("z")
    assert extract("<!--" + "x" * 100_000) == ""


def test_every_word_survives(spark):
    rows = [(1, "u", "<p>a b</p>", 0), (None, None, None, 1), (2, "u", "", 2), (2, "u", "", 2), (3, "v", "<table><td>q</table>", 4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(((r.page_id, r.text) for r in html_text(df).collect()), key=repr)
    assert got == sorted([(1, "a b"), (None, None), (2, ""), (2, ""), (3, "q")], key=repr)
    assert html_text(df.filter("page_id > 9")).count() == 0
