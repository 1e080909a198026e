"""Filter interaction audit by failing-id relations.

Each filter has one written table: the ids of the rows that fail it. Everything
else is joins of such tables. The survivors of all prefixes (the 32 sets of filters
that can come first) are one relation of (prefix, id) rows, which grows by one
filter at a time: every row is doubled (prefix without and with the filter), and a
left-anti join with the filter's ids drops the rows of prefixes that hold it. A
left-semi join of the survivors with the ids of each filter outside the prefix
gives what that filter removes next. Redundancies, sole failures and losses are
counts of the same relations; an order of the filters only looks its prefixes up.

Only rows that fail something enter the relation; the others are counted once (a
left-anti join with all ids) and survive every prefix. All joins after the first are
on the row id, which is unique, so no key is hot; texts are shuffled nowhere, and the
repeated texts of filter E meet by digest, groups of over 1 / ``HOT`` of all rows by a
broadcast join (at most ``HOT`` such groups exist).

The filters (words are maximal runs of ``[^\\x20\\x09-\\x0D]``, case-sensitive; null
text counts as empty): A under 100 words; B 100 x distinct words < 80 x words;
C 100 x ``[A-Z]`` characters > 10 x code points; D holds one of ``#$%&*|``; E the same
text as a row with a smaller doc_id anywhere in the table.

Defined results: a null lang is the part ``''``. Rows are judged one by one, also rows
that repeat: rows of the same doc_id do not fail E because of each other, and a null
doc_id neither fails E nor makes others fail it. A doc_id with several labels counts as
good or toxic if one of them says so; a null doc_id has no label. An empty table has no
parts and gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import itertools
from functools import reduce
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import materialize

FILTERS = "ABCDE"
# Texts repeated by at least 1 / HOT of all rows are joined by broadcast: at most HOT of them.
HOT = 4096
_BLANK = r"[\x20\x09-\x0D]+"
_TRIM = " \t\n\x0b\x0c\r"


def _judged(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, part, A, B, C, D, digest) per row; ``rid`` is fixed by writing it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = (docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"))
            .withColumn("stripped", F.btrim("text", F.lit(_TRIM)))
            .withColumn("words", F.when(F.col("stripped") == "", F.array().cast("array<string>"))
                        .otherwise(F.split("stripped", _BLANK))))
    n = F.size("words")
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    return rows.select(
        "rid", "doc_id", "part", (n < 100).alias("A"), (100 * F.size(F.array_distinct("words")) < 80 * n).alias("B"),
        (100 * capitals > 10 * F.length("text")).alias("C"), F.col("text").rlike("[#$%&*|]").alias("D"),
        F.unhex(F.sha2("text", 256)).alias("digest"))


def _later_copies(rows: DataFrame) -> DataFrame:
    """Row ids whose digest also occurs with a smaller doc_id."""
    total = rows.count()
    groups = materialize(rows.groupBy("digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
                         .filter("n > 1"), "audit-copies")
    is_hot = F.col("n") * HOT >= total
    hot = F.broadcast(groups.filter(is_hot).select("digest", "first"))
    narrow = rows.select("rid", "doc_id", "digest")
    cold = narrow.join(hot.select("digest"), "digest", "left_anti").join(groups.filter(~is_hot).select("digest", "first"), "digest")
    return narrow.join(hot, "digest").unionByName(cold).filter("doc_id > first").select("rid")


def failing_ids(rows: DataFrame) -> dict[str, DataFrame]:
    """One written id table per filter."""
    tables = {f: rows.filter(F.col(f)).select("rid") for f in FILTERS[:4]} | {"E": _later_copies(rows)}
    return {f: materialize(t, f"audit-fails-{f}") for f, t in tables.items()}


def _bit(i: int) -> int:
    return 1 << i


def survivors(failing: DataFrame, ids: dict[str, DataFrame]) -> DataFrame:
    """Every (prefix, row) such that the row of ``failing`` fails no filter of the prefix (a set of bits)."""
    out = failing.withColumn("prefix", F.lit(0))
    for i, f in enumerate(FILTERS):
        out = out.withColumn("prefix", F.explode(F.array(F.col("prefix"), F.col("prefix") + _bit(i))))
        gone = ids[f].withColumnRenamed("rid", "gone_id")
        out = out.join(gone, (F.col("rid") == F.col("gone_id")) & (F.col("prefix").bitwiseAND(_bit(i)) != 0), "left_anti")
    return out


def removals(alive: DataFrame, ids: dict[str, DataFrame]) -> DataFrame:
    """(part, prefix, bit, removed, good_lost, toxic_lost): what each filter removes after each prefix without it."""
    fails = reduce(DataFrame.unionByName, [t.select(F.col("rid").alias("fail_id"), F.lit(_bit(i)).alias("fail_bit"))
                                           for i, t in enumerate(ids[f] for f in FILTERS)])
    turns = (alive.withColumn("bit", F.explode(F.array(*[F.lit(_bit(i)) for i in range(len(FILTERS))])))
             .filter(F.col("prefix").bitwiseAND(F.col("bit")) == 0))
    hit = turns.join(fails, (F.col("rid") == F.col("fail_id")) & (F.col("bit") == F.col("fail_bit")), "left_semi")
    return hit.groupBy("part", "prefix", "bit").agg(F.count("*").alias("removed"), F.sum("good").alias("good_lost"),
                                                    F.sum("toxic").alias("toxic_lost"))


def _turns(parts: DataFrame) -> DataFrame:
    """part, filter_order, step, and the step's prefix and bit, for every order of the filters."""
    orders = ["".join(p) for p in itertools.permutations(FILTERS)]
    bit: Column = F.expr("shiftleft(1, ascii(substr(filter_order, step, 1)) - 65)")
    prefix = F.expr("aggregate(slice(sequence(1, 5), 1, step - 1), 0, "
                    "(m, k) -> m + shiftleft(1, ascii(substr(filter_order, k, 1)) - 65))")
    return (parts.withColumn("filter_order", F.explode(F.array(*map(F.lit, orders))))
            .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
            .withColumns({"prefix": prefix, "bit": bit}))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter order and step; see the module text and the query's contract."""
    rows = materialize(_judged(docs), "audit-rows")
    ids = failing_ids(rows)
    any_id = reduce(DataFrame.unionByName, ids.values()).distinct()

    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    narrow = rows.select("rid", "doc_id", "part")
    failing = materialize(narrow.join(any_id, "rid", "left_semi").join(marks, "doc_id", "left")
                          .select("rid", "part", F.coalesce("good", F.lit(0)).alias("good"),
                                  F.coalesce("toxic", F.lit(0)).alias("toxic")), "audit-failing")
    clean = narrow.join(any_id, "rid", "left_anti").groupBy("part").agg(F.count("*").alias("clean"))

    alive = survivors(failing, ids)
    left = alive.groupBy("part", "prefix").agg(F.count("*").alias("left"))
    # at most 80 rows a part from here on
    gone = materialize(removals(alive, ids), "audit-removals")
    weight = F.expr("case bit_count(prefix) " + " ".join(
        f"when {k} then {factorial(k) * factorial(len(FILTERS) - 1 - k)}" for k in range(len(FILTERS))) + " end")
    whole = _bit(len(FILTERS)) - 1
    per_filter = gone.groupBy("part", "bit").agg(
        F.sum(F.when(F.col("prefix") == 0, F.col("removed"))).alias("fails"),
        F.sum(F.when(F.col("prefix") + F.col("bit") == whole, F.col("removed"))).alias("unique_fails"),
        F.sum(weight * F.col("removed")).alias("shapley"))

    parts = materialize(rows.groupBy("part").agg(F.count("*").alias("n")).join(clean, "part", "left")
                        .select("part", F.coalesce("clean", F.lit(0)).alias("clean")), "audit-parts")
    after = left.withColumnRenamed("prefix", "after")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    out = (_turns(parts).withColumn("after", F.col("prefix") + F.col("bit"))
           .join(after, ["part", "after"], "left").join(gone, ["part", "prefix", "bit"], "left")
           .join(per_filter, ["part", "bit"], "left"))
    return out.select("part", "filter_order", F.col("step").cast("int").alias("step"),
                      (F.col("clean") + zero("left")).cast("long").alias("kept"), zero("removed").alias("removed"),
                      (zero("fails") - zero("removed")).alias("redundant"), zero("unique_fails").alias("unique_fails"),
                      zero("good_lost").alias("good_lost"), zero("toxic_lost").alias("toxic_lost"), zero("shapley").alias("shapley"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
f AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
             max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN d.doc_id > first THEN 16 ELSE 0 END AS mask
  FROM d JOIN f USING (text) LEFT JOIN l ON l.doc_id = d.doc_id),
g AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
c(ch, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (
  SELECT c1.ch || c2.ch || c3.ch || c4.ch || c5.ch AS filter_order, [c1.b, c2.b, c3.b, c4.b, c5.b] AS bits
  FROM c c1, c c2, c c3, c c4, c c5
  WHERE len(list_distinct([c1.ch, c2.ch, c3.ch, c4.ch, c5.ch])) = 5),
s AS (
  SELECT filter_order, step, bits[step] AS b, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (
  SELECT part, filter_order, step, s.b,
         sum(CASE WHEN mask & (before | s.b) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & s.b <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & before <> 0 AND mask & s.b <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = s.b THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & s.b <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & s.b <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM s, g GROUP BY part, filter_order, step, s.b)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, b))::BIGINT AS shapley
FROM r
"""
