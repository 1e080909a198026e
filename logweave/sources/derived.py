"""Log-shaped views derived from the driver tables (FIXTURES section B).

The reference reads raw system logs that are not shipped; these views build
the same kind of input from the given tables so every query's work grows with
the data:

* ``event_log_lines`` (X1): one log line per ``events`` row.
* ``document_lines`` (X2): every newline-separated line of ``documents``.
* ``lineitem_codes`` (X3): a 42-code event sequence ordered by ship date.
* ``conversation_roles`` (X4): the role sequence of each conversation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.sources.tables import spread, table

# Message body per event type for the X1 log view.
EVENT_BODIES = {
    "error": "link disabled on port",
    "signup": "memory alarm raised on host",
    "purchase": "memory usage resumed alarm cleared",
}
DEFAULT_BODY = "heartbeat from host"


def body_expr(event_type: F.Column) -> F.Column:
    expr = F.lit(DEFAULT_BODY)
    for k, v in reversed(list(EVENT_BODIES.items())):
        expr = F.when(event_type == k, F.lit(v)).otherwise(expr)
    return expr


def event_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line_id = event_id + 1``, line = ``<time>|<event_type>|<body>``."""
    ev = spread(table(spark, sf_dir, "events").select("event_id", "ts", "event_type"), "event_id")
    return ev.select(
        (F.col("event_id") + 1).alias("line_id"),
        F.concat_ws("|", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.col("event_type"),
                    body_expr(F.col("event_type"))).alias("line"),
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, line_no, line)``; line breaks are \\n, \\r and \\r\\n (as text files)."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return docs.select("doc_id", F.posexplode(F.split("text", "\r\n|\r|\n")).alias("pos", "line")) \
        .select("doc_id", (F.col("pos") + 1).cast("long").alias("line_no"), "line")


# Columns after the ship date that make the lineitem order total (FIXTURES X3).
LINEITEM_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                  "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                  "l_linestatus"]


def lineitem_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3 before numbering: every lineitem row with its event code."""
    li = table(spark, sf_dir, "lineitem").select(*LINEITEM_ORDER)
    return li.withColumn("code", F.concat(F.col("l_returnflag"), F.col("l_linestatus"),
                                          F.col("l_linenumber").cast("string")))


def conversation_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, turn, role)``."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")


# Word tokens for frequency tables: lower-cased runs of letters / digits.
WORD_SPLIT = r"[^\p{L}\p{N}]+"
POSITION_STRIDE = 1 << 32  # first_seen = row id * stride + word position


def words(spark: SparkSession, sf_dir: str, source: str = "documents") -> DataFrame:
    """``(sample, pos)``: every word of ``documents`` (or ``benchmark``) text."""
    id_col = {"documents": "doc_id", "benchmark": "item_id", "conversations": "conv_id"}[source]
    t = spread(table(spark, sf_dir, source).select(id_col, "text"), id_col)
    ex = t.select(id_col, F.posexplode(F.split(F.lower("text"), WORD_SPLIT)).alias("i", "sample"))
    return ex.where(F.col("sample") != "").select(
        "sample", (F.col(id_col) * F.lit(POSITION_STRIDE) + F.col("i") + 1).alias("pos"))
