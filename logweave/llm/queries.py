"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import (chat_format, decontaminate, exact_dedup, filter_audit, html_text, lang_id, line_dedup, lm_score, ngram_join,
                          packing, prefix_trie, suffix_dedup, toxicity)
from logweave.llm.common import bucket_is, table
from logweave.llm.registry import register

SPACES = r"[\x20\x09-\x0D]"

OP9_SQL = """
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm,
         length(coalesce(text, '')) AS points FROM documents),
k AS (
  SELECT doc_id, norm, count(*) OVER g AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id
  FROM d WINDOW g AS (PARTITION BY norm))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
"""


@register("op1_ngram_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"), width=4, percent=85)


@register("op2_html_text")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.html_text(table(spark, sf_dir, "pages"))


@register("op3_suffix_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register("op4_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@register("op5_line_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


@register("op6_decontaminate")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op7_chat_format", chat_format.ORACLE_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.rotate(table(spark, sf_dir, "conversations"))


@register("op8_lm_score")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = bucket_is("doc_id", 5, 1)
    model, counts = lm_score.train(docs.filter(~held))
    return lm_score.score(docs, held, model, counts)


@register("op9_exact_dedup", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@register("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = bucket_is("doc_id", 4, 2)
    model = lang_id.train(docs.filter(~held))
    out = lang_id.predict(docs, model)
    return out.select("doc_id", bucket_is("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


@register("op11_prefix_trie", prefix_trie.ORACLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@register("op12_toxicity")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op13_filter_audit", filter_audit.ORACLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
