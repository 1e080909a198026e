"""Packing into optimal length buckets.

A text's length is its number of words plus one end mark; a text longer than
``max_len`` continues in further segments, so that every token is packed. The
global histogram of segment lengths (``max_len`` entries at most) goes through a
dynamic programme that chooses the bucket boundaries with the least padding.
In a bucket, segments are numbered in a fixed order (shard by shard, shards by
hash) and each batch takes as many as the token budget allows at the bucket's
padded length; only a bucket's last batch may be short.

Null and empty texts have length 1. Rows that repeat are packed each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MAX_LEN = 2048
BUCKETS = 16
BUDGET = 32_768
SHARDS = 4096


def boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` buckets with the least total padding (rising; the last is the longest length)."""
    lengths = np.array(sorted(histogram), np.int64)
    if not len(lengths):
        return []
    counts = np.array([histogram[v] for v in lengths], np.float64)
    number = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)])
    n, k = len(lengths), min(buckets, len(lengths))
    best = np.full(n + 1, np.inf)
    best[0] = 0
    back = np.zeros((k + 1, n + 1), np.int64)
    for b in range(1, k + 1):
        now = np.full(n + 1, np.inf)
        for j in range(1, n + 1):
            # bucket b takes lengths i .. j - 1, padded to lengths[j - 1]
            cost = best[:j] + lengths[j - 1] * (number[j] - number[:j]) - (tokens[j] - tokens[:j])
            i = int(cost.argmin())
            now[j], back[b, j] = cost[i], i
        best = now
    out, j = [], n
    for b in range(k, 0, -1):
        out.append(int(lengths[j - 1]))
        j = int(back[b, j])
    return out[::-1]


def segments(docs: DataFrame, max_len: int) -> DataFrame:
    """doc_id, segment, start_token, n_tokens and a hash of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")) + 1
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), F.xxhash64(text).alias("key"))
            .select("doc_id", "key", "size", F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / max_len).cast("int"))).alias("segment"))
            .select("doc_id", "key", "segment", (F.col("segment").cast("long") * max_len).alias("start_token"),
                    F.least(F.lit(max_len), F.col("size") - F.col("segment") * max_len).cast("int").alias("n_tokens")))


def pack(docs: DataFrame, max_len: int = MAX_LEN, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """doc_id, segment, start_token, n_tokens, bucket, padded_len, batch, slot: one row per segment."""
    if budget < max_len:
        raise ValueError("a batch must hold one segment at least")
    parts = segments(docs, max_len)
    histogram = {r["n_tokens"]: r["n"] for r in parts.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}  # <= max_len rows
    ends = boundaries(histogram, buckets)
    bucket, padded = F.lit(0), F.lit(ends[0] if ends else 1)
    for i, end in enumerate(ends[:-1]):
        bucket = F.when(F.col("n_tokens") > end, i + 1).otherwise(bucket)
        padded = F.when(F.col("n_tokens") > end, ends[i + 1]).otherwise(padded)
    placed = (parts.withColumn("bucket", bucket).withColumn("padded_len", padded)
              .withColumn("shard", F.pmod(F.xxhash64("doc_id", "segment", "key"), F.lit(SHARDS)).cast("int")))
    sizes = placed.groupBy("bucket", "shard").agg(F.count("*").alias("n"))  # buckets x SHARDS rows
    before = F.sum("n").over(W.partitionBy("bucket").orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("bucket", "shard", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(W.partitionBy("bucket", "shard").orderBy("doc_id", "segment", "key"))
    numbered = (placed.withColumn("rank", rank).join(F.broadcast(offsets), ["bucket", "shard"])
                .withColumn("index", F.col("before") + F.col("rank") - 1))
    per_batch = F.floor(F.lit(budget) / F.col("padded_len"))
    return numbered.select("doc_id", "segment", "start_token", "n_tokens", "bucket", "padded_len",
                           F.floor(F.col("index") / per_batch).cast("long").alias("batch"),
                           (F.col("index") % per_batch).cast("int").alias("slot"))
