"""Exact dedup by a Golomb-coded fingerprint exchange.

1. Every task reads its share of the rows, computes one fingerprint per row
   (48 bits of the SHA-256 of the normalised text), sorts the distinct ones and
   sends them, split by owner range and Rice coded, to the owners. Texts stay.
2. An owner decodes what all senders sent, finds the fingerprints that more
   than one sender has (or one sender has twice) and answers each sender with
   a bitmap, one bit per fingerprint in sending order.
3. Only the rows that the bitmaps mark are suspects. Their normalised texts are
   shuffled and compared byte by byte; of equal texts one row stays.

Rows: a null text counts as empty; a null id sorts after every other id; rows
that repeat entirely are separate rows and one of them stays.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import SPACE, likely_rows, materialize, shuffle_partitions, small_batches

FP_BITS = 48
# Rows after which a sender closes a run and starts the next (bounds its memory).
RUN_ROWS = 200_000

_SENT = ("row_id long, doc_id long, n_points long, sha string, sender long, owner int, rank int, "
         "n_sent int, blob binary")


def rice_encode(values: np.ndarray) -> bytes:
    """Sorted non-negative integers as Rice-coded gaps: header, unary quotients, remainders."""
    n = len(values)
    if n == 0:
        return struct.pack("<IB", 0, 0)
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    k = max(0, int(np.log2(max(1.0, float(values[-1]) / n))))
    q = (gaps >> np.uint64(k)).astype(np.int64)
    stops = np.cumsum(q + 1) - 1
    unary = np.ones(int(stops[-1]) + 1, np.uint8)
    unary[stops] = 0
    rem = gaps & np.uint64((1 << k) - 1)
    bits = ((rem[:, None] >> np.arange(k - 1, -1, -1, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return struct.pack("<IB", n, k) + struct.pack("<I", len(unary)) + np.packbits(unary).tobytes() \
        + np.packbits(bits.ravel()).tobytes()


def rice_decode(blob: bytes) -> np.ndarray:
    n, k = struct.unpack_from("<IB", blob)
    if n == 0:
        return np.zeros(0, np.uint64)
    (m,) = struct.unpack_from("<I", blob, 5)
    cut = 9 + (m + 7) // 8
    unary = np.unpackbits(np.frombuffer(blob[9:cut], np.uint8), count=m)
    q = np.diff(np.flatnonzero(unary == 0), prepend=-1) - 1
    rem = np.zeros(n, np.uint64)
    if k:
        bits = np.unpackbits(np.frombuffer(blob[cut:], np.uint8), count=n * k).reshape(n, k)
        for j in range(k):
            rem = (rem << np.uint64(1)) | bits[:, j].astype(np.uint64)
    return np.cumsum((q.astype(np.uint64) << np.uint64(k)) | rem)


def _send(owners: int):
    width = (1 << FP_BITS) // owners + 1

    def flush(sender, ids, points, shas):
        fps = np.array([int(s[:FP_BITS // 4], 16) for s in shas], np.uint64)
        own = (fps // np.uint64(width)).astype(np.int32)
        distinct, at, count = np.unique(fps, return_inverse=True, return_counts=True)
        first = np.searchsorted(distinct, np.arange(owners, dtype=np.uint64) * np.uint64(width))
        ranks = (at - first[own]).astype(np.int32)
        n = len(ids)
        yield pa.RecordBatch.from_pydict({
            "row_id": pa.array(sender * RUN_ROWS + np.arange(n)), "doc_id": pa.array(ids, pa.int64()),
            "n_points": pa.array(points, pa.int64()), "sha": pa.array(shas),
            "sender": pa.array(np.full(n, sender)), "owner": pa.array(own), "rank": pa.array(ranks),
            "n_sent": pa.nulls(n, pa.int32()), "blob": pa.nulls(n, pa.binary())})
        bounds = np.append(first, len(distinct))
        to = [o for o in range(owners) if bounds[o] < bounds[o + 1]]
        blobs = []
        for o in to:
            part = slice(bounds[o], bounds[o + 1])
            # the low bit says that the sender itself has the fingerprint more than once
            coded = ((distinct[part] - np.uint64(o * width)) << np.uint64(1)) | (count[part] > 1)
            blobs.append(rice_encode(coded))
        m = len(to)
        none = pa.nulls(m, pa.int64())
        yield pa.RecordBatch.from_pydict({
            "row_id": none, "doc_id": none, "n_points": none, "sha": pa.nulls(m, pa.string()),
            "sender": pa.array(np.full(m, sender)), "owner": pa.array(to, pa.int32()),
            "rank": pa.nulls(m, pa.int32()),
            "n_sent": pa.array([int(bounds[o + 1] - bounds[o]) for o in to], pa.int32()),
            "blob": pa.array(blobs, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, runs = TaskContext.get().partitionId(), 0
        ids: list = []
        points: list = []
        shas: list = []
        for b in batches:
            text = b.column(1)
            points += pc.fill_null(pc.utf8_length(text), 0).to_pylist()
            ids += b.column(0).to_pylist()
            for t in text:
                raw = t.as_buffer()
                raw = raw.to_pybytes() if raw is not None else b""
                shas.append(hashlib.sha256(raw.translate(None, SPACE)).hexdigest())
            while len(ids) >= RUN_ROWS:
                yield from flush((part << 20) + runs, ids[:RUN_ROWS], points[:RUN_ROWS], shas[:RUN_ROWS])
                ids, points, shas, runs = ids[RUN_ROWS:], points[RUN_ROWS:], shas[RUN_ROWS:], runs + 1
        if ids:
            yield from flush((part << 20) + runs, ids, points, shas)

    return run


def _own(t: pa.Table) -> pa.Table:
    """One owner: decode, count over senders, answer one bitmap per sender that has a duplicate."""
    senders, blobs = t.column("sender").to_pylist(), t.column("blob").to_pylist()
    sent = [rice_decode(b) for b in blobs]
    if not sent:
        values = np.zeros(0, np.uint64)
    else:
        values = np.concatenate(sent)
    fps, many = values >> np.uint64(1), (values & np.uint64(1)).astype(bool)
    distinct, at, count = np.unique(fps, return_inverse=True, return_counts=True)
    dup = count > 1
    dup |= np.bincount(at, weights=many, minlength=len(distinct)) > 0 if len(distinct) else False
    marks = dup[at] if len(distinct) else np.zeros(0, bool)
    out_s, out_b, lo = [], [], 0
    for s, v in zip(senders, sent):
        bits = marks[lo:lo + len(v)]
        lo += len(v)
        if bits.any():
            out_s.append(s)
            out_b.append(np.packbits(bits).tobytes())
    owner = t.column("owner")[0].as_py() if len(t) else 0
    return pa.table({"sender": pa.array(out_s, pa.int64()), "owner": pa.array([owner] * len(out_s), pa.int32()),
                     "bitmap": pa.array(out_b, pa.binary())})


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sent = materialize(docs.mapInArrow(_send(shuffle_partitions(spark)), _SENT), "exact-sent")
    rows = sent.filter(F.col("row_id").isNotNull()).drop("blob", "n_sent")
    bitmaps = (sent.filter(F.col("blob").isNotNull()).select("sender", "owner", "blob")
               .groupBy("owner").applyInArrow(_own, "sender long, owner int, bitmap binary"))
    byte = F.conv(F.hex(F.expr("substring(bitmap, cast(rank div 8 + 1 as int), 1)")), 16, 10).cast("int")
    bit = F.expr("shiftright(byte, 7 - cast(rank % 8 as int)) & 1")
    marked = (rows.join(bitmaps, ["sender", "owner"], "left").withColumn("byte", byte)
              .withColumn("suspect", F.coalesce(bit == 1, F.lit(False))).drop("bitmap", "byte"))
    marked = materialize(marked.select("row_id", "doc_id", "n_points", "sha", "suspect"), "exact-marked")
    suspects = marked.filter("suspect")

    # Byte verification: the suspects' texts, grouped by their bytes.
    ids = suspects.select(F.xxhash64("doc_id").alias("k")).distinct()
    keyed = likely_rows(docs.withColumn("k", F.xxhash64("doc_id")), "k", ids)
    norm = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]", "")
    texts = (keyed.join(ids, "k", "left_semi").select(norm.alias("norm"))
             .groupBy("norm").agg(F.count("*").alias("n")).select(F.sha2("norm", 256).alias("sha"))
             .groupBy("sha").agg(F.count("*").alias("n_texts")))
    # most code points first, then the smallest id, as one number: points * 2**64 + (2**63 - 1 - id)
    key = F.expr("cast(cast(n_points as decimal(18,0)) * 18446744073709551616BD + "
                 "(9223372036854775807BD - coalesce(doc_id, 9223372036854775807)) as decimal(38,0))")
    best = suspects.withColumn("key", key).groupBy("sha").agg(F.max("key").alias("key"), F.count("*").alias("size"))
    # of rows equal in length and id, the first row read stays
    first = (suspects.withColumn("key", key).join(best, ["sha", "key"])
             .groupBy("sha").agg(F.min("row_id").alias("keep_row"), F.min("doc_id").alias("keep"), F.first("size").alias("size")))
    groups = (first.join(texts, "sha")
              .withColumn("size", F.when(F.col("n_texts") == 1, F.col("size")).otherwise(
                  F.raise_error(F.lit("two texts with one SHA-256")).cast("long")))
              .select("sha", "keep_row", "keep", "size"))
    done = suspects.join(groups, "sha").select(
        "doc_id", F.col("keep").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("row_id") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256"))
    alone = marked.filter(~F.col("suspect")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    return alone.unionByName(done)
