"""Removal of repeated byte strings by column-wise suffix-array construction.

A byte is removed when a ``SPAN``-byte string that covers it starts anywhere
else too (same text included; overlaps count; judged on the input).

1. *Anchors.* Every ``SPAN``-byte window of a text is routed by its smallest
   ``ANCHOR``-byte hash (leftmost on ties). Equal windows have the same anchor,
   and neighbours mostly share it, so a text becomes a few *pieces*: a run of
   starts with one anchor. An anchor that occurs once in all texts cannot hold
   a repeat; its pieces are never shipped.
2. *Pieces.* Equal pieces (by a 128-bit digest) are counted. A piece met twice
   repeats by that alone; where an anchor has pieces met once, the bytes of one
   of each of its pieces are shipped. An anchor with very many different pieces (a common
   line in ever new surroundings) is split: its windows are routed one by one by
   their own digest, and a digest met twice is a repeat.
3. *Column-wise construction* (one bucket of pieces at a time): each round adds
   one symbol in front of every string and merges the new suffixes into the
   order of all earlier ones. The order is kept as Burrows-Wheeler columns
   (first symbol, position of the tail, common prefix with the predecessor)
   in sequential files that a round reads once and writes once. A symbol is
   ``UNIT`` bytes, each piece enters once per phase, so a round covers ``UNIT``
   bytes of every start. A start repeats when its common prefix with a
   neighbour reaches ``SPAN`` bytes.
4. Repeated starts go back to the texts that hold the piece; the rest of each
   text is hashed.

Null text counts as empty; rows that repeat entirely are separate rows (and so
repeat each other); texts under ``SPAN`` bytes stay whole.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import (BYTE_CODE, _power_tables, likely_rows, materialize, mix64, shuffle_partitions, small_batches,
                                 text_bytes)

SPAN = 200
ANCHOR = 64
UNIT = 20
DEPTH = SPAN // UNIT
# Different pieces of one anchor above which its windows are routed one by one.
HOT_PIECES = 2_000
# Bytes of pieces that one construction handles.
BUCKET_BYTES = 1_500_000
_BLOCK = 1 << 21
# Longest stretch of common-prefix values that a minimum is taken over directly.
_NEAR = 32

_BASE_SCHEMA = "doc_id long, dkey long, n_bytes long, sha string, starts array<int>, widths array<int>, anchors array<long>"


def _window_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours, by blockwise prefix and suffix minima."""
    n = len(v) - w + 1
    rows = -(-len(v) // w)
    a = np.full(rows * w, np.iinfo(np.uint64).max, np.uint64)
    a[:len(v)] = v
    a = a.reshape(rows, w)
    right = np.minimum.accumulate(a, axis=1).ravel()
    left = np.minimum.accumulate(a[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(left[:n], right[w - 1:w - 1 + n])


def _kmers(raw: np.ndarray, width: int) -> np.ndarray:
    p, inv = _power_tables(len(raw) + 1)
    acc = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_CODE[raw] * p[:len(raw)], out=acc[1:])
    h = (acc[width:] - acc[:-width]) * inv[:len(raw) - width + 1]
    return mix64(h)


def pieces_of(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text number, first start in it, number of starts and anchor of every piece of the texts
    ``raw[off[i]:off[i + 1]]``. Works on blocks, so a long text costs no more memory than a short one."""
    out: list[tuple] = []
    tag = np.uint64((1 << 21) - 1)
    for lo in range(0, max(len(raw) - SPAN + 1, 0), _BLOCK - SPAN):
        block = raw[lo:lo + _BLOCK - 1]
        h = _kmers(block, ANCHOR)
        at = (_window_min((h & ~tag) | np.arange(len(h), dtype=np.uint64), SPAN - ANCHOR + 1) & tag).astype(np.int64)
        whole = np.ones(len(at), bool)  # windows that lie in one text
        for end in off[np.searchsorted(off, lo, side="right"):] - lo:
            if end - SPAN + 1 >= len(at):
                break
            whole[max(0, end - SPAN + 1):end] = False
        start = np.flatnonzero(whole)
        if not len(start):
            continue
        new = np.flatnonzero((np.diff(at[start], prepend=-1) != 0) | (np.diff(start, prepend=-2) != 1))
        first = start[new]
        doc = np.searchsorted(off, first + lo, side="right") - 1
        out.append((doc, first + lo - off[doc], np.diff(new, append=len(start)), h[at[first]].view(np.int64)))
    if not out:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*out))


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        raw, off = text_bytes(b.column(2))
        data = raw.tobytes()
        shas = [hashlib.sha256(data[off[i]:off[i + 1]]).hexdigest() for i in range(len(b))]
        doc, start, width, anchor = pieces_of(raw, off)
        ends = pa.array(np.searchsorted(doc, np.arange(len(b) + 1)).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(np.diff(off), pa.int64()), pa.array(shas, pa.string()),
             pa.ListArray.from_arrays(ends, pa.array(start.astype(np.int32))),
             pa.ListArray.from_arrays(ends, pa.array(width.astype(np.int32))),
             pa.ListArray.from_arrays(ends, pa.array(anchor.astype(np.int64)))],
            ["doc_id", "dkey", "n_bytes", "sha", "starts", "widths", "anchors"])


def _digest(piece: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(piece)
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def _fields(lists: pa.ListArray) -> tuple[np.ndarray, pa.StructArray]:
    """Lengths and flattened structs of a list column."""
    return np.diff(lists.offsets.to_numpy()), lists.flatten()


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each piece is: text key, start, number of starts, anchor, digest of the piece."""
    for b in batches:
        raw, off = text_bytes(b.column(2))
        data = raw.tobytes()
        n, found = _fields(b.column(3))
        start, width = (found.field(x).to_numpy().astype(np.int64) for x in ("start", "width"))
        lo = start + np.repeat(off[:-1], n)
        digests = b"".join([xxhash.xxh3_128_digest(data[x:y]) for x, y in zip(lo.tolist(), (lo + width + SPAN - 1).tolist())])
        pair = np.frombuffer(digests, ">i8").astype(np.int64).reshape(-1, 2)
        row = np.repeat(np.arange(len(b)), n)
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), found.field("start"), found.field("width"),
             found.field("anchor"), pa.array(pair[:, 0]), pa.array(pair[:, 1])],
            ["did", "dkey", "start", "width", "anchor", "p1", "p2"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the chosen pieces of each text."""
    kinds = (pa.int64(), pa.int64(), pa.binary())
    for b in batches:
        rows: list[tuple] = []
        for text, chosen in zip(b.column(0), b.column(1)):
            raw = text.as_buffer().to_pybytes()
            rows += [(f["anchor"], f["n"], raw[f["start"]:f["start"] + f["width"] + SPAN - 1]) for f in chosen.as_py()]
        for lo in range(0, len(rows), 20_000):
            cols = list(zip(*rows[lo:lo + 20_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["anchor", "n", "piece"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of a piece: piece digest, start, digest of the window, number of such pieces."""
    for b in batches:
        for n, piece in zip(b.column(1).to_pylist(), b.column(2)):
            raw = piece.as_buffer().to_pybytes()
            own = np.array([_digest(raw[i:i + SPAN]) for i in range(len(raw) - SPAN + 1)], np.int64)
            p1, p2 = _digest(raw)
            k = len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(k, p1)), pa.array(np.full(k, p2)), pa.array(np.arange(k, dtype=np.int32)),
                 pa.array(own[:, 0]), pa.array(own[:, 1]), pa.array(np.full(k, n))], ["p1", "p2", "shift", "w1", "w2", "n"])


class _Columns:
    """Columns in files of one folder: read whole in sequence (and then deleted), written whole in sequence."""

    def __init__(self, folder: str, kinds: dict[str, type]):
        self.folder, self.kinds, self.turn = folder, kinds, 0

    def read(self) -> dict[str, np.ndarray]:
        out = {}
        for name, kind in self.kinds.items():
            path = os.path.join(self.folder, name)
            out[name] = np.fromfile(path, kind) if self.turn else np.zeros(0, kind)
            if self.turn:
                os.unlink(path)
        return out

    def write(self, columns: dict[str, np.ndarray]) -> None:
        self.turn += 1
        for name, column in columns.items():
            column.tofile(os.path.join(self.folder, name))


def repeated_starts(pieces: list[bytes], counts: list[int], folder: str | None = None) -> list[np.ndarray]:
    """For each of the different ``pieces``: which starts have a SPAN-byte string that occurs elsewhere too."""
    with tempfile.TemporaryDirectory(dir=folder) as scratch:
        mark = _construct(pieces, scratch)
    out, lo = [], 0
    for p, n in zip(pieces, counts):
        width = len(p) - SPAN + 1
        out.append(np.ones(width, bool) if n > 1 else mark[lo:lo + width])
        lo += len(p)
    return out


def _symbols(raw: bytes) -> np.ndarray:
    """A number for the UNIT bytes from each place on; equal numbers for equal bytes only."""
    width = 8
    ranks = np.ndarray((len(raw) - width + 1,), "<u8", raw, strides=(1,))
    ranks = np.unique(ranks, return_inverse=True)[1]
    while width < UNIT:  # equal now and some bytes on: equal over both stretches
        step = min(width, UNIT - width)
        ranks = np.unique(ranks[:-step] * len(raw) + ranks[step:], return_inverse=True)[1]
        width += step
    return ranks.astype(np.int32)


def _construct(pieces: list[bytes], scratch: str) -> np.ndarray:
    raw = b"".join(pieces)
    sizes = np.array([len(p) for p in pieces], np.int64)
    base = np.cumsum(sizes) - sizes
    mark = np.zeros(len(raw), bool)
    if len(raw) < SPAN:
        return mark
    ranks = _symbols(raw)
    # one string per piece and phase: its first start and its number of whole symbols
    head = (base[:, None] + np.arange(UNIT)).ravel()
    room = ((sizes[:, None] - np.arange(UNIT)) // UNIT).ravel()
    last = head + (room - 1) * UNIT
    ends = base + sizes
    files = _Columns(scratch, {"first": np.int32, "tail": np.int32, "start": np.int32, "common": np.uint8})
    where = np.full(len(head), -1, np.int64)  # position of each string's newest suffix
    for turn in range(1, int(room.max()) + 1):
        old = files.read()
        m = len(old["first"])
        active = np.flatnonzero(room >= turn)
        start = last[active] - (turn - 1) * UNIT
        first, tail = ranks[start], where[active]
        key = first.astype(np.int64) * (m + 1) + tail + 1
        order = np.argsort(key, kind="stable")
        active, start, first, tail = active[order], start[order], first[order], tail[order]
        slot = np.searchsorted(old["first"].astype(np.int64) * (m + 1) + old["tail"] + 1, key[order], side="right")
        moved = np.arange(m + 1)
        moved[:m] += np.cumsum(np.bincount(slot, minlength=m + 1)[:m])
        moved[m] = -1  # the empty tail stays -1
        new = slot + np.arange(len(slot))
        where[active] = new
        merged = {}
        for name, fresh in (("first", first), ("tail", tail), ("start", start), ("common", None)):
            col = np.zeros(m + len(new), files.kinds[name])
            col[moved[:m]] = old[name]
            if fresh is not None:
                col[new] = fresh
            merged[name] = col
        _prefixes(merged, old["common"], new, ranks, ends)
        merged["tail"] = moved[merged["tail"]].astype(np.int32)
        files.write(merged)
    done = files.read()
    deep = done["common"] >= DEPTH
    deep[:-1] |= deep[1:]
    mark[done["start"][deep]] = True
    return mark


def _prefixes(merged: dict[str, np.ndarray], common: np.ndarray, new: np.ndarray, ranks: np.ndarray, ends: np.ndarray) -> None:
    """Common prefixes (in symbols, DEPTH at most) at the new suffixes and their successors.

    Two neighbours with one first symbol share one symbol more than their tails,
    and those share the minimum over the positions between them.
    """
    n = len(merged["first"])
    at = np.sort(np.concatenate([new, new + 1]), kind="stable")
    at = at[(np.diff(at, prepend=0) > 0) & (at < n)]  # each once, the very first place left out
    same = merged["first"][at] == merged["first"][at - 1]
    merged["common"][at[~same]] = 0
    at = at[same]
    a, b = merged["tail"][at - 1].astype(np.int64), merged["tail"][at].astype(np.int64)
    found = np.ones(len(at), np.int64)
    gap = b - a
    near = (a >= 0) & (gap <= _NEAR)
    if near.any():
        size = gap[near]
        to = np.cumsum(size) - size
        spots = np.repeat(a[near] + 1 - to, size) + np.arange(int(size.sum()))
        found[near] = 1 + np.minimum.reduceat(common[spots], to).astype(np.int64)
    far = np.flatnonzero((a >= 0) & (gap > _NEAR))
    if len(far):
        x, y = merged["start"][at[far]].astype(np.int64), merged["start"][at[far] - 1].astype(np.int64)
        room = np.minimum(*((ends[np.searchsorted(ends, s, side="right")] - s) // UNIT for s in (x, y)))
        depth = np.ones(len(far), np.int64)
        alive = np.arange(len(far))
        for d in range(1, DEPTH):
            alive = alive[room[alive] > d]
            alive = alive[ranks[x[alive] + d * UNIT] == ranks[y[alive] + d * UNIT]]
            if not len(alive):
                break
            depth[alive] = d + 1
        found[far] = depth
    merged["common"][at] = np.minimum(found, DEPTH)


def _bucket(t: pa.Table) -> pa.Table:
    pieces = [p.as_buffer().to_pybytes() for p in t.column("piece")]
    counts = t.column("n").to_pylist()
    rows: list[tuple] = []
    for p, starts in zip(pieces, repeated_starts(pieces, counts)):
        if starts.any():
            rows.append((*_digest(p), np.packbits(starts).tobytes()))
    cols = list(zip(*rows)) or [[]] * 3
    return pa.table([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.binary()))], names=["p1", "p2", "bits"])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Remove the bytes that repeated starts cover."""
    for b in batches:
        raw, off = text_bytes(b.column(1))
        n, marks = _fields(b.column(2))
        bits = marks.field("bits")
        packed = np.frombuffer(b"".join(x.as_buffer().to_pybytes() for x in bits), np.uint8)
        sizes = 8 * pc.binary_length(bits).to_numpy(zero_copy_only=False).astype(np.int64)
        base = marks.field("start").to_numpy().astype(np.int64) + np.repeat(off[:-1], n) - (np.cumsum(sizes) - sizes)
        on = np.flatnonzero(np.unpackbits(packed))
        start = on + np.repeat(base, sizes)[on]
        seen = np.zeros(len(raw) + SPAN, np.int64)  # starts up to here; a span that begins in a text ends in it
        seen[start + SPAN - 1] = 1
        seen = np.cumsum(seen > 0)
        gone = np.empty(len(raw), bool)
        gone[:] = seen[SPAN - 1:SPAN - 1 + len(raw)] > np.concatenate([[0], seen])[:len(raw)]
        rows = []
        for did, lo, hi in zip(b.column(0).to_pylist(), off[:-1], off[1:]):
            g = gone[lo:hi]
            kept = raw[lo:hi][~g].tobytes()
            spans = int(np.count_nonzero(np.diff(g.astype(np.int8), prepend=0) == 1))
            rows.append((did, int(hi - lo), int(g.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
        cols = list(zip(*rows)) or [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, where bytes were removed, kept_bytes."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .select("doc_id", F.xxhash64("doc_id", "text").alias("dkey"), "text"))
    did = F.coalesce("doc_id", F.lit(-1))
    base = materialize(docs.mapInArrow(_survey, _BASE_SCHEMA), "suffix-base")
    runs = (base.select(did.alias("did"), "dkey", F.explode(F.arrays_zip("starts", "widths", "anchors")).alias("r"))
            .select("did", "dkey", F.col("r.starts").alias("start"), F.col("r.widths").alias("width"),
                    F.col("r.anchors").alias("anchor")))
    twice = runs.groupBy("anchor").agg(F.count("*").alias("c")).filter("c > 1").select("anchor")
    spans = materialize(runs.join(twice, "anchor", "left_semi").groupBy("did", "dkey")  # a group is bounded by its text
                        .agg(F.collect_set(F.struct("start", "width", "anchor")).alias("found")), "suffix-spans")

    def with_text(keyed: DataFrame, texts: DataFrame) -> DataFrame:
        keyed = keyed.withColumnsRenamed({"did": "d", "dkey": "k"})
        return texts.join(keyed, (did == F.col("d")) & (F.col("dkey") == F.col("k"))).drop("d", "k")

    held = materialize(with_text(spans, likely_rows(docs, "dkey", spans.select("dkey"))), "suffix-held")
    places = materialize(held.select(did.alias("did"), "dkey", "text", "found").mapInArrow(
        _places, "did long, dkey long, start int, width int, anchor long, p1 long, p2 long"), "suffix-places")
    pieces = places.groupBy("anchor", "p1", "p2").agg(
        F.count("*").alias("n"), F.min(F.struct("did", "dkey", "start", "width")).alias("at"))
    per_anchor = pieces.groupBy("anchor").agg(F.count("*").alias("c"), F.min("n").alias("least"))
    chosen = materialize(pieces.join(per_anchor, "anchor").select(
        "at.*", "anchor", "n", "p1", "p2", (F.col("c") > HOT_PIECES).alias("hot"), (F.col("least") > 1).alias("plain")),
        "suffix-chosen")
    # one bit for every start of the piece, the rest of the last byte 0
    bits = F.unhex(F.expr("concat(repeat('FF', width div 8), if(width % 8 = 0, '', hex(cast(256 - shiftleft(1, 8 - width % 8) as bigint))))"))
    plain = chosen.filter("plain").select("p1", "p2", F.lit(0).alias("shift"), bits.alias("bits"))
    chosen = chosen.filter("not plain")
    total = chosen.filter("not hot").agg(F.sum(F.col("width") + SPAN - 1)).first()[0] or 0
    buckets = int(total // BUCKET_BYTES) + 1

    def cut(rows: DataFrame) -> DataFrame:
        per_text = rows.groupBy("did", "dkey").agg(F.collect_list(F.struct("start", "width", "anchor", "n")).alias("chosen"))
        return with_text(per_text, held.select("doc_id", "dkey", "text")).select("text", "chosen") \
            .mapInArrow(_cut, "anchor long, n long, piece binary")

    usual = (cut(chosen.filter("not hot")).withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
             .repartition(max(buckets, shuffle_partitions(spark)), "bucket")
             .groupBy("bucket").applyInArrow(_bucket, "p1 long, p2 long, bits binary"))
    windows = cut(chosen.filter("hot")).mapInArrow(_windows, "p1 long, p2 long, shift int, w1 long, w2 long, n long")
    again = windows.groupBy("w1", "w2").agg(F.sum("n").alias("c")).filter("c > 1").select("w1", "w2")
    hot = windows.join(again, ["w1", "w2"], "left_semi").select("p1", "p2", "shift", F.unhex(F.lit("80")).alias("bits"))
    found = usual.select("p1", "p2", F.lit(0).alias("shift"), "bits").unionByName(hot).unionByName(plain)
    found = materialize(found, "suffix-found")

    per_doc = (places.join(found, ["p1", "p2"]).groupBy("did", "dkey")
               .agg(F.collect_set(F.struct((F.col("start") + F.col("shift")).alias("start"), "bits")).alias("marks")))
    per_doc = materialize(per_doc, "suffix-marks")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary"
    touched = with_text(per_doc, held.select("doc_id", "dkey", "text")).select("doc_id", "text", "marks") \
        .mapInArrow(_finish, schema)
    none = F.lit(0).cast("long")
    whole = (base.join(per_doc.select(F.col("did").alias("d"), F.col("dkey").alias("k")),
                       (did == F.col("d")) & (F.col("dkey") == F.col("k")), "left_anti")
             .select("doc_id", "n_bytes", none.alias("n_removed"), none.alias("n_spans"),
                     F.col("sha").alias("kept_sha256"), F.lit(None).cast("binary").alias("kept_bytes")))
    return whole.unionByName(touched)
