"""N-gram Jaccard join with signature trees.

Words are lower-cased (A-Z) runs of non-space; a text's set holds its distinct
shingles (64-bit hashes); two sets link when 100 x overlap >= percent x union.

1. Equal sets become one representative.
2. *Routing.* With a global order of shingles, two sets that link share one of
   their first ``n - ceil(percent n / 100) + 1`` shingles. The order is by hash,
   with the very frequent shingles last (a bounded list; any list is right).
   Only shingles that at least two prefixes hold route anything. Taking ``l - 1``
   more shingles into the prefix, linked sets share at least ``l`` of them; with
   ``l`` a twentieth of the set, sets that share fewer with all others together
   (a passage or two) are out before anything else is looked at.
3. *Signature trees.* The sets of one bucket (a shingle's holders, split by a
   hash when they are many) form a tree: nodes hold the OR of the members'
   bitmaps and the range of their sizes. A dual traversal prunes the node pairs
   whose largest possible overlap is too small, and pairs that are already in
   one component; what is left is compared exactly.
   Two rounds give each text one bucket, by its first unresolved shingle.
4. Shingles whose holders are still in several components are traversed whole,
   with bitmaps only (blocks against blocks where holders are many). A set carries
   its smallest such shingles: a pair that has met by one of them is not given out
   again by the others, and a pair that was in one bucket of a round is not given out at
   all. The pairs left, across components, that share enough prefix shingles are
   compared exactly.
5. Components of all links found.

No text, no words: the set is empty and links with nothing. Null ids: rows are
kept, and their component is the smallest id reachable, if any. Memory: a
bucket, at most ``BUCKET_SHINGLES`` plus one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import (LOWER_CODE, drop_table, likely_rows, materialize, mix64, packed, shuffle_partitions, slices, small_batches,
                                 span_hashes, text_bytes, without)
from logweave.llm.components import components

# A shingle is frequent with a share of 1 / FREQUENT of all prefix entries: at most so many.
FREQUENT = 20_000
# Part of a set that its longer prefix has to share.
SHARE = 20
BITS = 1024
FAN = 16
# Shingles of the sets that one bucket compares exactly, and sets of one block in the last traversal.
BUCKET_SHINGLES = 2_000_000
BLOCK_SETS = 4_096
# Smallest unresolved shingles of a set that travel with it, so that a pair is met once and not by every shingle it shares.
EARLY = 4
_NONE = 2**63 - 1
_HOLD = 4_000_000
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_MULT = np.array([pow(0xC2B2AE3D27D4EB4F, j + 1, 1 << 64) for j in range(64)], np.uint64)


def prefix_size(n: int, percent: int) -> int:
    return n + 1 - -(-percent * n // 100)


def least_shared(n: int) -> int:
    """Shingles that the longer prefix of a set has in common with those of a set as large that links with it."""
    return max(1, n // SHARE)


def shingle_sets(raw: np.ndarray, off: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text ``raw[off[i]:off[i + 1]]``."""
    n = len(off) - 1
    if not len(raw):
        return [np.zeros(0, np.uint64)] * n
    word = ~_SPACE[raw]
    before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    inner = off[(off > 0) & (off < len(raw))]
    before[inner], after[inner - 1] = False, False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    h = span_hashes(LOWER_CODE[raw], starts, ends)
    at = np.searchsorted(starts, off)
    sums = np.zeros(max(len(h) - width + 1, 0), np.uint64)
    for j in range(width):
        sums += h[j:j + len(sums)] * _MULT[j]
    sums = mix64(sums)
    out = []
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= width:
            out.append(np.unique(sums[a:b - width + 1]))
        elif b > a:
            out.append(mix64((h[a:b] * _MULT[:b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sets_of(column: pa.Array, width: int) -> list[np.ndarray]:
    raw, off = text_bytes(column)
    out = []
    for i, j in slices(off):
        out += shingle_sets(raw[off[i]:off[j]], off[i:j + 1] - off[i], width)
    return out


def bitmap(s: np.ndarray) -> np.ndarray:
    """``BITS`` bits, twice as many until at most 10 shingles come to 7 bits: fuller ones would rule no pair out."""
    bits = BITS
    while 10 * bits < 7 * len(s):
        bits *= 2
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) > 0)


class Tree:
    """Levels of a signature tree over sets in order of size; level 0 holds the sets themselves."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, percent: int):
        self.percent = percent
        ones = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.levels = [(bits, sizes, sizes, sizes - ones)]
        while len(self.levels[-1][0]) > FAN:
            bits, low, high, spare = self.levels[-1]
            cut = np.arange(0, len(bits), FAN)
            self.levels.append((np.bitwise_or.reduceat(bits, cut), np.minimum.reduceat(low, cut),
                                np.maximum.reduceat(high, cut), np.maximum.reduceat(spare, cut)))

    def _possible(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether members of the nodes can link: a set's shingles lie in its bits, and at most
        ``spare`` of them share a bit, so an overlap is at most spare + common bits."""
        bits, low, high, spare = self.levels[level]
        most = np.minimum(spare[i], spare[j]) + np.bitwise_count(bits[i] & bits[j]).sum(axis=1, dtype=np.int64)
        most = np.minimum(most, np.minimum(high[i], high[j]))
        p = self.percent
        return ((100 + p) * most >= p * (low[i] + low[j])) & (100 * most >= p * np.maximum(low[i], low[j]))

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs (i < j) of sets that the dual traversal leaves, near sizes first."""
        top = len(self.levels) - 1
        n = len(self.levels[top][0])
        i, j = np.triu_indices(n)
        yield from self._down(top, i, j)

    def _down(self, level: int, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = 1 << 15
        for lo in range(0, len(i), step):
            a, b = i[lo:lo + step], j[lo:lo + step]
            if level == 0:
                a, b = a[a < b], b[a < b]
            ok = self._possible(level, a, b)
            a, b = a[ok], b[ok]
            if level == 0:
                if len(a):
                    yield a, b
                continue
            near = np.argsort(b - a, kind="stable")
            a, b, below = a[near], b[near], len(self.levels[level - 1][0])
            for k in range(0, len(a), 128):
                x = (a[k:k + 128, None, None] * FAN + np.arange(FAN)[None, :, None])
                y = (b[k:k + 128, None, None] * FAN + np.arange(FAN)[None, None, :])
                x, y = (v.ravel() for v in np.broadcast_arrays(x, y))
                keep = (x <= y) & (y < below)
                yield from self._down(level - 1, x[keep], y[keep])


def near_pairs(sizes: np.ndarray, bitmaps: list[bytes], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of sets, in order of size, that signature trees leave.

    Bitmaps are longer for larger sets. Each length has its tree, with all sets large enough to link
    with one of that length; their longer bitmaps are folded."""
    length = np.array([len(b) for b in bitmaps])
    for own in np.unique(length):
        first, last = np.searchsorted(length, [own, own + 1])
        end = np.searchsorted(sizes, 100 * sizes[last - 1] // percent, side="right")
        bits = np.array([np.bitwise_or.reduce(np.frombuffer(b, np.uint8).reshape(-1, own)) for b in bitmaps[first:end]])
        for i, j in Tree(sizes[first:end], bits.view(np.uint64), percent).pairs():
            ok = i < last - first
            yield i[ok] + first, j[ok] + first


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    n, m = len(a), len(b)
    if not n or not m or 100 * min(n, m) < percent * max(n, m):
        return False
    at = np.searchsorted(b, a)
    at[at == m] = m - 1
    both = int(np.count_nonzero(b[at] == a))
    return 100 * both >= percent * (n + m - both)


def join_sets(ids: list[int], sets: list[np.ndarray], known: list[int], percent: int) -> list[tuple[int, int]]:
    """New links between known components of the sets: each joined component with the smallest it is now one with."""
    order = sorted(range(len(ids)), key=lambda k: (len(sets[k]), ids[k]))
    ids, sets, known = ([x[k] for k in order] for x in (ids, sets, known))
    names, label = np.unique(np.array(known, np.int64), return_inverse=True)
    own = label.copy()
    sizes = np.array([len(s) for s in sets], np.int64)
    for i, j in near_pairs(sizes, [bitmap(s).tobytes() for s in sets], percent):
        apart = label[i] != label[j]
        for a, b in zip(i[apart].tolist(), j[apart].tolist()):
            if label[a] != label[b] and linked(sets[a], sets[b], percent):
                label[np.isin(label, [label[a], label[b]])] = min(label[a], label[b])  # names rise with labels
    return sorted({(int(names[o]), int(names[m])) for o, m in zip(own, label) if o != m})


def _frequent(width: int, percent: int):
    """Prefix shingles with a high share in a stretch of the task's texts, and the entries of the stretch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush():
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            many = counts * FREQUENT >= counts.sum()
            many &= counts > 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(tokens[many].view(np.int64), 0)), pa.array(np.append(counts[many], counts.sum())),
                 pa.array(np.append(np.zeros(int(many.sum()), bool), True))], ["token", "n", "total"])

        for b in batches:
            for s in sets_of(b.column(0), width):
                if len(s):
                    held.append(s[:prefix_size(len(s), percent)])
                    size += len(held[-1])
            if size > _HOLD:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()
    return run


def frequent_shingles(docs: DataFrame, width: int, percent: int) -> np.ndarray:
    counts = docs.select("text").mapInArrow(_frequent(width, percent), "token long, n long, total boolean") \
        .groupBy("token", "total").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "join-frequent")
    total = counts.filter("total").agg(F.sum("n")).first()[0] or 0
    top = counts.filter(~F.col("total") & (F.col("n") * FREQUENT >= F.lit(total))).collect()  # FREQUENT rows at most
    return np.sort(np.array([r["token"] for r in top], np.int64).view(np.uint64))


def _describe(width: int, percent: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = shared.value
        for b in batches:
            sets = sets_of(b.column(1), width)
            d1, d2, tokens, bits = [], [], [], []
            for s in sets:
                d = xxhash.xxh3_128_digest(s.tobytes())
                d1.append(int.from_bytes(d[:8], "big", signed=True))
                d2.append(int.from_bytes(d[8:], "big", signed=True))
                at = np.searchsorted(last, s)
                late = np.zeros(len(s), bool)
                if len(last):
                    late = last[np.minimum(at, len(last) - 1)] == s
                tokens.append(np.concatenate([s[~late], s[late]])[:prefix_size(len(s), percent) + least_shared(len(s)) - 1 if len(s) else 0])
                bits.append(bitmap(s).tobytes())
            ends = np.cumsum([0] + [len(t) for t in tokens]).astype(np.int32)
            flat = np.concatenate(tokens).view(np.int64) if tokens else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(bits, pa.binary()), b.column(2)],
                ["doc_id", "n", "d1", "d2", "tokens", "bits", "row_key"])
    return run


def _runs(batches: Iterator[pa.RecordBatch], keys: int, convert) -> Iterator[tuple[list, list]]:
    """Consecutive rows with equal first ``keys`` columns, as lists of ``convert(batch)`` rows."""
    held: list = []
    now = None
    for b in batches:
        names = list(zip(*(b.column(i).to_pylist() for i in range(keys))))
        for key, row in zip(names, convert(b)):
            if key != now and held:
                yield now, held
                held = []
            now = key
            held.append(row)
    if held:
        yield now, held


def _compare(width: int, percent: int):
    def rows(b: pa.RecordBatch):
        return zip(b.column(2).to_pylist(), b.column(3).to_pylist(), sets_of(b.column(4), width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in _runs(batches, 2, rows):
            if len(group) > 1:
                ids, known, sets = (list(x) for x in zip(*group))
                found = join_sets(ids, sets, known, percent)
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()),
                                                  pa.array([f[1] for f in found], pa.int64())], ["u", "v"])
    return run


def _cross(percent: int):
    """Pairs across components that the bitmaps allow, in one block or between two blocks of a shingle's holders.

    A pair that shares one of its ``EARLY`` smallest shingles below this one has been met there and is left out,
    and so is a pair that was in one bucket of a round: it has been compared exactly."""
    def rows(b: pa.RecordBatch):
        return zip(*(b.column(i).to_pylist() for i in range(3, 10)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, group in _runs(batches, 3, rows):
            if len({g[1] for g in group}) < 2:
                continue
            group.sort(key=lambda g: (g[2], g[0]))
            ids, comp, sizes, block = (np.array([g[k] for g in group], np.int64) for k in (0, 1, 2, 4))
            been = np.array([g[6] for g in group], np.int64).reshape(len(group), -1, 2)
            early = np.full((len(group), EARLY), _NONE, np.int64)
            for k, g in enumerate(group):
                early[k, :len(g[5])] = g[5]
            for i, j in near_pairs(sizes, [g[3] for g in group], percent):
                ok = (comp[i] != comp[j]) & ~(been[i] == been[j]).all(axis=2).any(axis=1)
                if key[1] != key[2]:
                    ok &= block[i] != block[j]
                i, j = i[ok], j[ok]
                met = np.zeros(len(i), bool)
                for k in range(EARLY):
                    met |= (early[i, k] < key[0]) & (early[i, k, None] == early[j]).any(axis=1)
                u, v = ids[i[~met]], ids[j[~met]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["u", "v"])
    return run


def _verify(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [linked(x, y, percent) for x, y in zip(sets_of(b.column(2), width), sets_of(b.column(3), width))]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(0)], ["u", "v"]).filter(pa.array(ok, pa.bool_()))
    return run


def ngram_join(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that links reach) for every row."""
    rows = _grouped(docs, width, percent)
    smallest = rows.groupBy("component").agg(F.min("doc_id").alias("component_id")).filter("component is not null")
    return (rows.join(smallest, "component", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def one_per_group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay when each group keeps the document with the smallest id.

    Rows without an id come last; rows with one id are told apart by a hash of the text, and rows that repeat
    entirely stay once. Texts without words are no group and all stay."""
    rows = _grouped(docs, width, percent).filter("n > 0")
    first = rows.groupBy("component").agg(
        F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)), "row_key")).alias("keeper"))
    keys = rows.groupBy("component", "row_key").agg(F.count("*").alias("copies"))
    keys = materialize(keys.join(first, "component").select(
        F.col("row_key").alias("_row_key"), "copies", (F.col("row_key") == F.col("keeper.row_key")).alias("stays")), "join-keys")
    keyed = packed(docs, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("_row_key"))
    left = without(keyed, "_row_key", keys.filter("not stays").select("_row_key"))
    often = keys.filter("stays and copies > 1").select("_row_key")
    marked = likely_rows(left, "_row_key", often, every=True)
    maybe = marked.filter("likely").drop("likely").join(often.withColumn("_often", F.lit(True)), "_row_key", "left")
    return (marked.filter("not likely").drop("likely")
            .unionByName(maybe.filter("_often is null").drop("_often"))
            .unionByName(maybe.filter("_often").drop("_often").dropDuplicates(["_row_key"]))).select("row.*")


def _grouped(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, row_key, n, component (the same number for all rows of a group; null for an empty set) of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .withColumn("row_key", F.xxhash64("doc_id", "text")))
    shared = spark.sparkContext.broadcast(frequent_shingles(docs, width, percent))
    described = materialize(docs.mapInArrow(
        _describe(width, percent, shared),
        "doc_id long, n long, d1 long, d2 long, tokens array<long>, bits binary, row_key long"), "join-described")
    sets = materialize(described.filter("n > 0").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("doc_id"), F.first("row_key").alias("row_key"), F.first("n").alias("n"),
        F.first("tokens").alias("tokens"), F.first("bits").alias("bits"))
        .withColumn("rid", F.monotonically_increasing_id()), "join-sets")
    of_docs = materialize(described.select("doc_id", "row_key", "n", "d1", "d2"), "join-docs")
    drop_table(described)
    prefixes = sets.select("rid", F.explode("tokens").alias("token"))
    entries = materialize(_shared(_shared(prefixes, sets, percent), sets, percent)
                          .join(sets.select("rid", "n"), "rid").select("rid", "n", "token"), "join-prefixes")
    common = entries.groupBy("token").agg(F.count("*").alias("holders")).filter("holders > 1")
    entries = materialize(entries.join(common, "token"), "join-entries")
    load = materialize(entries.groupBy("token").agg(F.sum("n").alias("load")), "join-load")

    def route(rows: DataFrame, turn: int) -> DataFrame:
        """Each set's first shingle, and the part of that shingle's holders it is compared with."""
        first = rows.groupBy("rid").agg(F.min("token").alias("token"), F.first("component").alias("component"))
        parts = F.greatest(F.lit(1), F.ceil(F.col("load") / BUCKET_SHINGLES))
        return (first.join(load, "token").withColumn("part", F.pmod(F.xxhash64("rid", F.lit(turn)), parts))
                .select("rid", "token", "part", "component"))

    start = materialize(route(entries.withColumn("component", F.col("rid")), 0).join(sets.select("rid", "row_key"), "rid"),
                        "join-start")
    texts = materialize(likely_rows(docs.select("row_key", "text"), "row_key", start).join(start, "row_key")
                        .dropDuplicates(["rid"]), "join-texts")

    # every set is in one part: the links found are its component already
    label = materialize(_compared(texts, width, percent, spark).select(F.col("u").alias("rid"), F.col("v").alias("component")),
                        "join-label")
    left = materialize(_unresolved(entries, label), "join-left")
    again = materialize(route(left, 1), "join-again")
    label = _merged(label, _compared(again.join(texts.select("rid", "text"), "rid"), width, percent, spark))
    left = materialize(_unresolved(entries, label), "join-left")

    pairs = materialize(_candidates(left, sets, (start, again), percent, spark), "join-pairs")
    one = (pairs.groupBy("cu", "cv").agg(F.min(F.struct(F.xxhash64("u", "v"), "u", "v")).alias("p"))
           .select("cu", "cv", "p.u", "p.v"))
    label = _merged(label, _exact(one, texts, width, percent))
    rest = _labelled(pairs.select("u", "v"), label).filter("cu <> cv")
    label = _merged(label, _exact(rest, texts, width, percent))
    drop_table(texts)
    drop_table(entries)

    named = sets.join(label, "rid", "left").select("d1", "d2", F.coalesce("component", "rid").alias("component"))
    return materialize(of_docs.join(named, ["d1", "d2"], "left").select("doc_id", "row_key", "n", "component"), "join-groups")


def _needed(percent: int) -> Column:
    """Prefix shingles that a set of ``n`` shares at least with any that links with it."""
    return F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * percent / 100) / SHARE))


def _shared(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Entries (rid, token) whose shingle has another holder, of the sets that have enough of them.

    The partner may be as small as ``percent`` of the set, and then need only share its own twentieth."""
    common = entries.groupBy("token").agg(F.count("*").alias("holders")).filter("holders > 1").select("token")
    kept = materialize(entries.join(common, "token", "left_semi"), "join-shared")
    enough = (kept.groupBy("rid").agg(F.count("*").alias("c")).join(sets.select("rid", "n"), "rid")
              .filter(F.col("c") >= _needed(percent)).select("rid"))
    return kept.join(enough, "rid", "left_semi")


def _compared(routed: DataFrame, width: int, percent: int, spark) -> DataFrame:
    """Links within each (token, part) of routed (rid, token, part, component, text)."""
    return (routed.select("token", "part", "rid", "component", "text")
            .repartition(4 * shuffle_partitions(spark), "token", "part").sortWithinPartitions("token", "part")
            .mapInArrow(_compare(width, percent), "u long, v long"))


def _merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """The (rid, component) table after joining the components that ``links`` (u, v) name."""
    links = materialize(links, "join-links")
    if links.isEmpty():
        return label
    now = materialize(components(links), "join-merged")
    known = label.join(now, label["component"] == now["node"], "left").select(
        "rid", F.coalesce(now["component"], label["component"]).alias("component"))
    # a component of one set has no row so far
    alone = now.filter("node <> component").join(label, now["node"] == label["rid"], "left_anti").select(
        F.col("node").alias("rid"), "component")
    return materialize(known.unionByName(alone), "join-label")


def _unresolved(entries: DataFrame, label: DataFrame) -> DataFrame:
    """Entries of the shingles whose holders are in more than one component."""
    named = entries.join(label, "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    mixed = (named.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b"))
             .filter("a < b").select("token"))
    return named.join(mixed, "token", "left_semi")


def _candidates(left: DataFrame, sets: DataFrame, rounds: tuple[DataFrame, ...], percent: int, spark) -> DataFrame:
    """Pairs (u, v, cu, cv) across components that may link; ``rounds`` have the bucket of each set in them."""
    blocks = F.ceil(F.col("holders") / BLOCK_SETS).cast("int")
    early = (left.groupBy("rid").agg(F.slice(F.sort_array(F.collect_list("token")), 1, EARLY).alias("early"),  # of one prefix
                                     F.first("n").alias("n"), F.count("*").alias("c"))
             .filter(F.col("c") >= _needed(percent)).select("rid", "early", F.array().cast("array<long>").alias("been")))
    for bucket in rounds:  # sets left at the end were in both
        early = (early.join(bucket.select("rid", F.array("token", "part").alias("_bucket")), "rid")
                 .select("rid", "early", F.concat("been", "_bucket").alias("been")))
    wide = (left.join(early, "rid").join(sets.select("rid", "bits"), "rid").withColumn("blocks", blocks)
            .withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("token", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
                    "rid", "component", "n", "bits", "block", "early", "been"))
    pairs = materialize(wide.repartition(4 * shuffle_partitions(spark), "token", "x", "y").sortWithinPartitions("token", "x", "y")
                        .mapInArrow(_cross(percent), "u long, v long").distinct(), "join-met")
    ids = materialize(pairs.select(F.explode(F.array("u", "v")).alias("rid")).distinct(), "join-met-ids")
    prefix = materialize(likely_rows(sets.select("rid", "n", "tokens"), "rid", ids).join(ids, "rid"), "join-met-sets")
    # linked sets share so many prefix shingles
    need = F.greatest(F.lit(1), F.floor(F.least("n", "m") / SHARE))
    pairs = (pairs.join(prefix.select(F.col("rid").alias("u"), "n", F.col("tokens").alias("a")), "u")
             .join(prefix.select(F.col("rid").alias("v"), F.col("n").alias("m"), F.col("tokens").alias("b")), "v")
             .filter(F.size(F.array_intersect("a", "b")) >= need).select("u", "v"))
    return _labelled(pairs, left.select("rid", "component").distinct())


def _labelled(pairs: DataFrame, label: DataFrame) -> DataFrame:
    for name in ("u", "v"):
        own = label.select(F.col("rid").alias(name), F.col("component").alias("c" + name))
        pairs = pairs.join(own, name, "left").withColumn("c" + name, F.coalesce("c" + name, name))
    return pairs.select("u", "v", F.least("cu", "cv").alias("cu"), F.greatest("cu", "cv").alias("cv"))


def _exact(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (u, v) of components: those of the pairs (cu, cv, u, v) whose sets u and v link."""
    joined = (pairs.join(texts.select(F.col("rid").alias("u"), F.col("text").alias("a")), "u")
              .join(texts.select(F.col("rid").alias("v"), F.col("text").alias("b")), "v").select("cu", "cv", "a", "b"))
    return joined.mapInArrow(_verify(width, percent), "u long, v long")
