"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in a plain form: lower case, every run of characters other
than letters and digits as one space. An item of ``m`` characters may differ by
``k = floor(RATE m)`` edits; it is split into ``k + 1`` pieces, one of which must
occur unchanged in any passage within the budget. Exact piece hits come from an
Aho-Corasick automaton; around each hit Myers' bit-parallel algorithm finds the
smallest edit distance between the item and a stretch of the text.

Items are taken in blocks of a bounded size, each block against all documents.
Items under ``MIN_CHARS`` plain characters are too short to tell a leak from
chance and match nothing; a null text matches nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import materialize, packed, small_batches, without

RATE = 0.05
MIN_CHARS = 20
# Characters of items that one block broadcasts.
BLOCK_CHARS = 4_000_000
_OTHER = re.compile(r"[\W_]+")


def plain(text: str | None) -> str:
    return _OTHER.sub(" ", (text or "").lower()).strip()


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """``k + 1`` pieces of nearly equal length, with their places."""
    cuts = [i * len(item) // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks_of(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def best_match(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Smallest edit distance of the item to a stretch of ``text``, and where the first such stretch ends
    (Myers' bit-parallel recurrence; an integer holds a column of the distance table)."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for at, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        plus = down | (full & ~(diagonal | up))
        minus = up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up = minus | (full & ~((eq | down) | plus))
        down = plus & (eq | down)
        if score < best:
            best, end = score, at
    return best, end


class Matcher:
    """Automaton over the pieces of a block of plain items."""

    def __init__(self, items: list[tuple[int, str]]):
        import ahocorasick

        self.items: dict[str, list[int]] = {}
        for i, t in items:
            if len(t) >= MIN_CHARS:
                self.items.setdefault(t, []).append(i)
        self.texts = sorted(self.items)
        self.masks: list = [None] * len(self.texts)
        found: dict[str, list[tuple[int, int]]] = {}
        for n, t in enumerate(self.texts):
            for at, piece in pieces(t, int(len(t) * RATE)):
                found.setdefault(piece, []).append((n, at))
        self.machine = ahocorasick.Automaton()
        for piece, where in found.items():
            self.machine.add_word(piece, (len(piece), where))
        if found:
            self.machine.make_automaton()

    def matches(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(item id, edits, end in the plain text) of the best match of every item within its budget."""
        if not self.texts:
            return
        spots: dict[int, list[int]] = {}
        for end, (size, where) in self.machine.iter(text):
            for n, at in where:
                spots.setdefault(n, []).append(end + 1 - size - at)
        for n, starts in spots.items():
            t = self.texts[n]
            m, k = len(t), int(len(t) * RATE)
            if self.masks[n] is None:
                self.masks[n] = masks_of(t)
            best, end, done = k + 1, 0, -1
            for s in sorted(starts):
                if s <= done:  # within a window that has been looked at
                    continue
                lo, done = max(0, s - k), s + k
                d, e = best_match(self.masks[n], m, text[lo:s + m + 2 * k])
                if d < best:
                    best, end = d, lo + e
                if not best:
                    break
            if best <= k:
                for i in self.items[t]:
                    yield i, best, end


def _match(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        for b in batches:
            rows = []
            for row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows += [(row, *m) for m in matcher.matches(plain(text))]
            cols = list(zip(*rows)) or [[]] * 4
            kinds = (b.column(0).type, pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "item_id", "edits", "end_char"])
    return run


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, edits, end_char (in the plain text) of every item that a document holds."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .filter(F.col("text").isNotNull())
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(size // BLOCK_CHARS) + 1
    out = None
    for b in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()  # about BLOCK_CHARS
        shared = spark.sparkContext.broadcast([(r["item_id"], plain(r["text"])) for r in block])
        found = docs.mapInArrow(_match(shared), "doc_id long, item_id long, edits int, end_char int")
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text holds no item."""
    spark = docs.sparkSession
    small_batches(spark)
    keyed = packed(docs, F.xxhash64("doc_id", "text").alias("_row_key"))
    found = leaks(keyed.select(F.col("_row_key").alias("doc_id"), "row.text"), items)
    found = materialize(found.select(F.col("doc_id").alias("_row_key")).distinct(), "leaks")
    return without(keyed, "_row_key", found).select("row.*")
