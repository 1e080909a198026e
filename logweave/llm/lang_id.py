"""Language identification by word-first backoff.

Words are maximal runs of letters, lower-cased (a numeral such as ``½`` may be part of
one, but is none by itself). A word that occurs in the training
texts ("known") scores its log frequency in each language. Any other word falls
back to its character 4-grams (with edge marks), and if none of them is known, to
its 3-grams, 2-grams and 1-grams; it scores the mean log frequency of the known ones.

All training texts are counted in full. Words with a share of at least 1 / ``WORDS``
in some language are kept at hand in every task; the counts of all others stay a
distributed table, which meets the distinct words of each chunk of texts by a join.
Of the n-grams, those with a share of at least 1 / ``GRAMS`` in some language are
kept, so the model kept at hand is bounded by languages x (WORDS + 4 x GRAMS).

A null text or one without a letter gets ``und`` with score 0. The score of the
others is the posterior of the best language (0 to 1); ties go to the first
language in alphabetical order.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import materialize, packed, shuffle_partitions, small_batches, without

WORDS = 20_000
GRAMS = 20_000
ORDERS = (4, 3, 2, 1)
# Added count of a word or gram that a language does not use.
SMOOTH = 0.5
# Entries a task holds before it hands them on, and bytes of text scored in one chunk.
HOLD = 400_000
CHUNK_BYTES = 32_000_000
# Rows of a chunk that are scored at once.
SCORED_ROWS = 2_000
_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return [w for w in _LETTERS.findall(text.lower()) if w.isalpha() or any(map(str.isalpha, w))]


def grams_of(word: str, n: int) -> list[str]:
    w = f"^{word}$" if n > 1 else word
    return [w[i:i + n] for i in range(len(w) - n + 1)]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = {}

    def flush():
        for lang, c in held.items():
            words = sorted(c)  # neighbours with common beginnings: half the room in the exchange
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(c), pa.string()),
                                              "gram": pa.array(words, pa.string()),
                                              "n": pa.array([c[w] for w in words], pa.int64())})
        held.clear()

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            held.setdefault(lang, Counter()).update(words_of(text))
        if sum(map(len, held.values())) > HOLD:
            yield from flush()
    yield from flush()


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, int], Counter] = {}

    def flush():
        for (lang, n), c in held.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(c), pa.string()),
                                              "width": pa.array([n] * len(c), pa.int32()),
                                              "gram": pa.array(list(c), pa.string()),
                                              "n": pa.array(list(c.values()), pa.int64())})
        held.clear()

    for b in batches:
        for lang, word, count in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            for n in ORDERS:
                c = held.setdefault((lang, n), Counter())
                for g in grams_of(word, n):
                    c[g] += count
        if sum(map(len, held.values())) > HOLD:
            yield from flush()
    yield from flush()


class Model:
    """Log frequencies: ``tables[0]`` for frequent words, ``tables[n]`` for n-grams; rows of the matrices by key.
    ``words`` (lang, gram, n) has the counts of all ``n_words`` words; it stays on the driver's side."""

    def __init__(self, langs: list[str], rows: list[tuple[int, str, str, int]], totals: dict[tuple[int, str], int],
                 words: DataFrame, n_words: int):
        self.langs, self.words = langs, words
        self.at = at = {lang: i for i, lang in enumerate(langs)}
        self.tables: dict[int, dict[str, np.ndarray]] = {}
        for width in (0, *ORDERS):
            counts: dict[str, np.ndarray] = {}
            for w, lang, gram, n in rows:
                if w == width:
                    counts.setdefault(gram, np.zeros(len(langs)))[at[lang]] = n
            total = np.array([totals.get((width, lang), 0) for lang in langs], float)
            low = np.log(total + SMOOTH * ((len(counts) if width else n_words) + 1))
            if not width:
                self.low = low
            self.tables[width] = {g: (np.log(c + SMOOTH) - low).tolist() for g, c in counts.items()}

    def __getstate__(self):
        return {**self.__dict__, "words": None}

    def rare(self, counts: pa.Table) -> tuple[pa.Array, np.ndarray]:
        """The distinct words of ``counts`` (lang, gram, n), and a row of log frequencies for each."""
        gram = pc.dictionary_encode(counts.column("gram").cast(pa.large_string()).combine_chunks())
        rows = np.zeros((len(gram.dictionary), len(self.langs)))
        lang = pc.index_in(counts.column("lang").combine_chunks(), value_set=pa.array(self.langs, counts.schema.field("lang").type))
        rows[gram.indices.to_numpy(), lang.to_numpy()] = counts.column("n").to_numpy()
        rows += SMOOTH
        np.log(rows, out=rows)
        rows -= self.low
        return gram.dictionary, rows

    def word(self, w: str, rare: dict[str, list[float]] = {}) -> list[float]:  # noqa: B006
        """Score of a word in each language; ``rare`` has the known words that are not at hand."""
        known = self.tables[0].get(w) or rare.get(w)
        if known is not None:
            return known
        for n in ORDERS:
            get = self.tables[n].get
            found = [v for g in grams_of(w, n) if (v := get(g)) is not None]
            if found:
                return [sum(x) / len(found) for x in zip(*found)]
        return [0.0] * len(self.langs)


def _often(counts: DataFrame, width, most: int) -> tuple[DataFrame, DataFrame]:
    """Totals by (width, lang), and the entries that have a share of 1 / most in a language."""
    counts = counts.withColumn("width", width)
    totals = counts.groupBy("width", "lang").agg(F.sum("n").alias("total"))
    often = (counts.join(F.broadcast(totals), ["width", "lang"])  # a row per language and order
             .filter(F.col("n") * most >= F.col("total")).select("width", "gram").distinct())
    return totals, counts.join(often, ["width", "gram"], "left_semi").select("width", "lang", "gram", "n")


def train(labelled: DataFrame, words: int = WORDS, grams: int = GRAMS) -> Model:
    """Count all words of ``labelled`` (lang, text); the bounded part of the model is kept on the driver."""
    small_batches(labelled.sparkSession)
    rows = (labelled.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
            .filter(F.col("lang").isNotNull() & F.col("text").isNotNull()))
    counted = materialize(rows.mapInArrow(_count_words, "lang string, gram string, n long")
                          .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "lang-words")
    gram_counts = materialize(counted.mapInArrow(_count_grams, "lang string, width int, gram string, n long")
                              .groupBy("lang", "width", "gram").agg(F.sum("n").alias("n")), "lang-grams")
    kept, totals = [], {}
    for counts, width, most in ((counted, F.lit(0), words), (gram_counts, F.col("width"), grams)):
        t, k = _often(counts, width, most)
        totals |= {(r["width"], r["lang"]): r["total"] for r in t.collect()}
        kept += [(r["width"], r["lang"], r["gram"], r["n"]) for r in k.collect()]  # at most languages**2 x most
    return Model(sorted({lang for _, lang in totals}), kept, totals, counted, counted.select("gram").distinct().count())


class Predictor:
    """Scores texts; the scores of words met before are kept at hand (and dropped when they are many).
    ``rare`` has the known words of the texts that are not at hand; without it all are fetched (small models only)."""

    def __init__(self, model: Model, rare: dict[str, list[float]] | None = None):
        self.model, self.k = model, len(model.langs)
        if rare is None:
            words, rows = model.rare(model.words.toArrow())
            rare = dict(zip(words.to_pylist(), rows.tolist()))
        self.rare = rare
        self.at: dict[str, int] = {}
        self.rows = np.zeros((1024, max(self.k, 1)))

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = words_of(text) if text is not None else []
        if not words or not self.k:
            return "und", 0.0
        if len(self.at) > HOLD:
            self.at.clear()
        ids = []
        for w in words:
            i = self.at.get(w)
            if i is None:
                i = self.at[w] = len(self.at)
                if i >= len(self.rows):
                    self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                self.rows[i] = self.model.word(w, self.rare)
            ids.append(i)
        total = self.rows[np.array(ids)].sum(axis=0)
        best = int(total.argmax())
        return self.model.langs[best], float(1 / np.exp(total - total[best]).sum())


def _split(shared):
    """Per row: the summed scores of its frequent words, its other words (one text, sorted: hardly any room is
    lost to an entry per word), and the number of all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = shared.value.tables[0]
        at = {w: i for i, w in enumerate(near)}
        rows = np.array(list(near.values()) or np.zeros((1, len(shared.value.langs))))
        for b in batches:
            sums, rare, counts = [], [], []
            for text in b.column("text").to_pylist():
                words = words_of(text or "")
                found = [at[w] for w in words if w in at]
                sums.append(rows[found].sum(axis=0).tolist() if found else [0.0] * rows.shape[1])
                rare.append(" ".join(sorted([w for w in words if w not in at])))
                counts.append(len(words))
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(sums, pa.list_(pa.float64())), pa.array(rare, pa.string()),
                                              pa.array(counts, pa.int64()), b.column("_chunk")], names=["key", "sums", "rare", "words", "_chunk"])
    return run


def _words_in(rare: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts, one after the other, as an Arrow array, and their number in each text
    (a text without any has one, the empty one)."""
    split = pc.split_pattern(rare.cast(pa.large_string()), " ")
    return split.flatten(), pc.list_value_length(split).to_numpy()


def _rare_words(t: pa.Table) -> pa.Table:
    """The distinct words of a chunk that are not at hand."""
    parts = [pc.unique(_words_in(b.column(0))[0]) for b in t.select(["rare"]).to_batches(max_chunksize=SCORED_ROWS)]
    found = pc.unique(pa.chunked_array(parts, pa.large_string()))
    del parts
    found = found.filter(pc.not_equal(found, ""))
    found = found.take(pc.sort_indices(found)).cast(pa.string())
    return pa.table([pa.array(np.full(len(found), t.column("_chunk")[0].as_py(), np.int64)), found], names=["_chunk", "gram"])


def _score_chunk(shared):
    def run(rows: pa.Table, counts: pa.Table) -> pa.Table:
        model = shared.value
        words, known = model.rare(counts)
        far: dict[str, list[float]] = {}  # scores of the words without a count
        langs, scores = [], []
        # a chunk's texts are split a batch at a time; of their words, only those without a count become Python objects
        for part in rows.select(["sums", "rare", "words"]).to_batches(max_chunksize=SCORED_ROWS):
            flat, length = _words_in(part.column(1))
            flat = pc.dictionary_encode(flat)
            met, ids = flat.dictionary, flat.indices.to_numpy()
            at = pc.fill_null(pc.index_in(met, value_set=words), -1).to_numpy()
            vectors = known[at] if len(known) else np.zeros((len(at), max(len(model.langs), 1)))
            unknown = np.flatnonzero(at < 0) if model.langs else np.zeros(0, np.int64)
            for i, w in zip(unknown.tolist(), met.take(pa.array(unknown)).to_pylist()):
                if w not in far:
                    far[w] = model.word(w) if w else [0.0] * len(model.langs)  # no word at all: a row without any
                vectors[i] = far[w]
            ends = np.cumsum(length)
            for sums, n, lo, hi in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), (ends - length).tolist(), ends.tolist()):
                if not n or not model.langs:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                total = vectors[ids[lo:hi]].sum(axis=0) + sums
                best = int(total.argmax())
                langs.append(model.langs[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
        return pa.table([rows.column("key"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["key", "lang_pred", "score"])
    return run


def _dealt(rows: DataFrame, shared) -> DataFrame:
    """What ``rows`` (key, text) need of the distributed counts, in chunks. A row's chunk also depends on the
    scan partition it comes from: rows that repeat entirely do not all meet in one chunk."""
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(int(size // CHUNK_BYTES) + 1, 2 * spark.sparkContext.defaultParallelism)
    place = F.pmod(F.xxhash64("key", "text", F.spark_partition_id()), F.lit(chunks)).cast("long")
    return (rows.select("key", "text", place.alias("_chunk"))
            .mapInArrow(_split(shared), "key long, sums array<double>, rare string, words long, _chunk long")
            .repartition(min(chunks, 4 * shuffle_partitions(spark)), "_chunk"))


def scores(rows: DataFrame, model: Model) -> DataFrame:
    """key, lang_pred, score for every row of ``rows`` (key, text).

    Frequent words are scored where the text is read; only a row's other words
    travel, once: chunks and their distinct words are read from one exchange.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)  # bounded: see the module text
    dealt = _dealt(rows, shared)
    words = dealt.groupBy("_chunk").applyInArrow(_rare_words, "_chunk long, gram string")
    met = words.join(model.words, "gram").select("_chunk", "lang", "gram", "n")
    return dealt.groupBy("_chunk").cogroup(met.groupBy("_chunk")).applyInArrow(
        _score_chunk(shared), "key long, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (all columns) whose language is told with a score of at least ``least``."""
    text = F.col("text").cast("string")
    key = F.xxhash64("doc_id", text)
    told = scores(docs.select(key.alias("key"), text.alias("text")), model)
    gone = materialize(told.filter(~((F.col("lang_pred") != "und") & (F.col("score") >= least)))
                       .select(F.col("key").alias("_row_key")).distinct(), "lang-rejected")
    return without(packed(docs, key.alias("_row_key")), "_row_key", gone).select("row.*")


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score for every row; only the text is looked at."""
    rows = docs.select(F.col("doc_id").cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    return scores(rows, model).withColumnRenamed("key", "doc_id")
