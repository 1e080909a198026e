"""Toxicity by a learnt lexicon, Levenshtein automata and context windows.

Learning (labelled rows only):

1. Distinct words of each labelled text are counted in toxic and in clean texts (texts
   that repeat exactly count once). Words and their beginnings (``MIN_STEM`` to
   ``MAX_STEM`` letters) that a likelihood-ratio test finds toxic (``LEAST_G2``, about one
   in a million by chance, and ``LEAST_LIFT`` times as frequent) become the lexicon: at
   most ``LEXICON`` words and ``LEXICON`` stems, the most significant first.
2. The words are a trie. A word of the text runs through the Levenshtein automata of all
   lexicon words at once: a state is the set of (trie node, edits so far) that are within
   budget, and transitions are kept once computed (the intersection automaton, made
   lazily). Budget: no edit under 5 letters, one from 5, two from 8. Misspellings that
   clean training texts use as words of their own are known and do not count.
3. Each hit has a context score from the window of ``WINDOW`` words on both sides: other
   hits raise it, quotation marks around it, a quoted line (``>``) and words of reporting
   lower it. A text's evidence is the sum of weight x context; two features (evidence, and
   evidence per 100 words, both as logarithms) go into a logistic regression fitted on
   the full histogram of the training texts (``BINS`` x ``BINS`` cells, so of fixed size).

Scoring is one pass over the texts without a shuffle.

Defined results: a null or empty text has no evidence and scores what training texts
without evidence do. A doc_id with several labels is toxic if one says so; null labels and
null doc_ids are not learnt from. Without labelled rows (or with no toxic one among them)
every score is 0. Rows that repeat are scored alike; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import exp, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import bucket_is, likely_rows, materialize, small_batches

MIN_STEM, MAX_STEM = 4, 12
LEXICON = 1_000
VARIANTS = 50_000
LEAST_G2, LEAST_LIFT = 24.0, 5.0
MAX_WEIGHT = 6.0
FUZZY = 0.6        # share of its weight that a misspelt term keeps
WINDOW = 5
NEAR, QUOTED, REPORTED, LEAST_CONTEXT = 0.5, 0.75, 0.5, 0.1
BINS = 64
RIDGE = 0.01
# Entries a task holds before it hands them on, and letters of a text handled at once.
HOLD = 400_000
SEGMENT = 1 << 20

# Words that report what somebody said (English, German, French, Spanish).
REPORTING = frozenset("""
said says say wrote writes called calls quote quoted quotes word words term terms phrase sentence
sagte sagt schrieb nannte zitat zitiert wort begriff
dit disait mot terme citation
dijo dice escribió llamó cita palabra término
""".split())
OPENING, CLOSING = "“„«", "”»"

_TOKEN = re.compile(r"[^\W_]+(?:[*@$#!]+[^\W_]+)*")
_MARKED = re.compile(r"[^\W_]+(?:[*@$#!]+[^\W_]+)*|[\n\"“”„«»]|(?<=\n)[ \t]*>|^[ \t]*>")


def segments(text: str, size: int) -> Iterator[str]:
    """The text in parts of about ``size`` letters, cut at blanks only."""
    i, n = 0, len(text)
    while i < n:
        j = i + size
        while j < n and not text[j].isspace():
            j += 1
        yield text[i:j]
        i = j


def budget(word: str) -> int:
    return 0 if len(word) < 5 else 1 if len(word) < 8 else 2


class Automaton:
    """Levenshtein automata of all ``words`` over their trie; states are made when first met."""

    def __init__(self, words: dict[str, float], most_states: int = 200_000):
        self.words, self.most = words, most_states
        self.children: list[dict[str, int]] = [{}]
        self.slack = [0]       # largest budget of the words below a node
        self.ends: dict[int, str] = {}
        for w in sorted(words):
            node, room = 0, budget(w)
            self.slack[0] = max(self.slack[0], room)
            for ch in w:
                nxt = self.children[node].get(ch)
                if nxt is None:
                    nxt = self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.slack.append(0)
                node = nxt
                self.slack[node] = max(self.slack[node], room)
            self.ends[node] = w
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.steps: dict[tuple[int, str], int] = {}
        self.hits: list[tuple[str, int] | None] = []
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        todo = list(nodes.items())
        while todo:  # letters of the term that the text left out
            node, e = todo.pop()
            if nodes.get(node, e) < e:
                continue
            for nxt in self.children[node].values():
                if e < self.slack[nxt] and nodes.get(nxt, e + 2) > e + 1:
                    nodes[nxt] = e + 1
                    todo.append((nxt, e + 1))
        if not nodes:
            return -1
        key = tuple(sorted(nodes.items()))
        found = self.ids.get(key)
        if found is None:
            found = self.ids[key] = len(self.states)
            self.states.append(key)
            best = None
            for node, e in key:
                w = self.ends.get(node)
                if w is not None and e <= budget(w) and (best is None or (e, -self.words[w], w) < (best[1], -self.words[best[0]], best[0])):
                    best = (w, e)
            self.hits.append(best)
        return found

    def _step(self, state: int, ch: str) -> int:
        nodes: dict[int, int] = {}

        def put(node, e):
            if e <= self.slack[node] and nodes.get(node, e + 1) > e:
                nodes[node] = e
        for node, e in self.states[state]:
            put(node, e + 1)  # a letter too many
            for c, nxt in self.children[node].items():
                put(nxt, e if c == ch else e + 1)
        out = self.steps[state, ch] = self._state(nodes)
        return out

    def find(self, word: str) -> tuple[str, int] | None:
        """The closest lexicon word within its budget, and the number of edits."""
        if len(self.states) > self.most:
            self._reset()
        state, steps = self.start, self.steps
        for ch in word:
            nxt = steps.get((state, ch))
            state = self._step(state, ch) if nxt is None else nxt
            if state < 0:
                return None
        return self.hits[state]


class Lexicon:
    """Weights of whole words and stems, and the clean words that only look like misspellings."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], clean: frozenset[str] = frozenset()):
        self.words, self.stems, self.clean = words, stems, clean
        self.lengths = sorted({len(s) for s in stems})
        self.auto: Automaton | None = None
        self.known: dict[str, float] = {}   # weights of terms met before
        self.plain: set[str] = set()        # words met before that are no term

    def __getstate__(self):
        return {**self.__dict__, "auto": None, "known": {}, "plain": set()}

    def fuzzy(self, word: str) -> float:
        """Weight as a misspelling (0: none)."""
        if self.auto is None:
            self.auto = Automaton(self.words)
        hit = self.auto.find(word)
        return FUZZY * self.words[hit[0]] if hit is not None and hit[1] else 0.0

    def weight(self, word: str) -> float:
        if word in self.plain:
            return 0.0
        w = self.known.get(word)
        if w is None:
            w = self.words.get(word, 0.0)
            for n in self.lengths:
                w = max(w, self.stems.get(word[:n], 0.0))
            if not w and word not in self.clean:
                w = self.fuzzy(word)
            if len(self.plain) + len(self.known) > HOLD:
                self.plain.clear()
                self.known.clear()
            if w:
                self.known[word] = w
            else:
                self.plain.add(word)
        return w

    def any_term(self, words: list[str]) -> bool:
        return any([self.weight(w) for w in set(words).difference(self.plain)])


def evidence(text: str | None, lexicon: Lexicon) -> tuple[float, int]:
    """Sum of weight x context over the hits of a text, and its number of words."""
    total = len(text or "")
    if not total:
        return 0.0, 0
    lowered = text.lower() if total <= SEGMENT else None
    parts = [lowered] if lowered is not None else (s.lower() for s in segments(text, SEGMENT))
    place, last, inside, quoted_line, report = 0, -WINDOW - 1, None, False, -WINDOW - 1
    done, pending = 0.0, None  # pending: the last hit (place, weight, hits near it, quoted, reported), still open to its right
    for part in parts:
        tokens = _TOKEN.findall(part)
        if total <= SEGMENT and not lexicon.any_term(tokens):
            return 0.0, len(tokens)
        for t in _MARKED.findall(part):
            head = t[0]
            if head == "\n":
                inside, quoted_line = None, False
            elif head == '"':
                inside = None if inside == '"' else '"'
            elif head in OPENING:
                # a German quotation ends with the mark that opens an English one
                inside = None if inside == "„" and head == "“" else head
            elif head in CLOSING:
                inside = None
            elif head == ">" or head in " \t":
                quoted_line = True
            else:
                w = lexicon.weight(t)
                if w:
                    near = place - last <= WINDOW
                    if pending is not None:
                        if near:
                            pending[2] += 1
                        done += _context(*pending)
                    pending = [place, w, int(near), inside is not None or quoted_line, place - report <= WINDOW]
                    last = place
                if t in REPORTING:
                    report = place
                    if pending is not None and place - pending[0] <= WINDOW:
                        pending[4] = True
                place += 1
    if pending is not None:
        done += _context(*pending)
    return done, place


def _context(_place: int, weight: float, near: int, quoted: bool, reported: bool) -> float:
    score = 1 + NEAR * near - QUOTED * quoted - REPORTED * reported
    return weight * max(score, LEAST_CONTEXT)


def features(e: float, n: int) -> tuple[float, float]:
    return log1p(e), log1p(100 * e / max(n, 1))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[int]] = {}

    def flush():
        out = pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()),
                                          "bad": pa.array([v[1] for v in held.values()], pa.int64()),
                                          "good": pa.array([v[0] for v in held.values()], pa.int64())})
        held.clear()
        return out
    for b in batches:
        for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
            words = set()
            for part in segments(text or "", SEGMENT):
                words.update(_TOKEN.findall(part.lower()))
            for w in words:
                v = held.get(w)
                if v is None:
                    v = held[w] = [0, 0]
                v[toxic] += 1
            if len(held) > HOLD:
                yield flush()
    if held:
        yield flush()


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic 0/1, first) of the labelled rows; ``first`` marks one row of equal texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    marks = (labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    near = likely_rows(rows, "doc_id", marks)
    firsts = (near.select("doc_id", F.xxhash64("text").alias("hash")).join(marks, "doc_id")
              .groupBy("hash", "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id", F.lit(True).alias("first")).distinct())
    return near.join(marks, "doc_id").join(firsts, "doc_id", "left").select("doc_id", "text", "toxic", F.coalesce("first", F.lit(False)).alias("first"))


def _candidates(counted: DataFrame) -> list[tuple[str, float, float, int]]:
    """(term, weight, g2, toxic texts) of words (with a closing ``$``) and stems that are toxic beyond chance."""
    totals = counted.agg(F.sum("bad"), F.sum("good")).first()
    bad, good = float(totals[0] or 0), float(totals[1] or 0)
    if not bad:
        return []
    marked = F.concat("word", F.lit("$"))
    ends = F.sequence(F.least(F.lit(MIN_STEM), F.length(marked)), F.least(F.lit(MAX_STEM), F.length(marked)))
    terms = counted.select(F.explode(F.transform(ends, lambda k: F.substring(marked, F.lit(1), k))).alias("term"), "bad", "good")
    share = bad / (bad + good)
    n, b, g = F.col("bad") + F.col("good"), F.col("bad"), F.col("good")
    side = lambda x, p: F.when(x > 0, x * F.log(x / (n * p))).otherwise(0.0)
    found = (terms.groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
             .withColumn("lift", (b / bad) / ((g + 0.5) / (good + 0.5)))
             .withColumn("g2", 2 * (side(b, share) + side(g, max(1 - share, 1e-12))))
             .filter((F.col("lift") >= LEAST_LIFT) & (F.col("g2") >= LEAST_G2)))
    # a bound on the lexicon, not on the texts: the most significant terms
    best = found.orderBy(F.desc("g2"), "term").limit(40 * LEXICON)
    return [(r["term"], min(log(r["lift"]), MAX_WEIGHT), r["g2"], r["bad"]) for r in best.collect()]


def choose(candidates: list[tuple]) -> tuple[dict[str, float], dict[str, float]]:
    """Whole words, and stems that no single continuation accounts for and no kept shorter stem covers."""
    by_g2 = sorted(candidates, key=lambda c: (-c[2], c[0]))
    words = {t[:-1]: w for t, w, *_ in by_g2 if t.endswith("$")}
    words = dict(list(words.items())[:LEXICON])
    most: dict[str, int] = {}
    for t, _, _, bad in candidates:
        most[t[:-1]] = max(most.get(t[:-1], 0), bad)
    stems: dict[str, float] = {}
    for t, w, _, bad in sorted(by_g2, key=lambda c: len(c[0])):
        if not t.endswith("$") and most.get(t, 0) < 0.95 * bad and not any(t[:k] in stems for k in range(MIN_STEM, len(t))):
            stems[t] = w
    order = {t: i for i, (t, *_) in enumerate(by_g2)}
    return words, {s: stems[s] for s in sorted(stems, key=order.__getitem__)[:LEXICON]}


def _variants(counted: DataFrame, lexicon: Lexicon) -> frozenset[str]:
    """Training words that look like misspellings of the lexicon but are as frequent in clean texts."""
    def run(batches):
        for b in batches:
            keep = [i for i, w in enumerate(b.column("word").to_pylist()) if w not in lexicon.words and lexicon.fuzzy(w)]
            yield b.take(pa.array(keep, pa.int64()))
    near = counted.filter("good > bad").select("word", "bad", "good").mapInArrow(run, "word string, bad long, good long")
    return frozenset(r["word"] for r in near.orderBy(F.desc("good"), "word").limit(VARIANTS).collect())


def _evidence(rows: DataFrame, lexicon: Lexicon, keep: str, kind: str) -> DataFrame:
    def run(batches):
        for b in batches:
            found = [evidence(t, lexicon) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(keep), pa.array([f[0] for f in found], pa.float64()),
                                              pa.array([f[1] for f in found], pa.int64())], names=[keep, "e", "n"])
    return rows.select(keep, "text").mapInArrow(run, f"{keep} {kind}, e double, n long")


def fit(cells: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method on rows (x1, x2, texts, toxic texts); a small ridge on the slopes."""
    x = np.column_stack([np.ones(len(cells)), cells[:, :2]])
    n, bad = cells[:, 2], cells[:, 3]
    w = np.zeros(3)
    ridge = np.diag([1e-6, RIDGE, RIDGE])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (bad - n * p) - ridge @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray | None):
        self.lexicon, self.weights = lexicon, None if weights is None else weights.tolist()

    def score(self, e: float, n: int) -> float:
        if self.weights is None:
            return 0.0
        a, b, c = self.weights
        x, y = features(e, n)
        return 1 / (1 + exp(-max(-35.0, min(35.0, a + b * x + c * y))))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn lexicon and weights from the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) marks."""
    small_batches(docs.sparkSession)
    rows = materialize(_labelled(docs, labels), "toxic-labelled")
    counted = materialize(rows.filter("first").select("text", "toxic").mapInArrow(_count, "word string, bad long, good long")
                          .groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "toxic-words")
    words, stems = choose(_candidates(counted))
    lexicon = Lexicon(words, stems)
    if words or stems:
        lexicon = Lexicon(words, stems, _variants(counted, lexicon))
    cell = lambda c: F.least(F.floor(F.log1p(c) * 8), F.lit(BINS - 1))
    x1, x2 = F.col("e"), 100 * F.col("e") / F.greatest("n", F.lit(1))
    cells = (_evidence(rows, lexicon, "toxic", "int").groupBy(cell(x1).alias("i"), cell(x2).alias("j"))
             .agg(F.avg(F.log1p(x1)).alias("x1"), F.avg(F.log1p(x2)).alias("x2"), F.count("*").alias("n"), F.sum("toxic").alias("bad"))
             .orderBy("i", "j").collect())  # at most BINS x BINS rows
    table = np.array([(r["x1"], r["x2"], r["n"], r["bad"]) for r in cells], float).reshape(-1, 4)
    return Model(lexicon, fit(table) if len(table) and table[:, 3].sum() else None)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted for every row; only the text is looked at."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # LEXICON words and stems, VARIANTS clean words

    def run(batches):
        m = shared.value
        for b in batches:
            found = [m.score(*evidence(t, m.lexicon)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, pa.float64()),
                                              pa.array([int(s >= 0.5) for s in found], pa.int32())], names=["doc_id", "score", "predicted"])
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, score double, predicted int"))


def toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted: learnt from the rows whose crc32(doc_id) mod ``modulus`` is not ``held``."""
    model = train(docs.filter(~bucket_is("doc_id", modulus, held)), labels)
    return score(docs, model).select("doc_id", bucket_is("doc_id", modulus, held).alias("held_out"), "score", "predicted")
