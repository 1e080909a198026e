"""Log template mining.

Pipeline, all on Spark:

1. ``mask``: ordered regex rules replace variable parts by ``<:NAME:>``
   (a chain of ``regexp_replace``: JVM, whole-stage codegen).
2. ``tokenize``: ``_`` becomes a blank, split on Unicode blanks.
3. ``leaf_keys``: a line's leaf is (token count, first token). A first token
   holding a digit, or one that arrives after a length node already has
   ``max_children - 1`` own leaves, goes to the shared wildcard leaf. This is
   a rank over the distinct first tokens of each length: pure SQL.
4. ``mine``: greedy clustering inside each leaf (published Drain procedure:
   similarity = equal non-wildcard positions / length, best match wins, ties
   to more wildcards then the older cluster; merge turns differing positions
   into wildcards). Leaves are independent; the lines of a leaf, however many,
   are added one after another in position order. Rows stream through in
   batches, candidates come from an inverted index, and mining can go on from a
   stored state.
5. ``match``: second pass, every line against the finished templates of its
   leaf (exact match, wildcards match anything) through a discrimination tree.
   A leaf's lines are dealt to several tasks.

The leaves are those of the tree that mined: ``own_leaves`` is the table of
first tokens with a leaf of their own, ``route`` sends any lines through it.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.functions.parse import strip_u  # noqa: F401  (re-exported)
from logweave.operators.order import dense_index

# Masking rules in application order (regex, mask name), the
# mask wrapper, the wildcard token and the mining parameters.
MASKING_RULES = [
    (r"((?<=[^A-Za-z0-9])|^)(([0-9a-f]{2,}:){3,}([0-9a-f]{2,}))((?=[^A-Za-z0-9])|$)", "ID"),
    (r"((?<=[^A-Za-z0-9])|^)(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})((?=[^A-Za-z0-9])|$)", "IP"),
    (r"((?<=[^A-Za-z0-9])|^)([0-9a-f]{6,} ?){3,}((?=[^A-Za-z0-9])|$)", "SEQ"),
    (r"((?<=[^A-Za-z0-9])|^)([0-9A-F]{4} ?){4,}((?=[^A-Za-z0-9])|$)", "SEQ"),
    (r"((?<=[^A-Za-z0-9])|^)(0x[a-f0-9A-F]+)((?=[^A-Za-z0-9])|$)", "HEX"),
    (r"((?<=[^A-Za-z0-9])|^)([\-\+]?\d+)((?=[^A-Za-z0-9])|$)", "NUM"),
    (r"(?<=executed cmd )(\".+?\")", "CMD"),
]
MASK_PREFIX = "<:"
MASK_SUFFIX = ":>"
PARAM = "<*>"
SIM_TH = 0.4
MAX_CHILDREN = 100
EXTRA_DELIMITERS = ["_"]


# Execution form of a rule. The rules above bound a match by "start of text
# or a non-alphanumeric character before" and "end of text or one after";
# that is exactly "no alphanumeric before / after", which the regex engine
# checks much faster as negative look-arounds. Same matches, same output.
_BOUND_BEFORE = "((?<=[^A-Za-z0-9])|^)"
_BOUND_AFTER = "((?=[^A-Za-z0-9])|$)"


def execution_pattern(pattern: str) -> str:
    p = pattern
    if p.startswith(_BOUND_BEFORE):
        p = "(?<![A-Za-z0-9])" + p[len(_BOUND_BEFORE):]
    if p.endswith(_BOUND_AFTER):
        p = p[: -len(_BOUND_AFTER)] + "(?![A-Za-z0-9])"
    return "(?U)" + p


# Cheap necessary conditions of the rules above, by pattern: a rule only runs
# on rows that can match it, which skips most of the regex work on prose. Any
# other pattern, whatever its name, runs on every row.
_GUARDS = {pattern: guard for (pattern, _), guard in zip(MASKING_RULES, (
    lambda c: (F.instr(c, ":") > 0) & c.rlike("[0-9a-f]{2}:"),
    lambda c: (F.instr(c, ".") > 0) & c.rlike(r"(?U)\d\."),
    lambda c: c.rlike("[0-9a-f]{6}"),
    lambda c: c.rlike("[0-9A-F]{4}"),
    lambda c: F.instr(c, "0x") > 0,
    lambda c: c.rlike(r"(?U)\d"),
    lambda c: F.instr(c, "executed cmd ") > 0,
), strict=True)}


def mask(content: Column, rules=MASKING_RULES) -> Column:
    """Apply the masking rules in order (Unicode digits / blanks, ``(?U)``)."""
    out = content
    for pattern, name in rules:
        out = F.regexp_replace(out, "(?U)" + pattern, MASK_PREFIX + name + MASK_SUFFIX)
    return out


def mask_column(df: DataFrame, src: str, dst: str, rules=MASKING_RULES) -> DataFrame:
    """T1 as projection steps: same result as ``mask``, but each rule runs in
    its execution form and only on rows passing its cheap guard. Each step is
    its own projection, so the guarded value is computed once."""
    out = df.withColumn(dst, F.col(src))
    for pattern, name in rules:
        c = F.col(dst)
        replaced = F.regexp_replace(c, execution_pattern(pattern), MASK_PREFIX + name + MASK_SUFFIX)
        guard = _GUARDS.get(pattern)
        out = out.withColumn(dst, F.when(guard(c), replaced).otherwise(c) if guard else replaced)
    return out


def tokenize(content: Column, delimiters=EXTRA_DELIMITERS) -> Column:
    """Extra delimiters become blanks, then split on Unicode blanks.

    A split on blank runs yields an empty token at most before a leading and
    after a trailing run (and the only one of an empty text): these go. So a
    text is searched once, and not stripped first.
    """
    c = content
    for d in delimiters:
        c = F.translate(c, d, " ")
    return F.array_remove(F.split(c, r"(?U)\s+"), "")


def has_digit(tok: Column) -> Column:
    return tok.rlike(r"(?U)\d")


def _with_first(lines: DataFrame, tokens: str) -> DataFrame:
    return lines.withColumn("n_tokens", F.size(tokens)).withColumn(
        "_first", F.when(F.col("n_tokens") >= 2, F.col(tokens).getItem(0)))


def own_leaves(lines: DataFrame, tokens: str = "tokens", pos: str = "pos",
               max_children: int = MAX_CHILDREN, before: DataFrame | None = None) -> DataFrame:
    """``(n_tokens, first)`` of the first tokens that have a leaf of their own.

    These are the first ``max_children - 1`` distinct digit-free first tokens
    of each length in order of first appearance; all others share the wildcard
    leaf. At most ``max_children - 1`` rows per length. ``before`` is the table
    of the lines mined earlier: its leaves stay, new ones fill the room left.
    """
    t = _with_first(lines, tokens)
    # No filter touches the token columns here: a pushed-down filter would
    # re-evaluate the mask chain; nulls are grouped and ranked last instead.
    cand = F.when(~has_digit(F.col("_first")), F.col("_first"))
    firsts = t.groupBy("n_tokens", cand.alias("first")).agg(F.min(pos).alias("_fp")).withColumn("_new", F.lit(True))
    if before is not None:
        known = before.select("n_tokens", "first", F.lit(None).cast(firsts.schema["_fp"].dataType).alias("_fp"), F.lit(False).alias("_new"))
        firsts = (firsts.unionByName(known).groupBy("n_tokens", "first")
                  .agg(F.min("_fp").alias("_fp"), F.min("_new").alias("_new")))
    # distinct first tokens per length: bounded by the vocabulary, not the lines
    w = Window.partitionBy("n_tokens").orderBy(F.col("first").isNull(), "_new", "_fp", "first")
    return (firsts.withColumn("_r", F.row_number().over(w))
            .where(F.col("first").isNotNull() & (F.col("_r") <= max_children - 1))
            .select("n_tokens", "first"))


def route(lines: DataFrame, own: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Add ``n_tokens`` and ``leaf_token`` (first token, ``<*>`` or null) by the own-leaf table
    of the tree that mined. Lines of 0 or 1 tokens sit at the length node (null token)."""
    t = _with_first(lines, tokens)
    o = own.select("n_tokens", F.col("first").alias("_first"), F.lit(True).alias("_own"))
    # at most max_children - 1 rows a line length: it goes to the lines, not they to it
    t = t.join(F.broadcast(o), ["n_tokens", "_first"], "left")
    leaf = F.when(F.col("_first").isNull(), F.lit(None).cast("string")) \
        .when(F.col("_own"), F.col("_first")).otherwise(F.lit(PARAM))
    return t.withColumn("leaf_token", leaf).drop("_first", "_own")


def leaf_keys(lines: DataFrame, tokens: str = "tokens", pos: str = "pos",
              max_children: int = MAX_CHILDREN) -> DataFrame:
    """Route lines through the tree that they themselves grow."""
    return route(lines, own_leaves(lines, tokens, pos, max_children), tokens)


def order_key(hi: Column, lo: Column) -> Column:
    """One sortable number for a pair of non-negative longs (no overflow at any size)."""
    return (hi.cast("decimal(18,0)") * F.expr("9223372036854775808BD") + lo.cast("decimal(19,0)")).cast("decimal(38,0)")


MINE_SCHEMA = ("kind string, n_tokens int, leaf_token string, level int, piece long, local_id int, pos decimal(38,0), "
               "change_type string, template array<string>, size long")
# Catalogues merged by one task where a caller asks for chunks.
FAN = 64
# Longer than any leaf: lines of one piece when no chunks are asked for.
_WHOLE = 1 << 62


# Up to so many clusters a line is compared with all of them; beyond, with those the index proposes.
COMPARED = 128
# Lines whose cluster is kept at hand until a cluster changes.
_SETTLED = 1 << 16


class LeafClusters:
    """Clusters of one leaf (or of one chunk of it) while lines are added in position order.

    Templates are rows of numbers in one integer table (0: wildcard), four
    bytes a token; a number stands for a token at its position. The postings
    have, for every number, the clusters whose template held it when it was
    opened; what a wildcard has replaced since stays in them and is sorted out
    by the comparison with the table. A cluster is similar enough to a line only
    if it shares ``need`` positions with it, so of the line's postings without
    the ``need - k`` longest it occurs in ``k``: only those clusters are
    compared. A close cluster found in the shortest postings raises ``need`` first.
    """

    __slots__ = ("sim_th", "wild", "sizes", "first", "last", "last_at", "last_pos", "_need", "_numbers", "_known", "_words", "_table",
                 "_posted", "_settled")

    def __init__(self, sim_th: float = SIM_TH):
        self.sim_th = sim_th
        self.wild: list[int] = []
        self.sizes: list[int] = []
        self.first: list = []
        self.last = self.last_pos = None
        self.last_at = -1
        self._need: dict[int, int] = {}
        self._numbers: list[dict[str, int]] = []  # by position
        self._known: dict[str, str] = {}
        self._words: list[str] = [PARAM]
        self._table = None
        self._posted: list[int | array] | None = None  # by number; a single cluster as it is
        self._settled: dict[str, int] = {}

    def need(self, n: int) -> int:
        """The least number of equal positions that reaches the similarity threshold."""
        k = self._need.get(n)
        if k is None:
            k = 0
            while k < n and k / n < self.sim_th:
                k += 1
            self._need[n] = k
        return k

    def template(self, c: int) -> list[str]:
        words = self._words
        return [words[w] for w in self._table[c].tolist()]

    @property
    def index(self) -> dict[tuple[int, str], set[int]]:
        """For every (position, token) the clusters whose template holds that token there."""
        out: dict[tuple[int, str], set[int]] = {}
        for c in range(len(self.sizes)):
            for i, t in enumerate(self.template(c)):
                if t != PARAM:
                    out.setdefault((i, t), set()).add(c)
        return out

    def _line(self, toks: list[str]) -> list[int]:
        """A line's numbers; -1, which equals nothing, for a wildcard and for a token not seen yet."""
        if not self._numbers:
            self._numbers = [{} for _ in toks]
        return [at.get(t, -1) for at, t in zip(self._numbers, toks)]

    def _closest(self, line, near, need: int) -> tuple[int, int]:
        """(equal positions, cluster) of the best of the clusters ``near`` (None: all); cluster -1 if none has ``need``."""
        table = self._table[:len(self.sizes)] if near is None else self._table[near]
        same = (table == line).sum(axis=1)
        top = int(same.max(initial=-1))
        if top < need:
            return need, -1
        best = (same == top).nonzero()[0]
        cs = best.tolist() if near is None else near[best].tolist()
        return top, min(cs, key=lambda c: (-self.wild[c], c))

    def best(self, toks: list[str]) -> int:
        """The cluster of highest similarity, then of more wildcards, then the oldest; -1 if none is similar enough."""
        return self._best(self._line(toks))

    def _best(self, numbers: list[int]) -> int:
        n = len(numbers)
        if n == 0 or not self.sizes:
            return 0 if self.sizes else -1
        need = self.need(n)
        if need == 0 or self._posted is None:
            return self._closest(np.array(numbers, np.int32), None, need)[1]
        posted = self._posted
        held = [posted[w] for w in numbers if w > 0]
        if len(held) < need:
            return -1
        line = np.array(numbers, np.int32)
        single = [e for e in held if type(e) is int]
        lists = sorted([e for e in held if type(e) is not int], key=len)
        shortest = np.array(single[:1], np.int32) if single else np.frombuffer(lists[0], np.int32)
        found, at = self._closest(line, shortest, need)
        if at >= 0 and found == len(held):
            return at
        k = min(found, 3)
        most = len(held) - found + k
        near = np.array(single[:most], np.int32)
        if most > len(single):
            near = np.concatenate([near, *[np.frombuffer(e, np.int32) for e in lists[:most - len(single)]]])
        if k > 1:  # named k times
            near.sort()
            near = near[k - 1:][near[k - 1:] == near[:1 - k]]
        return self._closest(line, near, found)[1]

    def _post(self, c: int, numbers: list[int]) -> None:
        posted = self._posted
        for w in numbers:
            if w:
                held = posted[w]
                if type(held) is not int:
                    held.append(c)
                elif held < 0:
                    posted[w] = c
                else:
                    posted[w] = array("i", (held, c))

    def _open(self, toks: list[str], numbers: list[int], size: int, pos) -> int:
        c, n = len(self.sizes), len(toks)
        if self._table is None:
            self._table = np.empty((4, n), np.int32)
        elif c == len(self._table):
            grown = np.empty((c + c // 2 + 1, n), np.int32)
            grown[:c] = self._table
            self._table = grown
        if -1 in numbers:
            words, posted = self._words, self._posted
            for i, w in enumerate(numbers):
                if w < 0:
                    t = toks[i]
                    if t == PARAM:
                        numbers[i] = 0
                        continue
                    numbers[i] = self._numbers[i][t] = len(words)
                    words.append(self._known.setdefault(t, t))
                    if posted is not None:
                        posted.append(-1)
        self._table[c] = numbers
        self.wild.append(numbers.count(0))
        self.sizes.append(size)
        self.first.append(pos)
        if self._posted is not None:
            self._post(c, numbers)
        elif c + 1 > COMPARED:
            self._posted = [-1] * len(self._words)
            for old in range(c + 1):
                self._post(old, self._table[old].tolist())
        return c

    def _merge(self, c: int, numbers: list[int]) -> bool:
        """Positions where template and line differ become wildcards; says whether there were any."""
        row = self._table[c]
        other = (row != np.array(numbers, np.int32)) & (row != 0)
        changed = int(other.sum())
        if changed:
            row[other] = 0
            self.wild[c] += changed
        return changed > 0

    def again(self, pos, text: str, count: int = 1) -> bool:
        """Add a line that was added before, if no cluster was made or changed since: it joins its cluster unchanged."""
        c = self._settled.get(text, -1)
        if c < 0:
            return False
        self._advance(pos)
        self.sizes[c] += count
        return True

    def _advance(self, pos) -> None:
        if self.last_pos is not None and pos < self.last_pos:
            raise ValueError("rows of a leaf must arrive in position order")
        self.last_pos = pos

    def add(self, pos, toks: list[str], count: int = 1, text: str | None = None) -> tuple[str, int] | None:
        """Add a line (or a template that stands for ``count`` lines); the change it makes, if any, and its cluster."""
        self._advance(pos)
        if self.last_at >= 0 and toks == self.last:
            # a repeat of the previous line joins the same cluster unchanged
            self.sizes[self.last_at] += count
            return None
        numbers = self._line(toks)
        c = self._best(numbers)
        if c < 0:
            c, what = self._open(toks, numbers, count, pos), "cluster_created"
        else:
            self.sizes[c] += count
            what = "cluster_template_changed" if self._merge(c, numbers) else None
        plain = PARAM not in toks
        # a template with wildcards is no line: its repeat is scored anew
        self.last, self.last_at = list(toks), c if plain else -1
        if self._settled and (what or len(self._settled) >= _SETTLED):
            self._settled.clear()
        if plain and text is not None:
            self._settled[text] = c
        return (what, c) if what else None

    def restore(self, template: list[str], size: int, pos) -> None:
        """Take over a finished cluster as it is."""
        self._open(template, self._line(template), size, pos)

    def rows(self) -> Iterator[tuple]:
        """(local id from 1, first position, template, size) of every cluster."""
        for c, (size, pos) in enumerate(zip(self.sizes, self.first)):
            yield c + 1, pos, self.template(c), size


# A token list as one text while it is shuffled and written: a third of the bytes. Tokens are cut at blanks, so none holds one.
GLUE = " "


def _glued(tokens: str | Column) -> Column:
    return F.array_join(tokens, GLUE)


def _unglued(text: str, n_tokens: str = "n_tokens") -> Column:
    return F.when(F.col(n_tokens) == 0, F.array().cast("array<string>")).otherwise(F.split(text, GLUE))


def _cut(n: int, text: str) -> list[str]:
    return text.split(GLUE) if n else []


# What the clustering stream reads, sorted by all but the last three. ``take`` rows are clusters
# to be taken over, the others are lines (or templates) to be added; ``text`` is the glued token list.
_STREAM = ["n_tokens", "leaf_token", "piece", "take", "pos", "local_id", "text", "size", "fresh"]
_FOUND_SCHEMA = MINE_SCHEMA.replace("template array<string>", "text string")
_SLICE = 1024  # rows of a batch that are Python objects at a time


def _slices(b) -> Iterator:
    for i in range(0, b.num_rows, _SLICE):
        yield b.slice(i, _SLICE)


def _runs(batches, collapse: bool) -> Iterator[tuple]:
    """The rows of ``_STREAM``; with ``collapse`` consecutive repeats of a line as one row with their number: they
    join the cluster of the first unchanged. A run goes on from batch to batch."""
    import pyarrow as pa
    import pyarrow.compute as pc
    held = None
    for b in (part for whole in batches for part in _slices(whole)):
        if not b.num_rows:
            continue
        cols, size = [b.column(c) for c in _STREAM], b.column("size").to_numpy(zero_copy_only=False)
        at, of = np.arange(b.num_rows), _STREAM.index
        if collapse and b.num_rows > 1:
            same = np.ones(b.num_rows - 1, bool)
            for c in ("n_tokens", "leaf_token", "piece", "take", "text"):
                now, before = cols[of(c)].slice(1), cols[of(c)].slice(0, b.num_rows - 1)
                both = pc.or_kleene(pc.equal(now, before), pc.and_(pc.is_null(now), pc.is_null(before)))
                same &= pc.fill_null(both, False).to_numpy(zero_copy_only=False)
            same &= cols[of("take")].to_numpy(zero_copy_only=False)[1:] == 1
            at = np.flatnonzero(np.concatenate([[True], ~same]))
            size = np.add.reduceat(size, at)
        heads = pa.array(at)
        lists = [size.tolist() if c == "size" else col.take(heads).to_pylist() for c, col in zip(_STREAM, cols)]
        for row in zip(*lists):
            if held is not None:
                if collapse and row[3] == held[3] == 1 and row[6] == held[6] and row[:3] == held[:3]:
                    held = (*held[:7], held[7] + row[7], held[8])
                    continue
                yield held
            held = row
    if held is not None:
        yield held


def _cluster_stream(sim_th: float, level: int, feed: bool = True):
    """mapInArrow function: one catalogue per (leaf, piece), and with ``feed`` the changes made by ``fresh`` rows."""
    import pyarrow as pa
    kinds = [pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.decimal128(38, 0), pa.string(),
             pa.string(), pa.int64()]
    names = [c.split()[0] for c in _FOUND_SCHEMA.replace("decimal(38,0)", "decimal").split(", ")]

    def batch(out: list[tuple]):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    def run(batches):
        key, clusters, done, out = None, None, set(), []

        def flush():
            for i, pos, tpl, size in clusters.rows():
                yield "piece", key[0], key[1], level, key[2], i, pos, None, GLUE.join(tpl), size

        for n, leaf, piece, take, pos, _, text, size, fresh in _runs(batches, level == 0):
            if (n, leaf, piece) != key:
                if key is not None:
                    for row in flush():
                        out.append(row)
                        if len(out) >= _SLICE:
                            yield batch(out)
                            out = []
                key, clusters = (n, leaf, piece), LeafClusters(sim_th)
                if key in done:
                    raise ValueError(f"rows of leaf {key} are not contiguous in the partition")
                done.add(key)
            if take == 0:
                clusters.restore(_cut(n, text), size, pos)
                continue
            if clusters.again(pos, text, size):
                continue
            change = clusters.add(pos, _cut(n, text), size, text)
            if feed and change is not None and fresh:
                what, c = change
                out.append(("change", n, leaf, level, piece, c + 1, pos, what, GLUE.join(clusters.template(c)), clusters.sizes[c]))
                if len(out) >= _SLICE:
                    yield batch(out)
                    out = []
        if key is not None:
            for row in flush():
                out.append(row)
                if len(out) >= _SLICE:
                    yield batch(out)
                    out = []
        if out:
            yield batch(out)

    return run


def _leaf_equal(a: DataFrame, b: DataFrame) -> Column:
    return (a["n_tokens"] == b["n_tokens"]) & a["leaf_token"].eqNullSafe(b["leaf_token"])


_PIECE = ["n_tokens", "leaf_token", "piece"]


# Python tasks for each shuffle partition: leaves are of unlike size, and the work is in their lines, not their bytes.
_TASKS = 2


def _dealt(rows: DataFrame, *place: str) -> DataFrame:
    """Rows of a place in one task; so many tasks that adaptive execution, which goes by bytes, does not join any."""
    return rows.repartition(_TASKS * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *place)


def _sorted_stream(rows: DataFrame) -> DataFrame:
    return _dealt(rows.select(*_STREAM), *_PIECE).sortWithinPartitions(*_PIECE, "take", "pos", "local_id")


def _levels(sizes: DataFrame, chunk_rows: int, fan: int) -> int:
    """Rounds of merging that the largest leaf needs."""
    most = sizes.agg(F.max(F.col("before") + F.col("added"))).first()[0] or 0
    pieces, level = -(-most // chunk_rows), 0
    while pieces > 1:
        pieces, level = -(-pieces // fan), level + 1
    return level


def _into_chunks(keyed: DataFrame, sizes: DataFrame, chunk_rows: int, levels: int) -> DataFrame:
    """``piece``: which chunk of its leaf a line is in. Leaves of one chunk need no numbering.

    Of the larger leaves only the positions are sorted and numbered. The first
    position of every chunk (a row per ``chunk_rows`` lines) says of each line
    how many chunks of its leaf begin before it, so no text is moved here.
    """
    rows = keyed.select("n_tokens", "leaf_token", F.col("pos").cast("decimal(38,0)").alias("pos"), "tokens")
    if levels == 0:
        return rows.withColumn("piece", F.lit(0).cast("long"))
    big = F.broadcast(sizes.where(F.col("before") + F.col("added") > chunk_rows))
    places = rows.join(big, _leaf_equal(rows, big), "left_semi").select("n_tokens", "leaf_token", "pos")
    numbered = dense_index(places, ["pos"], out="seq", groups=["n_tokens", "leaf_token"])
    numbered = numbered.join(big, _leaf_equal(numbered, big)).select(numbered["*"], big["before"])
    begins = numbered.where((F.col("before") + F.col("seq") - 1) % chunk_rows == 0)
    begins = begins.groupBy("n_tokens", "leaf_token").agg(F.collect_list(F.struct("pos")).alias("_starts"))
    leaves = big.join(begins, _leaf_equal(big, begins), "left").select(
        big["n_tokens"], big["leaf_token"], F.ceil(big["before"] / chunk_rows).cast("long").alias("_open"), "_starts")
    leaves = F.broadcast(leaves)  # a number for each chunk
    placed = rows.join(leaves, _leaf_equal(rows, leaves), "left").select(rows["*"], "_open", "_starts")
    passed = F.size(F.filter("_starts", lambda s: F.coalesce(s["pos"] <= F.col("pos"), s["pos"].isNull())))
    piece = F.greatest(F.col("_open") - 1 + F.coalesce(F.when(F.col("_starts").isNotNull(), passed), F.lit(0)), F.lit(0))
    return placed.withColumn("piece", F.coalesce(piece, F.lit(0)).cast("long")).drop("_open", "_starts")


def mine(keyed: DataFrame, sim_th: float = SIM_TH, state: DataFrame | None = None, chunk_rows: int | None = None,
         fan: int = FAN, feed: bool = True) -> DataFrame:
    """Clustering of every leaf.

    ``keyed`` has ``n_tokens, leaf_token, pos, tokens``. The lines of a leaf,
    however many, are added one after another in position order, as a sequential
    miner does; the leaves run beside each other. The result depends on the lines
    and their positions only, never on sizes or partitions.

    Only a caller who names ``chunk_rows`` gets another rule, for leaves of any
    size: the lines of a leaf, in position order, are cut into chunks of so many;
    each chunk is clustered line by line from nothing. The catalogues of ``fan``
    consecutive chunks are merged: the first is taken as it is, the clusters of
    the next ones are added in order, each like a line (its wildcards equal
    nothing) with the weight of its lines. Merged catalogues are merged again the
    same way until one is left. No query asks for it.

    Returns rows by ``kind``: ``cluster`` (the final catalogue), ``change``
    (lines that made or changed a cluster; of a leaf of several chunks, the
    first lines of the clusters that did so in the last merge), and the state
    to go on from, ``leaf`` (``size`` lines so far) and ``open`` (catalogues
    that later lines can still change or be merged with). With ``state`` (these
    two kinds of an earlier result, by the same rule) mining goes on as if the
    lines of ``keyed`` had followed the earlier ones; only what they change is
    reported. Without ``feed`` there are no ``change`` rows, for callers that read none.
    """
    from logweave.session import materialize
    leaf = ["n_tokens", "leaf_token"]
    spark = keyed.sparkSession
    zero = F.lit(0).cast("long")
    sizes = keyed.groupBy(*leaf).agg(F.count(F.lit(1)).alias("added")).withColumn("before", zero)
    if state is not None:
        old = state.where("kind = 'leaf'").select(*leaf, zero.alias("added"), F.col("size").alias("before"))
        sizes = sizes.unionByName(old).groupBy(*leaf).agg(F.sum("added").alias("added"), F.sum("before").alias("before"))
    # a row per leaf: at most max_children a line length, and lines of so many lengths hold half the square of
    # that number of tokens, so it goes to every task instead of the lines to it
    sizes = F.broadcast(materialize(sizes, "leaf-sizes"))
    if chunk_rows is None:
        if state is not None and not state.where("kind = 'open' and (level > 0 or piece > 0)").isEmpty():
            raise ValueError("the stored miner cut a leaf into chunks; the lines that made them must be mined anew")
        chunk_rows, levels = _WHOLE, 0
    else:
        levels = _levels(sizes, chunk_rows, fan)

    lines = _into_chunks(keyed, sizes, chunk_rows, levels).select(
        *_PIECE, F.lit(1).alias("take"), "pos", F.lit(0).alias("local_id"), _glued("tokens").alias("text"), F.lit(1).cast("long").alias("size"),
        F.lit(True).alias("fresh"))

    def stored(level: int, complete: bool) -> DataFrame:
        """Catalogues of the state at a level: those no line can change any more, or the one that is open."""
        unit = chunk_rows * fan ** level
        kept = state.where((F.col("kind") == "open") & (F.col("level") == level)).withColumn("text", _glued("template")).drop("template")
        kept = kept.join(sizes, _leaf_equal(kept, sizes)).select(kept["*"], sizes["before"])
        is_open = F.col("piece") >= F.expr(f"before div {unit}")
        return kept.where(~is_open if complete else is_open)

    if state is not None:
        taken = stored(0, False).select(*leaf, "piece", F.lit(0).alias("take"), "pos", "local_id", "text",
                                        "size", F.lit(False).alias("fresh"))
        lines = lines.unionByName(taken)
    found = [materialize(_sorted_stream(lines).mapInArrow(_cluster_stream(sim_th, 0, feed), _FOUND_SCHEMA), "mined-pieces")]
    for level in range(levels + 1):
        pieces = found[-1].where("kind = 'piece'")
        if state is not None:
            pieces = pieces.unionByName(stored(level, True).select(*pieces.columns))
            found[-1] = found[-1].where("kind = 'change'").unionByName(pieces)
        if level == levels:
            break
        unit = chunk_rows * fan ** level
        bounded = pieces.join(sizes, _leaf_equal(pieces, sizes)).where(F.col("before") + F.col("added") > unit)
        rows = bounded.select(
            pieces["n_tokens"], pieces["leaf_token"], F.expr(f"piece div {fan}").alias("piece"),
            F.when(F.col("piece") % fan == 0, 0).otherwise(1).alias("take"), "pos", "local_id", "text",
            pieces["size"], (F.col("piece") >= F.expr(f"before div {unit}")).alias("fresh"))
        found.append(materialize(_sorted_stream(rows).mapInArrow(_cluster_stream(sim_th, level + 1, feed), _FOUND_SCHEMA), "merged-pieces"))

    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    every = every.withColumn("template", _unglued("text")).drop("text")
    if levels == 0 and state is None:  # one chunk a leaf: its only catalogue is final, and open
        place = every
        final = F.lit(True)
        is_open = F.lit(True)
    else:
        place = every.join(sizes, _leaf_equal(every, sizes)).select(every["*"], (F.col("before") + F.col("added")).alias("_total"))
        units = [chunk_rows * fan ** i for i in range(levels + 1)]
        top = sum((F.when(F.col("_total") > u, 1).otherwise(0) for u in units), F.lit(0))
        final = F.col("level") == top
        complete = F.expr("case level " + " ".join(f"when {i} then _total div {u}" for i, u in enumerate(units)) + " end")
        is_open = F.floor(F.col("piece") / fan) == F.floor(complete / fan)
    cols = [c.split()[0] for c in MINE_SCHEMA.replace("decimal(38,0)", "decimal").split(", ")]
    is_piece = F.col("kind") == "piece"
    clusters = place.where(final).withColumn("kind", F.when(is_piece, "cluster").otherwise(F.col("kind"))).select(*cols)
    opened = place.where(is_piece & is_open).withColumn("kind", F.lit("open")).select(*cols)
    empty = spark.createDataFrame([], MINE_SCHEMA)
    counted = sizes.select(F.lit("leaf").alias("kind"), *leaf, (F.col("before") + F.col("added")).alias("size"))
    return clusters.unionByName(opened).unionByName(empty.unionByName(counted, allowMissingColumns=True))


def catalogue(mined: DataFrame) -> DataFrame:
    """``(cluster_id, n_tokens, leaf_token, template, tokens, size, first_pos)``.

    Cluster ids follow creation order over the whole input (first line of
    each cluster), as a sequential miner would number them.
    """
    cl = mined.where(F.col("kind") == "cluster").select(
        "n_tokens", "leaf_token", "local_id", F.col("pos").alias("first_pos"), _glued("template").alias("template"), "size")
    ided = dense_index(cl, ["first_pos"], out="cluster_id")
    return ided.select(F.col("cluster_id").cast("int").alias("cluster_id"), "n_tokens", "leaf_token", "local_id",
                       "template", _unglued("template").alias("tokens"), "size", "first_pos")


def changes(mined: DataFrame, cat: DataFrame) -> DataFrame:
    """Change feed ``(pos, change_type, cluster_id, template)``."""
    ch = mined.where(F.col("kind") == "change")
    ids = cat.select("n_tokens", "leaf_token", "local_id", "cluster_id")
    return (ch.join(ids, [ch.n_tokens == ids.n_tokens, ch.leaf_token.eqNullSafe(ids.leaf_token),
                          ch.local_id == ids.local_id])
            .select(ch.pos, "change_type", "cluster_id", F.array_join(ch.template, " ").alias("template")))


def match_join(keyed: DataFrame, cat: DataFrame) -> DataFrame:
    """T7 as a join (declarative form; ``match`` is the fast path with the same result).

    A template matches when every non-wildcard position equals the line's
    token. Among matches the one with more wildcards wins, then the older
    one. The per-leaf template lists are one row per leaf, so this form is for
    small catalogues.
    Adds ``EventId`` (null when unmatched), ``EventTemplate``, ``param``
    (template tokens, empty when unmatched) and ``match`` (1/0).
    """
    per_leaf = (cat.select("n_tokens", "leaf_token",
                           F.struct(F.size(F.filter("tokens", lambda t: t == F.lit(PARAM))).alias("params"),
                                    (-F.col("cluster_id")).alias("neg_id"),
                                    F.col("cluster_id"), F.col("tokens"), F.col("template")).alias("c"))
                .groupBy(F.col("n_tokens").alias("_mn"), F.col("leaf_token").alias("_ml"))
                .agg(F.sort_array(F.collect_list("c"), asc=False).alias("_cands")))
    j = keyed.join(per_leaf, (keyed.n_tokens == per_leaf._mn) & keyed.leaf_token.eqNullSafe(per_leaf._ml), "left")
    line_toks = F.col("tokens")
    hits = F.filter(F.coalesce(F.col("_cands"), F.array()),
                    lambda c: F.forall(F.arrays_zip(c["tokens"].alias("a"), line_toks.alias("b")),
                                       lambda z: (z["a"] == F.lit(PARAM)) | (z["a"] == z["b"])))
    best = F.try_element_at(hits, F.lit(1))
    return (j.withColumn("_best", best)
            .withColumn("EventId", F.col("_best.cluster_id"))
            .withColumn("EventTemplate", F.col("_best.template"))
            .withColumn("param", F.coalesce(F.col("_best.tokens"), F.array().cast("array<string>")))
            .withColumn("match", F.when(F.col("_best").isNotNull(), 1).otherwise(0))
            .drop("_mn", "_ml", "_cands", "_best"))


def template_values(tokens: Column, template: Column) -> Column:
    """The line's tokens at the template's wildcard positions."""
    z = F.arrays_zip(template.alias("t"), tokens.alias("v"))
    return F.transform(F.filter(z, lambda e: e["t"] == F.lit(PARAM)), lambda e: e["v"])


def position_templates(keyed: DataFrame) -> DataFrame:
    """T5 (SQL form): per leaf and position, keep the token if it is the only
    one seen there, else a wildcard. One row per leaf with its template."""
    ex = keyed.select("n_tokens", "leaf_token", F.posexplode("tokens").alias("i", "tok"))
    per_pos = ex.groupBy("n_tokens", "leaf_token", "i").agg(
        F.count_distinct("tok").alias("_nd"), F.min("tok").alias("_t"))
    per_pos = per_pos.withColumn("tok", F.when(F.col("_nd") == 1, F.col("_t")).otherwise(F.lit(PARAM)))
    # one entry per token position: bounded by the line length
    return (per_pos.groupBy("n_tokens", "leaf_token")
            .agg(F.sort_array(F.collect_list(F.struct("i", "tok"))).alias("_p"))
            .select("n_tokens", "leaf_token", F.array_join(F.transform("_p", lambda s: s["tok"]), " ")
                    .alias("template")))


# Lines of a leaf that one task matches at least (a leaf with more templates: as many).
SHAPES_PER_TASK = 1024
BUCKET = 8


class TemplateTree:
    """The templates of one leaf: those without wildcards by their text, the others in a discrimination tree.

    An inner node tests one position: a child per token and one for the
    wildcard. A line follows two children at most, and a branch whose best
    template (more wildcards, then older) is no better than the best found is
    skipped. Up to ``BUCKET`` templates are compared one by one.
    """

    def __init__(self, templates: list[tuple[int, int, list[str]]] = ()):
        """``templates``: (minus wildcards, id, tokens)."""
        self.exact: dict[str, int] = {}
        self.wild: list[tuple[int, int, list[str]]] = []
        self.root: dict | None = None
        self._known: dict[str, str] = {}
        for wild, cid, toks in templates:
            self.hold(wild, cid, toks, GLUE.join(toks))

    def hold(self, wild: int, cid: int, toks: list[str], text: str) -> None:
        """Add a template; all come before the first ``find``."""
        if wild == 0:
            self.exact[text] = min(cid, self.exact.get(text, cid))
        else:
            self.wild.append((wild, cid, [self._known.setdefault(t, t) for t in toks]))

    def _build(self) -> None:
        self.root = self._node(sorted(self.wild, key=lambda r: r[:2]), 0)
        todo = [self.root]
        while todo:
            node = todo.pop()
            rows, at = node["rows"], node["at"]
            if len(rows) <= BUCKET or at >= len(rows[0][2]):
                continue
            split: dict[str, list] = {}
            for r in rows:
                split.setdefault(r[2][at], []).append(r)
            node["next"] = {t: self._node(part, at + 1) for t, part in split.items()}
            node["rows"] = None
            todo += node["next"].values()

    @staticmethod
    def _node(rows: list, at: int) -> dict:
        return {"rows": rows, "at": at, "best": rows[0][:2] if rows else None, "next": None}

    def find(self, toks: list[str], text: str | None = None) -> int | None:
        """Id of the matching template with the most wildcards, the oldest of them."""
        if self.root is None:
            self._build()
        best, todo = None, [self.root]
        while todo:
            node = todo.pop()
            if node["best"] is None or (best is not None and node["best"] >= best):
                continue
            if node["rows"] is None:
                nxt, t = node["next"], toks[node["at"]]
                if t != PARAM and t in nxt:
                    todo.append(nxt[t])
                if PARAM in nxt:  # looked at first: more wildcards
                    todo.append(nxt[PARAM])
                continue
            for wild, cid, tpl in node["rows"]:
                if best is not None and (wild, cid) >= best:
                    break
                if all([a == PARAM or a == b for a, b in zip(tpl, toks)]):
                    best = (wild, cid)
                    break
        if best is None:
            return self.exact.get(GLUE.join(toks) if text is None else text)
        return best[1]


def _match_stream(carry: list[str]):
    """mapInArrow function over rows sorted by (leaf, salt, kind): a leaf's templates (kind 0), then its
    lines (kind 1). Each line gets the id and the text of its template."""
    import pyarrow as pa

    def run(batches):
        key, tree, texts, open_, done = None, None, {}, True, set()
        for b in (part for whole in batches for part in _slices(whole)):
            ids, said, keep = [], [], []
            cols = (b.column(c).to_pylist() for c in ("n_tokens", "leaf_token", "_salt", "_kind", "_o1", "_cid", "_text"))
            for idx, (n, leaf, salt, kind, wild, cid, text) in enumerate(zip(*cols)):
                if (n, leaf, salt) != key:
                    key, tree, texts, open_ = (n, leaf, salt), TemplateTree(), {}, True
                    if key in done:
                        raise ValueError(f"rows of leaf {key} are not contiguous in the partition")
                    done.add(key)
                if kind == 0:
                    if not open_:
                        raise ValueError("templates of a leaf must precede its lines")
                    tree.hold(wild, cid, _cut(n, text) if wild else [], text)
                    if wild:
                        texts[cid] = text
                    continue
                open_ = False
                at = None if text is None else tree.find(_cut(n, text), text)
                keep.append(idx)
                ids.append(at)
                said.append(None if at is None else texts.get(at, text))
            if keep:
                part = b.take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in carry] + [pa.array(ids, pa.int32()), pa.array(said, pa.string())],
                                                 names=[*carry, "EventId", "EventTemplate"])

    return run


def _sorted_match_input(lines: DataFrame, cat: DataFrame, carry: list[str]) -> DataFrame:
    """Lines and templates of a leaf and salt in one partition: templates first, then the lines.

    A leaf's lines are dealt over several tasks where it has more than twice
    ``SHAPES_PER_TASK`` and than templates, so the copies of its templates are
    never more than its lines. Templates of a leaf without lines stay away.
    """
    leaf = ["n_tokens", "leaf_token"]
    if "_text" not in lines.columns:
        lines = lines.withColumn("_text", _glued("tokens"))
    many = lines.groupBy(*leaf).agg(F.count(F.lit(1)).alias("_lines"))
    held = cat.groupBy(*leaf).agg(F.count(F.lit(1)).alias("_templates"))
    share = F.greatest(F.lit(SHAPES_PER_TASK), "_templates")
    # a row per leaf, see ``mine``
    dealt = F.broadcast(many.join(held, _leaf_equal(many, held)).select(
        many["n_tokens"], many["leaf_token"], F.greatest(F.floor(F.col("_lines") / share).cast("int"), F.lit(1)).alias("_salts")))

    def salts(df: DataFrame, how: str) -> DataFrame:
        return df.join(dealt, _leaf_equal(df, dealt), how).select(df["*"], F.coalesce("_salts", F.lit(1)).alias("_salts"))

    params = F.size(F.filter("tokens", lambda t: t == F.lit(PARAM)))
    templates = salts(cat.select(*leaf, F.col("template").alias("_text"), (-params).cast("long").alias("_o1"), "cluster_id"), "inner")
    templates = templates.withColumn("_salt", F.explode(F.expr("sequence(0, _salts - 1)"))).select(
        *leaf, "_salt", "_text", F.lit(0).alias("_kind"), "_o1", F.col("cluster_id").alias("_cid"))
    # by the whole row: copies of a line are dealt like other lines
    rows = salts(lines, "left").withColumn("_salt", F.pmod(F.xxhash64(*lines.columns), F.col("_salts")).cast("int")).select(
        *dict.fromkeys(carry + leaf + ["_salt", "_text"]), F.lit(1).alias("_kind"), F.lit(0).cast("long").alias("_o1"),
        F.lit(None).cast("int").alias("_cid"))
    place = [*leaf, "_salt"]
    return (rows.unionByName(templates, allowMissingColumns=True).repartition(*place)
            .sortWithinPartitions(*place, "_kind"))


def match(keyed: DataFrame, cat: DataFrame) -> DataFrame:
    """Match each line to a finished template of its leaf, no new clusters.

    A template matches when every non-wildcard position equals the line's
    token; among matches the one with more wildcards wins, then the older one.
    Lines and templates meet once, by leaf, and each line runs through the
    ``TemplateTree`` of its leaf.

    ``keyed`` must be routed by the own-leaf table of the mined lines. Adds
    ``EventId`` (null when unmatched), ``EventTemplate``, ``param`` (template
    tokens, empty when unmatched) and ``match`` (1/0).
    """
    carry = [c for c in keyed.columns if c != "tokens"] + ["_text"]
    lines = keyed.withColumn("_text", _glued("tokens")).drop("tokens").select(*carry)
    both = _sorted_match_input(lines, cat, carry)
    schema = lines.schema.add("EventId", "integer").add("EventTemplate", "string")
    found = both.select(*dict.fromkeys([*carry, "n_tokens", "leaf_token", "_salt", "_kind", "_o1", "_cid", "_text"])).mapInArrow(
        _match_stream(carry), schema)
    found = found.withColumn("tokens", _unglued("_text")).withColumn("match", F.when(F.col("EventId").isNotNull(), 1).otherwise(0))
    param = F.when(F.col("EventId").isNull(), F.array().cast("array<string>")).otherwise(_unglued("EventTemplate"))
    return found.select(*keyed.columns, "EventId", "EventTemplate", param.alias("param"), "match")
