"""Conversation prefix trie by truncation peeling.

A conversation is a path of turns; its prefixes are the nodes of a trie. The trie is
never held anywhere: from the deepest level on, each round takes the nodes that
survive from the level below, strips their last turn, merges them with the
conversations that enter at this level, regroups by what is left and so finds the
level's nodes with all their aggregates (members, children, leaves, savings). A round
is one aggregation with partial sums, so a node that a third of all conversations
share is no burden to a task, and its result is written before the next round reads it.

What makes rounds few and rows small:

* A prefix is known by a 128-bit digest chained over blocks of ``BLOCK`` turns (each
  block starts from the digest of the blocks before it, then each turn adds to it). A
  row carries the digests of one block at most; at a block's start the next ones are
  fetched by a join.
* A conversation enters at the depth of its first turn that no other shares: what lies
  below is a chain of nodes with one member, and needs no regrouping. Rounds are as many
  as the deepest shared prefix has turns, whatever the longest conversation has.

Children find their parent's ``conv_id`` by a join on the parent's digest; parents with
over 1 / ``HOT`` of all nodes as children (at most ``HOT`` of them) by broadcast. The
ids that end at a node are hashed in order from sorted pieces of ``PIECE`` ids, read as a
stream. A conversation of very many turns is numbered by a global sort, not in a window.

Defined results: rows with a null conv_id are left out. Turns of equal number come in the
order of a digest of (role, text); rows that repeat are turns that repeat. Null role or
text is the empty string. An empty table has no nodes, not even a root. Extra columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm.common import materialize
from logweave.operators.order import dense_index
from logweave.session import scratch_path

GRAFT = 20       # conversations c - c % GRAFT lend their first turns
MAX_HEAD = 3     # at most so many turns are lent
BLOCK = 64       # turns a row carries at most
SALT = 1 << 16   # rows of one conversation that meet one copy of its numbers
PIECE = 8192     # ids in one piece of a node's list of ends
HOT = 4096
_BLANK = r"[\x20\x09-\x0D]+"
_TRIM = " \t\n\x0b\x0c\r"
_ROOT = b"\0" * 16
_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _digest(*parts: bytes) -> bytes:
    return hashlib.blake2b(b"".join(parts), digest_size=16).digest()


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq from 1, mark, words) of the original turns."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    stripped = F.btrim(text, F.lit(_TRIM))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)).alias("mark"),
        F.when(stripped == "", F.lit(0)).otherwise(F.size(F.split(stripped, _BLANK))).cast("long").alias("words"))
    return dense_index(rows, ["turn", "mark"], groups=["conv_id"], keep=["mark", "words"])


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, d, mark, words) and conversations (conv_id, len)."""
    lent = (turns.filter((F.col("conv_id") % GRAFT == 0) & (F.col("seq") <= MAX_HEAD)).groupBy(F.col("conv_id").alias("base"))
            .agg(F.sort_array(F.collect_list(F.struct("seq", "mark", "words"))).alias("head")))  # MAX_HEAD at most
    h = (F.crc32(F.col("conv_id").cast("string")) % (MAX_HEAD + 1)).cast("int")
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own")).withColumn("h", h).withColumn(
        "base", F.col("conv_id") - F.col("conv_id") % GRAFT)
    head = F.slice(F.coalesce(F.col("head"), F.expr("cast(array() as array<struct<seq:bigint,mark:binary,words:bigint>>)")), F.lit(1), F.col("h"))
    convs = convs.join(lent, "base", "left").withColumn("head", head).withColumn("k", F.size("head"))
    convs = materialize(convs.select("conv_id", "own", "h", "k", "head",
                                     (F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("len")), "trie-convs")
    numbers = convs.select("conv_id", "h", "k", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"own div {SALT}"))).alias("salt"))
    own = (turns.withColumn("salt", F.expr(f"seq div {SALT}")).join(numbers, ["conv_id", "salt"]).filter("seq > h")
           .select("conv_id", (F.col("seq") - F.col("h") + F.col("k")).alias("d"), "mark", "words"))
    heads = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", F.col("t.seq").alias("d"), "t.mark", "t.words")
    return own.unionByName(heads), convs.select("conv_id", "len")


def _block_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("block"), pa.array(
            [_digest(*m) for m in b.column("marks").to_pylist()], pa.binary())], names=["conv_id", "block", "hash"])


def _block_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by (conv_id, block): the digest of all blocks before each."""
    conv, now = None, _ROOT
    for b in batches:
        starts = []
        for c, h in zip(b.column("conv_id").to_pylist(), b.column("hash").to_pylist()):
            if c != conv:
                conv, now = c, _ROOT
            starts.append(now)
            now = _digest(b"block", now, h)
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("block"), pa.array(starts, pa.binary())],
                                         names=["conv_id", "block", "start"])


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys = []
        for start, marks in zip(b.column("start").to_pylist(), b.column("marks").to_pylist()):
            now, out = start or _ROOT, []
            for m in marks:
                now = _digest(now, m)
                out.append(now)
            keys.append(out)
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("block"), pa.array(keys, pa.list_(pa.binary())), b.column("words")],
                                         names=["conv_id", "block", "keys", "words"])


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, block, keys, words): the prefix digests and word counts of each block of turns."""
    cut = (turns.withColumn("block", F.expr(f"(d - 1) div {BLOCK}")).groupBy("conv_id", "block")
           .agg(F.sort_array(F.collect_list(F.struct("d", "mark", "words"))).alias("t"))  # BLOCK at most
           .select("conv_id", "block", F.col("t.mark").alias("marks"), F.col("t.words").alias("words")))
    cut = materialize(cut, "trie-blocks")
    long = cut.filter("block > 0").select("conv_id").distinct()
    hashes = cut.join(long, "conv_id", "left_semi").select("conv_id", "block", "marks").mapInArrow(
        _block_hashes, "conv_id long, block long, hash binary")
    starts = hashes.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(
        _block_starts, "conv_id long, block long, start binary")
    return materialize(cut.join(starts, ["conv_id", "block"], "left").select("conv_id", "block", "start", "marks", "words").mapInArrow(
        _chain, "conv_id long, block long, keys array<binary>, words array<long>"), "trie-paths")


def _entrants(path: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, len, e, keys, words): each conversation at the depth ``e`` of its first turn of its own (or its end)."""
    each = path.select("conv_id", F.col("block") * BLOCK, F.posexplode("keys")).toDF("conv_id", "before", "at", "key")
    own = (each.groupBy("key").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.min(F.expr("before + at + 1")).alias("d"))
           .filter("n = 1").groupBy("conv_id").agg(F.min("d").alias("d")))
    entry = (convs.join(own, "conv_id", "left").select("conv_id", "len", F.least(F.coalesce("d", "len"), "len").cast("long").alias("e"))
             .withColumn("block", F.expr(f"(e - 1) div {BLOCK}")))
    n = F.expr(f"cast((e - 1) % {BLOCK} + 1 as int)")
    here = F.when(F.col("e") > 0, F.slice("keys", F.lit(1), n))
    return materialize(entry.join(path, ["conv_id", "block"], "left").select(
        "conv_id", "len", "e", here.alias("keys"), F.when(F.col("e") > 0, F.slice("words", F.lit(1), n)).alias("words")), "trie-entrants")


def _last(c: str):
    return F.element_at(c, -1)


def _peel(entrants: DataFrame, path: DataFrame, base: str) -> None:
    """The rounds: nodes of depth d are written to ``base``/depth=d, from the deepest entry to the root."""
    spark = entrants.sparkSession
    deepest = entrants.agg(F.max("e")).first()[0]
    below = None
    for d in range(deepest, -1, -1):
        more = F.col("len") > d
        rows = entrants.filter(F.col("e") == d).select(
            "keys", "words", "conv_id", F.lit(1).cast("long").alias("n"), more.cast("long").alias("children"),
            more.cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))
        if below is not None:  # the last turn was stripped when the level was written
            rows = rows.unionByName(below.select(
                F.col("up_keys").alias("keys"), F.col("up_words").alias("words"), "conv_id", F.col("n_convs").alias("n"),
                F.lit(1).cast("long").alias("children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")))
        key = _last("keys") if d else F.lit(_ROOT)
        node = (rows.groupBy(key.alias("key")).agg(
            F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.sum("children").alias("n_children"),
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.first("keys").alias("keys"), F.first("words").alias("words")))
        spent = (F.col("n_convs") - 1) * _last("words") if d else F.lit(0)
        node = node.select("key", "conv_id", "n_convs", "n_children", "keys", "words",
                           F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("leaves")).cast("long").alias("n_leaves"),
                           (F.col("saved") + spent).cast("long").alias("saved_tokens"))
        if d > 1 and d % BLOCK == 1:
            block = path.filter(F.col("block") == (d - 2) // BLOCK).select("conv_id", F.col("keys").alias("up_keys"), F.col("words").alias("up_words"))
            node = node.join(block, "conv_id")
        else:
            cut = F.greatest(F.size("keys") - 1, F.lit(0))
            node = node.withColumns({"up_keys": F.slice("keys", F.lit(1), cut), "up_words": F.slice("words", F.lit(1), cut)})
        node.select("key", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "up_keys", "up_words").write.parquet(f"{base}/depth={d}")
        below = spark.read.parquet(f"{base}/depth={d}")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by (key, conv_id): runs of at most ``PIECE`` ids of one key as text."""
    key, ids = None, []

    def flush():
        return pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "first": pa.array([ids[0]], pa.int64()),
                                           "ids": pa.array([",".join(map(str, ids))], pa.string())})
    for b in batches:
        for k, c in zip(b.column("key").to_pylist(), b.column("conv_id").to_pylist()):
            if ids and (k != key or len(ids) >= PIECE):
                yield flush()
                ids = []
            key = k
            ids.append(c)
    if ids:
        yield flush()


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by (key, first): SHA-256 of each key's ids, comma-joined."""
    key, state = None, None

    def row():
        return pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "ends": pa.array([state.hexdigest()], pa.string())})
    for b in batches:
        for k, ids in zip(b.column("key").to_pylist(), b.column("ids").to_pylist()):
            if state is not None and k == key:
                state.update(b",")
            else:
                if state is not None:
                    yield row()
                key, state = k, hashlib.sha256()
            state.update(ids.encode())
    if state is not None:
        yield row()


def _ends(entrants: DataFrame) -> DataFrame:
    """(key, ends) for the nodes of the rounds at which a conversation ends."""
    ended = entrants.filter("e = len").select(F.coalesce(F.try_element_at("keys", F.lit(-1)), F.lit(_ROOT)).alias("key"), "conv_id")
    pieces = ended.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(
        _pieces, "key binary, first long, ids string")
    return pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hash_pieces, "key binary, ends string")


def _tails(entrants: DataFrame) -> DataFrame:
    """The chains of nodes with one member below each entry."""
    rows = entrants.filter("len > e").select("conv_id", "e", "len", F.explode(F.expr(
        f"sequence(e div {BLOCK}, (len - 1) div {BLOCK})")).alias("block"))
    rows = rows.withColumn("depth", F.explode(F.expr(f"sequence(greatest(e, block * {BLOCK}) + 1, least(len, (block + 1) * {BLOCK}))")))
    one = F.lit(1).cast("long")
    last = F.col("depth") == F.col("len")
    return rows.select("conv_id", F.col("depth").cast("long").alias("depth"), F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"),
                       (~last).cast("long").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
                       F.sha2(F.when(last, F.col("conv_id").cast("string")).otherwise(F.lit("")), 256).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations; see the module text."""
    spark: SparkSession = conversations.sparkSession
    turns, convs = rebuild(_turns(conversations))
    path = paths(turns)
    entrants = _entrants(path, convs)
    if entrants.isEmpty():
        return spark.createDataFrame([], _NODE)
    base = scratch_path(spark, "trie-levels")
    _peel(entrants, path, base)

    nodes = spark.read.parquet(base).withColumn("depth", F.col("depth").cast("long"))
    total = nodes.count()
    hot = F.col("n_children") * HOT >= total
    parents = nodes.select(F.col("key").alias("up"), F.col("conv_id").alias("up_conv"), hot.alias("hot"))
    up = F.when(F.col("depth") > 1, F.try_element_at("up_keys", F.lit(-1))).when(F.col("depth") == 1, F.lit(_ROOT))
    found = (nodes.withColumn("up", up)
             .join(F.broadcast(parents.filter("hot").select("up", F.col("up_conv").alias("hot_conv"))), "up", "left"))
    # a hot key has its answer already and meets no row of the second join: it is spread by its own key there
    other = F.when(F.col("hot_conv").isNull(), F.col("up")).otherwise(F.col("key"))
    found = found.withColumn("other", other).join(
        parents.filter(~F.col("hot")).select(F.col("up").alias("other"), "up_conv"), "other", "left")
    ends = _ends(entrants).withColumnRenamed("key", "end_key")
    found = found.join(ends, found.key == ends.end_key, "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("hot_conv", "up_conv"))
    out = found.select("conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
                       F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
    return out.unionByName(_tails(entrants))


ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS s,
         {'r': coalesce(role, ''), 't': coalesce(text, '')} AS x
  FROM conversations WHERE conv_id IS NOT NULL),
k AS (
  SELECT c, list(x ORDER BY s) AS own,
         (xor(list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT), lambda a, b:
           list_reduce(list_prepend(xor(a, b), range(8)), lambda v, i:
             (CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295::BIGINT), 4294967295) % 4)::INT AS h
  FROM t GROUP BY c),
f AS (
  SELECT k.c, list_concat(coalesce(b.own[1:k.h], []), k.own[k.h + 1:]) AS p
  FROM k LEFT JOIN k b ON b.c = k.c - k.c % 20),
e AS (SELECT c, len(p) AS n, p, unnest(range(len(p) + 1)) AS d FROM f),
q AS (
  SELECT p[1:d] AS pre, d, min(c) AS c, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends
  FROM e GROUP BY ALL),
w AS (
  SELECT q.*, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(pre[d].t, '[^\x20\x09-\x0D]+')) END AS v,
         coalesce(ch.n, 0) AS n_children
  FROM q LEFT JOIN (SELECT pre[1:d - 1] AS up, d - 1 AS ud, count(*) AS n FROM q WHERE d > 0 GROUP BY ALL) ch
    ON ch.ud = q.d AND ch.up = q.pre),
a AS (SELECT pre[1:g] AS anc, g, v, n_children FROM (SELECT *, unnest(range(d + 1)) AS g FROM w)),
z AS (SELECT anc, g, sum(v)::BIGINT AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves FROM a GROUP BY ALL)
SELECT w.c AS conv_id, w.d AS depth, u.c AS parent_conv_id, w.n_convs, w.n_children, z.leaves AS n_leaves,
       z.saved AS saved_tokens, w.ends AS ends_sha256
FROM w JOIN z ON z.g = w.d AND z.anc = w.pre LEFT JOIN w u ON u.d = w.d - 1 AND u.pre = w.pre[1:w.d - 1]
"""
