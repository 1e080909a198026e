"""Chat formatting by multi-party perspective rotation, in DataFrame operations only.

For every participant of a conversation (every speaker but ``system``) the whole
dialogue is rendered once with that speaker as the assistant and all others as
named users. Loss spans cover the assistant's words and end marks.

A row holds a block of at most ``BLOCK_ROWS`` turns or so: turns 0-63, 64-127 and
so on; if such a stretch holds more rows (turn numbers that repeat), one block
per turn number, and its rows dealt to several blocks by hash when they alone
are too many (equal rows are counted first and their copies dealt by number). Blocks in order of (part, block_turn, piece) give the dialogue.
Within a block turns are in order of (turn, speaker, text).

Null turn: after all others. Null speaker: "unknown". Null text: empty. A
conversation without a participant is rendered once, with a null perspective.
Marks of the format inside a text are broken up, so a text cannot fake a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_TURNS = 64
BLOCK_ROWS = 256
# Copies of one row that a single array numbers.
_COPIES = 4_096
END_MARK = "<|end|>\n"


def _head(t: Column, perspective: Column) -> Column:
    return (F.when(t["speaker"] == "system", F.lit("<|system|>\n"))
            .when(t["speaker"] == perspective, F.lit("<|assistant|>\n"))
            .otherwise(F.concat(F.lit("<|user name="), t["speaker"], F.lit("|>\n"))))


def _safe(c: Column) -> Column:
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def blocks(turns: DataFrame) -> DataFrame:
    """conv_id, part, block_turn, piece, turns (array of turn, speaker, text in order)."""
    rows = turns.select(
        "conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(2**62)).alias("turn"),
        _safe(F.coalesce(F.col("role").cast("string"), F.lit("unknown"))).alias("speaker"),
        _safe(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    rows = rows.withColumn("part", F.floor(F.col("turn") / PART_TURNS))
    per_turn = rows.groupBy("conv_id", "part", "turn").agg(F.count("*").alias("n"))
    full = (per_turn.groupBy("conv_id", "part").agg(F.sum("n").alias("all")).filter(F.col("all") > BLOCK_ROWS)
            .select(F.col("conv_id").alias("c"), F.col("part").alias("p")))
    split = (per_turn.alias("t").join(full, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")), "left_semi")
             .select(F.col("conv_id").alias("c"), F.col("turn").alias("u"), F.ceil(F.col("n") / PART_TURNS).alias("pieces")))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("turn") == F.col("u"))
    alone = rows.join(split, same, "left_anti").select(
        "*", (F.col("part") * PART_TURNS).alias("block_turn"), F.lit(0).alias("piece"))
    # equal rows of a turn that is split: one row with their number, then its copies, each with its own
    counted = (rows.join(split, same).groupBy("conv_id", "turn", "speaker", "text", "part", "pieces")
               .agg((F.count("*") - 1).alias("last")))
    step = F.lit(_COPIES)
    copies = (counted.select("*", F.explode(F.sequence(F.lit(0), F.floor(F.col("last") / step))).alias("run"))
              .select("*", F.explode(F.sequence(F.col("run") * step, F.least("last", F.col("run") * step + step - 1))).alias("copy")))
    dealt = alone.unionByName(copies.select(
        "conv_id", "turn", "speaker", "text", "part", F.col("turn").alias("block_turn"),
        F.pmod(F.xxhash64("speaker", "text", "copy"), F.col("pieces")).cast("int").alias("piece")))
    return (dealt.groupBy("conv_id", "part", "block_turn", "piece")
            .agg(F.sort_array(F.collect_list(F.struct("turn", "speaker", "text"))).alias("turns")))


def rotate(turns: DataFrame) -> DataFrame:
    """conv_id, perspective, part, block_turn, piece, n_turns, text, loss_spans ("from-to,..." in characters), n_loss."""
    who = (turns.select("conv_id", _safe(F.coalesce(F.col("role").cast("string"), F.lit("unknown"))).alias("perspective"))
           .filter("perspective <> 'system'").distinct().withColumnRenamed("conv_id", "c"))
    seen = blocks(turns).join(who, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    me = F.coalesce("perspective", F.lit("system"))  # no participant: no turn is the assistant's
    body = lambda t: F.concat(t["text"], F.lit(END_MARK))
    own = lambda t: (t["speaker"] == me) & (t["speaker"] != "system")
    text = F.array_join(F.transform("turns", lambda t: F.concat(_head(t, me), body(t))), "")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("spans"), F.lit(0).alias("loss"))

    def step(a: Column, t: Column) -> Column:
        lo = a["at"] + F.length(_head(t, me))
        hi = lo + F.length(t["text"]) + len(END_MARK) - 1  # the line break after the end mark is not learnt
        span = F.concat(a["spans"], F.when(a["spans"] == "", "").otherwise(","), lo.cast("string"), F.lit("-"), hi.cast("string"))
        return F.struct((hi + 1).alias("at"), F.when(own(t), span).otherwise(a["spans"]).alias("spans"),
                        (a["loss"] + F.when(own(t), hi - lo).otherwise(0)).alias("loss"))

    done = seen.withColumn("m", F.aggregate("turns", start, step))
    return done.select("conv_id", "perspective", "part", "block_turn", "piece", F.size("turns").alias("n_turns"),
                       text.alias("text"), F.col("m.spans").alias("loss_spans"), F.col("m.loss").alias("n_loss"))


ORACLE_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(turn, 4611686018427387904) AS turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS speaker,
         replace(coalesce(text, ''), '<|', '< |') AS body FROM conversations),
who AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (
  SELECT t.*, w.perspective, turn // 64 AS part,
         CASE WHEN speaker = 'system' THEN '<|system|>' || chr(10)
              WHEN speaker = w.perspective THEN '<|assistant|>' || chr(10)
              ELSE '<|user name=' || speaker || '|>' || chr(10) END AS head,
         coalesce(speaker = w.perspective, false) AS own
  FROM t LEFT JOIN who w ON t.conv_id IS NOT DISTINCT FROM w.conv_id),
p AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 8) OVER (
           PARTITION BY conv_id, perspective, part ORDER BY turn, speaker, body
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS lo FROM r)
SELECT conv_id, perspective, part, part * 64 AS block_turn, 0 AS piece, count(*) AS n_turns,
       string_agg(head || body || '<|end|>' || chr(10), '' ORDER BY turn, speaker, body) AS text,
       coalesce(string_agg(lo || '-' || (lo + length(body) + 7), ',' ORDER BY turn, speaker, body) FILTER (own), '') AS loss_spans,
       coalesce(sum(length(body) + 7) FILTER (own), 0) AS n_loss
FROM p GROUP BY conv_id, perspective, part
"""
