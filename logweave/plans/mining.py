"""Template mining and structuring jobs (E2 first half)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.operators import templates as T
from logweave.operators.order import dense_by_id, time_gap
from logweave.operators.parse import parse_log, parsed_rows
from logweave.plans import models
from logweave.session import materialize as materialize_table
from logweave.sources.derived import document_lines, event_log_lines
from logweave.sources.text import concat_splits, read_lines

# Fixed value: X1 train / test split point (event time).
EVENTS_TRAIN_BEFORE = "2024-01-16 00:00:00"


def tokenized_lines(lines: DataFrame, content: str = "content", text: bool = True) -> DataFrame:
    """Mask and tokenize lines: adds ``tokens``. Written once to the checkpoint
    folder (it feeds routing, miner and matcher), not run once per consumer;
    without ``text`` only the tokens are, not the line they come from."""
    m = T.mask_column(lines, content, "_masked").withColumn("tokens", T.tokenize(F.col("_masked"))).drop("_masked")
    if not text:
        m = m.drop(content)
    return materialize_table(m, "tokenized-lines")


def keyed_lines(lines: DataFrame, content: str = "content", pos: str = "pos", own: DataFrame | None = None,
                text: bool = True) -> DataFrame:
    """Mask, tokenize and route lines: adds ``tokens, n_tokens, leaf_token``.

    Lines to be mined are routed by the tree they grow; lines to be matched
    against a finished catalogue by ``own``, the own-leaf table of the lines
    that were mined.
    """
    m = tokenized_lines(lines, content, text)
    if own is None:  # written: every pass over the routed lines reads it
        own = materialize_table(T.own_leaves(m, "tokens", pos), "own-leaves")
    return T.route(m, own, "tokens")


def mine_catalogue(keyed: DataFrame, sim_th: float = T.SIM_TH, feed: bool = False) -> tuple[DataFrame, DataFrame]:
    """Run the per-leaf miner once; what it finds is a written table, so the
    change feed (only with ``feed``), the catalogue and the match pass reuse it."""
    mined = T.mine(keyed, sim_th, feed=feed)
    return mined, T.catalogue(mined)


OWN_SCHEMA = "n_tokens int, first string"


def text_mining_input(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Raw text logs by split (train first) in mining form; lines without a time are left out (Q28)."""
    parts = []
    for i, (split, path) in enumerate(paths.items()):
        lines = read_lines(spark, path, split=split, across_files=True)
        p = parsed_rows(parse_log(lines, split_reason=False))
        parts.append(p.select("split", "line_id", "line", "epoch", F.col("message").alias("content"),
                              T.order_key(F.lit(i), F.col("line_id")).alias("pos")))
    return concat_splits(*parts)


def fit_templates(lines: DataFrame, path: str, fit_id: str, base: str | None = None) -> DataFrame:
    """Mine ``lines`` (content, pos) and store the miner under ``path`` as ``fit_id``.

    With ``base`` mining goes on from that stored fit, as if ``lines`` had
    followed the lines of the base (their positions must be larger); the base
    itself stays as it was. A fit that is run again replaces its own rows only.
    Stored are the own-leaf table and the miner's rows (catalogue, changes and
    open clusters, see ``templates.mine``).
    """
    spark = lines.sparkSession
    tokens = tokenized_lines(lines)
    before = state = None
    if base is not None:
        if base == fit_id:
            raise ValueError("a fit cannot go on from itself")
        before = models.load_model(spark, f"{path}/own", base, OWN_SCHEMA)
        state = models.load_model(spark, f"{path}/mined", base).where("kind in ('leaf', 'open')")
    own = materialize_table(T.own_leaves(tokens, before=before), "own-leaves")
    models.save_model(own, f"{path}/own", fit_id)
    models.save_model(T.mine(T.route(tokens, own), state=state), f"{path}/mined", fit_id)
    return models.load_model(spark, f"{path}/mined", fit_id)


def stored_matcher(spark: SparkSession, path: str, fit_id: str) -> tuple[DataFrame, DataFrame]:
    """Own-leaf table and catalogue of a stored fit, to route and match new lines."""
    own = models.load_model(spark, f"{path}/own", fit_id, OWN_SCHEMA)
    return own, T.catalogue(models.load_model(spark, f"{path}/mined", fit_id))


def event_log_mining_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 in mining form: content is the text after the time token (Q11: train then test)."""
    p = parsed_rows(parse_log(event_log_lines(spark, sf_dir), split_reason=False))
    p = p.withColumn("split", F.when(F.col("ts") < F.lit(EVENTS_TRAIN_BEFORE).cast("timestamp_ntz"), "train")
                     .otherwise("test"))
    return p.select("split", "line_id", "line", "epoch", F.col("message").alias("content"),
                    T.order_key(F.when(F.col("split") == "train", 0).otherwise(1), F.col("line_id")).alias("pos"))


def structure(lines: DataFrame, fitted: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Mine and match ``lines`` (split, line_id, line, epoch, content, pos) into the structured log.
    With ``fitted`` (own leaves, catalogue; see ``stored_matcher``) nothing is mined.

    ``(split, LineId, seq, timestamp, Content, line, EventTemplate, EventId,
    param, match, values, time_gap, ParameterList)``; ``time_gap`` is text,
    ``ParameterList`` is ``struct(tokens, gap)`` as in the reference and
    ``values`` holds the line's tokens at the template's wildcards (Q18).
    """
    if fitted is None:
        keyed = keyed_lines(lines)
        _, cat = mine_catalogue(keyed)
    else:
        own, cat = fitted
        keyed = keyed_lines(lines, own=own)
    matched = T.match(keyed, cat)
    seq = dense_by_id(matched, "line_id", out="seq", groups=["split"], counted=keyed.select("split", "line_id"))
    gapped = time_gap(seq, "seq", "epoch", groups=["split"])
    return gapped.select(
        "split", F.col("line_id").alias("LineId"), "seq", F.col("epoch").cast("double").alias("timestamp"),
        F.col("content").alias("Content"), "line", "EventTemplate", "EventId", "param", "match",
        T.template_values(F.col("tokens"), F.col("param")).alias("values"),
        F.col("time_gap").cast("string").alias("time_gap"),
        F.struct(F.col("param").alias("tokens"), F.col("time_gap").cast("string").alias("gap")).alias("ParameterList"))


def structured_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The structured log of X1."""
    return structure(event_log_mining_input(spark, sf_dir))


def document_mining_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 lines as mining input; ``pos`` orders documents, then lines."""
    d = document_lines(spark, sf_dir)
    return d.where(F.col("line").rlike(r"(?U)\S")).select(
        "doc_id", "line_no", F.col("line").alias("content"),
        T.order_key(F.col("doc_id"), F.col("line_no")).alias("pos"))


def benchmark_mining_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logweave.sources.tables import spread, table
    b = spread(table(spark, sf_dir, "benchmark").select("item_id", "text"), "item_id")
    lines = b.select("item_id", F.posexplode(F.split("text", "\r\n|\r|\n")).alias("i", "content"))
    return lines.where(F.length(T.strip_u(F.col("content"))) > 0).select(
        "item_id", (F.col("i") + 1).cast("long").alias("line_no"), "content",
        T.order_key(F.col("item_id"), F.col("i") + 1).alias("pos"))
