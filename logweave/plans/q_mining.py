"""Queries for template mining and the structured log."""

from __future__ import annotations

from pyspark.sql import functions as F

from logweave.operators import templates as T
from logweave.plans import mining as MI
from logweave.plans.catalog import register
from logweave.plans import path as PATH
from logweave.plans.oracle_views import PATH_MODEL, X1_LINES, with_views

X1_MINING = with_views(X1_LINES) + """,
xm AS (
  SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'train' ELSE 'test' END AS split,
         event_type || '|' || message AS content FROM x1),
ids AS (
  SELECT content, CAST(dense_rank() OVER (ORDER BY fs, fl) AS INTEGER) AS EventId FROM (
    SELECT content, min(CASE WHEN split = 'train' THEN 0 ELSE 1 END) AS fs,
           min(line_id) FILTER (WHERE split = (SELECT CASE WHEN min(CASE WHEN split = 'train' THEN 0 ELSE 1 END) = 0
                                                      THEN 'train' ELSE 'test' END FROM xm x2 WHERE x2.content = xm.content)) AS fl
    FROM xm GROUP BY content)),
sl AS (
  SELECT split, line_id AS LineId,
         CAST(row_number() OVER (PARTITION BY split ORDER BY line_id) AS BIGINT) AS seq,
         ids.EventId, content AS EventTemplate, 1 AS match,
         CAST(coalesce(epoch - lag(epoch) OVER (PARTITION BY split ORDER BY line_id), 0) AS VARCHAR) AS time_gap
  FROM xm JOIN ids USING (content))"""


# The X1 log has five events, so a path is unusual when its event is not the likeliest three.
LOG_TOP_K = 3


def _docs_keyed(spark, sf_dir):
    return MI.keyed_lines(MI.document_mining_input(spark, sf_dir), text=False)


@register("mask_lines")
def q_mask_lines(spark, sf_dir):
    """Masked document lines (DuckDB has no look-behind, so no SQL oracle)."""
    d = MI.document_mining_input(spark, sf_dir)
    return T.mask_column(d, "content", "masked").select("doc_id", "line_no", "masked")


@register("tokenize", with_views("""
raw AS (SELECT doc_id, CAST(unnest(generate_series(1, len(parts))) AS BIGINT) AS line_no, unnest(parts) AS line
        FROM (SELECT doc_id, string_split_regex(text, '\\r\\n|\\r|\\n') AS parts FROM documents)),
tk AS (SELECT doc_id, line_no,
              list_filter(string_split_regex(replace(line, '_', ' '),
                '[\\t\\n\\x0B\\f\\r \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+'),
                lambda x: x <> '') AS toks FROM raw)""") + """
SELECT doc_id, line_no, CAST(len(toks) AS INTEGER) AS n_tokens, array_to_string(toks, ' ') AS joined FROM tk""")
def q_tokenize(spark, sf_dir):
    """Tokens of every document line (unmasked), joined back with one blank."""
    from logweave.sources.derived import document_lines
    d = document_lines(spark, sf_dir).withColumn("toks", T.tokenize(F.col("line")))
    return d.select("doc_id", "line_no", F.size("toks").alias("n_tokens"), F.array_join("toks", " ").alias("joined"))


@register("leaf_key")
def q_leaf_key(spark, sf_dir):
    """Leaf (token count, first token or wildcard) of each masked document line."""
    return _docs_keyed(spark, sf_dir).select("doc_id", "line_no", "n_tokens", "leaf_token")


@register("mine_templates")
def q_mine_templates(spark, sf_dir):
    """The template catalogue mined from all document lines."""
    _, cat = MI.mine_catalogue(_docs_keyed(spark, sf_dir))
    return cat.select("cluster_id", "n_tokens", "leaf_token", "template", "size")


@register("template_sizes")
def q_template_sizes(spark, sf_dir):
    """Templates by size (most lines first)."""
    _, cat = MI.mine_catalogue(_docs_keyed(spark, sf_dir))
    return cat.select("cluster_id", "template", "size").orderBy(F.col("size").desc(), "cluster_id")


@register("template_changes")
def q_template_changes(spark, sf_dir):
    """Every line that created a cluster or changed its template."""
    mined, cat = MI.mine_catalogue(_docs_keyed(spark, sf_dir), feed=True)
    return T.changes(mined, cat)


@register("match_templates")
def q_match_templates(spark, sf_dir):
    """Second pass, each document line against the finished templates."""
    keyed = _docs_keyed(spark, sf_dir)
    _, cat = MI.mine_catalogue(keyed)
    return T.match(keyed, cat).select("doc_id", "line_no", "EventId", "EventTemplate", "match")


@register("template_values")
def q_template_values(spark, sf_dir):
    """The values a line carries at its template's wildcard positions."""
    keyed = _docs_keyed(spark, sf_dir)
    _, cat = MI.mine_catalogue(keyed)
    m = T.match(keyed, cat).where(F.col("match") == 1)
    return m.select("doc_id", "line_no", "EventId",
                    F.array_join(T.template_values(F.col("tokens"), F.col("param")), " ").alias("values"))


@register("unmatched_lines")
def q_unmatched_lines(spark, sf_dir):
    """P18 / Q11 ``fit_on='train'``: templates mined on documents, benchmark lines that match none."""
    lines = MI.tokenized_lines(MI.document_mining_input(spark, sf_dir), text=False)
    own = T.own_leaves(lines)
    _, cat = MI.mine_catalogue(T.route(lines, own))
    bench = MI.keyed_lines(MI.benchmark_mining_input(spark, sf_dir), own=own)
    m = T.match(bench, cat)
    return m.where(F.col("EventId").isNull()).select("item_id", "line_no", "content")


@register("position_templates", with_views(X1_LINES) + """,
tk AS (SELECT string_split(event_type || '|' || message, ' ') AS toks FROM x1),
pos AS (SELECT len(toks) AS n_tokens, toks[1] AS leaf_token, unnest(generate_series(1, len(toks))) AS i,
               unnest(toks) AS tok FROM tk),
pp AS (SELECT n_tokens, leaf_token, i, CASE WHEN count(DISTINCT tok) = 1 THEN min(tok) ELSE '<*>' END AS tok
       FROM pos GROUP BY ALL)
SELECT CAST(n_tokens AS INTEGER) AS n_tokens, leaf_token, string_agg(tok, ' ' ORDER BY i) AS template FROM pp GROUP BY ALL""")
def q_position_templates(spark, sf_dir):
    """T5: SQL form of the merge (per leaf and position: one token or a wildcard)."""
    return T.position_templates(MI.keyed_lines(MI.event_log_mining_input(spark, sf_dir)))


@register("structured_log", X1_MINING + """
SELECT split, LineId, seq, EventId, EventTemplate, match, time_gap FROM sl""")
def q_structured_log(spark, sf_dir):
    """Mined, matched and gap-annotated event log."""
    s = MI.structured_event_log(spark, sf_dir)
    return s.select("split", "LineId", "seq", "EventId", "EventTemplate", "match", "time_gap")


@register("parameter_list", X1_MINING + """
SELECT split, LineId, replace(EventTemplate, '|', '|') AS param_text, time_gap AS gap FROM sl""")
def q_parameter_list(spark, sf_dir):
    """``ParameterList = (template tokens, gap text)`` per line."""
    s = MI.structured_event_log(spark, sf_dir)
    return s.select("split", "LineId", F.array_join("ParameterList.tokens", " ").alias("param_text"),
                    F.col("ParameterList.gap").alias("gap"))


@register("log_path_anomalies", X1_MINING + """,
win AS (
  SELECT * FROM (
    SELECT split, LineId, seq, lag(EventId, 3) OVER w AS c1, lag(EventId, 2) OVER w AS c2, lag(EventId, 1) OVER w AS c3,
           EventId AS y FROM sl WINDOW w AS (PARTITION BY split ORDER BY seq)) WHERE seq >= 4),""" + PATH_MODEL + f"""
SELECT split, LineId, y AS EventId, level, rank FROM scored WHERE rank IS NULL OR rank > {LOG_TOP_K}""")
def q_log_path_anomalies(spark, sf_dir):
    """M3 on the mined log: structured test rows whose event is not the expected one."""
    s = MI.structured_event_log(spark, sf_dir)
    return PATH.log_path(s, top_k=LOG_TOP_K).select("split", "LineId", "EventId", "level", "rank")


@register("log_null_events", X1_MINING + """
SELECT split, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (EventId IS NULL) AS BIGINT) AS n_unmatched
FROM sl GROUP BY split""")
def q_log_null_events(spark, sf_dir):
    """Q26: lines of the structured log without an event, per split."""
    return PATH.null_events(MI.structured_event_log(spark, sf_dir))
