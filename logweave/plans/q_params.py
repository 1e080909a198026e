"""Queries for the parameter-value detector and its key bookkeeping
(A2, A3, A5, A6, J-a, J-b, J-c, J-d, M4-M6, P22, P23, S9, S11, U4, W5, W7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from logweave.operators import gaps as G
from logweave.operators import params as PV
from logweave.plans import params as PP
from logweave.plans.catalog import register
from logweave.plans.mining import structured_event_log
from logweave.plans.q_mining import X1_MINING
from logweave.session import materialize, scratch_path
from logweave.sources.partitioned import write_partitioned

CLEAN = "$$=|/|#|:|\\[|\\]|'|\\s+|\\.|-|\\(|\\)|rhost=|,$$"
FILTERS = "$$[!\"#$%&()*+,\\-./:;<=>?@\\[\\\\\\]^_`{|}~\\t\\n]$$"

P = X1_MINING + f""",
pk AS (SELECT *, CAST(row_number() OVER (PARTITION BY split, EventId ORDER BY seq) AS BIGINT) AS k FROM sl),
tx AS (SELECT split, EventId, k, LineId, 0 AS t, regexp_replace(EventTemplate, {CLEAN}, '', 'g') AS text FROM pk
       UNION ALL SELECT split, EventId, k, LineId, 1, regexp_replace(time_gap, {CLEAN}, '', 'g') FROM pk),
wl AS (SELECT split, EventId, k, LineId, t, unnest(ws) AS word, unnest(generate_series(0, len(ws) - 1)) AS w FROM (
         SELECT *, list_filter(string_split(regexp_replace(lower(text), {FILTERS}, ' ', 'g'), ' '), lambda x: x <> '') AS ws
         FROM tx)),
vocab AS (SELECT EventId, word, CAST(count(*) AS BIGINT) AS cnt,
                 CAST(row_number() OVER (PARTITION BY EventId ORDER BY count(*) DESC,
                      min((CASE WHEN split = 'train' THEN 0 ELSE 1 END) * 1000000000000000 + k * 100000 + t * 10000 + w))
                      AS INTEGER) AS word_id
          FROM wl GROUP BY EventId, word),
tid AS (SELECT tx.split, tx.EventId, tx.k, tx.LineId, tx.t, coalesce(g.ids, [0]) AS ids FROM tx LEFT JOIN (
          SELECT split, EventId, k, t, list(word_id ORDER BY w) AS ids FROM wl JOIN vocab USING (EventId, word)
          GROUP BY ALL) g USING (split, EventId, k, t)),
vec AS (SELECT split, EventId, k, LineId, flatten(list(ids ORDER BY t)) AS vec FROM tid GROUP BY ALL),
modal AS (SELECT EventId, dim FROM (SELECT EventId, len(vec) AS dim, row_number() OVER (PARTITION BY EventId ORDER BY count(*) DESC, len(vec)) AS r
          FROM vec GROUP BY EventId, len(vec)) WHERE r = 1),
okv AS (SELECT vec.* FROM vec JOIN modal USING (EventId) WHERE len(vec.vec) = modal.dim),
pw AS (SELECT * FROM (SELECT split, EventId, k, LineId, lag(vec, 3) OVER w AS x1, lag(vec, 2) OVER w AS x2,
                             lag(vec, 1) OVER w AS x3, vec AS y
                      FROM okv WINDOW w AS (PARTITION BY split, EventId ORDER BY k)) WHERE k > 3),
trainable AS (SELECT EventId, count(*) AS n_rows FROM okv WHERE split = 'train' GROUP BY EventId HAVING count(*) >= 9),
ma AS (SELECT pw.*, list_sum(list_transform(generate_series(1, len(y)),
                       lambda i: (y[i] - (x1[i] + x2[i] + x3[i]) / 3.0) * (y[i] - (x1[i] + x2[i] + x3[i]) / 3.0))) / len(y) AS mse
       FROM pw WHERE split = 'test' AND EventId IN (SELECT EventId FROM trainable))"""


def rows(spark, sf_dir):
    return PP.param_rows(spark, sf_dir)


def _vec_text(c):
    return F.array_join(c.cast("array<string>"), ",")


@register("clean_params", P + " SELECT split, LineId, t, text FROM tx")
def q_clean_params(spark, sf_dir):
    """2.9: cleaned parameter texts (template tokens, gap) of every row."""
    r = rows(spark, sf_dir)
    return r.select("split", "LineId", F.posexplode("texts").alias("t", "text"))


@register("param_vocab", P + " SELECT EventId, word, word_id, cnt FROM vocab")
def q_param_vocab(spark, sf_dir):
    """Per-key vocabulary (count desc, first seen), fitted on train then test."""
    return PV.vocabulary(rows(spark, sf_dir)).select("EventId", "word", "word_id", "cnt")


@register("encode_params", P + " SELECT split, EventId, k, LineId, array_to_string(vec, ',') AS vec FROM vec")
def q_encode_params(spark, sf_dir):
    """J-c / M4b: word-id vector of each row."""
    r = rows(spark, sf_dir)
    v = PV.encode(r, PV.vocabulary(r))
    return v.select("split", "EventId", "k", "LineId", _vec_text(F.col("vec")).alias("vec"))


@register("event_vectors", P + " SELECT split, EventId, k, LineId, array_to_string(vec, ',') AS vec FROM okv")
def q_event_vectors(spark, sf_dir):
    """Per-key matrices as rows (ragged rows rejected, Q27)."""
    v = PP.param_vectors(rows(spark, sf_dir)).where("ok")
    return v.select("split", "EventId", "k", "LineId", _vec_text(F.col("vec")).alias("vec"))


@register("param_windows", P + """
SELECT split, EventId, k, LineId, array_to_string(x1, ',') AS x1, array_to_string(x2, ',') AS x2,
       array_to_string(x3, ',') AS x3, array_to_string(y, ',') AS y FROM pw""")
def q_param_windows(spark, sf_dir):
    """Three previous vectors and the next one, per key and split."""
    w = PV.windows(PP.param_vectors(rows(spark, sf_dir)).where("ok"))
    return w.select("split", "EventId", "k", "LineId", *[_vec_text(F.col(c)).alias(c) for c in ("x1", "x2", "x3", "y")])


@register("trainable_events", P + " SELECT EventId, CAST(n_rows AS BIGINT) AS n_rows FROM trainable")
def q_trainable_events(spark, sf_dir):
    """A3: keys with more than 8 train rows."""
    return PV.trainable(PP.param_vectors(rows(spark, sf_dir)).where("ok"))


@register("param_model_ma", P + " SELECT EventId, k, LineId, round(mse, 6) AS mse FROM ma")
def q_param_model_ma(spark, sf_dir):
    """M5a + A5: mean-of-last-3 forecast and its squared error for every test window."""
    s = PP.param_value(rows(spark, sf_dir), "mean")
    return s.select("EventId", "k", "LineId", F.round("mse", 6).alias("mse"))


@register("param_anomalies", P + " SELECT EventId, k, LineId, round(mse, 6) AS mse FROM ma WHERE mse > 1000")
def q_param_anomalies(spark, sf_dir):
    """Test windows with squared error > 1000, traced to the line."""
    s = PP.param_value(rows(spark, sf_dir), "mean").where("is_anomaly")
    return s.select("EventId", "k", "LineId", F.round("mse", 6).alias("mse"))


@register("param_model_ar1", P + """,
pairs AS (SELECT EventId, unnest(generate_series(0, len(vec) - 1)) AS dim, unnest(vec) AS y, unnest(prev) AS x FROM (
  SELECT EventId, vec, lag(vec) OVER (PARTITION BY EventId ORDER BY k) AS prev FROM okv
  WHERE split = 'train' AND EventId IN (SELECT EventId FROM trainable)) WHERE prev IS NOT NULL)
SELECT EventId, CAST(dim AS INTEGER) AS dim,
       CASE WHEN var_pop(x) > 0 THEN round(regr_slope(y, x), 6) END AS slope,
       CASE WHEN var_pop(x) > 0 THEN round(regr_intercept(y, x), 6) END AS intercept
FROM pairs GROUP BY EventId, dim""")
def q_param_model_ar1(spark, sf_dir):
    """Lag-1 regression per key and dimension (SQL aggregates)."""
    vec = PP.param_vectors(rows(spark, sf_dir)).where("ok")
    models = PV.trainable(vec).select("EventId")
    m = PV.fit_ar1(vec.where(F.col("split") == "train").join(models, "EventId", "left_semi"))
    return m.select("EventId", "dim", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


@register("param_model_ar3")
def q_param_model_ar3(spark, sf_dir):
    """Least squares on 3 lags per key and dimension, and the flagged test lines."""
    s = PP.param_value(rows(spark, sf_dir), "ar3")
    return s.select("EventId", "k", "LineId", F.round("mse", 6).alias("mse"), "is_anomaly")


@register("known_events", P + """
SELECT LineId, EventId FROM sl WHERE split = 'test' AND EventId IN (SELECT EventId FROM sl WHERE split = 'train')""")
def q_known_events(spark, sf_dir):
    """J-a: test rows whose key occurs in train (left-semi join)."""
    s = structured_event_log(spark, sf_dir)
    train_ids = s.where(F.col("split") == "train").select("EventId").distinct()
    return s.where(F.col("split") == "test").join(train_ids, "EventId", "left_semi").select("LineId", "EventId")


@register("unmodelled_events", P + """
SELECT DISTINCT EventId FROM okv WHERE split = 'test' AND EventId NOT IN (SELECT EventId FROM trainable)""")
def q_unmodelled_events(spark, sf_dir):
    """J-d: test keys skipped because they have no model (left-anti join)."""
    vec = PP.param_vectors(rows(spark, sf_dir)).where("ok")
    return (vec.where(F.col("split") == "test").select("EventId").distinct()
            .join(PV.trainable(vec), "EventId", "left_anti"))


@register("event_key_union", P + " SELECT DISTINCT EventId FROM sl")
def q_event_key_union(spark, sf_dir):
    """U4: keys of train united with keys of test."""
    s = structured_event_log(spark, sf_dir)
    tr = s.where(F.col("split") == "train").select("EventId")
    te = s.where(F.col("split") == "test").select("EventId")
    return tr.union(te).distinct()


@register("empty_events", P + """
SELECT s.split, k.EventId FROM (SELECT DISTINCT EventId FROM sl) k, (VALUES ('train'), ('test')) s(split)
WHERE NOT EXISTS (SELECT 1 FROM sl x WHERE x.split = s.split AND x.EventId = k.EventId)""")
def q_empty_events(spark, sf_dir):
    """(split, key) pairs with no rows: per key, the splits it is missing from."""
    s = structured_event_log(spark, sf_dir)
    all_splits = F.array(F.lit("train"), F.lit("test"))
    per_key = s.groupBy("EventId").agg(F.collect_set("split").alias("_present"))
    return per_key.select(F.explode(F.array_except(all_splits, F.col("_present"))).alias("split"), "EventId")


@register("scorable_events", P + """
SELECT EventId, n_test FROM (
  SELECT EventId, count(*) AS n_test FROM okv WHERE split = 'test' AND EventId IN (SELECT EventId FROM trainable)
  GROUP BY EventId HAVING count(*) >= 4) ORDER BY EventId LIMIT 1""")
def q_scorable_events(spark, sf_dir):
    """The first key that has a model and enough test rows for a window."""
    vec = PP.param_vectors(rows(spark, sf_dir)).where("ok")
    t = (vec.where(F.col("split") == "test").join(PV.trainable(vec), "EventId", "left_semi")
         .groupBy("EventId").agg(F.count(F.lit(1)).alias("n_test")).where(F.col("n_test") >= 4))
    return t.orderBy("EventId").limit(1)


@register("group_rows", P + " SELECT split, EventId, k, LineId, EventTemplate AS Content FROM pk")
def q_group_rows(spark, sf_dir):
    """Rows per key in order (row form: key, position in key, line)."""
    r = rows(spark, sf_dir)
    return r.select("split", "EventId", "k", "LineId", "Content")


# Fixed value: the keys that the wide export has a column for.
X1_EVENT_IDS = (1, 2, 3, 4, 5)


@register("pivot_by_event", P + """
SELECT split, k, max(CASE WHEN EventId = 1 THEN LineId END) AS e1, max(CASE WHEN EventId = 2 THEN LineId END) AS e2,
       max(CASE WHEN EventId = 3 THEN LineId END) AS e3, max(CASE WHEN EventId = 4 THEN LineId END) AS e4,
       max(CASE WHEN EventId = 5 THEN LineId END) AS e5
FROM pk GROUP BY split, k""")
def q_pivot_by_event(spark, sf_dir):
    """Wide export, one column per key, rows by position within the key."""
    from logweave.operators.wide import pivot_by_key
    r = rows(spark, sf_dir)
    return pivot_by_key(r, ["split", "k"], "EventId", "LineId", X1_EVENT_IDS, prefix="e")


@register("long_by_event", P + " SELECT split, k, EventId, LineId FROM pk")
def q_long_by_event(spark, sf_dir):
    """The export in long form, for any number of keys."""
    from logweave.operators.wide import long_form
    return long_form(rows(spark, sf_dir), ["split", "k"], "EventId", "LineId")


@register("trace_anomalies", P + """
SELECT LineId, EventId, EventTemplate, time_gap FROM sl
WHERE split = 'test' AND LineId IN (SELECT LineId FROM ma WHERE mse > 1000)""")
def q_trace_anomalies(spark, sf_dir):
    """J-b: rows of the structured test log whose line was flagged (left-semi join)."""
    s = materialize(structured_event_log(spark, sf_dir), "structured-log")  # mined and matched once
    flags = PP.param_value(PP.param_rows(spark, sf_dir, structured=s), "mean").where("is_anomaly").select("LineId")
    return s.where(F.col("split") == "test").join(flags, "LineId", "left_semi").select("LineId", "EventId", "EventTemplate", "time_gap")


def _gaps(spark, sf_dir):
    s = structured_event_log(spark, sf_dir).where(F.col("EventId").isNotNull())
    return materialize(s.select("split", "LineId", "EventId", F.col("time_gap").cast("long").alias("gap")), "event-gaps")


GAP_MODEL = X1_MINING + """,
gp AS (SELECT split, LineId, EventId, CAST(time_gap AS BIGINT) AS gap FROM sl),
gr AS (SELECT EventId, gap, row_number() OVER (PARTITION BY EventId ORDER BY gap) AS r, count(*) OVER (PARTITION BY EventId) AS n
       FROM gp WHERE split = 'train'),
gm AS (SELECT EventId, CAST(max(n) AS BIGINT) AS n_rows, min(gap) FILTER (r >= 0.25 * n) AS low,
              min(gap) FILTER (r >= 0.5 * n) AS mid, min(gap) FILTER (r >= 0.75 * n) AS high FROM gr GROUP BY EventId)"""


@register("gap_model", GAP_MODEL + " SELECT EventId, n_rows, low, mid, high FROM gm")
def q_gap_model(spark, sf_dir):
    """Q18 as a number: quartiles of the time gap per key, from mergeable sketches."""
    return G.fit_gaps(_gaps(spark, sf_dir).where("split = 'train'"))


@register("gap_anomalies", GAP_MODEL + """
SELECT LineId, EventId, gap, round(abs(gap - mid) / greatest(high - low, 1), 6) AS distance
FROM gp JOIN gm USING (EventId) WHERE split = 'test' AND abs(gap - mid) / greatest(high - low, 1) > 3.0""")
def q_gap_anomalies(spark, sf_dir):
    """Q18 as a number: test lines whose gap is far from the quartiles of their key."""
    rows = _gaps(spark, sf_dir)
    found = G.gap_distance(rows.where("split = 'test'"), G.fit_gaps(rows.where("split = 'train'"))).where("is_anomaly")
    return found.select("LineId", "EventId", "gap", F.round("distance", 6).alias("distance"))


@register("event_vector_sink", P + " SELECT split, EventId, k, LineId, array_to_string(vec, ',') AS vec FROM okv")
def q_event_vector_sink(spark, sf_dir):
    """The vectors written by (split, EventId) and read back."""
    path = scratch_path(spark, "event-vectors")
    v = PP.param_vectors(rows(spark, sf_dir)).where("ok")
    write_partitioned(v.select("split", "EventId", "k", "LineId", "vec"), path, ["split", "EventId"], ["k"])
    return spark.read.parquet(path).select("split", F.col("EventId").cast("int").alias("EventId"), "k", "LineId",
                                           _vec_text(F.col("vec")).alias("vec"))


@register("structured_log_sink", X1_MINING + " SELECT split, LineId, seq, EventId, EventTemplate, match, time_gap FROM sl")
def q_structured_log_sink(spark, sf_dir):
    """The structured log written with its nested columns by split, and read back."""
    path = scratch_path(spark, "structured-log")
    write_partitioned(structured_event_log(spark, sf_dir), path, ["split"], ["LineId"])
    return spark.read.parquet(path).select("split", "LineId", "seq", "EventId", "EventTemplate", "match",
                                           F.col("ParameterList.gap").alias("time_gap"))
