"""Queries on ordered sequences: dense positions, gaps, n-grams, path model."""

from __future__ import annotations

from pyspark.sql import functions as F

from logweave.operators import nextevent as NE
from logweave.operators.ngrams import distinct_ngrams, row_ngrams, row_pad
from logweave.operators.order import dense_index, time_gap
from logweave.operators.parse import parse_log, parsed_rows
from logweave.plans import path as PATH
from logweave.plans.catalog import register
from logweave.plans.mining import EVENTS_TRAIN_BEFORE
from logweave.plans.oracle_views import LI_SEQ, X1_LINES, with_views
from logweave.sources.derived import conversation_roles, event_log_lines

X1 = with_views(X1_LINES)
LI = with_views(LI_SEQ)


def event_log_split(spark, sf_dir):
    """Parsed X1 lines with ``split`` and a dense ``seq`` per split (P20)."""
    p = parsed_rows(parse_log(event_log_lines(spark, sf_dir)))
    p = p.withColumn("split", F.when(F.col("ts") < F.lit(EVENTS_TRAIN_BEFORE).cast("timestamp_ntz"), "train")
                     .otherwise("test"))
    return dense_index(p, ["line_id"], out="seq", groups=["split"])


@register("dense_seq", LI + " SELECT split, seq, code FROM x3")
def q_dense_seq(spark, sf_dir):
    """P20 / S2 recipe: dense position per split of the lineitem code sequence."""
    return PATH.lineitem_sequence(spark, sf_dir).select("split", "seq", "code")


@register("time_gap", X1 + """
SELECT split, line_id, seq, CAST(coalesce(epoch - lag(epoch) OVER (PARTITION BY split ORDER BY line_id), 0) AS BIGINT) AS time_gap
FROM (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'train' ELSE 'test' END AS split,
             row_number() OVER (PARTITION BY CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'train' ELSE 'test' END
                                ORDER BY line_id) AS seq FROM x1)""")
def q_time_gap(spark, sf_dir):
    """Seconds since the previous line of the same split, first line 0."""
    s = event_log_split(spark, sf_dir)
    return time_gap(s, "seq", "epoch", groups=["split"]).select("split", "line_id", "seq", "time_gap")


CONV = """
WITH cv AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS idx FROM conversations)"""


@register("ngrams", CONV + """
SELECT * FROM (
  SELECT conv_id, turn, lag(role, 2) OVER w AS g1, lag(role, 1) OVER w AS g2, role AS g3, idx
  FROM cv WINDOW w AS (PARTITION BY conv_id ORDER BY idx)) WHERE idx >= 3""")
def q_ngrams(spark, sf_dir):
    """Role 3-grams of each conversation (none when shorter than 3)."""
    cv = dense_index(conversation_roles(spark, sf_dir), ["turn"], out="idx", groups=["conv_id"])
    return row_ngrams(cv, "idx", "role", 3, groups=["conv_id"]).select("conv_id", "turn", "g1", "g2", "g3", "idx")


@register("ngrams_padded", CONV + """,
padded AS (
  SELECT conv_id, idx + 1 AS idx, role FROM cv
  UNION ALL SELECT conv_id, 1, '<s>' FROM cv GROUP BY conv_id
  UNION ALL SELECT conv_id, max(idx) + 2, '</s>' FROM cv GROUP BY conv_id)
SELECT * FROM (
  SELECT conv_id, idx, lag(role) OVER w AS g1, role AS g2 FROM padded WINDOW w AS (PARTITION BY conv_id ORDER BY idx))
WHERE idx >= 2""")
def q_ngrams_padded(spark, sf_dir):
    """W2 + W3: role bigrams with ``<s>`` / ``</s>`` padding on both sides."""
    cv = dense_index(conversation_roles(spark, sf_dir), ["turn"], out="idx", groups=["conv_id"])
    padded = row_pad(cv, "idx", "role", 2, groups=["conv_id"], pad_left=True, pad_right=True,
                     left_pad_symbol="<s>", right_pad_symbol="</s>")
    return row_ngrams(padded, "idx", "role", 2, groups=["conv_id"]).select("conv_id", "idx", "g1", "g2")


@register("distinct_ngrams", LI + """
SELECT c1 AS g1, c2 AS g2, c3 AS g3, y AS g4, CAST(count(*) AS BIGINT) AS cnt, min(seq) AS first_seen
FROM tw GROUP BY c1, c2, c3, y""")
def q_distinct_ngrams(spark, sf_dir):
    """Distinct 4-grams of the train sequence with first position and count."""
    seq = PATH.lineitem_sequence(spark, sf_dir).where(F.col("split") == "train")
    grams = row_ngrams(seq, "seq", "EventId", 4, groups=["split"])
    return distinct_ngrams(grams, "seq", 4)


@register("event_windows", LI + """
SELECT split, seq, c1, c2, c3, y, c1 / k.K AS x1, c2 / k.K AS x2, c3 / k.K AS x3
FROM win, (SELECT max(EventId) + 1 AS K FROM x3 WHERE split = 'train') k""")
def q_event_windows(spark, sf_dir):
    """(3 context events, next event) with the context scaled by K of the train split."""
    seq = PATH.lineitem_sequence(spark, sf_dir)
    win = PATH.path_windows(seq)
    return NE.scale_context(win, PATH.class_count(seq)).select(
        "split", "seq", "c1", "c2", "c3", "y", "x1", "x2", "x3")


@register("event_cardinality", LI + """
SELECT split, CAST(max(EventId) + 1 AS INTEGER) AS K, CAST(count(DISTINCT EventId) + 1 AS BIGINT) AS n_classes
FROM x3 GROUP BY split""")
def q_event_cardinality(spark, sf_dir):
    """A4: classes as max id + 1, and distinct events + 1, per split."""
    seq = PATH.lineitem_sequence(spark, sf_dir)
    return seq.groupBy("split").agg((F.max("EventId") + 1).cast("int").alias("K"),
                                    (F.countDistinct("EventId") + 1).cast("long").alias("n_classes"))


@register("next_event_model", LI + " SELECT level, c1, c2, c3, y, cnt, rank FROM model")
def q_next_event_model(spark, sf_dir):
    """M1: context-count model fitted on the train split."""
    seq = PATH.lineitem_sequence(spark, sf_dir)
    win = PATH.path_windows(seq)
    return NE.fit(win.where(F.col("split") == "train")).select("level", "c1", "c2", "c3", "y", "cnt", "rank")


@register("path_anomalies", LI + f"""
SELECT seq, l_orderkey, l_linenumber, c1, c2, c3, y, level, rank FROM scored
WHERE rank IS NULL OR rank > {PATH.PATH_TOP_K}""")
def q_path_anomalies(spark, sf_dir):
    """M2 / M3 / J-b: test windows whose next event is outside the top 10, traced to the line."""
    _, scored = PATH.execution_path(PATH.lineitem_sequence(spark, sf_dir))
    return scored.where("is_anomaly").select("seq", "l_orderkey", "l_linenumber", "c1", "c2", "c3", "y",
                                             "level", "rank")


@register("next_event_accuracy", LI + f"""
SELECT CAST(count(*) AS BIGINT) AS n_windows,
       CAST(sum(CASE WHEN rank = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_top1,
       CAST(sum(CASE WHEN rank <= {PATH.PATH_TOP_K} THEN 1 ELSE 0 END) AS BIGINT) AS n_topk,
       round(sum(CASE WHEN rank = 1 THEN 1 ELSE 0 END) / count(*), 6) AS acc_top1,
       round(sum(CASE WHEN rank <= {PATH.PATH_TOP_K} THEN 1 ELSE 0 END) / count(*), 6) AS acc_topk
FROM tw JOIN model m ON m.level = 3 AND m.c1 = tw.c1 AND m.c2 = tw.c2 AND m.c3 = tw.c3 AND m.y = tw.y""")
def q_next_event_accuracy(spark, sf_dir):
    """M7: accuracy of the model on its own training windows."""
    seq = PATH.lineitem_sequence(spark, sf_dir)
    win = PATH.path_windows(seq)
    model = NE.fit(win.where(F.col("split") == "train"))
    return NE.accuracy_on_fit(model, PATH.PATH_TOP_K)


@register("next_event_learnt")
def q_next_event_learnt(spark, sf_dir):
    """M1 learnt form: accuracy of the perceptron beside the count model on the test windows (training is not SQL)."""
    _, both = PATH.learnt_path(PATH.lineitem_sequence(spark, sf_dir))
    return both
