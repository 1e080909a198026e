"""Queries for frequency tables (F1-F13, W6, K1, K2, U7) over document words."""

from __future__ import annotations

from pyspark.sql import functions as F

from logweave.operators import freq as FQ
from logweave.plans.catalog import register
from logweave.plans.oracle_views import BENCH_FREQ, BENCH_WORDS, DOC_FREQ, DOC_WORDS, with_views
from logweave.sources.derived import words

DOC = with_views(DOC_WORDS, DOC_FREQ)
BOTH = with_views(DOC_WORDS, DOC_FREQ, BENCH_WORDS, BENCH_FREQ)
TOP_K = 25


def doc_fd(spark, sf_dir):
    return FQ.freqdist(words(spark, sf_dir, "documents"), "sample", "pos")


def bench_fd(spark, sf_dir):
    return FQ.freqdist(words(spark, sf_dir, "benchmark"), "sample", "pos")


@register("freqdist", DOC + " SELECT sample, cnt, first_seen FROM dfq")
def q_freqdist(spark, sf_dir):
    return doc_fd(spark, sf_dir)


@register("freq_totals", DOC + " SELECT CAST(sum(cnt) AS BIGINT) AS N, CAST(count(*) AS BIGINT) AS B FROM dfq")
def q_freq_totals(spark, sf_dir):
    return FQ.totals(doc_fd(spark, sf_dir))


@register("freq_hapaxes", DOC + " SELECT sample FROM dfq WHERE cnt = 1")
def q_freq_hapaxes(spark, sf_dir):
    return FQ.hapaxes(doc_fd(spark, sf_dir))


@register("freq_of_freq", BOTH + """
SELECT cnt AS r, CAST(count(*) AS BIGINT) AS Nr FROM dfq GROUP BY cnt
UNION ALL
SELECT 0, CAST((SELECT count(*) FROM (SELECT sample FROM dfq UNION SELECT sample FROM bfq))
               - (SELECT count(*) FROM dfq) AS BIGINT)""")
def q_freq_of_freq(spark, sf_dir):
    """F5 with ``bins`` = distinct words of documents and benchmark together."""
    fd = doc_fd(spark, sf_dir)
    vocab = fd.select("sample").unionByName(bench_fd(spark, sf_dir).select("sample")).distinct()
    return FQ.freq_of_freq(fd, vocab.agg(F.count(F.lit(1)).alias("bins")))


@register("freq_relative", DOC + " SELECT sample, cnt / (SELECT sum(cnt) FROM dfq) AS freq FROM dfq")
def q_freq_relative(spark, sf_dir):
    return FQ.relative(doc_fd(spark, sf_dir))


@register("freq_max", DOC + " SELECT sample, cnt FROM dfq ORDER BY cnt DESC, first_seen, sample LIMIT 1")
def q_freq_max(spark, sf_dir):
    return FQ.max_sample(doc_fd(spark, sf_dir))


@register("freq_topk", DOC + f"""
SELECT sample, cnt, row_number() OVER (ORDER BY cnt DESC, first_seen, sample) AS rank,
       sum(cnt) OVER (ORDER BY cnt DESC, first_seen, sample ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_cnt
FROM dfq ORDER BY cnt DESC, first_seen, sample LIMIT {TOP_K}""")
def q_freq_topk(spark, sf_dir):
    """K2: the top-k report (the limit is the feature), with cumulative counts."""
    return FQ.cumulative(doc_fd(spark, sf_dir), n=TOP_K).select("sample", "cnt", "rank", "cum_cnt")


@register("freq_cumulative", DOC + """
SELECT sample, cnt, row_number() OVER w AS rank, sum(cnt) OVER w AS cum_cnt,
       sum(cnt) OVER w / (SELECT sum(cnt) FROM dfq) * 100 AS cum_pct
FROM dfq WINDOW w AS (ORDER BY cnt DESC, first_seen, sample ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_freq_cumulative(spark, sf_dir):
    """W6 over the whole table: distributed rank, then a chunked running sum."""
    return FQ.cumulative(doc_fd(spark, sf_dir), percents=True).select("sample", "cnt", "rank", "cum_cnt", "cum_pct")


@register("freq_add", BOTH + """
SELECT sample, CAST(sum(cnt) AS BIGINT) AS cnt FROM (SELECT sample, cnt FROM dfq UNION ALL SELECT sample, cnt FROM bfq)
GROUP BY sample HAVING sum(cnt) > 0""")
def q_freq_add(spark, sf_dir):
    return FQ.add(doc_fd(spark, sf_dir), bench_fd(spark, sf_dir))


@register("freq_sub", BOTH + """
SELECT d.sample, CAST(d.cnt - coalesce(b.cnt, 0) AS BIGINT) AS cnt FROM dfq d LEFT JOIN bfq b USING (sample)
WHERE d.cnt - coalesce(b.cnt, 0) > 0""")
def q_freq_sub(spark, sf_dir):
    return FQ.subtract(doc_fd(spark, sf_dir), bench_fd(spark, sf_dir))


@register("freq_union", BOTH + """
SELECT sample, CAST(max(cnt) AS BIGINT) AS cnt FROM (SELECT sample, cnt FROM dfq UNION ALL SELECT sample, cnt FROM bfq)
GROUP BY sample HAVING max(cnt) > 0""")
def q_freq_union(spark, sf_dir):
    return FQ.union_max(doc_fd(spark, sf_dir), bench_fd(spark, sf_dir))


@register("freq_intersect", BOTH + """
SELECT sample, CAST(least(d.cnt, b.cnt) AS BIGINT) AS cnt FROM dfq d JOIN bfq b USING (sample)""")
def q_freq_intersect(spark, sf_dir):
    return FQ.intersect_min(doc_fd(spark, sf_dir), bench_fd(spark, sf_dir))


@register("freq_subset", BOTH + """
SELECT coalesce(sum(CASE WHEN coalesce(b.cnt,0) > coalesce(d.cnt,0) THEN 1 ELSE 0 END), 0) = 0 AS le,
       coalesce(sum(CASE WHEN coalesce(d.cnt,0) > coalesce(b.cnt,0) THEN 1 ELSE 0 END), 0) = 0 AS ge,
       coalesce(sum(CASE WHEN coalesce(b.cnt,0) > coalesce(d.cnt,0) THEN 1 ELSE 0 END), 0) = 0
         AND coalesce(sum(CASE WHEN coalesce(d.cnt,0) > coalesce(b.cnt,0) THEN 1 ELSE 0 END), 0) > 0 AS lt,
       coalesce(sum(CASE WHEN coalesce(d.cnt,0) > coalesce(b.cnt,0) THEN 1 ELSE 0 END), 0) = 0
         AND coalesce(sum(CASE WHEN coalesce(b.cnt,0) > coalesce(d.cnt,0) THEN 1 ELSE 0 END), 0) > 0 AS gt,
       coalesce(sum(CASE WHEN coalesce(b.cnt,0) <> coalesce(d.cnt,0) THEN 1 ELSE 0 END), 0) = 0 AS eq
FROM bfq b FULL OUTER JOIN dfq d USING (sample)""")
def q_freq_subset(spark, sf_dir):
    """is the benchmark word multiset contained in the documents' one?"""
    return FQ.compare(bench_fd(spark, sf_dir), doc_fd(spark, sf_dir))


@register("freq_edit", DOC + """
SELECT sample, cnt FROM dfq WHERE sample NOT IN ('the', 'de')
UNION ALL SELECT 'the', 1
UNION ALL SELECT 'zz-new', 3 WHERE NOT EXISTS (SELECT 1 FROM dfq WHERE sample = 'zz-new')
UNION ALL SELECT 'und', 5 WHERE NOT EXISTS (SELECT 1 FROM dfq WHERE sample = 'und')""")
def q_freq_edit(spark, sf_dir):
    """``fd['the'] = 1``, ``del fd['de']``, ``setdefault('zz-new', 3)``, ``setdefault('und', 5)``."""
    fd = FQ.set_count(doc_fd(spark, sf_dir), "the", 1)
    fd = FQ.delete(fd, "de")
    fd = FQ.setdefault(fd, "zz-new", 3)
    return FQ.setdefault(fd, "und", 5)
