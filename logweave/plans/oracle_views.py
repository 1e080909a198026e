"""SQL text of the derived views, for the DuckDB oracle (FIXTURES section B).

The same views are built with the DataFrame API in ``logweave.sources.derived``.
"""

X1_LINES = """
x1 AS (
  SELECT event_id + 1 AS line_id, ts, event_type,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') || '|' || event_type || '|' ||
         CASE event_type WHEN 'error' THEN 'link disabled on port'
                         WHEN 'signup' THEN 'memory alarm raised on host'
                         WHEN 'purchase' THEN 'memory usage resumed alarm cleared'
                         ELSE 'heartbeat from host' END AS line,
         CASE event_type WHEN 'error' THEN 'link disabled on port'
                         WHEN 'signup' THEN 'memory alarm raised on host'
                         WHEN 'purchase' THEN 'memory usage resumed alarm cleared'
                         ELSE 'heartbeat from host' END AS message,
         CAST(floor(epoch(date_trunc('second', ts))) AS BIGINT) AS epoch,
         CAST(floor(epoch(date_trunc('second', ts)) / 300) AS BIGINT) AS time_bucket
  FROM events
)"""

X2_LINES = """
x2 AS (
  SELECT doc_id, CAST(unnest(generate_series(1, len(parts))) AS BIGINT) AS line_no, unnest(parts) AS line
  FROM (SELECT doc_id, string_split_regex(text, '\\r\\n|\\r|\\n') AS parts FROM documents)
)"""

X3_CODES = """
x3 AS (
  SELECT row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                     l_quantity, l_extendedprice, l_discount, l_tax,
                                     l_returnflag, l_linestatus) AS seq,
         l_returnflag || l_linestatus || CAST(l_linenumber AS VARCHAR) AS code, l_shipdate
  FROM lineitem
)"""


def with_views(*views: str) -> str:
    return "WITH " + ",".join(views)


def words_view(name: str, source: str, id_col: str) -> str:
    return f"""
{name} AS (
  SELECT sample, pos FROM (
    SELECT unnest(parts) AS sample,
           {id_col} * 4294967296 + unnest(generate_series(1, len(parts))) AS pos
    FROM (SELECT {id_col}, string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+') AS parts FROM {source}))
  WHERE sample <> ''
)"""


DOC_WORDS = words_view("dw", "documents", "doc_id")
BENCH_WORDS = words_view("bw", "benchmark", "item_id")
DOC_FREQ = "dfq AS (SELECT sample, CAST(count(*) AS BIGINT) AS cnt, min(pos) AS first_seen FROM dw GROUP BY sample)"
BENCH_FREQ = "bfq AS (SELECT sample, CAST(count(*) AS BIGINT) AS cnt, min(pos) AS first_seen FROM bw GROUP BY sample)"


LI_EVENTS = """
li AS (
  SELECT *, CASE WHEN l_shipdate < TIMESTAMP '1998-06-01' THEN 'train' ELSE 'test' END AS split,
         l_returnflag || l_linestatus || CAST(l_linenumber AS VARCHAR) AS code
  FROM lineitem),
codes AS (SELECT code, CAST(dense_rank() OVER (ORDER BY code) AS INTEGER) AS EventId FROM (SELECT DISTINCT code FROM li)),
x3 AS (
  SELECT li.split, CAST(row_number() OVER (PARTITION BY li.split ORDER BY l_shipdate, l_orderkey, l_linenumber,
           l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS BIGINT) AS seq,
         codes.EventId, li.code, li.l_orderkey, li.l_linenumber
  FROM li JOIN codes USING (code))"""

# Path model over a view ``win`` (split, seq, c1, c2, c3, y): training windows, model, scored test windows.
PATH_MODEL = """
tw AS (SELECT * FROM win WHERE split = 'train'),
model AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY level, c1, c2, c3 ORDER BY cnt DESC, y) AS BIGINT) AS rank FROM (
    SELECT 3 AS level, c1, c2, c3, y, CAST(count(*) AS BIGINT) AS cnt FROM tw GROUP BY c1, c2, c3, y
    UNION ALL SELECT 2, NULL, c2, c3, y, count(*) FROM tw GROUP BY c2, c3, y
    UNION ALL SELECT 1, NULL, NULL, c3, y, count(*) FROM tw GROUP BY c3, y
    UNION ALL SELECT 0, NULL, NULL, NULL, y, count(*) FROM tw GROUP BY y)),
scored AS (
  SELECT t.*, m.rank FROM (
    SELECT w.*, CASE WHEN s3.c1 IS NOT NULL THEN 3 WHEN s2.c2 IS NOT NULL THEN 2 WHEN s1.c3 IS NOT NULL THEN 1 ELSE 0 END AS level
    FROM (SELECT * FROM win WHERE split = 'test') w
    LEFT JOIN (SELECT DISTINCT c1, c2, c3 FROM tw) s3 ON w.c1 = s3.c1 AND w.c2 = s3.c2 AND w.c3 = s3.c3
    LEFT JOIN (SELECT DISTINCT c2, c3 FROM tw) s2 ON w.c2 = s2.c2 AND w.c3 = s2.c3
    LEFT JOIN (SELECT DISTINCT c3 FROM tw) s1 ON w.c3 = s1.c3) t
  LEFT JOIN model m ON m.level = t.level AND m.y = t.y
    AND m.c1 IS NOT DISTINCT FROM (CASE WHEN t.level >= 3 THEN t.c1 END)
    AND m.c2 IS NOT DISTINCT FROM (CASE WHEN t.level >= 2 THEN t.c2 END)
    AND m.c3 IS NOT DISTINCT FROM (CASE WHEN t.level >= 1 THEN t.c3 END))"""

LI_SEQ = LI_EVENTS + "," + """
win AS (
  SELECT * FROM (
    SELECT split, seq, l_orderkey, l_linenumber,
           lag(EventId, 3) OVER w AS c1, lag(EventId, 2) OVER w AS c2, lag(EventId, 1) OVER w AS c3, EventId AS y
    FROM x3 WINDOW w AS (PARTITION BY split ORDER BY seq)) WHERE seq >= 4)""" + "," + PATH_MODEL
