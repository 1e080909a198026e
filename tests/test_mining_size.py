"""What mining and matching hold in a task and move between tasks (findings F1 to F4, F6, F7)."""

import random
import tracemalloc

from pyspark.sql import functions as F

import logweave.session
from logweave.operators import templates as T
from logweave.plans import mining as MI


def frame(spark, lines):
    return spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "pos long, tokens array<string>")


def unlike_lines(n, width=6, seed=3):
    rnd = random.Random(seed)
    return [["the"] + [f"w{rnd.randrange(4000)}" for _ in range(width - 1)] for _ in range(n)]


def test_lines_meet_their_templates_in_one_exchange(spark):
    """no distinct shapes, no join of the lines to their shapes and of those to the template texts."""
    keyed = MI.materialize_table(T.leaf_keys(frame(spark, unlike_lines(60))), "keyed")
    matched = T.match(keyed, T.catalogue(T.mine(keyed)))
    assert matched.where("match = 1").count() == 60
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_templates_are_not_copied_for_a_few_more_lines_than_templates(spark):
    """1,300 lines on 1,100 templates are one task's work, not two with a copy of the templates each."""
    lines = [["hot", f"a{i}", f"b{i}", f"c{i}", f"d{i}"] for i in range(1100)]
    keyed = T.leaf_keys(frame(spark, lines + [["hot", f"a{i}", f"b{i}", f"c{i}", "z"] for i in range(200)]))
    cat = T.catalogue(T.mine(T.leaf_keys(frame(spark, lines))))
    both = T._sorted_match_input(keyed.select("pos", "n_tokens", "leaf_token", "tokens"), cat, ["n_tokens", "leaf_token", "tokens"])
    kinds = {r["_kind"]: r["count"] for r in both.groupBy("_kind").count().collect()}
    assert kinds == {0: 1100, 1: 1300}


def test_text_of_the_line_is_not_written_beside_its_tokens(spark):
    """the queries that give back no line write its tokens alone."""
    lines = spark.createDataFrame([(1, "a b 7"), (2, "c_d")], "pos long, content string")
    keyed = MI.keyed_lines(lines, text=False)
    assert "content" not in keyed.columns
    assert [r.tokens for r in keyed.orderBy("pos").collect()] == [["a", "b", "<:NUM:>"], ["c", "d"]]
    assert "content" in MI.keyed_lines(lines).columns


def test_a_cluster_takes_little_memory():
    """token numbers and postings instead of texts and sets."""
    lines = unlike_lines(8000, width=20)
    tracemalloc.start()
    clusters = T.LeafClusters()
    for pos, toks in enumerate(lines):
        clusters.add(pos, list(toks))
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(clusters.sizes) == 8000
    assert held / 8000 < 2000  # 1,331 measured, 3,191 before; most of it are the 76,000 pairs of position and token


def test_a_line_is_compared_with_few_clusters(monkeypatch):
    """a word that all lines share does not bring all clusters up for comparison."""
    near, plain = [], T.LeafClusters._closest

    def counted(self, line, candidates, need):
        near.append(len(self.sizes) if candidates is None else len(candidates))
        return plain(self, line, candidates, need)

    monkeypatch.setattr(T.LeafClusters, "_closest", counted)
    clusters = T.LeafClusters()
    for pos, toks in enumerate(unlike_lines(6000)):
        clusters.add(pos, toks)
    assert len(clusters.sizes) > 5500 and max(near[-1000:]) < 200


def test_a_stale_posting_names_no_cluster():
    """A token that a wildcard replaced still leads to its cluster, which must not count it."""
    clusters = T.LeafClusters(0.6)
    for pos in range(T.COMPARED + 10):
        clusters.add(pos, [f"{c}{pos}" for c in "abcde"])
    at = clusters.best(["a3", "b3", "c3", "x", "y"])
    assert at == 3
    clusters.add(1000, ["a3", "b3", "c3", "x", "y"])
    assert clusters.template(3) == ["a3", "b3", "c3", T.PARAM, T.PARAM]
    assert clusters.best(["q", "b3", "c3", "d3", "e3"]) == -1


def test_chunks_are_dealt_without_moving_the_tokens(spark, monkeypatch):
    """only the positions of a large leaf are sorted and written; equal and null positions stay in one leaf's chunks."""
    written, plain = [], logweave.session.materialize

    def noted(df, name):
        written.append((name, df.columns))
        return plain(df, name)

    monkeypatch.setattr(logweave.session, "materialize", noted)
    keyed = T.leaf_keys(frame(spark, [["hot", str(i)] for i in range(250)] + [["cold", "x", "y"]]))
    sizes = keyed.groupBy("n_tokens", "leaf_token").agg(F.count("*").alias("added")).withColumn("before", F.lit(130))
    got = {(r.n_tokens, r.pos): r.piece for r in T._into_chunks(keyed, sizes, 100, 1).collect()}
    assert all("tokens" not in columns for name, columns in written if name == "dense-index")
    assert [got[2, i] for i in (0, 69, 70, 169, 170, 249)] == [1, 1, 2, 2, 3, 3]
    assert len(got) == 251
