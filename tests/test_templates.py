"""Template mining: masking samples, leaf-parallel miner = sequential miner, match paths agree."""

import random

import pytest
from pyspark.sql import functions as F

from logweave.operators import templates as T

PARAM = "<*>"


def sequential_mine(lines, sim_th=0.4, max_children=100):
    """Plain sequential reference (one pass over all lines, prefix tree of depth 4)."""
    nodes = {}
    clusters = []  # [template, size]
    for toks in lines:
        n = len(toks)
        node = nodes.setdefault(n, {"children": {}, "wild": False})
        if n <= 1:
            key = None
        else:
            first = toks[0]
            if first in node["children"]:
                key = first
            elif any(ch.isdigit() for ch in first):
                if not node["wild"]:
                    node["wild"] = True
                    node["children"][PARAM] = []
                key = PARAM
            else:
                count = len(node["children"])
                if node["wild"]:
                    own = count < max_children
                else:
                    own = count + 1 < max_children
                    if not own and count + 1 == max_children:
                        node["wild"] = True
                        node["children"][PARAM] = []
                if own:
                    node["children"][first] = []
                    key = first
                else:
                    key = PARAM
        leaf = node.setdefault("leaf", {}).setdefault(key, [])
        best, best_sim, best_params = None, -1.0, -1
        if n == 0 and leaf:
            best, best_sim = leaf[0], 1.0
        for ci in (leaf if n else []):
            tpl = clusters[ci][0]
            sim = sum(1 for a, b in zip(tpl, toks) if a != PARAM and a == b) / n
            params = sum(1 for a in tpl if a == PARAM)
            if sim > best_sim or (sim == best_sim and params > best_params):
                best, best_sim, best_params = ci, sim, params
        if best is not None and best_sim >= sim_th:
            clusters[best][0] = [a if a == b else PARAM for a, b in zip(clusters[best][0], toks)]
            clusters[best][1] += 1
        else:
            clusters.append([list(toks), 1])
            leaf.append(len(clusters) - 1)
    return [(" ".join(t), s) for t, s in clusters]


def random_lines(seed, n=400):
    rnd = random.Random(seed)
    firsts = ["alpha", "beta", "gamma", "delta", "eps", "x1", "9z", "zeta"]
    words = ["a", "b", "c", "d", "on", "off", "up", "down"]
    out = []
    for _ in range(n):
        k = rnd.randint(0, 6)
        toks = ([rnd.choice(firsts)] if k else []) + [rnd.choice(words) for _ in range(max(k - 1, 0))]
        out.append(toks)
        if rnd.random() < 0.2:
            out.append(list(toks))  # consecutive repeat
    return out


@pytest.mark.parametrize("seed,max_children", [(1, 3), (2, 4), (3, 100)])
def test_leaf_parallel_equals_sequential(spark, seed, max_children):
    lines = random_lines(seed)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "pos long, tokens array<string>")
    keyed = T.leaf_keys(df, "tokens", "pos", max_children=max_children)
    cat = T.catalogue(T.mine(keyed)).orderBy("cluster_id").collect()
    assert [(r.template, r.size) for r in cat] == sequential_mine(lines, max_children=max_children)
    cat2 = T.catalogue(T.mine(keyed))
    a = sorted((r.pos, r.EventId) for r in T.match(keyed, cat2).collect())
    b = sorted((r.pos, r.EventId) for r in T.match_join(keyed, cat2).collect())
    assert a == b
    # with templates fitted on every line, each line matches some template
    assert all(e is not None for _, e in a)


def test_masking_samples(spark):
    samples = {"10.0.0.1": "<:IP:>", "0xFF": "<:HEX:>", "-5": "<:NUM:>", "aa:bb:cc:dd": "<:ID:>",
               "deadbeef abcdef01 deadbeef": "<:SEQ:>", 'executed cmd "ls"': "executed cmd <:CMD:>",
               "٣": "<:NUM:>", "1-2": "<:NUM:>-<:NUM:>", "ab12 3": "ab12 <:NUM:>"}
    df = spark.createDataFrame([(k,) for k in samples], "c string")
    lit = {r.c: r.m for r in df.select("c", T.mask(F.col("c")).alias("m")).collect()}
    fast = {r.c: r.m for r in T.mask_column(df, "c", "m").collect()}
    assert lit == samples and fast == samples


def test_tokenize_and_values(spark):
    df = spark.createDataFrame([("  a_b  c　d ",), ("",)], "c string")
    toks = [r.t for r in df.select(T.tokenize(F.col("c")).alias("t")).collect()]
    assert toks == [["a", "b", "c", "d"], []]
    v = spark.range(1).select(T.template_values(F.array(*[F.lit(x) for x in ["u", "7", "x"]]),
                                                F.array(*[F.lit(x) for x in ["u", PARAM, PARAM]])).alias("v"))
    assert v.first().v == ["7", "x"]


def test_new_lines_are_routed_by_the_tree_that_mined(spark):
    """Foreign lines meet the catalogue's own leaves, whatever first words they have themselves."""
    mined = [[f, "x", str(k % 3)] for k, f in enumerate(["alpha", "beta", "alpha", "gamma", "gamma", "delta"])]
    new = [["omega", "x", "1"], ["gamma", "x", "9"], ["alpha", "y", "z"], ["delta", "x", "2"], ["beta"]]
    rows = lambda lines: spark.createDataFrame(list(enumerate(lines)), "pos long, tokens array<string>")
    own = T.own_leaves(rows(mined), max_children=3)
    assert sorted((r.n_tokens, r.first) for r in own.collect()) == [(3, "alpha"), (3, "beta")]
    cat = T.catalogue(T.mine(T.route(rows(mined), own)))
    got = {r.pos: r.EventTemplate for r in T.match(T.route(rows(new), own), cat).collect()}
    leaves = {}
    for r in cat.collect():
        leaves.setdefault((r.n_tokens, r.leaf_token), []).append(r.tokens)
    for pos, toks in enumerate(new):
        leaf = None if len(toks) < 2 else toks[0] if toks[0] in ("alpha", "beta") else PARAM
        fits = [t for t in leaves.get((len(toks), leaf), []) if all(a in (PARAM, b) for a, b in zip(t, toks))]
        assert (got[pos] is not None) == bool(fits), toks
    assert got[3] is not None and got[4] is None


def test_a_hot_leaf_is_matched_by_several_tasks(spark):
    df = spark.range(3000).select("id", F.array(F.lit("hot"), F.concat(F.lit("w"), F.col("id").cast("string"))).alias("tokens"))
    keyed = T.leaf_keys(df.withColumnRenamed("id", "pos"))
    assert keyed.select("leaf_token").distinct().count() == 1
    cat = T.catalogue(T.mine(keyed))
    both = T._sorted_match_input(keyed.select("n_tokens", "leaf_token", "tokens").distinct(), cat, ["n_tokens", "leaf_token", "tokens"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these few rows would become one task
    try:
        sizes = [n for n in both.where("_kind = 1").rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect() if n]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1 and max(sizes) < 3000
    assert T.match(keyed, cat).where("match = 1").count() == 3000


def test_line_order_holds_beyond_32_bits(spark):
    big = 2**33
    df = spark.createDataFrame([(big, 2), (big, 1), (2**41, 0), (5, 2**40)], "hi long, lo long")
    got = [tuple(r) for r in df.orderBy(T.order_key(F.col("hi"), F.col("lo"))).collect()]
    assert got == [(5, 2**40), (big, 1), (big, 2), (2**41, 0)]


def test_a_user_rule_is_not_guarded_by_its_name(spark):
    df = spark.createDataFrame([("port abc down",)], "c string")
    assert T.mask_column(df, "c", "m", [("abc", "NUM")]).first().m == "port <:NUM:> down"


def test_a_text_is_tokenized_and_kept_by_one_search(spark):
    """no stripping before the split; blanks of every kind at both ends and between."""
    from logweave.functions.parse import strip_u
    odd = ["", " ", "a", " a", "a ", "\t a__b　c \r\n", "_", "__a_", "\u0085x y ", "\x1c a", "a\x0bb", "x \n", "\n x", "​z", "  q ", None]
    df = spark.createDataFrame([(t,) for t in odd], "t string")
    stripped = strip_u(F.translate("t", "_", " "))
    before = F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, r"(?U)\s+"))
    got = df.select("t", T.tokenize(F.col("t")).alias("now"), before.alias("before"), F.coalesce(F.length(strip_u(F.col("t"))) > 0, F.lit(False)).alias("kept"))
    rows = got.collect()
    assert all(r.now == r.before for r in rows) and rows[5].now == ["a", "b", "c"]
    assert {r.t for r in got.where("kept").collect()} == {r.t for r in df.where(F.col("t").rlike(r"(?U)\S")).collect()}
    plan = df.select(T.tokenize(F.col("t")).alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and plan.count("split(") == 1
