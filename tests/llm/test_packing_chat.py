import itertools
import random
import re
from collections import Counter, defaultdict

import pytest

from logweave.llm import chat_format as C
from logweave.llm import packing as P


def padding(h, ends):
    return sum(n * (min(e for e in ends if e >= v) - v) for v, n in h.items())


@pytest.mark.parametrize("seed", range(8))
def test_boundaries_are_optimal(seed):
    rnd = random.Random(seed)
    h = {rnd.randint(1, 60): rnd.randint(1, 50) for _ in range(9)}
    for k in (1, 2, 3, 20):
        best = min(padding(h, [*c, max(h)]) for c in itertools.combinations(sorted(h), min(k, len(h)) - 1))
        got = P.boundaries(h, k)
        assert len(got) <= k and got == sorted(got) and padding(h, got) == best
    assert P.boundaries({}, 4) == []


def test_pack_keeps_every_token(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join("w" * rnd.randint(1, 3) for _ in range(rnd.randint(0, 90)))) for i in range(300)]
    rows += [(500, None), (501, ""), (502, " \n"), (None, "a b"), (None, "a b"), rows[5], (503, "x " * 1000)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, bucket int").repartition(3)
    got = P.pack(df, max_len=40, buckets=5, budget=200).collect()
    want = Counter()
    for d, t in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) + 1
        for s in range(-(-n // 40)):
            want[d, s, s * 40, min(40, n - s * 40)] += 1
    assert Counter((r.doc_id, r.segment, r.start_token, r.n_tokens) for r in got) == want
    ends = P.boundaries(Counter(r.n_tokens for r in got), 5)
    batches = defaultdict(list)
    for r in got:
        assert r.padded_len == min(e for e in ends if e >= r.n_tokens) == ends[r.bucket]
        batches[r.bucket, r.batch].append(r.slot)
    short = Counter()
    for (b, _), slots in batches.items():
        full = 200 // ends[b]
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= full
        short[b] += len(slots) < full
    assert max(short.values()) <= 1
    assert P.pack(df.filter("doc_id > 900")).count() == 0


def chat(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        safe = lambda v: v.replace("<|", "< |")
        convs[c].append((t if t is not None else 2**62, safe(r if r is not None else "unknown"), safe(x or "")))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        for who in sorted({r for _, r, _ in turns} - {"system"}) or [None]:
            text, loss = "", []
            for _, r, x in turns:
                text += "<|system|>\n" if r == "system" else "<|assistant|>\n" if r == who else f"<|user name={r}|>\n"
                if r == who:
                    loss.append(x + "<|end|>")
                text += x + "<|end|>\n"
            out[c, who] = text, loss
    return out


def rotated(df):
    parts = defaultdict(list)
    for r in C.rotate(df).collect():
        spans = [tuple(map(int, s.split("-"))) for s in r.loss_spans.split(",") if s]
        assert sum(b - a for a, b in spans) == r.n_loss
        parts[r.conv_id, r.perspective].append((r.part, r.block_turn, r.piece, r.text, [r.text[a:b] for a, b in spans], r.n_turns))
    return {k: ("".join(p[3] for p in sorted(v)), [s for p in sorted(v) for s in p[4]], max(p[5] for p in v)) for k, v in parts.items()}


def test_rotation(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|end|> é"), (1, 2, "bob", "yo"), (1, 3, "cy", ""), (1, 4, "ann", None),
            (2, 0, "system", "alone"), (3, 0, None, "who"), (3, None, "bob", "late"), (3, 1, "bob", "x"), (None, 0, "user", "a"),
            (None, 1, "assistant", "b"), (4, 0, "user", "same"), (4, 0, "user", "same")]
    rows += [(5, i, ("ann", "bob")[i % 2], f"t{i}") for i in range(200)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int")
    got = rotated(df)
    want = chat(rows)
    assert set(got) == set(want)
    for k, (text, loss) in want.items():
        assert got[k][:2] == (text, loss), k
    assert C.rotate(df.filter("conv_id > 9")).count() == 0


def test_a_hot_conversation_is_split(spark):
    rows = [(1, i // 900, ("ann", "bob")[i % 2], f"text {i}") for i in range(2700)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = rotated(df)
    for who in ("ann", "bob"):
        text, loss, most = got[1, who]
        assert most <= C.BLOCK_ROWS
        assert Counter(re.findall(r"text \d+", text)) == Counter(r[3] for r in rows)
        assert len(loss) == 1350
        at = [int(x) // 900 for x in re.findall(r"text (\d+)", text)]
        assert at == sorted(at)


def test_equal_rows_of_a_hot_turn_are_split(spark):
    df = spark.range(5000, numPartitions=3).selectExpr("7L as conv_id", "3L as turn", "'ann' as role", "'same' as text")
    blocks = C.blocks(df).selectExpr("part", "block_turn", "piece", "size(turns) as n").collect()
    assert sum(b.n for b in blocks) == 5000 and max(b.n for b in blocks) <= C.BLOCK_ROWS
    assert sorted(blocks) == sorted(C.blocks(df.repartition(5)).selectExpr("part", "block_turn", "piece", "size(turns) as n").collect())
    text, loss, _ = rotated(df)[7, "ann"]
    assert text == "<|assistant|>\nsame<|end|>\n" * 5000 and loss == ["same<|end|>"] * 5000


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, 0, "a", "b")], "conv_id long, turn long, role string, text string")
    plan = C.rotate(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
