import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from logweave.llm import prefix_trie as P

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int, words int"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def mark(x):
    role, text = x
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, mark((role or "", text or "")), (role or "", text or "")))
    own = {c: [x[-1] for x in sorted(t)] for c, t in own.items()}
    built = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + t[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
            if d:
                children[built[c][:d - 1]].add(built[c][:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * words
    return sorted((m[0], len(p), members[p[:-1]][0] if p else -1, len(m), len(children[p]), leaves[p], saved[p],
                   sha(",".join(str(c) for c in m if len(built[c]) == len(p)))) for p, m in members.items())


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    out = P.prefix_trie(df.repartition(4))
    assert tuple(out.columns) == COLUMNS
    return sorted(tuple(-1 if v is None else v for v in r) for r in out.collect())


def conversations(n, seed, deepest):
    rnd = random.Random(seed)
    texts = ["", None, "a b", "a  b\n", "long text of many words", " \t", "ü ç", "x"]
    trunk = [(rnd.choice(["user", "assistant", None]), rnd.choice(texts)) for _ in range(deepest)]
    rows = []
    for c in rnd.sample(range(5 * n), n):
        k = rnd.choice([1, 2, 3, 5, deepest])
        cut = rnd.randrange(k + 1)
        turns = trunk[:cut] + [(rnd.choice(["user", "tool"]), rnd.choice(texts)) for _ in range(k - cut)]
        numbers = rnd.choice([list(range(k)), [None, *range(1, k)], [7 * i for i in range(k)]])
        rows += [(c, t, *x) for t, x in zip(numbers, turns)]
    return rows


@pytest.mark.parametrize("block, hot", [(64, 4096), (4, 2)])
def test_against_brute_force(spark, monkeypatch, block, hot):
    monkeypatch.setattr(P, "BLOCK", block)
    monkeypatch.setattr(P, "HOT", hot)
    rows = conversations(60, 11, 13)
    rows += rows[:9] + [(None, 0, "user", "no id"), (40, None, "user", "same"), (40, None, "user", "same")]
    assert run(spark, rows) == brute(rows)


def test_many_copies_of_one_conversation_and_long_tails(spark, monkeypatch):
    monkeypatch.setattr(P, "SALT", 16)
    turns = [("user", "hello there"), ("assistant", "general"), ("user", "bye now")]
    rows = [(c, t, *x) for c in range(100, 900) for t, x in enumerate(turns)]
    rows += [(2000, t, "user", f"turn {t}") for t in range(300)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert max(r[3] for r in got) == 801


def test_turnless_conversations_and_empty_table(spark):
    assert run(spark, []) == []
    rows = [(c, 0, None, None) for c in range(21, 40)]  # the base is absent: those that lend or drop their turn are turnless
    got = run(spark, rows)
    assert got == brute(rows) and got[0][:2] == (21, 0)


def test_text_of_a_million_words(spark):
    rows = [(c, 0, "user", "word " * 1_000_000) for c in (0, 1, 2, 3)]
    assert run(spark, rows) == brute(rows)
