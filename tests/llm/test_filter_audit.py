import itertools
import random
import re
from collections import Counter

from logweave.llm import filter_audit as A


def brute(docs, labels):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, _ in docs]
    fails = []
    for (i, t, _), w in zip(docs, words):
        t = t or ""
        fails.append({f for f, bad in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            bool(re.search(r"[#$%&*|]", t)),
            i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs)))  if bad})
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out, total = {}, Counter()
    for part in {lang or "" for *_, lang in docs}:
        mine = [(i, f) for (i, _, lang), f in zip(docs, fails) if (lang or "") == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                all_fails = sum(f in x[1] for x in mine)
                out[part, order, step] = (len(left), len(gone), all_fails - len(gone), sum(x[1] == {f} for x in mine),
                                          sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone))
                total[part, f] += len(gone)
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def make(n, seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["ÉCOLE", "ABC", "x y"]
    docs = []
    for i in range(n):
        kind = rnd.random()
        if docs and kind < .2:
            text = rnd.choice(docs)[1]
        elif kind < .3:
            text = rnd.choice(["", None, " \t\n", "A", "#", "a b"])
        else:
            k = rnd.choice([20, 99, 100, 101, 150])
            text = rnd.choice([" ", "\n", "\t \x0b"]).join(rnd.choices(vocab[:rnd.choice([60, 403])], k=k)) if kind < .9 else "LOUD TEXT " * 60
            text += rnd.choice(["", "", "", "|", " *", " "])
        docs.append((i if rnd.random() < .95 else None, text, rnd.choice(["en", "de", None, ""])))
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, n, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    return docs, labels


def run(spark, docs, labels):
    df = spark.createDataFrame([(*d, 1, 2, 3) for d in docs], "doc_id long, text string, lang string, rid long, prefix int, part int")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = A.filter_audit(df.repartition(3), lab).collect()
    assert len({(r[0], r[1], r[2]) for r in got}) == len(got)
    return {tuple(r[:3]): tuple(r[3:]) for r in got}


def test_against_brute_force(spark):
    docs, labels = make(120, 5)
    docs += docs[:6]  # rows that repeat
    assert run(spark, docs, labels) == brute(docs, labels)


def test_hot_text_and_broadcast_branch(spark, monkeypatch):
    docs, labels = make(40, 6)
    docs += [(1000 + i, "same text " * 60, "en") for i in range(60)]
    want = brute(docs, labels)
    for hot in (0, 2, 4096):  # no, some and all repeated texts by broadcast
        monkeypatch.setattr(A, "HOT", hot)
        assert run(spark, docs, labels) == want


def test_empty_and_very_long(spark):
    assert run(spark, [], []) == {}
    docs = [(1, "word " * 400_000, "en"), (2, " ".join(map(str, range(200_000))), "en")]
    assert run(spark, docs, []) == brute(docs, [])
