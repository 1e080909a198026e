import random

import pytest

from logweave.llm import decontaminate as D


def table(item, text):
    """Smallest edit distance of the item to any stretch of the text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize("seed", range(30))
def test_bit_parallel_distance(seed):
    rnd = random.Random(seed)
    word = lambda n: "".join(rnd.choice("abc") for _ in range(n))
    item, text = word(rnd.randint(1, 90)), word(rnd.randint(0, 150))
    assert D.best_match(D.masks_of(item), len(item), text)[0] == table(item, text)


def fixture():
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(80)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    items = [(i, prose(rnd.randint(6, 40))) for i in range(12)] + [(50, "short"), (51, None), (52, "")]
    items.append((60, items[0][1].upper()))
    docs = [(1, None), (2, ""), (None, items[1][1]), (3, prose(5000) + " " + items[2][1] + " " + prose(2000))]
    for d in range(10, 60):
        t = list(rnd.choice(items[:12])[1])
        for _ in range(rnd.randint(0, 5)):
            p = rnd.randrange(len(t))
            t[p:p + rnd.randint(0, 1)] = rnd.choice(["", "x", " ", "!", "q"])
        docs.append((d, prose(rnd.randint(0, 50)) + ". " + "".join(t) + "\n" + prose(rnd.randint(0, 50))))
    return items, docs + [docs[10]]


def test_against_all_pairs(spark, monkeypatch):
    items, docs = fixture()
    di = spark.createDataFrame(items, "item_id long, text string")
    dd = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int").repartition(3)
    want = []
    for d, t in docs:
        for i, x in items:
            x = D.plain(x)
            if len(x) >= D.MIN_CHARS:
                dist = table(x, D.plain(t))
                if dist <= int(len(x) * D.RATE):
                    want.append((d, i, dist))
    for chars in (4_000_000, 500):
        monkeypatch.setattr(D, "BLOCK_CHARS", chars)
        got = [(r.doc_id, r.item_id, r.edits) for r in D.leaks(dd, di).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert len(want) > 30
    hit = {d for d, _, _ in want}
    kept = D.clean(dd, di).collect()
    assert sorted([r.doc_id for r in kept], key=repr) == sorted([d for d, _ in docs if d not in hit], key=repr)
    assert D.clean(dd, di).columns == dd.columns


def test_empty_tables(spark):
    di = spark.createDataFrame([(1, "some item of twenty chars")], "item_id long, text string")
    dd = spark.createDataFrame([(1, "x some item of twenty chars y")], "doc_id long, text string")
    assert D.leaks(dd.filter("doc_id > 1"), di).count() == 0
    assert D.leaks(dd, di.filter("item_id > 1")).count() == 0
    assert D.leaks(dd, di).count() == 1
