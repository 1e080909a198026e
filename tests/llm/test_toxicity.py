import random
import zlib

import numpy as np
import pytest

from logweave.llm import toxicity as T

TERMS = ["blargh", "snorfle", "grumblewort", "vexbag"]
CLEAN = ["the", "meadow", "river", "quiet", "stone", "bright", "winter", "garden", "lantern", "harbour", "copper", "walnut", "vexing",
         "snorkel", "blank"]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, prev = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("most", [5, 100_000])
def test_automaton_against_dynamic_programme(most):
    rnd = random.Random(2)
    words = {"".join(rnd.choices("abcd", k=rnd.randint(2, 11))): rnd.random() for _ in range(60)}
    auto = T.Automaton(words, most_states=most)
    for _ in range(3000):
        w = "".join(rnd.choices("abcde", k=rnd.randint(0, 12)))
        if rnd.random() < .5:
            w = rnd.choice(list(words))
            for _ in range(rnd.randint(0, 2)):
                i = rnd.randrange(len(w) + 1)
                w = rnd.choice([w[:i] + w[i + 1:], w[:i] + "x" + w[i:], w[:i] + "a" + w[i + 1:]])
        near = [(levenshtein(w, t), -v, t) for t, v in words.items() if levenshtein(w, t) <= T.budget(t)]
        got = auto.find(w)
        assert got == ((min(near)[2], min(near)[0]) if near else None)


def lexicon():
    return T.Lexicon({t: 4.0 for t in TERMS}, {"zzyx": 3.0}, frozenset({"snorfl"}))


def test_weights_of_exact_misspelt_and_known_words():
    lex = lexicon()
    assert lex.weight("blargh") == 4.0 and lex.weight("zzyxing") == 3.0
    assert lex.weight("blarg") == lex.weight("bl@rgh") == lex.weight("grumblwort") == lex.weight("grumbelwort") == 4.0 * T.FUZZY
    assert lex.weight("snorfl") == lex.weight("meadow") == lex.weight("bla") == 0.0


def test_context_separates_quotation_from_abuse():
    lex = lexicon()
    plain, words = T.evidence("you are a blargh today", lex)
    assert (plain, words) == (4.0, 5)
    for quoted in ('they wrote "blargh" here', "they are “blargh” here", "„blargh“ ist alt", "> you blargh", "the old line\n> blargh\n"):
        assert T.evidence(quoted, lex)[0] < plain / 2
    assert T.evidence("blargh, said the river", lex)[0] == pytest.approx(4.0 * (1 - T.REPORTED))
    assert T.evidence("blargh vexbag", lex)[0] == pytest.approx(2 * 4.0 * (1 + T.NEAR))
    assert T.evidence('"open line\nblargh', lex)[0] == 4.0  # a quotation ends with its line


def test_long_texts_are_read_whole(monkeypatch):
    lex = lexicon()
    text = "meadow river " * 200 + "blargh " + "stone " * 300 + "vexbag"
    whole = T.evidence(text, lex)
    monkeypatch.setattr(T, "SEGMENT", 50)
    assert "".join(T.segments(text, 50)) == text
    assert T.evidence(text, lex) == whole == (8.0, 400 + 1 + 300 + 1)
    assert T.evidence("x" * 500, lex) == (0.0, 1)


def test_fit_recovers_a_steep_boundary():
    cells = np.array([[0, 0, 900, 5], [2, 3, 50, 48], [3, 4, 20, 20.0]])
    w = T.fit(cells)
    p = 1 / (1 + np.exp(-(np.column_stack([np.ones(3), cells[:, :2]]) @ w)))
    assert p[0] < .02 and p[1] > .8 and p[2] > .9


def corpus(n, seed):
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = rnd.choices(CLEAN, k=rnd.randint(5, 60))
        toxic = rnd.random() < .2
        if toxic:
            for _ in range(rnd.randint(2, 5)):
                t = rnd.choice(TERMS)
                if rnd.random() < .3:
                    k = rnd.randrange(1, len(t))
                    t = t[:k] + rnd.choice("qk") + t[k + 1:]
                words.insert(rnd.randrange(len(words)), t)
        docs.append((i, " ".join(words), int(toxic)))
        labels.append((i, int(toxic)))
    return docs, labels


def run(spark, docs, labels):
    df = spark.createDataFrame([(d, t, "en", 1.0, 7) for d, t in docs], "doc_id long, text string, lang string, e double, n int")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    out = T.toxicity(df.repartition(3), lab)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    return out.collect()


def test_held_out_accuracy_and_labels_are_never_inputs(spark):
    docs, labels = corpus(900, 4)
    got = {r.doc_id: r for r in run(spark, [d[:2] for d in docs], labels)}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= .5)
    held = [(d, got[d[0]]) for d in docs if got[d[0]].held_out]
    assert len(held) > 100 and np.mean([r.predicted == d[2] for d, r in held]) > .97
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    assert sorted(run(spark, [d[:2] for d in docs], flipped)) == sorted(got.values())


def test_nulls_empties_repeats_ties(spark):
    docs, labels = corpus(300, 5)
    rows = [d[:2] for d in docs] + [(None, "blargh blargh vexbag"), (1000, None), (1001, ""), (1002, " \n"), (5, docs[5][1])]
    rows += [(2000, "you blargh and vexbag " * 50_000)]
    marks = labels + [(None, 1), (3000, 1), (7, None), (8, 0), (8, 1), (1000, 0), (1001, None)]
    got = run(spark, rows, marks)
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[1000].score == by[1001].score == by[1002].score < .5
    assert by[None].predicted == 1 and by[None].held_out is False and by[2000].predicted == 1
    assert len({(r.score, r.predicted) for r in got if r.doc_id == 5}) == 1


def test_no_labels_no_rows(spark):
    assert [tuple(r) for r in run(spark, [(1, "blargh")], [])] == [(1, False, 0.0, 0)]
    assert run(spark, [], [(1, 1)]) == []
