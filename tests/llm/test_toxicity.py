"""Toxicity: the grammar's scopes, held-out accuracy, and edge cases."""

import random
import zlib

import pytest

from geoweave.llm import toxicity


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("What an idiot.", ["insult"]),
        ("You are an IDIOT!!", ["target_insult"]),
        ("He is not an idiot.", ["negated_insult"]),
        ("She said he was a moron. You moron", ["reported_insult", "target_insult"]),
        ("kill the process", ["threat"]),
        ("I will kill you. they kill", ["threat", "target_threat", "target_threat"]),
        ("hurt them all, burning their house", ["threat", "target_threat", "target_threat"]),
        ("I won't kill you", ["negated_threat"]),
        ("idiots, all of you", ["insult", "target_insult"]),
        ("idiots. all of you", ["insult"]),
        ("an 1d10t and $tupid###", ["insult", "insult"]),
        ("not that one or two more idiot", ["insult"]),
        ("idiotic trashcan", []),
    ],
)
def test_scopes(text, kinds):
    assert [toxicity.KINDS[k] for k, _, _ in toxicity.Grammar().matches(text)] == kinds


def test_negated_and_reported_score_lower():
    model = toxicity.Model()
    one = lambda t: float(model.scores([toxicity.counts_of(toxicity.Grammar(), t)])[0])
    assert one("you idiot") > one("what an idiot") > 0.7 > 0.3 > one("they said idiot") and one("not an idiot") < 0.3 and one("") < 0.1


def test_hints_count_together():
    grammar = toxicity.Grammar((), ("abcd*", "xyz"))
    kinds = lambda t: [toxicity.KINDS[k] for k, _, _ in grammar.matches(t)]
    assert kinds("abcde is abcd. Such a XYZ! abc, not xyz. said xyz") == ["hint", "target_hint", "negated_hint", "reported_hint"]
    assert kinds("abcdx. xyz of all of you") == ["hint", "further_hint", "target_hint"]
    model = toxicity.Model((), toxicity.PRIOR, ("abcd*",))
    scores = [float(model.scores([toxicity.counts_of(model.grammar(), "abcdx " * n)])[0]) for n in range(4)]
    assert scores == sorted(scores) and scores[1] < 0.3 and scores[3] > 0.7


def brute_kinds(classes):
    """The scopes word by word, each from the words before it in its clause."""
    T, out, clause, hinted, waits = toxicity, [], [], False, None
    for c in classes:
        if c == T.END:
            clause, waits = [], None
            continue
        i = len(clause)
        near = lambda kind, n: kind in clause[max(0, i - n) : i]  # noqa: B023, E731
        if c in T.NAMES:
            if T.REPORT in clause:
                scope = "reported_"
            elif near(T.NEGATION, 3):
                scope = "negated_"
            elif near(T.TARGET, 4):
                scope = "target_"
            else:
                scope, waits = "further_" if c == T.HINT and hinted else "", (i, c)
            out.append(scope + T.NAMES[c])
            hinted = hinted or c == T.HINT
        elif c == T.TARGET and waits and i - waits[0] <= 4:
            out.append(f"target_{T.NAMES[waits[1]]}")
            waits = None
        clause.append(c)
    return out


def test_arcs_equal_a_plain_walk():
    word = {toxicity.OTHER: "lorem", toxicity.INSULT: "idiot", toxicity.THREAT: "kill", toxicity.TARGET: "you", toxicity.NEGATION: "not", toxicity.REPORT: "said", toxicity.END: ".", toxicity.HINT: "xyz"}
    grammar, rng = toxicity.Grammar((), ("xyz",)), random.Random(3)
    for _ in range(2000):
        classes = rng.choices(list(word), weights=[6, 2, 2, 2, 1, 1, 1, 2], k=rng.randint(1, 25))
        assert [toxicity.KINDS[k] for k, _, _ in grammar.matches(" ".join(word[c] for c in classes))] == brute_kinds(classes), classes


def test_long_text():
    assert sum(toxicity.counts_of(toxicity.Grammar(), "lorem you idiot " * 200_000)) == 200_000


def test_stems_with_better_longer_ones_go():
    every = {"lose*": (113, 133), "loser": (113, 113), "achl*": (44, 71), "achlx": (16, 16), "tras*": (94, 94), "trash": (94, 94)}
    assert toxicity._without_shorter(every, every) == ("loser", "achl*", "achlx", "tras*", "trash")


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.toxicity_report(toxicity.score(docs, model)).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for d, r in got.items())
    test = [(r.toxic, got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(t == p for t, p in test) >= 0.93 * len(test)
    assert sum(t < p for t, p in test) <= 0.02 * len(test)
    assert sum(t and p for t, p in test) >= 0.7 * sum(t for t, _ in test)
    kept = toxicity.reject(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(not r.predicted for r in got.values())


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "you idiot")], "doc_id long, text string").selectExpr("*", "3 AS id", "4 AS score")
    labels = spark.createDataFrame([(None, None, 1), (2, 1, None), (2, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0)):
        model = toxicity.fit(docs, given)
        got = toxicity.toxicity_report(toxicity.score(docs, model)).collect()
        assert sorted(r.predicted for r in got) == [0, 0, 0, 1]
        assert toxicity.reject(docs, model).count() == 3
    assert toxicity.score(docs.limit(0), model).collect() == []
