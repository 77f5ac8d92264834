"""Reply trees against a brute-force walk, and the template's round trip."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from geoweave.llm import chat

SCHEMA = "tree long, node long, parent long, role string, text string, score double"


@settings(deadline=None, max_examples=200)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a<b>\\l\n"]), st.text())))
def test_round_trip(turns):
    text, spans = chat.formatted(turns)
    assert chat.read_back(text) == turns
    assert [chat.unescaped(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_control_strings():
    said = r"\### Assistant: </turn> ok"
    text, spans = chat.formatted([("user", said), ("assistant", said)])
    assert text.count("</turn>") == 2 and len(spans) == 1


def brute_paths(rows):
    parent = {(t, n): p for t, n, p, *_ in rows}
    has_child = {(t, p) for t, n, p, *_ in rows}
    out = {}
    for t, n, *_ in rows:
        if (t, n) not in has_child:
            path, at = [], n
            while at is not None and (t, at) in parent:
                path.append(at)
                at = parent[t, at]
            out[t, n] = path[::-1]
    return out


def test_random_trees(spark):
    rng = random.Random(3)
    rows = [(t, n, rng.choice([None, *range(max(0, n - 4), n)]) if n else None, rng.choice(["user", "assistant"]), f"{t}.{n}", rng.random()) for t in range(12) for n in range(rng.randint(1, 30))]
    rows += [(99, n, n - 1 if n else None, "user", f"99.{n}", 0.0) for n in range(300)]
    score = {(r[0], r[1]): r[5] for r in rows}
    want = brute_paths(rows)
    got = {(r.tree, r.leaf): (r.rank, [t for _, t in chat.read_back(r.conversation)]) for r in chat.format_trees(spark.createDataFrame(rows, SCHEMA), branches=1000).collect()}
    assert {k: v for k, (_, v) in got.items()} == {(t, leaf): [f"{t}.{n}" for n in p] for (t, leaf), p in want.items()}
    mean = lambda t, leaf: sum(score[t, n] for n in want[t, leaf]) / len(want[t, leaf])
    for t in range(12):
        order = sorted((-mean(t, leaf), leaf) for tt, leaf in want if tt == t)
        assert [leaf for leaf, _ in sorted(((leaf, got[t, leaf][0]) for _, leaf in order), key=lambda x: x[1])] == [leaf for _, leaf in order]


def test_edges(spark):
    rows = [(None, 1, None, None, None, None), (None, 1, None, None, None, None), (5, 2, 77, "user", "orphan", None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS key", "2 AS leaf")
    got = chat.chat_report(chat.format_trees(df)).collect()
    assert sorted((str(r.conv_id), r.n_turns) for r in got) == [("5", 1), ("None", 1)]
    assert chat.chat_report(chat.format_trees(df.limit(0))).collect() == []
    with pytest.raises(ValueError, match="cycle"):
        chat.format_trees(spark.createDataFrame([(1, 1, 3, "u", "", 0.0), (1, 2, 1, "u", "", 0.0), (1, 3, 2, "u", "", 0.0), (1, 4, 3, "u", "", 0.0)], SCHEMA)).collect()


def test_rows_by_turn_with_ties_and_nulls(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 1, "assistant", None), (1, 1, "assistant", None), (None, None, None, None)]
    made = chat.format_trees(chat.messages_of_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    got = {r.tree: chat.read_back(r.conversation) for r in made.collect()}
    assert got == {1: [("user", "a"), ("user", "b"), ("assistant", ""), ("assistant", "")], None: [("", "")]}


def test_only_chosen_paths_are_expanded(spark):
    """Many leaves under a long stem: as many rows as the chosen path has messages."""
    rows = [(1, n, n - 1 if n else None, "user", str(n), 0.0) for n in range(200)] + [(1, 1000 + n, 199, "assistant", "leaf", n / 100) for n in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    structure = df.selectExpr("cast(tree as string) AS key", "node", "parent", "score")
    members = chat.chosen_paths(structure)
    assert members.count() == 201 and {r.leaf for r in members.collect()} == {1099} and {r.distance for r in members.collect()} == set(range(201))
    made = chat.format_trees(df).collect()
    assert [t for _, t in chat.read_back(made[0].conversation)] == [str(n) for n in range(200)] + ["leaf"]


def test_cycles_are_an_error(spark):
    df = spark.createDataFrame([(1, 1, 2, "u", "a", 0.0), (1, 2, 1, "u", "b", 0.0)], SCHEMA)
    with pytest.raises(ValueError, match="cycle"):
        chat.format_trees(df)


def test_turns_with_and_without_ties(spark):
    schema = "conv_id long, turn long, role string, text string"
    plain = [(c, t, "user" if t % 2 == 0 else "assistant", f"{c}:{t}") for c in (1, None) for t in range(1100)]
    ties = [(2, 0, "user", "b"), (2, 0, "user", "a"), (2, None, "assistant", None), (2, 0, "user", "a")]
    for rows in (plain, plain[:3] + ties, []):
        df = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS key", "2 AS node")
        want = {}
        for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
            want.setdefault(c, []).append((role or "", text or ""))
        assert {r.tree: chat.read_back(r.conversation) for r in chat.format_turns(df).collect()} == want
