"""Weak supervision: counts against brute force, the estimation against planted accuracies, labels, edges."""

import random
import re
from collections import Counter

import pytest

from geoweave.llm import quality


def brute_counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    hit = {j for i, w in enumerate(windows) if n[w] > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def counts(df):
    return [(r.id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in quality.counted(df).collect()]


def test_counts_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for d, got in counts(docs):
        assert got == brute_counts(texts[d]), d


def test_counts_of_odd_texts(spark):
    rng = random.Random(1)
    texts = [None, "", " ", "a", "a b", "a b c", "a a a a", "a b c a b c", "x\n\nx\n \nx y\nx", "\x0b|<>\x0c##", "É É É\tÉ \x1c\x85 é\r\n"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 60))) for _ in range(60)] + ["w " * 30_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").selectExpr("*", "1 AS words", "2 AS id")
    for d, got in counts(df):
        assert got == brute_counts(texts[d]), texts[d][:40]


def planted(accuracy, rows=20_000, share=0.8, seed=2):
    rng = random.Random(seed)
    truth = Counter()
    for _ in range(rows):
        good = rng.random() < share
        truth[tuple(0 if rng.random() < 0.3 else 1 + (good != (rng.random() < a)) for a in accuracy), good] += 1
    found = Counter()
    for (votes, _), n in truth.items():
        found[votes] += n
    return sorted(found.items()), truth


def test_estimation_recovers_planted_accuracies():
    accuracy = [0.95, 0.9, 0.8, 0.7, 0.6, 0.9, 0.9, 0.9, 0.9]
    patterns, truth = planted(accuracy)
    model = quality.estimate(patterns)
    assert abs(model.share[0] - 0.8) < 0.02
    right = sum(n for (votes, good), n in truth.items() if (model.posterior(votes) > 0.5) == good)
    assert right > 0.98 * 20_000
    for r, a in enumerate(accuracy):  # 0.3 of the votes are kept back
        assert abs(model.bad[0][r] - 0.7 * (1 - a)) < 0.03


def brute_estimate(patterns, rounds):
    """The estimation row by row, in plain loops."""
    total, rules = sum(n for _, n in patterns), len(patterns[0][0])
    clip = lambda x: min(1 - 1e-4, max(1e-4, x))
    seen = [sum(n for v, n in patterns if v[r] == 2) / total for r in range(rules)]
    praise = [sum(n for v, n in patterns if v[r] == 1) / max(1, sum(n for v, n in patterns if v[r] != 2)) for r in range(rules)]
    start_bad = [[clip(0.05 * x) for x in seen]] + [[clip(0.9 if r == k else x) for r, x in enumerate(seen)] for k in range(rules)]
    start_good = [[clip(x) for x in praise], [clip(0.2 * x) for x in praise]]
    start_share = [0.85] + [0.15 / rules] * rules
    bad, good, share, w = start_bad, start_good, start_share, quality.PRIOR_ROWS
    for _ in range(rounds):
        parts = []
        for v, n in patterns:
            p = []
            for c in range(rules + 1):
                x = share[c]
                for r in range(rules):
                    g = good[min(c, 1)][r]
                    x *= bad[c][r] if v[r] == 2 else (1 - bad[c][r]) * (g if v[r] == 1 else 1 - g)
                p.append(x)
            parts.append([n * x / sum(p) for x in p])
        mass = [sum(p[c] for p in parts) for c in range(rules + 1)]
        vote = lambda c, r, k: sum(p[c] for p, (v, _) in zip(parts, patterns, strict=True) if v[r] == k)  # noqa: B023, E731
        new_bad = [[clip((vote(c, r, 2) + w * start_bad[c][r]) / (mass[c] + w)) for r in range(rules)] for c in range(rules + 1)]
        new_good = [[clip((sum(vote(c, r, 1) for c in cs) + w * start_good[i][r]) / (sum(vote(c, r, 0) + vote(c, r, 1) for c in cs) + w)) for r in range(rules)] for i, cs in enumerate(([0], range(1, rules + 1)))]
        share = [(m + w * s) / (total + w) for m, s in zip(mass, start_share, strict=True)]
        bad, good = new_bad, new_good
    return share, bad, good


def test_estimation_equals_plain_loops():
    patterns, _ = planted([0.9, 0.7, 0.8], rows=300, seed=5)
    model = quality.estimate(patterns, rounds=30)
    share, bad, good = brute_estimate(patterns, 30)
    assert model.share == pytest.approx(share) and [x for row in model.bad for x in row] == pytest.approx([x for row in bad for x in row]) and [x for row in model.good for x in row] == pytest.approx([x for row in good for x in row])


def test_a_rule_that_votes_at_random_is_disregarded(spark):
    rng = random.Random(4)
    rows = Counter()
    for _ in range(20_000):
        junk = rng.random() < 0.1
        rows[(2 * junk, 2 * (junk and rng.random() < 0.9), 0 if junk else int(rng.random() < 0.95), 2 * (rng.random() < 0.2))] += 1
    model = quality.estimate(sorted(rows.items()))
    assert abs(model.bad[0][3] - 0.2) < 0.02 and model.posterior((0, 0, 1, 2)) > 0.9 and model.posterior((2, 2, 0, 0)) < 0.1


def test_posterior_of_rows_is_that_of_the_model(spark):
    names = [r.name for r in quality.RULES]
    rng = random.Random(6)
    rows = [tuple(rng.choice((0, 0, 1, 2)) for _ in names) for _ in range(200)]
    model = quality.estimate(sorted(Counter(rows).items()))
    df = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names)).withColumn("p", quality.posterior(model))
    for r in df.collect():
        assert r.p == pytest.approx(model.posterior(tuple(r[n] for n in names)))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_verdicts_follow_the_labels(spark, folder):
    judged = {r.id: r for r in quality.judge_quality(spark.read.parquet(f"{folder}/documents.parquet")).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    good = [judged[r.doc_id] for r in labels if r.quality == 1 and not judged[r.doc_id].base_failed]
    bad = [judged[r.doc_id] for r in labels if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(not r.kept for r in bad) >= 0.95 * len(bad)


def test_edges(spark):
    df = spark.createDataFrame([(None, None), (1, ""), (1, "")], "doc_id long, text string").selectExpr("*", "1 AS kept", "2 AS n_words")
    got = quality.quality_report(quality.judge_quality(df)).collect()
    assert len(got) == 3 and all(r.base_failed and not r.kept and r.n_words == 0 for r in got)
    assert quality.judge_quality(df.limit(0)).collect() == []


def test_no_python_in_the_plan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = quality.counted(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
