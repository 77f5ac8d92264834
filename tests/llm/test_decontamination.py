"""Benchmark decontamination against a search of every window at every place, and edge cases."""

import hashlib
import random
import re

import pytest

from geoweave.llm import decontamination


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(documents, benchmark, size):
    """(n_words, hit positions, items) of each document."""
    windows = []
    for item, text in benchmark:
        words = words_of(text)
        k = min(size, len(words))
        windows += [("" if item is None else str(item), words[i : i + k]) for i in range(len(words) - k + 1) if k]
    out = []
    for d, text in documents:
        words, hit, items = words_of(text), set(), set()
        for item, window in windows:
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    items.add(item)
        out.append((d, len(words), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def report(spark, documents, benchmark, **options):
    docs = spark.createDataFrame(documents, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS hit_ranges", "3 AS n_words")
    items = spark.createDataFrame(benchmark, "item_id string, text string").selectExpr("*", "1 AS item")
    found = decontamination.contamination_report(decontamination.find_contamination(docs, items, **options)).collect()
    clean = decontamination.drop_contaminated(docs, items, **options)
    assert clean.columns == docs.columns and sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(r.doc_id) for r in found if not r.contaminated)
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found), key=str)


def sample():
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(["a", "b", "c", "dé", "e1", "-", "F"]) for _ in range(n))
    benchmark = [(str(i), text(rng.choice([1, 2, 3, 5, 8, 12, 20]))) for i in range(15)] + [(None, "b c c c"), ("7", "again c a a b"), ("x", None), ("y", " -- "), ("10", "same b b"), ("9", "same b b")]
    documents = [(i, text(rng.randint(0, 60))) for i in range(40)]
    documents += [(40, None), (41, ""), (None, "same b b"), (1, "B C\nC-C same! b b"), (1, "B C\nC-C same! b b"), (42, "a" * 50_000 + " same b b " + "c " * 30_000)]
    return documents, benchmark


@pytest.mark.parametrize("options", [{"window": 4}, {"window": 4, "max_block_words": 1}, {"window": 3, "max_block_words": 25}, {}])
def test_equals_brute_force(spark, options):
    documents, benchmark = sample()
    assert report(spark, documents, benchmark, **options) == brute(documents, benchmark, options.get("window", 10))


def test_empty_tables(spark):
    documents, benchmark = sample()
    assert all(not r[5] and r[2] == r[3] == 0 for r in report(spark, documents, []))
    assert report(spark, [], benchmark) == []


def test_shifts_skip_no_occurrence():
    rng = random.Random(6)
    for length in (1, 2, 3, 6):
        patterns = {tuple(rng.randint(0, 2) for _ in range(length)): {"x"} for _ in range(5)}
        symbols = tuple(rng.randint(0, 2) for _ in range(400))
        want = [(i, symbols[i : i + length]) for i in range(len(symbols) - length + 1) if symbols[i : i + length] in patterns]
        assert list(decontamination.WuManber(length, patterns).search(symbols)) == want
