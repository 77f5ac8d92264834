"""The filter of names: nothing is lost, little is let through, and frequent names are dealt out."""

import random

import pytest
from pyspark.sql import functions as F

from geoweave.operators import matching, name_filter
from geoweave.operators.matching import name_index, occurrences

WORDS = [f"w{i}" for i in range(400)] + ["é", "中文", "the"]


def some_names(n, seed=1):
    rng = random.Random(seed)
    return sorted({" ".join(rng.choices(WORDS, k=rng.choice([1, 2, 2, 3, 7]))) for _ in range(n)})


def frame(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def test_no_name_is_lost_and_few_others_pass(spark):
    names = some_names(3000)
    found = name_filter.name_filter(frame(spark, names)).value
    rng = random.Random(2)
    index, wrong, runs = name_index(names), 0, 0
    for _ in range(60):
        words = rng.choices(WORDS + ["never"], k=300)
        words[50:57] = rng.choice(names).split(" ")
        want, got = set(occurrences(words, index)), occurrences(words, found)
        assert want <= set(got) and got == sorted(got, key=lambda o: o[:2])
        assert all(" ".join(words[i : i + k]) == name for i, k, name in got)
        wrong, runs = wrong + len(set(got) - want), runs + 4 * len(words)
    assert wrong < runs / 100


def test_segments_and_a_full_filter(spark, monkeypatch):
    names = some_names(2000)
    monkeypatch.setattr(name_filter, "_SEGMENT", 1 << 12)
    monkeypatch.setattr(name_filter, "MAX_BITS", 1 << 14)
    small = name_filter.name_filter(frame(spark, names).repartition(5)).value
    assert len(small.data) == 1 << 11
    for name in names:
        assert (0, len(name.split(" ")), name) in small.occurrences(name.split(" "))


def test_no_names_and_no_words(spark):
    empty = name_filter.name_filter(frame(spark, ["", None])).value
    assert empty.occurrences(["a", "b"]) == [] and empty.occurrences([]) == []
    assert name_filter.filter_bits(0) == name_filter.filter_bits(1) == 1 << 20 and name_filter.filter_bits(10**12) == name_filter.MAX_BITS


@pytest.mark.parametrize("rows", [1_000_000, 7])
def test_frequent_names_are_salted_and_nothing_else_changes(spark, monkeypatch, rows):
    monkeypatch.setattr(matching, "HOT_ROWS", rows)
    texts = spark.range(90).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the gate of the mill").otherwise(F.concat(F.lit("mill "), "id")).alias("normal"))
    names = frame(spark, ["the", "mill", "the mill", "mill 7", "gate of", "absent"])
    got = matching.ngram_mentions(texts, names, key="doc_id", text_col="normal")
    search = matching.name_spans(spark, [r.name for r in names.collect()])
    want = texts.select("doc_id", F.explode(search(F.col("normal"))).alias("m")).groupBy("doc_id", "m.name").count()
    assert sorted(got.groupBy("doc_id", "name").count().collect()) == sorted(want.collect()) and got.count() == 211
    once = matching.ngram_mentions(texts, names, key="doc_id", text_col="normal", once=True)
    assert once.where("name = 'the'").groupBy("doc_id").count().where("count > 1").isEmpty()


def test_only_candidates_are_shuffled(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    names = frame(spark, [f"nowhere {i}" for i in range(5000)])
    assert matching.candidate_mentions(texts, names, key=["doc_id"], text_col="text", normal=False).count() < 20


def test_names_are_counted_before_they_are_fetched(spark, monkeypatch):
    names = frame(spark, ["a" * 50, "b", "b"])
    assert matching.broadcast_names(names) == ["a" * 50, "b"] or set(matching.broadcast_names(names)) == {"a" * 50, "b"}
    monkeypatch.setattr(matching, "MAX_NAME_BYTES", 20)
    assert matching.broadcast_names(names) is None
