"""Findings of the fourth review: each test failed before its change."""

import pytest

import __spark_entry__


@pytest.fixture(scope="module")
def run(spark):
    return lambda name, folder: sorted(map(tuple, __spark_entry__.queries()[name](spark, str(folder)).collect()), key=str)


def test_segments_of_empty_texts_and_of_other_line_breaks(spark, run, tmp_path):
    texts = ["a b\nc", "", None, "a\x0bb\u2028c\n\nd", "ab\r\nc\rd", "\n"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert run("segments", tmp_path) == [(0, 2, 4), (1, 0, 0), (2, 0, 0), (3, 3, 6), (4, 2, 4), (5, 1, 1)]


def generators(frame):
    """The lines of the executed plan that expand arrays."""
    frame.collect()
    return [line for line in frame._jdf.queryExecution().executedPlan().toString().splitlines() if "Generate explode" in line]


@pytest.fixture
def world(spark):
    from .test_retrieval import areas, docs

    a = areas(spark, *[("n", "Green", [])] * 30, ("n", "Quillbury", ["Old Mill"]), ("s", "Green", []))
    return docs(spark, ("Rain. Green and Green. Old Mill, Quillbury! Norland.", "http://x/green"), ("Green", "")), a


@pytest.mark.parametrize("version", ["v1", "v2", "v3"])
def test_rows_of_a_sentence_are_not_held_together(spark, world, version):
    """A compiled step (marked by a star) gives its rows on when it has all that come of one row: mentions times areas."""
    from geoweave.plans import runs

    found = generators(runs.find_candidates(*world, version, countries={"n": "Norland", "s": "Sudmark"}))
    assert len([x for x in found if "members" in x or "names" in x]) >= 2
    assert not [x for x in found if ("members" in x or "names" in x) and "*(" in x]


@pytest.mark.parametrize("version", ["v1", "v2", "v3"])
def test_sentences_are_never_written_on_the_way(spark, world, monkeypatch, version):
    from geoweave.operators import lexical, matching
    from geoweave.plans import runs

    written = []
    keep = matching.saved
    for module in (lexical, matching):
        monkeypatch.setattr(module, "saved", lambda df, label: (written.append(df.columns), keep(df, label))[1])
    monkeypatch.setattr(matching, "MAX_NAMES", 1)
    many = runs.find_candidates(*world, version, countries={"n": "Norland", "s": "Sudmark"})
    assert many.count() == 2 * 31 + 31 + 2 and written
    assert not [c for c in written if {"sentence", "context", "text"} & set(c)]


def test_contexts_are_told_by_their_hash(spark, world):
    from pyspark.sql import functions as F

    from geoweave.plans import runs

    countries = {"n": "Norland", "s": "Sudmark"}
    plain = runs.find_candidates(*world, "v3", countries=countries).withColumn("context_sha256", F.sha2("context", 256))
    short = runs.find_candidates(*world, "v3", countries=countries, digest=True)
    assert "context" not in short.columns
    assert sorted(map(str, short.collect())) == sorted(map(str, plain.select(*short.columns).collect()))


def test_writers_look_at_their_pages_often(spark):
    from geoweave import queries

    queries.shard(spark, "/root/testdata/sf0.001")
    assert int(spark.conf.get("parquet.page.size.row.check.max")) <= 1000


def test_places_of_mentions_without_a_sort_of_their_rows(spark, monkeypatch):
    from pyspark.sql import Window as W
    from pyspark.sql import functions as F

    from geoweave.operators import lexical

    from .test_retrieval import areas, docs

    monkeypatch.setattr(lexical, "BLOCK_AREAS", 3)
    # The half folds to a one and a two, which are two names (and a third one) at the same place.
    a = areas(spark, *[("n", "Green", ["GREEN", "Mill"])] * 7, *[("s", "2", []), ("s", "1", []), ("n", "2", ["1 2"]), ("s", "Mill", [])] * 2)
    d = docs(spark, ("Mill, Green mill. Rain! \u00bd Green.", ""), ("none", ""), ("Green \u00bd\u00bd, 2", "x"))
    rows = lexical.mentions(d, a)
    place = F.row_number().over(W.partitionBy("row_index").orderBy("start", "end", "polygon_id", "matched_alias"))
    want = rows.select("row_index", "start", "end", "polygon_id", "matched_alias", place.cast("long").alias("place"))
    got = lexical.mention_places(d, a)
    assert got.dtypes == want.dtypes and sorted(got.collect()) == sorted(want.collect())
    ties = rows.groupBy("row_index", "start", "end").agg(F.countDistinct(F.lower("matched_alias")).alias("n")).where("n > 1").count()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ties and plan.count("Window") == 1 and "Union" in plan


def test_texts_do_not_go_along_with_every_area(spark, world):
    """Version 1 has a row for each document and area of a name: excerpts are cut before, and rows go on one at a time."""
    import re

    from geoweave.plans import runs

    found = runs.retrieve(*world, "v1", country="Norland")
    lines = [x for x in generators(found.select("polygon_id", "row_index", "text_excerpt")) if "_profiles" in x]
    assert lines and found.count() == 32
    assert not [x for x in lines if "*(" in x or re.search(r"[\[ ]text#", x)]
