"""Mentions with offsets, windows, scores and summaries."""

import pytest
from pyspark.sql import functions as F

from geoweave.operators import lexical, matching, specificity
from geoweave.operators.matching import mentions_by_sentence, name_index
from geoweave.plans import report, runs

from .test_retrieval import areas, docs

COUNTRIES = {"n": "Norland", "s": "Sudmark"}


def found(text, *names):
    return [m for row in mentions_by_sentence(text, name_index(names)) for m in zip(row[8], row[9], strict=True)]


def test_bounds():
    assert found("An old MILL stood. The Mill Inn is shut; millers left.", "mill", "the mill inn") == [(7, 11), (19, 31), (23, 27)]
    assert found("ß", "ss") == [(0, 1)] and found("ﬀ½", "ff1", "2") == [(0, 2), (1, 2)]
    assert found("xMill Millx", "mill") == [] and found(".Mill:", "mill") == [(1, 5)] and found("Old%20Mill", "old mill") == []


def test_combining_marks_need_the_plain_text_only_with_the_gate(spark):
    a = areas(spark, ("n", "é", []), ("n", "e", []))
    d = docs(spark, ("é", ""), ("e", ""), ("é", ""))
    rows = lexical.mentions(d, a).collect()
    assert sorted((r.row_index, r.matched_alias, r.start, r.end) for r in rows) == [(0, "e", 0, 1), (1, "e", 0, 1), (2, "é", 0, 1)]


def test_window():
    row = mentions_by_sentence("Rain. The mill turns. Wind! Snow.", name_index(["mill"]))[0]
    assert row[:3] == (1, "The mill turns.", "Rain. The mill turns. Wind!")


@pytest.fixture
def world(spark):
    a = areas(spark, ("n", "Quillbury Mill", ["Old Mill"]), ("n", "Green", []), ("s", "Dale End", []), ("s", "Green", []))
    d = docs(spark, ("Green is all they sell.", "http://x/green"), ("Green, a part of Norland.", ""), ("They show Quillbury Mill.", "http://x/quillbury-mill"), ("Sudmark has Dale End.", ""), ("No land is as Green.", ""))
    return d, a


def test_tiers(spark, world):
    scored = runs.find_candidates(*world, "v3", countries=COUNTRIES)
    rows = scored.collect()
    assert len(rows) == 8
    tiers = [r.decision_tier for r in rows]
    assert (tiers.count("high_confidence"), tiers.count("possible"), tiers.count("rejected")) == (2, 3, 3)
    best = next(r for r in rows if r.matched_alias == "Quillbury Mill")
    assert (best.evidence_score, best.evidence_reasons, best.start, best.end) == (5, "distinctive_name|name_in_url", 10, 24)
    summary = {r.source_key: r for r in lexical.source_summary(scored, world[1]).collect()}
    assert (summary["n"].mentions, summary["n"].polygons_read, summary["n"].names_indexed, summary["s"].polygons_matched) == (4, 2, 3, 2)
    v2 = runs.find_candidates(*world, "v2", countries=COUNTRIES)
    assert "equal as multisets: yes" in report.comparison_report(v2, scored)
    assert "| n |" in report.run_card("Run", {"version": "v3"}, lexical.source_summary(scored, world[1]))


def test_nearby(spark):
    a = areas(spark, ("n", "North Gate", ["Frost Gate"]), ("n", "South Gate", []))
    d = docs(spark, ("North Gate is old. Some say Frost Gate. Far off. South Gate too.", ""), ("South Gate. Norland! Frost Gate.", ""), ("South Gate, then Frost Gate.", ""))
    inventory = specificity.name_inventory(a, None, COUNTRIES, total=1)
    rows = {(r.row_index, r.matched_alias): r for r in lexical.scored_mentions(d, a, inventory, COUNTRIES).collect()}
    signs = lambda i, name: (rows[i, name].same_polygon_alias_nearby, rows[i, name].other_polygon_name_nearby, rows[i, name].country_in_context)
    assert signs(0, "North Gate") == signs(0, "Frost Gate") == (True, False, False) and signs(0, "South Gate") == (False, False, False)
    assert signs(1, "South Gate") == signs(1, "Frost Gate") == (False, False, True)
    assert signs(2, "South Gate") == signs(2, "Frost Gate") == (False, True, False)


@pytest.mark.parametrize("version", ["v1", "v2", "v3"])
def test_names_beyond_the_broadcast(spark, world, monkeypatch, version):
    few = runs.find_candidates(*world, version, countries=COUNTRIES)
    want = sorted(few.drop("centroid").collect(), key=str)
    monkeypatch.setattr(matching, "MAX_NAMES", 1)
    many = runs.find_candidates(*world, version, countries=COUNTRIES)
    assert want and sorted(many.drop("centroid").collect(), key=str) == want


def test_first_version_keeps_all_names(spark):
    a = areas(spark, ("n", "Quillbury Mill", ["Old Mill"]), ("s", "Dorn", ["Old Mill"]))
    d = docs(spark, ("Old Mill.", ""), ("Dorn", ""), ("none", None), (None, None))
    assert sorted(r.source_key for r in runs.find_candidates(d, a, "v1", countries=COUNTRIES).collect()) == ["n", "s", "s"]
    with pytest.raises(ValueError):
        runs.find_candidates(d, a, "v4", countries=COUNTRIES)


def test_empty(spark, world):
    d, a = world
    assert runs.find_candidates(d.limit(0), a, "v3", countries=COUNTRIES).count() == 0
    empty = lexical.source_summary(runs.find_candidates(d.limit(0), a, "v3", countries=COUNTRIES), a).collect()
    assert [r.mentions for r in empty] == [0, 0]
    assert "no rows" in report.comparison_report(*(runs.find_candidates(d.limit(0), a, v, countries=COUNTRIES) for v in ("v2", "v3")))


def test_rows_of_two_shards_are_two_documents(spark, world):
    d, a = world
    twice = d.withColumn("shard", F.lit("a")).union(d.withColumn("shard", F.lit("b")))
    one, two = (runs.find_candidates(x, a, "v2", countries=COUNTRIES) for x in (d, twice))
    assert two.count() == 2 * one.count()
    tiers = runs.find_candidates(twice, a, "v3", countries=COUNTRIES).groupBy("decision_tier").count()
    assert {r.decision_tier: r["count"] for r in tiers.collect()}.keys() <= {"high_confidence", "possible", "rejected"}
