"""Rules, names, deduplication, specificity."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from geoweave.functions import spans
from geoweave.functions.text import normalized
from geoweave.operators import gazetteer, matching, retrieval, specificity
from geoweave.plans import runs, versions

DOC = "row_index long, document_id string, text string, url string"
AREA = "polygon_id string, source_key string, name string, aliases array<string>, tags map<string,string>, geometry string"


def docs(spark, *rows):
    return spark.createDataFrame([(i, f"doc-{i}", t, u) for i, (t, u) in enumerate(rows)], DOC)


def profiles(spark, *names):
    df = spark.createDataFrame([(f"way/{i}", n) for i, n in enumerate(names)], "polygon_id string, name string")
    return gazetteer.profiles(df)


def found(spark, rule, rows, *names, **options):
    return retrieval.evidence(docs(spark, *rows), profiles(spark, *names), rule=rule, context="Norland", **options).orderBy(*retrieval.ORDER).collect()


def test_fields_of_each_rule(spark):
    rows = [("Quillbury today", "http://x/norland"), ("Quillbury, a part of Norland.", "http://x/other"), ("In Norland", "http://x/quill%62ury"), ("Quillbury, Norland", "http://x/quillbury-norland"), (None, None)]
    at = lambda rule: [(r.row_index, "".join(x[0] for x in r.matched_fields), "".join(x[0] for x in r.context_fields)) for r in found(spark, rule, rows, "Quillbury")]
    assert at("any_field") == [(0, "t", "u"), (1, "t", "t"), (2, "u", "t"), (3, "tu", "tu")]
    assert at("url_or_context") == [(1, "t", "t"), (2, "u", "t"), (3, "tu", "tu")]
    assert at("url_and_text") == [(3, "tu", "tu")]
    assert at("text") == [(1, "t", "t"), (3, "tu", "tu")]
    url_only = found(spark, "url_or_context", [("nothing", "http://x/quillbury")], "Quillbury")[0]
    assert (url_only.context_phrase, url_only.context_fields, url_only.text_excerpt) == ("", [], "")


@pytest.mark.parametrize("gap, kept", [(498, 1), (499, 0)])
def test_gap_is_inclusive(spark, gap, kept):
    rows = found(spark, "nearby", [(f"Quillbury {'x' * gap} Norland", "")], "Quillbury")
    assert len(rows) == kept and all(r.name_country_distance == 500 for r in rows)


def test_gap_of_names_that_hold_the_context(spark):
    rows = found(spark, "nearby", [("QUILL-BURY lies by NORLAND.", ""), ("Norland Telecom", ""), ("Quillbury has a mill. Norland lies around it.", "")], "Quill Bury", "Norland Telecom", "Quillbury")
    assert [r.name_country_distance for r in rows] == [9, 0, 12]
    assert (rows[2].polygon_name_sentence, rows[2].country_name_sentence) == ("Quillbury has a mill.", "Norland lies around it.")


def test_all_areas_with_one_name_and_word_bounds(spark):
    rows = found(spark, "text", [("Port of Norland, Portal", "")], "Port", "port", "Porta", "!!")
    assert [r.polygon_id for r in rows] == ["way/0", "way/1"]


def test_errors(spark):
    for options in ({"rule": "no"}, {"max_gap": -1}, {"context": "!"}):
        with pytest.raises(ValueError):
            retrieval.evidence(docs(spark, ("a", "b")), profiles(spark, "x"), **({"rule": "text", "context": "Norland"} | options))
    with pytest.raises(ValueError):
        versions.retrieval_version("v7")


def test_keep_first(spark):
    rows = [(0, "p", "a", "x", "u", "t"), (1, "p", "a", "x", "u2", "t2"), (2, "p", "a", "", "u", "t"), (3, "p", "a", None, "u", "t"), (4, "q", "a", "x", "u", "t")]
    df = spark.createDataFrame(rows, "row_index long, polygon_id string, normalized_name string, document_id string, url string, text string")
    assert sorted(r.row_index for r in retrieval.deduplicated(df).collect()) == [0, 2, 4]
    narrow = retrieval.deduplicated(df, df.select("row_index", "text"))
    assert narrow.columns == df.columns and sorted(map(tuple, narrow.collect())) == sorted(map(tuple, retrieval.deduplicated(df).collect()))


def test_meaningful_and_one_per_name(spark):
    names = profiles(spark, "Ab", "123", "A1b", "Le Port", "le-port", None)
    kept = names.where(gazetteer.is_meaningful(F.col("normalized_name")))
    assert sorted(r.polygon_id for r in kept.collect()) == ["way/2", "way/3", "way/4"]
    assert sorted(r.polygon_id for r in gazetteer.one_per_name(kept).collect()) == ["way/2", "way/3"]


def areas(spark, *rows):
    return spark.createDataFrame([(f"{s}/way/{i}", s, n, a, {"name": n}, None) for i, (s, n, a) in enumerate(rows)], AREA)


def test_specific_names(spark):
    a = areas(spark, ("m", "Odd Corner", []), ("m", "Norland", []), ("m", "Twice", []), ("m", "twice", []), ("m", "Common", []))
    d = docs(spark, *[("Common thing in Norland", "")] * 3, ("Odd Corner in Norland", ""))
    kept = runs.run_profiles(a, d, versions.retrieval_version("v5"), country="Norland", ratio=0.3)
    assert [r.normalized_name for r in kept.collect()] == ["odd corner"]
    assert runs.retrieve(d, a, "v6", country="Norland", ratio=0.3).count() == 1
    assert runs.retrieve(d, a, "v5", country="Norland").count() == 0  # the cutoff of four documents is zero
    assert (specificity.retrieval_cutoff(999), specificity.lexical_cutoff(999), specificity.lexical_cutoff(0)) == (0, 1, 0)


def test_inventory_decisions(spark):
    a = areas(spark, ("m", "A", []), ("m", "2", []), ("m", "Cat", ["Cat", "CAT"]), ("m", "Norland", []), ("l", "Norland", []), ("m", "Central", []), ("l", "Central", []), ("m", "Foo%20Bar", []))
    rows = {r.normalized_name: r for r in specificity.name_inventory(a, None, {"m": "Norland", "l": "Liechtenstein"}, total=1000).collect()}
    assert {n: r.reason for n, r in rows.items()} == {"a": "too_few_letters", "2": "no_letters", "cat": "specific", "norland": "country_name", "central": "osm_reuse", "foo 20bar": "specific"}
    assert [c.alias for c in rows["cat"].candidates] == ["CAT", "Cat"]


def test_both_matching_strategies_agree(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("normal", normalized(F.col("text")))
    names = ["the", "and the", "thing", "the the", "of the and"]
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    search = matching.name_spans(spark, names)
    spans = texts.select("doc_id", F.explode(search(F.col("normal"))).alias("m")).groupBy("doc_id", "m.name").count()
    grams = matching.ngram_mentions(texts, frame, key="doc_id", text_col="normal").groupBy("doc_id", "name").count()
    assert spans.count() > 0 and spans.exceptAll(grams).isEmpty() and grams.exceptAll(spans).isEmpty()


@pytest.mark.parametrize("version", ["v1", "v4", "v5", "v6"])
def test_names_beyond_the_broadcast(spark, monkeypatch, version):
    a = areas(spark, ("m", "Quillbury", []), ("m", "Quill Bury", []), ("m", "Norland Gate", []), ("m", "Absent", []))
    d = docs(spark, ("Quillbury and Quill Bury in Norland. Norland Gate.", "http://x/quillbury"), ("Norland", "http://x/quill-bury"), (None, None), ("Quill", ""))
    want = sorted(runs.retrieve(d, a, version, country="Norland", ratio=0.5).collect())
    monkeypatch.setattr(matching, "MAX_NAMES", 1)
    assert want and sorted(runs.retrieve(d, a, version, country="Norland", ratio=0.5).collect()) == want


def brute_nearest(left, right):
    return min(((max(0, c - b, a - d), a, c) for a, b in left for c, d in right), default=None)


@given(st.lists(st.integers(0, 40), max_size=8, unique=True), st.integers(1, 5), st.lists(st.integers(0, 40), max_size=8, unique=True), st.integers(1, 5))
def test_nearest(left, n, right, k):
    left, right = sorted(left), sorted(right)
    assert spans.nearest(left, n, right, k) == brute_nearest([(x, x + n) for x in left], [(x, x + k) for x in right])


def test_long_text_of_names_and_contexts(spark):
    rows = found(spark, "nearby", [("norland casino " * 20_000, "")], "Casino")
    assert [(r.name_country_distance, r.polygon_name_sentence != "") for r in rows] == [(1, True)]
