"""Vocabularies, proximity, segmenters and classifiers."""

import pytest
from pyspark.errors import PythonException, SparkRuntimeException
from pyspark.sql import functions as F

from geoweave.operators import classify, topics

VOCAB = topics.Vocabulary({"water": ["pond"], "ground": ["clay"], "trees": ["elm", "elm grove"], "events": ["fair"]})
ROW = "polygon_id string, row_index long, polygon_name string, context_phrase string, text string, sentences array<string>, matched_name string"


def rows(spark, *sentence_lists):
    return spark.createDataFrame([(f"way/{i}", i, "Quillbury", "norland", "".join(s), list(s), "x") for i, s in enumerate(sentence_lists)], ROW)


def test_vocabulary_contract():
    good = {"version": "1", "language": "en", "matching": topics.CONTRACT, "categories": {"a": ["x"]}}
    assert topics.Vocabulary.from_mapping(good).rows() == [("x", "x", "a")]
    for bad in ({"matching": {}}, {"version": ""}, {"categories": {"a": ["x", "X"]}}, {"categories": {"a": ["!"]}}, {"categories": {}}, {"categories": {"a": []}}):
        with pytest.raises(ValueError):
            topics.Vocabulary.from_mapping(good | bad)


def test_terms_in_order_of_occurrence(spark):
    df = spark.createDataFrame([("ＥＬＭ-grove by a Pond; clay, elm",), ("Elms, ponds and a clayey affair",), (None,)], "text string")
    got = [[t.term for t in r.topics] for r in topics.topic_terms(df, VOCAB).collect()]
    assert got == [["elm", "elm grove", "pond", "clay"], [], []]
    assert topics.with_topic(df, VOCAB).count() == 1
    assert {r.category: r.documents for r in topics.category_counts(df, VOCAB).collect()} == {"trees": 1, "water": 1, "ground": 1}


def test_proximity(spark):
    df = rows(spark, ["Quillbury sleeps. ", "Clay and a pond make Norland. ", "Ponderous."], ["Norland holds Quillbury. ", "a. ", "b. ", "c. ", "One elm."])
    near = topics.near_topics(df, VOCAB)
    out = near.collect()
    assert len(out) == 1 and "context_phrase" not in out[0] and "matched_name" not in out[0]
    meta = out[0].relevant_sentence_metadata
    assert [(m.sentence_index, m.polygon_sentence_distance, m.country_sentence_distance, m.place_sentence_distance, m.topic_terms) for m in meta] == [(1, 1, 0, 0, ["clay", "pond"])]
    assert out[0].topic_categories == ["ground", "water"] and out[0].sentences_with_topic_term == ["Clay and a pond make Norland. "]
    assert {r.category: r.sentences for r in topics.category_sentences(near).collect()} == {"ground": 1, "water": 1}
    with pytest.raises(SparkRuntimeException, match="polygon_name"):
        topics.near_topics(rows(spark, ["nothing here. ", "Norland pond"]), VOCAB).collect()
    assert topics.near_topics(rows(spark, ["nothing here. ", "Norland pond"]), VOCAB, strict=False).collect() == []


def test_classifier_keeps_yes(spark):
    df = topics.near_topics(rows(spark, ["Quillbury pond. ", "Norland clay. ", "Norland elm."], ["A pond at Quillbury, Norland."]), VOCAB)
    seen = classify.labelled(df, lambda s: ["yes" if "clay" in x else "no" for x in s], batch=2)
    out = classify.keep_yes(seen).collect()
    assert len(out) == 1 and out[0].topic_terms == ["clay"] and out[0].topic_sentence_count == 1 and "sentences" not in out[0] and "text" not in out[0]
    assert tuple(classify.label_counts(seen).first()) == (2, 1, 1, 3)
    again = classify.labelled(df, lambda s: 1 / 0, known=seen)
    assert again.select("labels").exceptAll(seen.select("labels")).isEmpty()
    for bad in (lambda s: ["maybe"] * len(s), lambda s: []):
        with pytest.raises(PythonException):
            classify.labelled(df, bad).collect()


def test_label_parser_and_prompt(spark):
    df = spark.createDataFrame([(" yes\n",), ("<think>no</think> no",)], "raw string")
    assert [r.x for r in df.select(classify.parsed_label(F.col("raw")).alias("x")).collect()] == ["yes", "no"]
    with pytest.raises(SparkRuntimeException):
        spark.createDataFrame([("Yes",)], "raw string").select(classify.parsed_label(F.col("raw"))).collect()
    assert df.limit(1).select(classify.prompted(F.lit("s"), "Is {} so?").alias("p")).first().p == "Is s so?"


def test_segmenter(spark):
    df = spark.createDataFrame([("a. b",), ("",)], "text string")
    assert [r.sentences for r in classify.segmented(df, lambda ts: [[t] if t else [] for t in ts]).collect()] == [["a. b"], []]
    with pytest.raises(PythonException):
        classify.segmented(df, lambda ts: [["x"] for _ in ts]).collect()
