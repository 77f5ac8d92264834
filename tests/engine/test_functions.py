"""Normalisation, sentences, spans and geometry."""

import unicodedata
from urllib.parse import unquote

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from geoweave.functions import geometry, text


def one(spark, column, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())) if values else spark.range(1)
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize("mode", ["auto", "exact"])
def test_normalised(spark, mode):
    cases = [("  Quill  Bury-II\n", "quill bury ii"), ("Straße_ﬁ", "strasse fi"), (None, ""), ("ＰＯＮＤ", "pond"), ("A%20B", "a 20b"), ("İstanbul ŉ µ", text.exact_text("İstanbul ŉ µ"))]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, t string")
    got = {r.i: r.n for r in df.select("i", text.normalized(F.col("t"), mode=mode).alias("n")).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]


def test_decoding(spark):
    urls = {"https://example.test/Quill%20Bury": "https example test quill bury", "%6e%4f%72%4c": "norl", "a%zz+b%C3%A9%ff": "a zz bé"}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    for r in df.select("u", text.normalized(F.col("u"), decode_url=True).alias("n")).collect():
        assert r.n == urls[r.u]


@settings(deadline=None, max_examples=300)
@given(st.text(max_size=256))
def test_exact_is_idempotent(value):
    once = text.exact_text(value)
    assert text.exact_text(once) == once or any(ord(c) > 0x17F for c in once)


@settings(deadline=None, max_examples=500)
@given(st.text(st.one_of(st.characters(max_codepoint=0x24F), st.sampled_from("‘’“”–—‐%4é́ﬁ")), max_size=40), st.booleans())
def test_bytes_equal_the_definition(value, decode):
    folded = unicodedata.normalize("NFKC", value)
    folded = (unquote(folded) if decode else folded).casefold()
    assert text.exact_text(value, decode) == " ".join("".join(c if c.isalnum() else " " for c in folded).split())


def test_fast_equals_exact_on_plain_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    both = docs.select(text.normalized(F.col("text"), mode="fast").alias("a"), text.normalized(F.col("text"), mode="exact").alias("b"))
    assert both.where("a <> b").isEmpty()


def test_markers_and_excerpts(spark):
    assert one(spark, text.has_marker(F.lit("port norland bay"), F.lit("norland"))) and not one(spark, text.has_marker(F.lit("norlandbay"), F.lit("norland"))) and not one(spark, text.has_marker(F.lit("a"), F.lit("")))
    assert len(one(spark, text.excerpt(F.lit("x" * 241)))) == 240 and one(spark, text.excerpt(F.lit("x" * 240))) == "x" * 240
    assert one(spark, text.shortened(F.lit("x" * 238 + "  y"))) == "x" * 238 + "…"


def test_sentences(spark):
    assert one(spark, text.sentences(F.lit("...\nNorland. One!  Two"))) == ["Norland.", "One!", "Two"]
    assert one(spark, text.terminal_sentences(F.lit("Rain. The mill turns?! v1.2 Wind"))) == ["Rain.", "The mill turns?!", "v1.2 Wind"]
    for t in ("One. Two!  Three\n\nfour", "", "x\u001ey. z", "a.b. \n c"):
        assert "".join(one(spark, text.lossless_segments(F.lit(t)))) == t
    assert text.sentence_bounds("One. Two") == [(0, 4), (4, 8)]


def placed(value):
    found = text.PlacedWords(value)
    first, last = found.bounds()
    return found.words, first.tolist(), last.tolist()


def test_placed_words():
    assert placed("ß") == (["ss"], [0], [1]) and placed("a -- b") == (["a", "b"], [0, 5], [1, 6]) and placed("-ßaß ß x") == (["ssass", "ss", "x"], [1, 5, 7], [4, 6, 8])
    assert placed("½ﬁx") == (["1", "2fix"], [0, 0], [1, 3]) and placed("") == ([], [], [])


@settings(deadline=None, max_examples=500)
@given(st.text(st.one_of(st.characters(max_codepoint=0x24F), st.characters(), st.sampled_from("ßaA -–é½")), max_size=60))
def test_placed_words_lead_back_to_the_text(value):
    fold = lambda x: unicodedata.normalize("NFKC", x).casefold()
    words, first, last = placed(value)
    for word, a, b in zip(words, first, last, strict=True):
        assert word in "".join(map(fold, value[a:b]))
    every = "".join(c if c.isalnum() else " " for c in "".join(map(fold, value)))
    assert words == [w for w in every.split(" ") if w]


def ring(*points):
    return [{"lon": float(x), "lat": float(y)} for x, y in points]


def square(low, high, dx=0):
    return ring((low + dx, low), (high + dx, low), (high + dx, high), (low + dx, high), (low + dx, low))


@pytest.mark.parametrize("shape, want", [([[square(0, 4), square(1, 3)]], (2, 2)), ([[square(0, 4), square(0, 1)]], (2.1, 2.1)), ([[ring((0, 0), (1, 0), (2, 0), (0, 0))]], (1, 0)), ([], None), ([[]], None)])
def test_centroid(spark, shape, want):
    df = spark.createDataFrame([(shape,)], f"g {geometry.GEOMETRY}")
    c = df.select(geometry.centroid(F.col("g")).alias("c")).first().c
    assert c is None if want is None else (round(c.lon, 9), round(c.lat, 9)) == want


def test_contains(spark):
    df = spark.createDataFrame([([[square(0, 4), square(1, 2)], [square(0, 1, 10)]],)], f"g {geometry.GEOMETRY}")
    inside = lambda x, y: df.select(geometry.contains_point(F.col("g"), F.struct(F.lit(float(x)).alias("lon"), F.lit(float(y)).alias("lat"))).alias("x")).first().x
    assert [inside(*p) for p in ((0.5, 0.5), (1.5, 1.5), (3, 3), (10.5, 0.5), (5, 5))] == [True, False, True, True, False]
