"""Topic vocabularies: documents with a topic term, and sentences with one near an area's name."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoweave.functions.text import exact_text
from geoweave.operators.matching import Index, name_index, names_in, names_of

#: The one matching contract that vocabularies may state.
CONTRACT = {"field": "text", "case_sensitive": False, "unicode_normalization": "NFKC", "word_boundaries": True, "match_url": False}
DROPPED = ("context_fields", "context_phrase", "country_name_sentence", "matched_fields", "matched_name", "polygon_name_sentence")
WINDOW_SENTENCES = 2


@dataclass(frozen=True)
class Vocabulary:
    """category -> terms. Terms are unique after normalisation, over all categories."""

    categories: Mapping[str, Sequence[str]]

    def __post_init__(self):
        if not self.categories:
            raise ValueError("a vocabulary needs a category")
        seen: set[str] = set()
        for category, terms in self.categories.items():
            if not isinstance(category, str) or not category.strip() or not terms:
                raise ValueError("a category needs a name and terms")
            for term in terms:
                normal = exact_text(term) if isinstance(term, str) else ""
                if not normal:
                    raise ValueError(f"term without letters or digits in {category}")
                if normal in seen:
                    raise ValueError(f"term twice after normalisation: {term}")
                seen.add(normal)

    @classmethod
    def from_mapping(cls, value: Mapping) -> Vocabulary:
        if not isinstance(value, Mapping) or value.get("matching") != CONTRACT:
            raise ValueError("the matching contract of the vocabulary is not supported")
        for key in ("version", "language"):
            if not isinstance(value.get(key), str) or not value[key].strip():
                raise ValueError(f"the vocabulary needs a {key}")
        return cls(value.get("categories") or {})

    def rows(self) -> list[tuple[str, str, str]]:
        return [(exact_text(t), t, c) for c, terms in self.categories.items() for t in terms]


def topic_terms(frame: DataFrame, vocabulary: Vocabulary, text_col: str = "text", out: str = "topics") -> DataFrame:
    """Adds array<struct<term, category>>: the terms of the text in the order of their first occurrence."""
    rows = vocabulary.rows()
    known = F.create_map(*(F.lit(x) for n, t, c in rows for x in (n, f"{t}\u001f{c}")))
    # of terms that begin at the same word the shorter one comes first
    names = names_in(frame.sparkSession, [r[0] for r in rows])(F.col(text_col))
    split = lambda n, i: F.split(F.element_at(known, n), "\u001f")[i]
    return frame.withColumn(out, F.transform(names, lambda n: F.struct(split(n, 0).alias("term"), split(n, 1).alias("category"))))


def with_topic(frame: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Rows whose text has a term."""
    return topic_terms(frame, vocabulary, out="_topics").where(F.size("_topics") > 0).drop("_topics")


def category_counts(frame: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """category, documents: each category once a row."""
    found = topic_terms(frame, vocabulary, out="_topics")
    return found.select(F.explode(F.array_distinct(F.transform("_topics", lambda t: t["category"]))).alias("category")).groupBy("category").agg(F.count("*").alias("documents"))


_FOUND = "sentence_index int, sentence string, country_sentence_distance int, place_sentence_distance int, polygon_sentence_distance int, topic_categories array<string>, topic_category_count int, topic_term_count int, topic_terms array<string>"


def _distance(at: int, anchors: Sequence[int]) -> int:
    """To the nearest of some positions in rising order."""
    i = bisect_left(anchors, at)
    return min(abs(at - x) for x in anchors[max(0, i - 1) : i + 1])


def _topic_sentences(sentences: Sequence[str], normals: Sequence[str], name: str, context: str, index: Index, known: Mapping[str, tuple[str, str]], window: int) -> tuple[str | None, list[dict]]:
    """What is in no sentence, if anything is; and the sentences with a term that are near the name. normals: the sentences, normalised."""
    having = lambda marker: [i for i, n in enumerate(normals) if marker and f" {marker} " in f" {n} "]
    own, around = having(name), having(context)
    if normals and not (own and around):
        return "context_phrase" if own else "polygon_name", []
    out = []
    for i in sorted({i for at in own for i in range(max(0, at - window), min(len(normals), at + window + 1))}):
        told = [known[n] for n in names_of(normals[i], index)]
        if told:
            terms, categories = [t for t, _ in told], list(dict.fromkeys(c for _, c in told))
            far, near = _distance(i, around), _distance(i, own)
            row = i, sentences[i], far, min(far, near), near, categories, len(categories), len(terms), terms
            out.append(dict(zip(_FIELDS, row, strict=True)))
    return None, out


_FIELDS = [f.split(" ")[0] for f in _FOUND.split(", ")]


def _distinct_of(rows: Column, field: str) -> Column:
    return F.array_distinct(F.flatten(F.transform(rows, lambda r: r[field])))


def near_topics(frame: DataFrame, vocabulary: Vocabulary, *, window: int = WINDOW_SENTENCES, strict: bool = True) -> DataFrame:
    """Rows with `sentences` to rows with the sentences that have a term and are at most `window` sentences from the area's name.

    An error if the area's name or the context is in no sentence of a row (a name may reach over
    the end of a sentence); not strict: such rows go. A row is worked out by itself, in one narrow pass: rows that follow each
    other with the same sentences (a document with several areas) share their normalisation.
    """
    if window < 0:
        raise ValueError("window must not be negative")
    listed = vocabulary.rows()
    index, known = name_index(n for n, _, _ in listed), {n: (t, c) for n, t, c in listed}

    @F.pandas_udf(f"missing string, found array<struct<{_FOUND.replace(' ', ':').replace(',:', ',')}>>")
    def near(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, last, normals = [], None, []
            for sentences, name, context in zip(*batch, strict=True):
                own = [] if sentences is None else list(sentences)
                if own != last:
                    last, normals = own, [exact_text(x) for x in own]
                out.append(_topic_sentences(own, normals, exact_text(name), exact_text(context), index, known, window))
            yield pd.DataFrame(out, columns=["missing", "found"])

    # Not deterministic, so that it is not worked out anew for each use of what it gives.
    out = frame.withColumn("_near", near.asNondeterministic()("sentences", "polygon_name", "context_phrase"))
    lacks = F.col("_near.missing")
    whole = lacks.isNull() if not strict else F.when(lacks.isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(lacks, F.lit(" is in no sentence of its row"))).cast("boolean"))
    out = out.where(whole).where(F.size("_near.found") > 0).withColumn("_found", F.col("_near.found")).drop("_near", *DROPPED)
    names = ["country_sentence_distance", "place_sentence_distance", "polygon_sentence_distance", "sentence_index", "topic_categories", "topic_category_count", "topic_term_count", "topic_terms"]
    return out.withColumns(
        {
            "sentences_with_topic_term": F.transform("_found", lambda r: r["sentence"]),
            "relevant_sentence_metadata": F.transform("_found", lambda r: F.struct(*(r[n].alias(n) for n in names))),
            "topic_sentence_count": F.size("_found"),
            "topic_terms": _distinct_of(F.col("_found"), "topic_terms"),
            "topic_categories": _distinct_of(F.col("_found"), "topic_categories"),
        }
    ).drop("_found")


def category_sentences(near: DataFrame) -> DataFrame:
    """category, sentences of the rows of near_topics()."""
    each = near.select(F.explode("relevant_sentence_metadata").alias("m")).select(F.explode("m.topic_categories").alias("category"))
    return each.groupBy("category").agg(F.count("*").alias("sentences"))
