"""Plug-ins: sentence segmenters and yes/no classifiers, and what their answers do to rows.

Models are callables; they run in Arrow batches on the executors. No model comes with the engine.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoweave.functions.text import lossless_segments
from geoweave.operators.gazetteer import document_key

LABELS = ("yes", "no")
REASONING_END = "</think>"

Segmenter = Callable[[Sequence[str]], Sequence[Sequence[str]]]
Classifier = Callable[[Sequence[str]], Sequence[str]]


def segmented(frame: DataFrame, segmenter: Segmenter | None = None, *, batch: int = 32, text_col: str = "text") -> DataFrame:
    """Adds `sentences`, which join to the text again. Without a segmenter the built-in lossless one."""
    if batch <= 0:
        raise ValueError("batch must be positive")
    if segmenter is None:
        return frame.withColumn("sentences", lossless_segments(F.col(text_col)))

    @F.pandas_udf("array<string>")
    def split(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out: list[list[str]] = []
            for at in range(0, len(texts), batch):
                part = [t or "" for t in texts.iloc[at : at + batch]]
                found = [list(x) for x in segmenter(part)]
                if len(found) != len(part):
                    raise ValueError("the segmenter gave another number of texts")
                for text, pieces in zip(part, found, strict=True):
                    if "".join(pieces) != text:
                        raise ValueError("segments do not join to their text")
                out += found
            yield pd.Series(out, index=texts.index, dtype=object)

    return frame.withColumn("sentences", split(F.col(text_col)))


def parsed_label(raw: Column) -> Column:
    """What stands after the reasoning, if there is any; an error unless it is exactly yes or no."""
    label = F.regexp_replace(F.element_at(F.split(raw, REASONING_END), -1), "^\\s+|\\s+$", "")
    return F.when(label.isin(*LABELS), label).otherwise(F.raise_error(F.concat(F.lit("the answer must be exactly yes or no: "), raw)))


def prompted(sentence: Column, template: str) -> Column:
    """The template with the sentence in its one place, written as {}."""
    head, place, tail = template.partition("{}")
    if not place:
        raise ValueError("the template has no place for the sentence")
    return F.concat(F.lit(head), sentence, F.lit(tail))


def prompt_hash(template: str) -> str:
    """What a checkpoint of answers knows a prompt by."""
    return hashlib.sha256(template.encode()).hexdigest()


def labelled(frame: DataFrame, classifier: Classifier, *, batch: int = 8, known: DataFrame | None = None, key: Sequence[str] | None = None) -> DataFrame:
    """Adds `labels`, one for each of sentences_with_topic_term. Rows whose key is in `known` (key, labels) take theirs from there."""
    if batch <= 0:
        raise ValueError("batch must be positive")

    @F.pandas_udf("array<string>")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            flat = [s for row in rows for s in row]
            answers: list[str] = []
            for at in range(0, len(flat), batch):
                part = flat[at : at + batch]
                got = list(classifier(part))
                if len(got) != len(part):
                    raise ValueError("the classifier gave another number of labels")
                answers += got
            if any(a not in LABELS for a in answers):
                raise ValueError("labels must be yes or no")
            out, at = [], 0
            for row in rows:
                out.append(answers[at : at + len(row)])
                at += len(row)
            yield pd.Series(out, index=rows.index, dtype=object)

    key = list(key or ["polygon_id", *document_key(frame)])
    if known is None:
        return frame.withColumn("labels", classify(F.col("sentences_with_topic_term")))
    new = frame.join(known.select(*key), key, "left_anti")
    old = frame.join(known.select(*key, "labels"), key)
    return old.select(*frame.columns, "labels").unionByName(new.withColumn("labels", classify(F.col("sentences_with_topic_term"))))


def _merged(rows: Column, field: str) -> Column:
    return F.array_distinct(F.flatten(F.transform(rows, lambda m: m[field])))


def keep_yes(frame: DataFrame) -> DataFrame:
    """Rows with a yes, reduced to the sentences that got one; texts and sentence lists go, topic columns follow what is left."""
    n = F.size("labels")
    aligned = (n == F.size("sentences_with_topic_term")) & (n == F.size("relevant_sentence_metadata"))
    rows = frame.withColumn("labels", F.when(aligned, F.col("labels")).otherwise(F.raise_error(F.lit("labels do not match the sentences")))).where(F.array_contains("labels", "yes"))
    chosen = lambda c: F.filter(c, lambda x, i: F.element_at("labels", i + 1) == "yes")
    rows = rows.withColumns({c: chosen(F.col(c)) for c in ("sentences_with_topic_term", "relevant_sentence_metadata")})
    meta = F.col("relevant_sentence_metadata")
    return rows.withColumns({"topic_sentence_count": F.size(meta), "topic_terms": _merged(meta, "topic_terms"), "topic_categories": _merged(meta, "topic_categories")}).drop("labels", "text", "sentences")


def label_counts(frame: DataFrame) -> DataFrame:
    """One row: rows, rows kept, yes and no sentences."""
    yes = F.size(F.filter("labels", lambda x: x == "yes"))
    return frame.agg(F.count("*").alias("rows_processed"), F.count(F.when(yes > 0, 1)).alias("rows_kept"), F.coalesce(F.sum(yes), F.lit(0)).alias("yes_sentences"), F.coalesce(F.sum(F.size("labels") - yes), F.lit(0)).alias("no_sentences"))
