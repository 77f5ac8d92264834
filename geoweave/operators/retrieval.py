"""Retrieval rules: which documents are evidence for which areas.

documents: row_index, document_id, text, url, and shard where there are several. All rules match whole words of normalised fields;
text is never percent-decoded, the URL always. A rule looks at where the area's name and the
context (a country or city name) occur:

| rule | accepted |
| --- | --- |
| any_field | name and context each in the text or the URL |
| url_or_context | name in the URL; or name and context in the text |
| url_and_text | name in the URL and in the text, context in the text |
| text | name and context in the text |
| nearby | like text, with at most `max_gap` normalised characters between the closest spans |

Narrow where the profiles are few enough to broadcast: a text goes to Python once, and only documents with a name
come back. Where a rule needs the context in the text, that test comes first and names are searched only then. With more
profiles, candidates are found in the same pass with a filter of names and meet the profiles
without their texts, which the accepted rows get back by their key.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoweave.functions.spans import nearest
from geoweave.functions.text import SENTENCE_BREAK, exact_text, excerpt
from geoweave.operators.gazetteer import document_identity, document_key, first_of
from geoweave.operators.matching import is_few, joined_by_name, name_index, names_of, spans_of
from geoweave.operators.name_filter import name_filter
from geoweave.session import one_by_one, saved

#: The rules, and where they need the context whatever the name: in the text, in either field, or not at all.
GATES = {"any_field": "either", "url_or_context": "none", "url_and_text": "text", "text": "text", "nearby": "text"}
ORDER = ["row_index", "normalized_name", "polygon_id"]
#: Profiles of a name that one row carries, and profiles that are broadcast at most, about 60 bytes each.
BLOCK_PROFILES = 1000
MAX_PROFILES = 1_000_000
_BREAK = re.compile(SENTENCE_BREAK)


def _fields(in_text: Column, in_url: Column) -> Column:
    return F.filter(F.array(F.when(in_text, F.lit("text")), F.when(in_url, F.lit("url"))), lambda x: x.isNotNull())


def _sentence_at(text: str) -> Callable[[int], str]:
    """A function of a position in the normalised text: the sentence there, empty where none is."""
    starts, ends, parts, at = [], [], [], 0
    for part in _BREAK.split(text):
        n = len(exact_text(part))
        if n:
            starts.append(at)
            ends.append(at + n)
            parts.append(part.strip())
            at += n + 1

    def told(position: int) -> str:
        i = bisect_right(starts, position) - 1
        return parts[i] if i >= 0 and position < ends[i] else ""

    return told


def nearest_context(text: str, names: Sequence[str], marker: str, max_gap: int) -> list[dict]:
    """For each name whose closest span is near enough to the marker: gap, and the sentences in which the two spans begin."""
    normal = exact_text(text)
    context = [s for s, _, _ in spans_of(normal, name_index([marker]))]
    own: dict[str, list[int]] = {n: [] for n in names}
    for start, _, name in spans_of(normal, name_index(names)):
        own[name].append(start)
    told, out = None, []
    for name in names:
        pair = nearest(own[name], len(name), context, len(marker))
        if pair is not None and pair[0] <= max_gap:
            told = told or _sentence_at(text)
            out.append({"name": name, "gap": pair[0], "name_sentence": told(pair[1]), "context_sentence": told(pair[2])})
    return out


def _searched(docs: DataFrame, shared: Broadcast, marker: str, gate: str) -> DataFrame:
    """Adds context_in_text, context_in_url, text_names and url_names; only documents that pass the gate and have a name. shared: an index of names, or a filter."""
    kinds = [("context_in_text", "boolean", pa.bool_()), ("context_in_url", "boolean", pa.bool_()), *((c, "array<string>", pa.list_(pa.string())) for c in ("text_names", "url_names"))]
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            index, found = [], []
            for i, (text, url) in enumerate(zip(b.column("text"), b.column("url"), strict=True)):
                normal, normal_url = exact_text(text.as_py()), exact_text(url.as_py(), True)
                in_text, in_url = (f" {marker} " in f" {x} " for x in (normal, normal_url))
                if in_text or gate == "none" or in_url and gate == "either":
                    row = in_text, in_url, names_of(normal, shared.value), names_of(normal_url, shared.value)
                    if row[2] or row[3]:
                        index.append(i)
                        found.append(row)
            made = list(zip(*found, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([*b.take(pa.array(index, pa.int64())).columns, *(pa.array(c, t) for c, (_, _, t) in zip(made, kinds, strict=True))], names=[*columns, *(k for k, _, _ in kinds)])

    return docs.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in [*docs.dtypes, *((n, t) for n, t, _ in kinds)]))


def evidence(documents: DataFrame, profiles: DataFrame, *, rule: str, context: str, max_gap: int = 500, mode: str = "auto") -> DataFrame:
    """One row for each accepted document and area, with the columns of the rule's evidence."""
    if rule not in GATES:
        raise ValueError(f"rule must be one of {', '.join(GATES)}")
    if max_gap < 0:
        raise ValueError("max_gap must not be negative")
    marker = exact_text(context)
    if not marker:
        raise ValueError("context must not be empty")
    key = document_key(documents)
    docs = documents.select(*key, F.col("document_id").cast("string").alias("document_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("url", F.lit("")).alias("url"))
    named = profiles.where("normalized_name <> ''").select("polygon_id", "name", "normalized_name")
    # More profiles than names can be: names of version 1 are not merged. The search goes by names.
    named = saved(named, "profiles")
    names = named.select("normalized_name").distinct()
    few = is_few(names, "normalized_name")
    shared = docs.sparkSession.sparkContext.broadcast(name_index(r.normalized_name for r in names.collect())) if few else name_filter(names, "normalized_name")
    docs = _searched(docs, shared, marker, GATES[rule])
    accepted = {
        "any_field": F.array_union("text_names", "url_names"),
        "url_or_context": F.array_union("url_names", F.when(F.col("context_in_text"), F.col("text_names")).otherwise(F.array().cast("array<string>"))),
        "url_and_text": F.array_intersect("url_names", "text_names"),
        "text": F.col("text_names"),
        "nearby": F.col("text_names"),
    }[rule]
    common = ["polygon_id", F.col("name").alias("polygon_name"), *key, "document_id", "url", "matched_fields", "context_fields", F.col("name").alias("matched_name"), "context_phrase", "text"]
    lean = [*key, "document_id", "url", "matched_fields", "context_fields", "context_phrase", "normalized_name"]
    if rule == "nearby":

        @F.pandas_udf("array<struct<name:string,gap:int,name_sentence:string,context_sentence:string>>")
        def near(texts: pd.Series, names: pd.Series) -> pd.Series:
            return pd.Series([nearest_context(t, list(n), marker, max_gap) for t, n in zip(texts, names, strict=True)], index=texts.index, dtype=object)

        rows = docs.where(F.size("text_names") > 0).withColumn("pair", F.explode(near("text", "text_names"))).withColumn("normalized_name", F.col("pair.name"))
        shown = [F.col("pair.name_sentence").alias("polygon_name_sentence"), F.col("pair.context_sentence").alias("country_name_sentence"), F.col("pair.gap").alias("name_country_distance")]
    else:
        rows = docs.withColumn("normalized_name", F.explode(accepted))
        told = lambda field: F.array_contains("matched_fields", field) | F.array_contains("context_fields", field)
        shown = [F.when(told(f), excerpt(F.col(f))).otherwise(F.lit("")).alias(f"{f}_excerpt") for f in ("text", "url")]
    phrase = F.when(F.col("context_in_text") | F.col("context_in_url"), F.lit(marker)).otherwise(F.lit(""))
    in_text = F.array_contains("text_names", F.col("normalized_name"))
    in_url = F.array_contains("url_names", F.col("normalized_name"))
    rows = rows.withColumns({"matched_fields": _fields(in_text, in_url), "context_fields": _fields(F.col("context_in_text"), F.col("context_in_url")), "context_phrase": phrase})
    # What is shown is cut out of the text once a document and name, before there is a row for each area.
    told = rows.select(*lean, *shown, *(["text"] if few else []))
    made = told.columns[len(lean) : len(lean) + len(shown)]
    if not few:
        met = joined_by_name(saved(told, "accepted"), names, "normalized_name", key)
        told = met.join(documents.select(*key, F.coalesce("text", F.lit("")).alias("text")), key)
    return _with_profiles(told, named, key).select(*common, *made, "normalized_name")


def _with_profiles(rows: DataFrame, named: DataFrame, key: Sequence[str]) -> DataFrame:
    """rows: once for each document and name. With each profile of the name: profiles come in blocks, and rows for each are made last, where nothing moves any more."""
    sizes = named.groupBy("normalized_name").agg(F.ceil(F.count("*") / BLOCK_PROFILES).alias("_parts"))
    block = F.pmod(F.xxhash64("polygon_id"), F.col("_parts")).alias("_block")
    blocks = named.join(sizes, "normalized_name").groupBy("normalized_name", block).agg(F.collect_list(F.struct("polygon_id", "name")).alias("_profiles")).drop("_block")
    if named.count() <= MAX_PROFILES:
        met = rows.join(F.broadcast(blocks), "normalized_name")
    else:
        met = joined_by_name(saved(rows, "rows-of-names"), blocks, "normalized_name", key)
    return met.withColumn("_profile", one_by_one("_profiles", "polygon_id", "name")).drop("_profiles").select("*", "_profile.*").drop("_profile")


def deduplicated(found: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """One row for each area and document. documents: those that were searched; then rows are ranked without their texts, which the kept ones get back."""
    key = document_key(found)
    order = [*(c for c in key if c not in ORDER), *ORDER]
    marked = found.withColumn("_identity", document_identity())
    if documents is None:
        return first_of(marked, ["polygon_id", "_identity"], order).drop("_identity")
    kept = first_of(marked.drop("text"), ["polygon_id", "_identity"], order).drop("_identity")
    return kept.join(documents.select(*key, F.coalesce("text", F.lit("")).alias("text")), key).select(*found.columns)
