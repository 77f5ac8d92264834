"""Name matching: which normalised names occur in which texts, and where.

A normalised name occurs in a normalised text where its words are consecutive words of the text.
Names are searched in one of two ways, with equal results:

- few names (MAX_NAMES, MAX_NAME_BYTES; counted before any is fetched) are broadcast as a table by first word, and texts look
  their words up in a narrow pass;
- more names become a Bloom filter of bounded size (`operators.name_filter`), with which the same narrow pass finds
  candidates; what the filter lets through wrongly goes in an equi-join with the names. Only candidates are shuffled, never
  texts, and frequent names are salted.

`name_spans` works on normalised texts, `names_in` on any. `sentence_mentions` finds names in the
original text, with offsets in it, by sentence; names beyond the broadcast come to the texts there, each text's own by its key,
so that neither sentences nor mentions are written or shuffled.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.functions.text import PlacedWords, exact_text, sentence_bounds
from geoweave.operators.name_filter import NameFilter, name_filter
from geoweave.session import one_by_one, saved

#: Names that are broadcast at most: with their areas about 900 bytes each in every Python worker (measured), 90 MB in all.
MAX_NAMES = 100_000
#: Bytes of these names at most.
MAX_NAME_BYTES = 32 << 20
#: Rows of one name that one task takes in a join; names with more are salted.
HOT_ROWS = 1_000_000
#: Sentences that a task holds before it gives them on, but for those of one text.
ROWS_OUT = 4096

SPANS = "array<struct<name:string,start:int,end:int>>"

#: First word -> (words of a name, name) of the names that begin with it, shorter ones first.
Index = dict[str, list[tuple[list[str], str]]]


def name_index(names: Iterable[str]) -> Index:
    out: Index = defaultdict(list)
    for words, name in sorted((n.split(" "), n) for n in set(names) if n):
        out[words[0]].append((words, name))
    return dict(out)


def occurrences(words: Sequence[str], index: Index | NameFilter) -> list[tuple[int, int, str]]:
    """(first word, number of words, name) of all names, from left to right. Of a filter: of all candidates."""
    if isinstance(index, NameFilter):
        return index.occurrences(words)
    begins = [i for i, word in enumerate(words) if word in index]
    return [(i, len(own), name) for i in begins for own, name in index[words[i]] if len(own) == 1 or words[i : i + len(own)] == own]


def names_of(text: str | None, index: Index | NameFilter) -> list[str]:
    """The different names in a normalised text, in the order of their first occurrence."""
    return list(dict.fromkeys(name for _, _, name in occurrences(text.split(" "), index))) if text else []


def spans_of(text: str, index: Index | NameFilter) -> list[tuple[int, int, str]]:
    """(start, end, name) of all names in a normalised text, in its characters."""
    words, out, word, at = text.split(" "), [], 0, 0
    for i, _, name in occurrences(words, index):
        at += sum(len(w) + 1 for w in words[word:i])
        word = i
        out.append((at, at + len(name), name))
    return out


def is_few(names: DataFrame, column: str = "name") -> bool:
    """Whether the names, one a row, are few enough to be broadcast."""
    size = names.agg(F.count("*").alias("n"), F.sum(F.octet_length(column)).alias("bytes")).first()
    return size.n <= MAX_NAMES and (size.bytes or 0) <= MAX_NAME_BYTES


def broadcast_names(names: DataFrame, column: str = "name") -> list[str] | None:
    """Different names, or None if they are too many for a broadcast."""
    found = names.select(F.col(column).alias("name")).where("name <> ''").distinct()
    return [r.name for r in found.collect()] if is_few(found) else None


def joined_by_name(rows: DataFrame, table: DataFrame, name: str | Sequence[str], spread_by: Sequence[str]) -> DataFrame:
    """rows: a saved table. An inner join by name in which no task takes more than about HOT_ROWS rows of one name.

    name: the column, or columns, of both. spread_by: columns of `rows` that tell the rows of a name apart.
    """
    on = [name] if isinstance(name, str) else list(name)
    parts = F.ceil(F.col("n") / HOT_ROWS).cast("int").alias("_parts")
    # At most one for each HOT_ROWS rows.
    hot = F.broadcast(saved(rows.groupBy(*on).agg(F.count("*").alias("n")).where(F.col("n") > HOT_ROWS).select(*on, parts), "hot"))
    n = F.coalesce("_parts", F.lit(1))
    salted = rows.join(hot, on, "left").withColumn("_salt", F.pmod(F.hash(*spread_by), n)).drop("_parts")
    copies = table.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), n - 1))).drop("_parts")
    return salted.join(copies, [*on, "_salt"]).drop("_salt")


def name_spans(spark: SparkSession, names: Iterable[str]) -> Callable[[Column], Column]:
    """A function of a normalised text column: array of (name, start, end)."""
    shared = spark.sparkContext.broadcast(name_index(names))

    @F.pandas_udf(SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"name": n, "start": s, "end": e} for s, e, n in spans_of(t or "", shared.value)])

    return spans


def names_in(spark: SparkSession, names: Iterable[str]) -> Callable[[Column], Column]:
    """A function of a text column: the different names in it, by first occurrence. Texts are normalised on the way."""
    shared = spark.sparkContext.broadcast(name_index(names))

    @F.pandas_udf("array<string>")
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: names_of(exact_text(t), shared.value))

    return found


def candidate_mentions(texts: DataFrame, names: DataFrame, *, key: Sequence[str], text_col: str, column: str = "name", once: bool = False, normal: bool = True) -> DataFrame:
    """key, name, position (in words) in a saved table: what may be a name, and all that is. once: the first of each name in a text. normal: the texts are normalised."""
    shared = name_filter(names, column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            index, found = [], []
            for i, x in enumerate(b.column("_text")):
                text = x.as_py() if normal else exact_text(x.as_py())
                own = occurrences(text.split(" "), shared.value) if text else []
                if once:
                    own = list({o[2]: o for o in reversed(own)}.values())
                index += [i] * len(own)
                found += own
            kept = b.select(list(key)).take(pa.array(index, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array([o[2] for o in found], pa.string()), pa.array([o[0] for o in found], pa.int32())], names=[*key, "name", "position"])

    rows = texts.select(*key, F.col(text_col).alias("_text"))
    kinds = dict(rows.dtypes)
    return saved(rows.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in key), "name string, position int"])), "candidates")


def ngram_mentions(texts: DataFrame, names: DataFrame, *, key: str | Sequence[str], text_col: str, column: str = "name", once: bool = False, normal: bool = True) -> DataFrame:
    """key, name, position (in words) of names of any number."""
    keys = [key] if isinstance(key, str) else list(key)
    wanted = saved(names.select(F.col(column).alias("name")).where("name <> ''").distinct(), "names")
    found = candidate_mentions(texts, wanted, key=keys, text_col=text_col, once=once, normal=normal)
    return joined_by_name(found, wanted, "name", [*keys, "position"]).select(*keys, "name", "position")


def name_pairs(documents: DataFrame, names: DataFrame, *, key: Sequence[str], column: str, text_col: str = "text") -> DataFrame:
    """key and name, once for each text and name in it."""
    few = broadcast_names(names, column)
    if few is not None:
        return documents.select(*key, F.explode(names_in(documents.sparkSession, few)(F.col(text_col))).alias("name"))
    return ngram_mentions(documents, names, key=key, text_col=text_col, column=column, once=True, normal=False).select(*key, "name")


# ---------------------------------------------------------------- in original texts

_MENTIONS = [("sentence_index", "int"), ("sentence", "string"), ("context", "string"), ("inside", "array<string>"), ("around", "array<string>"), ("near", "array<string>"), ("reach", "array<struct<source_key:string,low:string,high:string>>"), ("names", "array<string>"), ("starts", "array<int>"), ("ends", "array<int>")]
_REACH = pa.list_(pa.struct([("source_key", pa.string()), ("low", pa.string()), ("high", pa.string())]))
_ARROW = [pa.int32(), pa.string(), pa.string(), *[pa.list_(pa.string())] * 3, _REACH, pa.list_(pa.string()), *[pa.list_(pa.int32())] * 2]

#: The place of the names in a row of _MENTIONS.
_NAMES = 7

Reach = dict[str, list[tuple[str, str, str]]]


def _united(reach: Reach, names: Iterable[str]) -> list[dict[str, str]]:
    """Over some names, the least and largest area of each source."""
    found: dict[str, tuple[str, str]] = {}
    for name in names:
        for source, low, high in reach[name]:
            a, b = found.get(source, (low, high))
            found[source] = min(a, low), max(b, high)
    return [{"source_key": s, "low": a, "high": b} for s, (a, b) in found.items()]


def mentions_by_sentence(text: str, index: Index | NameFilter, reach: Reach | None = None, markers: Sequence[str] = ()) -> list[tuple]:
    """Rows of _MENTIONS, one for each sentence with a mention.

    inside, around: the markers in the sentence, and in it with one neighbour on each side.
    near, reach: the names in these sentences, and over them the least and largest area of each source.
    """
    placed = PlacedWords(text)
    places = occurrences(placed.words, index)
    if not places:
        return []
    first, last = placed.bounds()
    bounds = sentence_bounds(text)
    starts = [a for a, _ in bounds]
    by_sentence: dict[int, list[tuple[int, int, str]]] = defaultdict(list)
    for i, k, name in places:
        start = int(first[i])
        by_sentence[bisect_right(starts, start) - 1].append((start, int(last[i + k - 1]), name))
    told = {i: {name for _, _, name in found} for i, found in by_sentence.items()}
    out = []
    for i, found in sorted(by_sentence.items()):
        around = text[starts[max(0, i - 1)] : bounds[min(len(bounds) - 1, i + 1)][1]].strip()
        sentence = text[slice(*bounds[i])].strip()
        near = sorted(set().union(*(told.get(j, ()) for j in (i - 1, i, i + 1))))
        marks = [[m for m in markers if f" {m} " in f" {normal} "] for normal in ((exact_text(x, True) for x in (sentence, around)) if markers else ("", ""))]
        out.append((i, sentence, around, *marks, near, _united(reach, near) if reach is not None else [], [n for _, _, n in found], [s for s, _, _ in found], [e for _, e, _ in found]))
    return out


def _areas_reached(candidates: DataFrame) -> DataFrame:
    """normalized_name, reach: the least and largest area of each source that has the name."""
    each = candidates.groupBy("normalized_name", "source_key").agg(F.min("polygon_id").alias("low"), F.max("polygon_id").alias("high"))
    return each.groupBy("normalized_name").agg(F.collect_list(F.struct("source_key", "low", "high")).alias("reach"))


def sentence_mentions(documents: DataFrame, candidates: DataFrame, told: DataFrame, *, key: Sequence[str], keep: Sequence[str] = (), markers: Sequence[str] = (), gate: bool = False, digest: bool = False) -> DataFrame:
    """documents: key, keep and text. candidates: normalized_name, polygon_id, source_key. told: normalized_name and columns, several rows a name.

    A row for each mention and each row of its name in `told`: key, keep, start, end, what is known of the mention's sentence (the columns of
    _MENTIONS but the lists of mentions), and the columns of `told`. Sentences and mentions are never shuffled: names few enough are
    broadcast; else a first pass finds the candidates of each text, these meet the names, and the texts get what is known of their own
    names by key, before sentences are made.
    gate: only texts whose plain normalisation holds a name at all. digest: context_sha256 in place of context, once a sentence.
    """
    docs = documents.select(*key, *keep, "text")
    reached = _areas_reached(candidates.where("normalized_name <> ''"))
    few = is_few(told, "normalized_name")
    if few:
        reach = {r.normalized_name: [tuple(x) for x in r.reach] for r in reached.collect()}
        shared = docs.sparkSession.sparkContext.broadcast((name_index(reach), reach))
    else:
        docs = _with_known(docs, reached, told, key, gate)
    stays = [*key, *keep]
    fields = [("context_sha256" if n == "context" and digest else n, t) for n, t in _MENTIONS]
    # Of the names of a sentence, where they are not broadcast.
    more = [] if few else [("told", dict(docs.dtypes)["told"])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.select(stays)
            own = None if few else _Known(b)

            def out(index: list[int], found: list[tuple], used: list[list[int]], rows: pa.RecordBatch = rows, own: _Known | None = own) -> pa.RecordBatch:
                columns = list(zip(*found, strict=True)) or [()] * len(_ARROW)
                made = [pa.array(c, t) for c, t in zip(columns, _ARROW, strict=True)]
                return pa.RecordBatch.from_arrays([*rows.take(pa.array(index, pa.int64())).columns, *made, *([] if own is None else [own.told_of(used)])], names=[*stays, *(n for n, _ in [*fields, *more])])

            index, found, used = [], [], []
            for i, text in enumerate(b.column("text")):
                value = text.as_py()
                names, reach = shared.value if own is None else own.of(i)
                if gate and not names_of(exact_text(value), names):
                    continue
                for row in mentions_by_sentence(value, names, reach, markers):
                    index.append(i)
                    found.append((*row[:2], hashlib.sha256(row[2].encode()).hexdigest(), *row[3:]) if digest else row)
                    if own is not None:
                        used.append([own.at[i][n] for n in dict.fromkeys(row[_NAMES])])
                if len(found) >= ROWS_OUT:
                    yield out(index, found, used)
                    index, found, used = [], [], []
            if found:
                yield out(index, found, used)

    kinds = dict(docs.dtypes)
    rows = docs.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in [*((c, kinds[c]) for c in stays), *fields, *more]))
    places, known = F.arrays_zip("names", "starts", "ends"), [n for n, _ in fields if n not in ("names", "starts", "ends")]
    if few:
        rows = rows.withColumn("m", one_by_one(places, "names", "starts", "ends")).select(*stays, *known, F.col("m.names").alias("normalized_name"), F.col("m.starts").alias("start"), F.col("m.ends").alias("end"))
        return rows.join(F.broadcast(told), "normalized_name")
    rows = rows.withColumn("_told", F.explode(F.flatten("told")))
    rows = rows.withColumn("m", F.explode(F.filter(places, lambda m: m["names"] == F.col("_told.normalized_name"))))
    return rows.select(*stays, *known, F.col("m.starts").alias("start"), F.col("m.ends").alias("end"), "_told.*")


class _Known:
    """A batch with the column `known` of _with_known: for each text an index of its own names, and where in the batch each of them is."""

    def __init__(self, batch: pa.RecordBatch):
        lists, told = batch.column("known"), batch.column("told")
        self.names, self.reach = (x.to_pylist() for x in lists.flatten().flatten())
        self.ends = np.cumsum([0, *pc.list_value_length(lists).to_pylist()])
        self.told = told.flatten()
        self.at: dict[int, dict[str, int]] = {}

    def of(self, i: int) -> tuple[Index, Reach]:
        self.at = {i: {self.names[j]: j for j in range(self.ends[i], self.ends[i + 1])}}
        reach = {n: [(x["source_key"], x["low"], x["high"]) for x in self.reach[j]] for n, j in self.at[i].items()}
        return name_index(reach), reach

    def told_of(self, used: list[list[int]]) -> pa.ListArray:
        """For each sentence, what is told of the names at these places."""
        each = self.told.take(pa.array([j for own in used for j in own], pa.int64()))
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, used)]), pa.int32()), each)


def _with_known(docs: DataFrame, reached: DataFrame, told: DataFrame, key: Sequence[str], gate: bool) -> DataFrame:
    """Documents with a name, with `known` (normalized_name, reach) and `told` (what the table tells), in one order, of the names in their text."""
    table = saved(reached.join(told.groupBy("normalized_name").agg(F.collect_list(F.struct(*told.columns)).alias("told")), "normalized_name"), "names-told")
    shared = name_filter(table, "normalized_name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            index, names = [], []
            for i, x in enumerate(b.column("text")):
                value = x.as_py()
                plain = names_of(exact_text(value), shared.value) if gate else []
                if gate and not plain:
                    continue
                own = {name for _, _, name in occurrences(PlacedWords(value).words, shared.value)}.union(plain)
                index += [i] * len(own)
                names += own
            yield pa.RecordBatch.from_arrays([*b.select(list(key)).take(pa.array(index, pa.int64())).columns, pa.array(names, pa.string())], names=[*key, "normalized_name"])

    kinds = dict(docs.dtypes)
    pairs = saved(docs.select(*key, "text").mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in key), "normalized_name string"])), "names-of-texts")
    each = joined_by_name(pairs, table, "normalized_name", key)
    known = each.groupBy(*key).agg(F.collect_list(F.struct("normalized_name", "reach", "told")).alias("_each"))
    known = known.select(*key, F.transform("_each", lambda x: F.struct(x["normalized_name"], x["reach"])).alias("known"), F.transform("_each", lambda x: x["told"]).alias("told"))
    return docs.join(known, list(key))
