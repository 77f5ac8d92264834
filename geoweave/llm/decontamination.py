"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Symbols are words. Every run of WINDOW consecutive words of a benchmark item is a
pattern; an item with fewer words (but not none) is one shorter pattern. Patterns of
one length share a matcher: a table of shifts over blocks of two words skips the
positions where no pattern can end, blocks with shift zero lead to a bucket of
patterns with that suffix, and a direct comparison confirms each occurrence.

Documents never shuffle: the patterns are broadcast in blocks of at most
MAX_BLOCK_WORDS benchmark words, and documents pass once over each block.

Defined results: null texts and texts without words have no words, hits or items.
A null item id counts as the empty string. Repeated documents are judged row by row,
repeated benchmark rows count once by item id. An empty benchmark hits nothing.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.llm.common import id_and_text, saved, sha256_text

WINDOW = 10
#: Bound of one broadcast: patterns take at most about WINDOW references for each of these words.
MAX_BLOCK_WORDS = 500_000

_WORD_BYTES = bytes(c for c in range(256) if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80)
#: Lower-cases A-Z and turns every byte that is no part of a word into a space.
_TO_WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _WORD_BYTES else 0x20 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TO_WORDS).split() if text else []


class WuManber:
    """Patterns of one length, as tuples of word numbers."""

    def __init__(self, length: int, patterns: dict[tuple[int, ...], set[str]]):
        self.length, self.patterns = length, patterns
        self.block = min(2, length)
        self.default = length - self.block + 1
        self.shift: dict[tuple[int, ...], int] = {}
        self.buckets: dict[tuple[int, ...], list[tuple[int, ...]]] = {}
        for p in patterns:
            for end in range(self.block, length + 1):
                key = p[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.default), length - end)
            self.buckets.setdefault(p[length - self.block :], []).append(p)

    def search(self, symbols: tuple[int, ...]) -> Iterator[tuple[int, tuple[int, ...]]]:
        """Start and pattern of every occurrence, from left to right."""
        length, block, default, shift, n = self.length, self.block, self.default, self.shift, len(symbols)
        end = length
        while end <= n:
            step = shift.get(symbols[end - block : end], default)
            if step:
                end += step
                continue
            window = symbols[end - length : end]
            for p in self.buckets[window[length - block :]]:
                if p == window:
                    yield end - length, p
            end += 1


class PatternBlock:
    """What one broadcast holds: word numbers, and a matcher for each pattern length."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.numbers: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, words in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]
            k = min(window, len(ids))
            for i in range(len(ids) - k + 1):
                by_length.setdefault(k, {}).setdefault(tuple(ids[i : i + k]), set()).add(item)
        self.matchers = [WuManber(k, by_length[k]) for k in sorted(by_length)]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        get = self.numbers.get
        symbols = tuple([get(w, 0) for w in words])
        ranges, items = [], set()
        for m in self.matchers:
            for start, p in m.search(symbols):
                ranges.append((start, start + m.length))
                items |= m.patterns[p]
        return ranges, items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def pattern_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, max_words: int) -> Iterator[PatternBlock]:
    """Blocks of whole items; the driver holds one block, and streams the partitions of the benchmark."""
    items, size = [], 0
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("string").cast("binary").alias("text"))
    for row in rows.toLocalIterator():
        words = words_of(bytes(row.text) if row.text is not None else None)
        if not words:
            continue
        if items and size + len(words) > max_words:
            yield PatternBlock(items, window)
            items, size = [], 0
        items.append((row.item, words))
        size += len(words)
    if items:
        yield PatternBlock(items, window)


_RANGES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_PASS = "id {id}, text binary, n_words long, hit_ranges array<struct<start:long,end:long>>, item_ids array<string>"


def _scan(block: Broadcast | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns: PatternBlock | None = block.value if block else None
        for b in batches:
            texts = b.column("text").to_pylist()
            old = b.column("hit_ranges").to_pylist() if "hit_ranges" in b.schema.names else [[]] * len(texts)
            seen = b.column("item_ids").to_pylist() if "item_ids" in b.schema.names else [[]] * len(texts)
            counts, ranges, items = [], [], []
            for text, r, i in zip(texts, old, seen, strict=True):
                words = words_of(text)
                found, names = patterns.hits(words) if patterns else ([], set())
                counts.append(len(words))
                ranges.append([{"start": s, "end": e} for s, e in merged([*((x["start"], x["end"]) for x in r), *found])] if found else r)
                items.append(sorted(names.union(i)) if names else i)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("text"), pa.array(counts, pa.int64()), pa.array(ranges, _RANGES), pa.array(items, pa.list_(pa.string()))],
                names=["id", "text", "n_words", "hit_ranges", "item_ids"],
            )

    return run


def find_contamination(
    documents: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, max_block_words: int = MAX_BLOCK_WORDS
) -> DataFrame:
    """Per document row: id, text (binary), n_words, hit_ranges (merged, in words, end exclusive), item_ids (sorted)."""
    spark = documents.sparkSession
    docs = id_and_text(documents, id_col, text_col)
    kind = dict(docs.dtypes)["id"]
    out = None
    for block in pattern_blocks(benchmark, item_col, item_text_col, window, max_block_words):
        # One block per stage: a saved table between passes keeps the broadcasts of one worker bounded.
        out = (docs if out is None else saved(out, "decontamination")).mapInArrow(_scan(spark.sparkContext.broadcast(block)), _PASS.format(id=kind))
    return docs.mapInArrow(_scan(None), _PASS.format(id=kind)) if out is None else out


def contamination_report(found: DataFrame, id_name: str = "doc_id") -> DataFrame:
    return found.select(
        F.col("id").alias(id_name),
        "n_words",
        F.coalesce(F.aggregate("hit_ranges", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"]), F.lit(0).cast("long")).alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        sha256_text(F.array_join("item_ids", ",")).alias("items_sha256"),
        (F.size("hit_ranges") > 0).alias("contaminated"),
    )


REPORT_SQL = r"""
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), patterns AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, k, array_to_string(w[i : i + k - 1], ' ') AS win
  FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)
), windows AS (
  SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM lowered CROSS JOIN (SELECT DISTINCT k FROM patterns) WHERE len(w) >= k)
), found AS (
  SELECT doc_id, windows.k, i, item FROM windows JOIN patterns ON windows.k = patterns.k AND windows.win = patterns.win
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM lowered d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN named ON named.doc_id = d.doc_id
"""


def _hit(patterns: Broadcast):
    @F.pandas_udf("boolean")
    def hit(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t is not None and bool(patterns.value.hits(words_of(t.encode()))[0])).astype(bool)

    return hit


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, max_block_words: int = MAX_BLOCK_WORDS) -> DataFrame:
    """The documents without any hit, with all their columns."""
    spark, out = documents.sparkSession, None
    for block in pattern_blocks(benchmark, item_col, item_text_col, window, max_block_words):
        hit = _hit(spark.sparkContext.broadcast(block))
        out = (documents if out is None else saved(out, "decontamination")).where(~hit(F.col(text_col)))
    return documents if out is None else out
