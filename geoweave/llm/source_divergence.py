"""How far the sources of a language differ in their words: all pairs of sources by two-dimensional tiling.

Terms are runs of letters A-Z, in either case, and of characters beyond ASCII; a language keeps those of at
least LEAST_DOCUMENTS of its documents. With n occurrences of a term in a group (language and source), N of
all kept terms there, and V kept terms, the group gives the term p = 1 + floor(10^9 (n + 2) / (N + 2 V)). Two such
numbers p and q differ by floor((p - q)^2 / (p + q)). All arithmetic is in integers.

Pairs of sources: the difference is summed over all kept terms. The vocabulary of a language is cut into chunks of about
CHUNK terms, and a group's counts in a chunk are packed into one row. The groups of a language are dealt into blocks of
about BLOCK, and packed rows are copied to the tiles of their block: one task for each pair of blocks and each SLAB chunks,
which takes chunk after chunk, holds the numbers of two blocks for one chunk, and adds to the
submatrix of its pairs. What the slabs found is added up by pair.

Terms of a source: those with more weight than in the whole language, ten by difference.

Scale: tokenising tasks sum up their own rows, so that (language, source, term) leave them once for each
MAX_TERMS terms held. No task takes a language or a source: keys are terms, chunks and tiles, whose sizes do
not depend on how rows are spread over sources. The result has a row for each pair of sources of a language, so
it grows with their square, as any full matrix does; the ranks of one source are a window of as many rows.

Defined results: null texts have no terms; null languages and sources are ''. Repeated rows count each. A group
without terms, and a language without kept terms, has pairs all the same (0 if nothing is kept). Counts up
to 9 * 10^15 are exact. Other columns are not read, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoweave.llm.common import saved

LEAST_DOCUMENTS = 10
TOP_TERMS = 10
#: Terms of a chunk, groups of a block, chunks of a task.
CHUNK = 4096
BLOCK = 32
SLAB = 8
#: Different terms that a tokenising task holds before it gives its counts on.
MAX_TERMS = 200_000
_TERM_BYTES = frozenset(range(0x41, 0x5B)) | frozenset(range(0x61, 0x7B)) | frozenset(range(0x80, 0x100))
#: Lower-cases A-Z and turns every byte that is no part of a term into a space.
_TO_TERMS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _TERM_BYTES else 0x20 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_TERMS).split()


def term_counts(documents: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", max_terms: int = MAX_TERMS) -> DataFrame:
    """lang, source, term, n (occurrences), documents (that have it). A row with a null term for each group, whether it has terms or not."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = documents.select(named(lang_col).alias("lang"), named(source_col).alias("source"), F.col(text_col).cast("string").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], dict[bytes, list[int]]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), own in held.items():
                terms = [None, *own]
                counts = [(0, 0), *own.values()]
                n, documents = zip(*counts, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.binary()), pa.array(n, pa.int64()), pa.array(documents, pa.int64())], names=["lang", "source", "term", "n", "documents"])

        for b in batches:
            for lang, source, text in zip(*(b.column(c) for c in ("lang", "source", "text")), strict=True):
                own = held.setdefault((lang.as_py(), source.as_py()), {})
                before = len(own)
                counted: dict[bytes, int] = {}
                for term in terms_of(text.as_py() or b""):
                    counted[term] = counted.get(term, 0) + 1
                for term, n in counted.items():
                    found = own.get(term)
                    if found is None:
                        own[term] = [n, 1]
                    else:
                        found[0] += n
                        found[1] += 1
                size += len(own) - before
                if size >= max_terms:
                    yield from out()
                    held, size = {}, 0
        yield from out()

    found = rows.mapInArrow(run, "lang string, source string, term binary, n long, documents long")
    return found.withColumn("term", F.col("term").cast("string")).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 kept)), by long division in three steps, as 10^9 n can go beyond 64 bits."""
    rest, out, by = n + F.lit(2), F.lit(1).cast("long"), total + F.lit(2) * kept
    divided = lambda x: F.call_function("div", x, by)
    for unit in (1_000_000, 1000, 1):
        rest = rest * F.lit(1000)
        out = out + divided(rest) * F.lit(unit)
        rest = rest % by
    return out


def shares(n: np.ndarray, total: int, kept: int) -> np.ndarray:
    """As `share`, of an array."""
    rest, by = (n + 2) * 1000, total + 2 * kept
    out = rest // by * 1_000_000 + 1
    rest = rest % by * 1000
    out += rest // by * 1000
    return out + rest % by * 1000 // by


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def vocabulary(counts: DataFrame, least: int = LEAST_DOCUMENTS, chunk: int = CHUNK) -> DataFrame:
    """lang, term, lang_n, chunk, place: the kept terms of each language, with a number in their chunk."""
    kept = saved(counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("documents").alias("documents")).where(F.col("documents") >= least).drop("documents"), "vocabulary")
    sizes = saved(kept.groupBy("lang").agg(F.ceil(F.count("*") / chunk).cast("long").alias("chunks")), "chunks")
    dealt = kept.join(sizes, "lang").withColumn("chunk", F.pmod(F.xxhash64("term"), "chunks"))
    # About `chunk` terms a window, as hashes spread them.
    return dealt.withColumn("place", F.row_number().over(W.partitionBy("lang", "chunk").orderBy("term")) - 1).drop("chunks")


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by tile and chunk; a tile's submatrix grows chunk by chunk. Held: the numbers of one chunk, and the sums of one tile."""

    def added(sums: dict, rows: list[dict]) -> None:
        size = rows[0]["size"]
        wide = np.zeros((len(rows), size), np.int64)
        for i, r in enumerate(rows):
            counts = np.zeros(size, np.int64)
            if r["places"]:
                counts[np.frombuffer(r["places"], "<i4")] = np.frombuffer(r["counts"], "<i8")
            wide[i] = shares(counts, r["total"], r["kept"]) if r["kept"] else 0
        first = [i for i, r in enumerate(rows) if r["own"] == r["b1"]]
        second = first if rows[0]["b1"] == rows[0]["b2"] else [i for i, r in enumerate(rows) if r["own"] == r["b2"]]
        for at, i in enumerate(first):
            others = second[at + 1 :] if second is first else second
            if others and size:
                q = wide[others]
                found = ((wide[i] - q) ** 2 // (wide[i] + q)).sum(axis=1).tolist()
            else:
                found = [0] * len(others)
            for j, value in zip(others, found, strict=True):
                pair = rows[i]["source"], rows[j]["source"]
                sums[pair] = sums.get(pair, 0) + value

    def out(tile: tuple, sums: dict) -> Iterator[pa.RecordBatch]:
        if sums:
            a, b = zip(*sums, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([tile[0]] * len(a)), pa.array(a), pa.array(b), pa.array(list(sums.values()), pa.int64())], names=["lang", "a", "b", "value"])

    tile, chunk, rows, sums = None, None, [], {}
    for batch in batches:
        for r in batch.to_pylist():
            now = r["lang"], r["b1"], r["b2"], r["slab"]
            if now != tile or r["chunk"] != chunk:
                if rows:
                    added(sums, rows)
                if now != tile and tile is not None:
                    yield from out(tile, sums)
                    sums = {}
                tile, chunk, rows = now, r["chunk"], []
            rows.append(r)
    if rows:
        added(sums, rows)
        yield from out(tile, sums)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of (place, n) as two strings of bytes."""
    for b in batches:
        cells = b.column("cells")
        flat = cells.flatten()
        ends = np.cumsum([len(x) for x in cells])
        cut = lambda name, kind: [x.astype(kind).tobytes() for x in np.split(flat.field(name).to_numpy(zero_copy_only=False), ends[:-1])] if len(cells) else []
        yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("source"), b.column("chunk"), pa.array(cut("place", "<i4"), pa.binary()), pa.array(cut("n", "<i8"), pa.binary())], names=["lang", "source", "chunk", "places", "counts"])


def pair_differences(kept: DataFrame, groups: DataFrame, sizes: DataFrame, *, block: int = BLOCK, slab: int = SLAB) -> DataFrame:
    """lang, source, item, value for each source and each other one of its language.

    kept: lang, source, chunk, place, n. groups: lang, source, total, kept, chunks, sources (of the language). sizes: lang, chunk, size.
    """
    packed = kept.groupBy("lang", "source", "chunk").agg(F.collect_list(F.struct("place", "n")).alias("cells"))
    packed = packed.mapInArrow(_packed, "lang string, source string, chunk long, places binary, counts binary")
    blocks = F.ceil(F.col("sources") / block).cast("long")
    # A row for each group and chunk, also where the group has none of its terms: those count as zero.
    grid = groups.select("lang", "source", "total", "kept", blocks.alias("blocks"), F.pmod(F.xxhash64("source"), blocks).alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("chunks"), F.lit(1)) - 1)).alias("chunk"))
    rows = grid.join(sizes, ["lang", "chunk"], "left").join(packed, ["lang", "source", "chunk"], "left")
    copies = rows.select("lang", "source", "total", "kept", "own", "chunk", F.coalesce("size", F.lit(0)).alias("size"), "places", "counts", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    tiles = copies.select("lang", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), F.floor(F.col("chunk") / slab).alias("slab"), "chunk", "source", "own", "total", "kept", "size", "places", "counts")
    keys = ["lang", "b1", "b2", "slab"]
    found = tiles.repartition(*keys).sortWithinPartitions(*keys, "chunk", "source").mapInArrow(_tiled, "lang string, a string, b string, value long")
    summed = found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return summed.select("lang", both.alias("pair"), "value").select("lang", "pair.source", "pair.item", "value")


def audit(documents: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, chunk: int = CHUNK, block: int = BLOCK, slab: int = SLAB, max_terms: int = MAX_TERMS) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    counts = saved(term_counts(documents, text_col=text_col, lang_col=lang_col, source_col=source_col, max_terms=max_terms), "counts")
    words = saved(vocabulary(counts, least, chunk), "terms")
    kept = saved(counts.where("term IS NOT NULL").join(words, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n", "chunk", "place"), "kept")
    sizes = saved(words.groupBy("lang", "chunk").agg(F.count("*").alias("size")), "sizes")
    langs = words.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"), (F.max("chunk") + 1).alias("chunks"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = counts.where("term IS NULL").select("lang", "source")
    sources = every.groupBy("lang").agg(F.count("*").alias("sources"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    groups = saved(every.join(sources, "lang").join(langs, "lang", "left").join(totals, ["lang", "source"], "left").select("lang", "source", "sources", *map(zero, ("total", "kept", "lang_total", "chunks"))), "groups")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    pairs = ranked(pair_differences(kept, groups, sizes, block=block, slab=slab)).withColumn("part", F.lit("pair"))
    told = kept.select("lang", "source", F.col("term").alias("item"), "n", "lang_n").join(groups.select("lang", "source", "total", "kept", "lang_total"), ["lang", "source"])
    told = told.select("lang", "source", "item", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q")).where("p > q")
    terms = ranked(told.select("lang", "source", "item", difference(F.col("p"), F.col("q")).alias("value"))).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(terms.select(*columns))


REPORT_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, text FROM documents
), words AS MATERIALIZED (SELECT k, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs
), vocab AS MATERIALIZED (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT k) >= {LEAST_DOCUMENTS}
), langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM vocab GROUP BY lang
), counts AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM words JOIN vocab USING (lang, term) GROUP BY ALL
), totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL
), groups AS MATERIALIZED (
  SELECT lang, source, coalesce(total, 0) AS total, v, lang_total FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN langs USING (lang) LEFT JOIN totals USING (lang, source)
), shares AS MATERIALIZED (
  SELECT lang, source, term, coalesce(n, 0) AS n, CAST(1 + 1000000000::HUGEINT * (coalesce(n, 0) + 2) // (total + 2 * v) AS BIGINT) AS p,
         CAST(1 + 1000000000::HUGEINT * (lang_n + 2) // (lang_total + 2 * v) AS BIGINT) AS q
  FROM groups JOIN vocab USING (lang) LEFT JOIN counts USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(d.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
             FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) d
    ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
), terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM shares WHERE n > 0 AND p > q
), every AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
