"""SimHash near-duplicate groups by a byte-position inverted index with count filtering.

Fingerprints: 64 bits over word shingles hashed with XXH64 (seed 42); a bit is one if it is
set in over half the hashes. Two fingerprints link when at most MAX_BITS bits differ. These
bits touch at most four of the eight bytes, so linked fingerprints share at least four
(position, byte) entries.

Index: postings of single bytes hold 1/256 of all fingerprints each and would grow with the
square of the corpus. Postings are therefore kept for sets of three positions, chosen so that
any four of the eight positions contain one of the sets (20 sets: three groups of positions;
all triples within a group, and two of a group with one of the next). For the pairs of a
posting the shared positional bytes of all eight positions are tallied; pairs below the
guaranteed minimum of four are dropped, the rest are verified by counting differing bits.

Scale: equal texts collapse to one fingerprint before the index, a posting of more than
MAX_POSTING fingerprints is cut into pairs of blocks that are separate groups, and a group
emits a spanning forest of its links, never all pairs. Components come from alternating
large-star and small-star rounds over tables in the shared folder; nothing is collected.

Defined results: a null text or one without words has fingerprint zero and links like any
other; fewer words than a shingle make one shingle. A null id sorts after all others. Repeated
rows get equal results. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoweave.llm.common import fresh_name, id_and_text, saved

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints of one posting that are compared as one group; larger postings are cut into pairs of blocks.
MAX_POSTING = 8192
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_CHUNK = 1 << 16


def position_sets() -> list[tuple[int, int, int]]:
    """Twenty triples of the positions 0-7, one of which lies within any four positions."""
    groups = ((0, 1, 2), (3, 4, 5), (6, 7))
    out = [t for g in groups for t in combinations(g, 3)]
    for i, g in enumerate(groups):
        out += [(*pair, other) for pair in combinations(g, 2) for other in groups[(i + 1) % 3]]
    return [tuple(sorted(t)) for t in out]


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64 bits."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(shingle_words, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    digest = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        spans = zip(starts[at : min(at + _CHUNK, n)].tolist(), ends[at + k - 1 : min(at + _CHUNK, n) + k - 1].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Per row: id, fp (the 64 bits as a signed long)."""
    docs = id_and_text(documents, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([fingerprint(x.as_py(), shingle_words) for x in b.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(found, pa.int64())], names=["id", "fp"])

    return docs.mapInArrow(run, f"id {dict(docs.dtypes)['id']}, fp long")


def _posting_keys() -> Column:
    """One key for each set of positions: the number of the set, then its three bytes."""
    byte = lambda p: F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255))
    keys = []
    for n, (a, b, c) in enumerate(position_sets()):
        keys.append(F.lit(n << 24).cast("long") + F.shiftleft(byte(a), 16) + F.shiftleft(byte(b), 8) + byte(c))
    return F.array(*keys)


def _forest(left: np.ndarray, right: np.ndarray, parent: dict[int, int], same: bool) -> Iterator[tuple[int, int]]:
    """Verified links between two arrays of fingerprints that join two trees of the group."""

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    columns = right.view(np.uint8).reshape(-1, 8)
    for i, fp in enumerate(left):
        others, bytes_ = (right[i + 1 :], columns[i + 1 :]) if same else (right, columns)
        tally = (bytes_ == fp.reshape(1).view(np.uint8)).sum(axis=1)
        near = others[tally >= 8 - MAX_BITS]
        for other in near[np.bitwise_count(near ^ fp) <= MAX_BITS].tolist():
            a, b = root(int(fp)), root(other)
            if a != b:
                parent[max(a, b)] = min(a, b)
                yield int(fp), other


def _group_links(fps: np.ndarray, block: np.ndarray) -> list[tuple[int, int]]:
    """fps of one group; block: their block numbers, of one or two blocks."""
    first = block[0]
    a, b = fps[block == first], fps[block != first]
    parent: dict[int, int] = {}
    return list(_forest(a, b, parent, False)) if len(b) else list(_forest(a, a, parent, True))


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group; the rows of one group (at most two blocks) are held at a time."""
    held: list[np.ndarray] = []

    def solve(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(rows):
            return
        cut = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
        starts, ends = np.r_[0, cut], np.r_[cut, len(rows)]
        wide = np.flatnonzero(ends - starts > 1)
        found = [x for s, e in zip(starts[wide].tolist(), ends[wide].tolist(), strict=True) for x in _group_links(rows[s:e, 4].astype(np.uint64), rows[s:e, 3])]
        if found:
            pairs = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.column_stack([batch.column(c).to_numpy() for c in ("key", "b1", "b2", "own", "fp")])
        rows = np.concatenate([*held, rows])
        last = np.flatnonzero((rows[:, :3] != rows[-1, :3]).any(axis=1))
        cut = int(last[-1]) + 1 if len(last) else 0
        yield from solve(rows[:cut])
        held = [rows[cut:]]
    if held:
        yield from solve(held[0])


def fingerprint_links(unique: DataFrame, max_posting: int = MAX_POSTING) -> DataFrame:
    """unique: column fp, distinct. Links (a, b) that connect what links directly or through others."""
    postings = unique.select("fp", F.explode(_posting_keys()).alias("key"))
    sizes = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    sized = postings.join(sizes, "key")
    blocks = F.ceil(F.col("n") / max_posting).cast("long")
    own = F.when(F.col("n") <= max_posting, F.lit(0).cast("long")).otherwise(F.pmod(F.xxhash64(F.col("fp"), F.lit(7)), blocks))
    dealt = sized.select("key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"))
    dealt = dealt.select("key", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), "own", "fp")
    return dealt.repartition("key", "b1", "b2").sortWithinPartitions("key", "b1", "b2", "own", "fp").mapInArrow(_links, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """links (a, b) of longs. Per linked node: node, root (the smallest node of its component).

    Alternating large-star and small-star rounds; every round is a table in the shared folder.
    """
    edges = saved(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        edges = saved(small.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, max_posting: int = MAX_POSTING) -> DataFrame:
    """Per row: id, fp, component (the smallest id that links reach, its own included)."""
    return grouped(saved(fingerprints(documents, id_col=id_col, text_col=text_col, shingle_words=shingle_words), "fingerprints"), max_posting)


def grouped(marked: DataFrame, max_posting: int = MAX_POSTING) -> DataFrame:
    """marked: id, fp and any other columns, in a table that can be read again. Adds component."""
    unique = saved(marked.groupBy("fp").agg(F.min("id").alias("least_id")), "unique")
    roots = saved(components(fingerprint_links(unique.select("fp"), max_posting)), "roots")
    named = unique.join(roots, unique["fp"] == roots["node"], "left").select(unique["fp"], "least_id", F.coalesce("root", unique["fp"]).alias("root"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component"))
    return marked.join(named.join(least, "root").select("fp", "component"), "fp")


def near_duplicate_report(found: DataFrame, id_name: str = "doc_id") -> DataFrame:
    return found.select(F.col("id").alias(id_name), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def keep_one_of_each(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, max_posting: int = MAX_POSTING) -> DataFrame:
    """One row of each group, with all its columns: that with the smallest id (null: last), then fingerprint, then text."""
    own, mark = fresh_name(documents, "fp"), fresh_name(documents, "times")
    marked = saved(fingerprints(documents, id_col=id_col, text_col=text_col, shingle_words=shingle_words), "fingerprints")
    first = F.struct(F.col("id").isNull().alias("last"), "id", "fp")
    unique = saved(marked.groupBy("fp", "id").agg(F.count("*").alias("times")), "unique")
    least = unique.groupBy("fp").agg(F.min(F.struct(first.alias("first"), "times")).alias("least"))
    roots = saved(components(fingerprint_links(unique.select("fp").distinct(), max_posting)), "roots")
    chosen = least.join(roots, least["fp"] == roots["node"], "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("least").alias("least"))
    chosen = saved(chosen.select(F.col("least.first.id").alias("kept_id"), F.col("least.first.fp").alias("kept_fp"), F.col("least.times").alias(mark)), "kept")

    @F.pandas_udf("long")
    def fp_of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t.encode() if t is not None else None, shingle_words) for t in texts], np.uint64).view(np.int64))

    # Dealt by id and fingerprint: the copies of one text spread, as their ids differ.
    kept = documents.withColumn(own, fp_of(F.col(text_col).cast("string"))).join(chosen, F.col(id_col).eqNullSafe(F.col("kept_id")) & (F.col(own) == F.col("kept_fp")))
    if chosen.where(F.col(mark) > 1).isEmpty():
        return kept.select(*documents.columns)
    one = fresh_name(documents, "one")
    repeated = kept.where(F.col(mark) > 1).withColumn(one, F.row_number().over(W.partitionBy(id_col, own).orderBy(text_col))).where(F.col(one) == 1)
    return kept.where(F.col(mark) == 1).select(*documents.columns).unionByName(repeated.select(*documents.columns))
