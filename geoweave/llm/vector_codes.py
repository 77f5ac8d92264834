"""Product codes of vectors: a codebook for each part of a vector, and nearest entries found by segment-mean lower bounds.

A component x becomes the integer floor(1024 * x), and vectors are cut into PARTS equal parts. A part's
codebook begins as that part of the ENTRIES vectors with the smallest ids, and each round of ROUNDS
assigns every part to its nearest entry (squared Euclidean distance, ties to the lower index) and
moves each entry to the floor of the mean of its parts; entries without parts stay.

Nearest entries are searched from coarse to fine. At each level a part is cut into blocks (one, four,
sixteen, ...); from the means of the blocks and the norm of what the means leave over, the distance to an
entry is bounded from below: the means differ by their own distance, and the rest by at least the
difference of its norms. Entries whose bound lies above the best known distance go; the bounds
are computed in floating point and lowered by more than its error, so that none goes wrongly. Only
those that are left at the finest level get exact integer distances.

Scale: vectors become one table of integers, which every round reads once. A task sums up its own parts for each
entry, so that a round shuffles PARTS * ENTRIES rows a task at most, and the driver gets that many rows in all,
whatever the number of vectors. Labels are summed before they meet; sums of labels with more than HOT_LABEL rows
reach these by a broadcast (there are at most one for each HOT_LABEL rows), so that no label's rows meet in one task.

Defined results: rows whose vector is null or holds a null or non-finite component are dropped. Vectors shorter than
the longest, rounded up to a multiple of PARTS, are filled up with zeros. Integers beyond LIMIT count as LIMIT, so that
distances fit in 64 bits. Null ids come after all others; of equal ids the vectors' bytes decide. Repeated rows are coded
each and count each. Sums of errors beyond 64 bits count as the largest. Other columns are not read, whatever
their names. An empty table, or one without a kept row, gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.llm.common import saved

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
LIMIT = 1 << 25
#: Rows of a label whose sum is broadcast in any case.
HOT_LABEL = 1_000_000
#: Labels whose sums are broadcast at most, besides.
MAX_BROADCAST_LABELS = 100_000
#: Numbers that a step of the search holds at most.
_CELLS = 1 << 21
_MOST = (1 << 63) - 1


class Parts:
    """Vectors of one part, with the features of each level."""

    def __init__(self, rows: np.ndarray, levels: list[int]):
        self.rows = rows.astype(np.int64)
        wide = rows.astype(np.float64)
        self.squares = (wide * wide).sum(axis=1)
        self.levels = [self._features(wide, n) for n in levels]

    def _features(self, wide: np.ndarray, blocks: int) -> np.ndarray:
        """Block means, scaled so that their squared differences are those of the blocks, and the norm of the rest."""
        starts = np.arange(blocks) * wide.shape[1] // blocks
        sizes = np.diff(np.r_[starts, wide.shape[1]])
        means = np.add.reduceat(wide, starts, axis=1) / np.sqrt(sizes)
        rest = np.sqrt(np.maximum(self.squares - (means * means).sum(axis=1), 0))
        return np.column_stack([means, rest])


def levels_of(width: int) -> list[int]:
    """Numbers of blocks, from coarse to fine."""
    out = [1]
    while out[-1] * 4 < width:
        out.append(out[-1] * 4)
    return out


def lower_bounds(a: np.ndarray, b: np.ndarray, squares_a: np.ndarray, squares_b: np.ndarray) -> np.ndarray:
    """Of features in the last axis: no more than the squared distance, whatever the rounding."""
    gap = a - b
    return (gap * gap).sum(axis=-1) * (1 - 1e-9) - 1e-5 * (squares_a + squares_b) - 1


def nearest(rows: np.ndarray, book: Parts) -> tuple[np.ndarray, np.ndarray]:
    """For each row the index of the nearest entry, the lowest of equals, and the squared distance."""
    n, width = rows.shape
    entries = len(book.rows)
    index, least = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not width:
        return index, least
    step = max(1, _CELLS // (entries * width))
    for at in range(0, n, step):
        index[at : at + step], least[at : at + step] = _nearest(Parts(rows[at : at + step], levels_of(width)), book)
    return index, least


def _nearest(own: Parts, book: Parts) -> tuple[np.ndarray, np.ndarray]:
    exact = lambda i, j: ((own.rows[i] - book.rows[j]) ** 2).sum(axis=1)
    every = np.arange(len(own.rows))
    bounds = lower_bounds(own.levels[0][:, None], book.levels[0][None], own.squares[:, None], book.squares[None])
    best = exact(every, bounds.argmin(axis=1))
    i, j = np.nonzero(bounds <= best[:, None])
    for a, b in zip(own.levels[1:], book.levels[1:], strict=True):
        bounds = lower_bounds(a[i], b[j], own.squares[i], book.squares[j])
        first = np.searchsorted(i, every)
        lowest = np.minimum.reduceat(bounds, first)
        at = np.minimum.reduceat(np.where(bounds == lowest[i], np.arange(len(i)), len(i)), first)
        best = np.minimum(best, exact(every, j[at]))
        kept = bounds <= best[i]
        i, j = i[kept], j[kept]
    distances = exact(i, j)
    first = np.searchsorted(i, every)
    least = np.minimum.reduceat(distances, first)
    return np.minimum.reduceat(np.where(distances == least[i], j, len(book.rows)), first), least


def integers(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per kept row: id, label, size, and the components as little-endian 32-bit integers."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column("vector")
            index, sizes, found = [], [], []
            flat = column.flatten()
            values = flat.to_numpy(zero_copy_only=False)  # nulls become NaN
            at = 0
            for i, row in enumerate(column.is_valid().to_pylist()):
                if not row:
                    continue
                size = len(column[i])
                own = values[at : at + size]
                at += size
                if np.isfinite(own).all():
                    index.append(i)
                    sizes.append(size)
                    found.append(np.clip(np.floor(own * SCALE), -LIMIT, LIMIT).astype("<i4").tobytes())
            kept = b.select(["id", "label"]).take(pa.array(index, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sizes, pa.int32()), pa.array(found, pa.binary())], names=["id", "label", "size", "integers"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, size int, integers binary")


def matrix(integers: list[bytes], width: int) -> np.ndarray:
    """Rows of integers, filled up with zeros."""
    if all(len(x) == 4 * width for x in integers):
        return np.frombuffer(b"".join(integers), "<i4").reshape(len(integers), width)
    return np.array([np.pad(own := np.frombuffer(x, "<i4"), (0, width - len(own))) for x in integers], np.int32).reshape(len(integers), width)


def _books(codebooks: np.ndarray) -> list[Parts]:
    return [Parts(part, levels_of(part.shape[1]) if part.shape[1] else []) for part in codebooks]


def _split(batch: pa.RecordBatch, codebooks: np.ndarray) -> np.ndarray:
    parts, _, width = codebooks.shape
    return matrix(batch.column("integers").to_pylist(), parts * width).reshape(batch.num_rows, parts, width)


def _moved(rows: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after one round."""
    parts, entries, width = codebooks.shape
    shared = rows.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        books = _books(own)
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for b in batches:
            each = _split(b, own)
            for p in range(parts):
                index, _ = nearest(each[:, p], books[p])
                counts[p] += np.bincount(index, minlength=entries)
                np.add.at(sums[p], index, each[:, p])
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(counts[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    found = rows.select("integers").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    total = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)))
    moved = codebooks.copy()
    for r in total.collect():  # one row an entry
        moved[r.part, r.entry] = [r[f"s{i}"] // r.n for i in range(width)]
    return moved


def fit(rows: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """rows: of `integers`, in a table that can be read again. The codebooks: part, entry, position."""
    longest = rows.agg(F.max("size")).first()[0] or 0
    width = -(-longest // parts)
    first = rows.orderBy(F.col("id").asc_nulls_last(), "integers").limit(entries).select("integers").collect()
    start = matrix([r.integers for r in first], parts * width)
    codebooks = np.ascontiguousarray(start.reshape(len(first), parts, width).transpose(1, 0, 2)).astype(np.int64)
    return reduce(lambda books, _: _moved(rows, books), range(rounds if len(first) else 0), codebooks)


def encode(rows: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """rows: of `integers`. Per row: id, label, code (two hexadecimal digits a part), error."""
    shared = rows.sparkSession.sparkContext.broadcast(codebooks)
    digits = max(2, len(f"{max(codebooks.shape[1] - 1, 0):x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = _books(shared.value)
        for b in batches:
            if not b.num_rows:
                continue
            each = _split(b, shared.value)
            found = [nearest(each[:, p], book) for p, book in enumerate(books)]
            codes = ["".join(f"{x:0{digits}x}" for x in row) for row in np.column_stack([index for index, _ in found]).tolist()]
            error = np.sum([least for _, least in found], axis=0)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(codes), pa.array(error.astype(np.int64))], names=["id", "label", "code", "error"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def decode(code: str, codebooks: np.ndarray) -> np.ndarray:
    """The components that a code stands for."""
    digits = len(code) // len(codebooks)
    return np.concatenate([part[int(code[i * digits : (i + 1) * digits], 16)] for i, part in enumerate(codebooks)]) / SCALE


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.reshape(-1).tolist())).encode()).hexdigest()


def with_label_errors(coded: DataFrame, hot_label: int = HOT_LABEL, max_broadcast: int = MAX_BROADCAST_LABELS) -> DataFrame:
    """coded: in a table that can be read again. Adds label_error, the sum over the rows of equal labels (nulls are equal)."""
    total = F.least(F.sum(F.col("error").cast("decimal(20,0)")), F.lit(_MOST).cast("decimal(38,0)")).cast("long")
    sums = saved(coded.groupBy(F.col("label").alias("of_label")).agg(F.count("*").alias("n"), total.alias("label_error")), "label-errors")
    same = F.col("label").eqNullSafe(F.col("of_label"))
    columns = [*coded.columns, "label_error"]
    if sums.limit(max_broadcast + 1).count() <= max_broadcast:
        return coded.join(F.broadcast(sums), same).select(*columns)
    hot, rest = F.broadcast(sums.where(F.col("n") > hot_label)), sums.where(F.col("n") <= hot_label)
    of_hot = coded.join(hot, same).select(*columns)
    return of_hot.unionByName(coded.join(hot, same, "left_anti").join(rest, same).select(*columns))


def compress(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Per kept row: id, label, code, error, label_error, codebooks_sha256."""
    rows = saved(integers(vectors, id_col=id_col, vector_col=vector_col, label_col=label_col), "integers")
    codebooks = fit(rows, parts=parts, entries=entries, rounds=rounds)
    coded = saved(encode(rows, codebooks), "codes")
    return with_label_errors(coded).withColumn("codebooks_sha256", F.lit(digest(codebooks)))


def code_report(found: DataFrame, id_name: str = "vec_id") -> DataFrame:
    return found.select(F.col("id").alias(id_name), "code", "error", "label_error", "codebooks_sha256")


def _report_sql() -> str:
    floor_mean = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(
            f"near{r} AS MATERIALIZED (SELECT k, part, min(d * {ENTRIES} + entry) AS best FROM (SELECT x.k, x.part, e.entry, "
            f"CAST(x.sq - 2 * list_dot_product(x.v, e.v) + list_dot_product(e.v, e.v) AS HUGEINT) AS d FROM parts x JOIN book{r} e USING (part)) GROUP BY k, part)"
        )
        if r < ROUNDS:
            steps.append(
                f"moved{r} AS (SELECT part, entry, list(CAST({floor_mean} AS DOUBLE) ORDER BY pos) AS v FROM (SELECT a.part, a.best % {ENTRIES} AS entry, c.pos, CAST(sum(CAST(c.x AS HUGEINT)) AS HUGEINT) AS s, CAST(count(*) AS HUGEINT) AS n "
                f"FROM near{r} a JOIN cells c USING (k, part) GROUP BY ALL) GROUP BY part, entry)"
            )
            steps.append(f"book{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN moved{r} m ON m.part = b.part AND m.entry = b.entry)")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS k, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS ints
  FROM embeddings WHERE embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)
), sized AS (SELECT *, len(ints) // {PARTS} AS w FROM kept
), parts AS MATERIALIZED (
  SELECT k, p AS part, ints[p * w + 1 : (p + 1) * w] AS v, list_dot_product(ints[p * w + 1 : (p + 1) * w], ints[p * w + 1 : (p + 1) * w]) AS sq FROM sized, range({PARTS}) AS t(p)
), cells AS MATERIALIZED (SELECT k, part, unnest(v) AS x, unnest(range(len(v))) AS pos FROM parts
), book0 AS MATERIALIZED (SELECT part, k AS entry, v FROM parts WHERE k < {ENTRIES}
), {", ".join(steps)},
digest AS (SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM (SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS pos FROM book{ROUNDS})),
coded AS (SELECT k, string_agg(lpad(lower(to_hex(CAST(best % {ENTRIES} AS BIGINT))), 2, '0'), '' ORDER BY part) AS code, CAST(sum(best // {ENTRIES}) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY k)
SELECT kept.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY kept.label) AS BIGINT) AS label_error, codebooks_sha256 FROM kept JOIN coded USING (k), digest
"""


#: For vectors of one length that four divides, and different ids.
REPORT_SQL = _report_sql()
