"""Packing token pieces into fixed windows by non-negative least squares over length combinations.

A document is tokenised and cut into full windows and one shorter tail. Full windows are
sequences of their own. For the tails:

1. the histogram of tail lengths is counted (at most WINDOW bins, whatever the corpus);
2. all combinations of up to DEPTH lengths that fill a window exactly are enumerated, and
   non-negative least squares solves how often each is used so that their sum matches the
   histogram (accelerated projected gradient; columns have at most DEPTH entries);
3. the counts are rounded within what the histogram holds;
4. what is left is packed greedily: pieces in order of falling length, laid end to end and cut
   at the windows' edges; the last window is split at powers of two.

The driver sees the histogram and the plan only. The k-th tail of a length takes the k-th slot
of that length in the plan, so a piece needs nothing but its rank within its length. Ranks come
from counters in the tokenising tasks plus prefix sums over (task, length) counts: no length,
however common, meets in one task, and token ids never shuffle. Only pieces that the greedy
step cuts are joined with their ids again, for the checksums of the parts.

Tokenising: words are split by a pattern that equals the tokenizer's own for texts of the
characters in _PLAIN and looked up in a bounded cache of byte-pair results; other texts, and
texts with the strings of added tokens, go through the tokenizer whole.

Defined results: a null or empty text is the separator id alone. Repeated rows are packed each.
Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from geoweave.llm.common import id_and_text, saved

WINDOW = 1024
DEPTH = 3
END_ID = 0
#: Words that the cache of a worker holds at most; it starts anew when full.
CACHE_WORDS = 300_000
#: Longer words are not kept in it.
CACHE_CHARS = 64
ITERATIONS = 400
#: Cut pieces that are broadcast at most (about 100 bytes each); more are joined by a shuffle.
MAX_BROADCAST_PIECES = 50_000
#: Offsets (one a task and length) that are broadcast at most; more meet the pieces in a sort by task and length.
MAX_BROADCAST_OFFSETS = 1_000_000

_PLAIN = re.compile("[^\t\n\r -~À-ÖØ-öø-ÿ]")
_SPLIT = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


class Tokenizer:
    """Token ids of a text as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        import json

        import tiktoken
        import tokenizers

        self.whole = tokenizers.Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        visible = _byte_characters()
        added = {t["content"] for t in model.get("added_tokens", [])}
        ranks = {bytes(visible[c] for c in token): n for token, n in model["model"]["vocab"].items() if token not in added}
        self.piece = tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.added = re.compile("|".join(map(re.escape, sorted(added)))) if added else None
        self.cache: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        if _PLAIN.search(text) or self.added and self.added.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = _SPLIT.findall(text)
        cache = self.cache
        try:
            return b"".join([cache[w] for w in words])
        except KeyError:
            if len(cache) > CACHE_WORDS:
                cache.clear()
            out = []
            for w in words:
                ids = cache.get(w)
                if ids is None:
                    ids = np.array(self.piece(w.encode()), "<u4").tobytes()
                    if len(w) <= CACHE_CHARS:
                        cache[w] = ids
                out.append(ids)
            return b"".join(out)


def _byte_characters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one character: printable Latin-1 as itself, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def combinations_filling(window: int, present: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Rows of up to depth lengths in falling order (0: none) that sum to the window; only lengths that are present."""
    has = np.zeros(window + 1, bool)
    has[present] = True
    rows = []
    if depth >= 2:
        a = np.arange((window + 1) // 2, window)
        b = window - a
        ok = has[a] & has[b]
        rows.append(np.column_stack([a[ok], b[ok], np.zeros(ok.sum(), int)]))
    if depth >= 3:
        a, b = np.meshgrid(np.flatnonzero(has[:window]), np.flatnonzero(has[:window]), indexing="ij")
        a, b = a.ravel(), b.ravel()
        c = window - a - b
        ok = (a >= b) & (b >= c) & (c >= 1)
        ok[ok] &= has[c[ok]]
        rows.append(np.column_stack([a[ok], b[ok], c[ok]]))
    return np.concatenate(rows) if rows else np.zeros((0, 3), int)


def solve_counts(histogram: np.ndarray, combos: np.ndarray, iterations: int = ITERATIONS) -> np.ndarray:
    """x >= 0 that minimises |A x - histogram|, A[length, combination] = how often the combination holds the length."""
    n = len(histogram)
    if not len(combos) or not histogram.any():
        return np.zeros(len(combos))
    scale = histogram.max()
    target = histogram / scale

    def forward(x: np.ndarray) -> np.ndarray:
        out = np.bincount(combos.ravel(), np.repeat(x, combos.shape[1]), minlength=n)
        out[0] = 0
        return out

    def back(r: np.ndarray) -> np.ndarray:
        r = r.copy()
        r[0] = 0
        return r[combos].sum(axis=1)

    v = np.ones(len(combos))
    for _ in range(20):  # the largest eigenvalue of A'A bounds the step
        v = back(forward(v))
        v /= np.linalg.norm(v)
    step = 1 / (1.05 * np.linalg.norm(back(forward(v))))
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(iterations):
        new = np.maximum(0, y - step * back(forward(y) - target))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x * scale


@dataclass(frozen=True)
class Plan:
    """Where the k-th piece of a length goes. Arrays are grouped by length and ordered by first rank."""

    window: int
    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    per_sequence: np.ndarray
    offset: np.ndarray
    used: np.ndarray
    left: np.ndarray
    left_start: np.ndarray
    line_tokens: int
    line_sequence: int
    #: rows of length n: bounds[n] up to bounds[n + 1]
    bounds: np.ndarray


def make_plan(histogram: np.ndarray, window: int = WINDOW, depth: int = DEPTH) -> Plan:
    """histogram[n]: pieces of n tokens, 1 <= n <= window. Sequences 0.. hold full windows, then combinations, then the greedy line."""
    histogram = histogram.astype(np.int64)
    tails = histogram.copy()
    tails[0] = tails[window] = 0
    rows, used, sequence = [], np.zeros(window + 1, np.int64), int(histogram[window])
    # Counts below one half round to zero; what they held is solved again, with fewer and with all combinations.
    for step in (depth, min(2, depth), depth):
        combos = combinations_filling(window, np.flatnonzero(tails - used), step)
        counts = solve_counts(tails - used, combos)
        for i in np.argsort(-counts, kind="stable"):
            if counts[i] < 0.5:
                break
            parts = [int(p) for p in combos[i] if p]
            repeat = min([round(counts[i]), *((tails[p] - used[p]) // parts.count(p) for p in parts)])
            if repeat <= 0:
                continue
            offset = 0
            for p in dict.fromkeys(parts):
                rows.append((p, used[p], sequence, parts.count(p), offset))
                used[p] += repeat * parts.count(p)
                offset += p * parts.count(p)
            sequence += int(repeat)
    rows.sort(key=lambda r: (r[0], r[1]))
    table = np.array(rows, np.int64).reshape(-1, 5)
    left = tails - used
    tokens = left * np.arange(window + 1)
    starts = np.zeros(window + 1, np.int64)
    starts[::-1][1:] = np.cumsum(tokens[::-1])[:-1]  # falling length
    return Plan(window, table[:, 0], table[:, 1], table[:, 2], table[:, 3], table[:, 4], used, left, starts, int(tokens.sum()), sequence, np.searchsorted(table[:, 0], np.arange(window + 2)))


def place(plan: Plan, length: int, rank: int) -> list[tuple[int, int, int]]:
    """(sequence, offset, tokens) of the parts of one piece, in the order of its tokens."""
    if length == plan.window:
        return [(rank, 0, length)]
    if rank < plan.used[length]:
        low, high = plan.bounds[length], plan.bounds[length + 1]
        i = low + np.searchsorted(plan.first[low:high], rank, "right") - 1
        k = rank - int(plan.first[i])
        m = int(plan.per_sequence[i])
        return [(int(plan.sequence[i]) + k // m, int(plan.offset[i]) + k % m * length, length)]
    at = int(plan.left_start[length]) + (rank - int(plan.used[length])) * length
    return line_parts(plan, at, length)


def line_parts(plan: Plan, at: int, length: int) -> list[tuple[int, int, int]]:
    """Parts of a piece that begins at this token of the greedy line. The last, partial window is cut at powers of two."""
    out, end = [], at + length
    full = plan.line_tokens // plan.window
    while at < end:
        w = at // plan.window
        base, sequence, room = w * plan.window, plan.line_sequence + w, plan.window
        if w == full:
            rest, inside = plan.line_tokens - base, at - base
            for bit in reversed(range(rest.bit_length())):
                if rest >> bit & 1:
                    if inside < 1 << bit:
                        room = 1 << bit
                        break
                    inside -= 1 << bit
                    base += 1 << bit
                    sequence += 1
        take = min(end, base + room) - at
        out.append((sequence, at - base, take))
        at += take
    return out


_PIECE = "task long, row long, doc_id {id}, start long, length long, rank long, doc_tokens long, crc long, ids binary"


def token_pieces(documents: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Pieces of at most a window with their ids (unsigned 32-bit little-endian), and their rank in (task, length)."""
    docs = id_and_text(documents, id_col, text_col)
    kind = dict(docs.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, row = tokenizer(tokenizer_path), TaskContext.get().partitionId(), 0
        ranks = [0] * (window + 1)
        end, width = END_ID.to_bytes(4, "little"), 4 * window
        for b in batches:
            index, cols = [], tuple([] for _ in range(7))
            for i, x in enumerate(b.column("text")):
                text = x.as_py()
                ids = (encode(text.decode()) if text else b"") + end
                for at in range(0, len(ids), width):
                    part = ids[at : at + width]
                    n = len(part) // 4
                    index.append(i)
                    for col, v in zip(cols, (row, at // 4, n, ranks[n], len(ids) // 4, zlib.crc32(part), part), strict=True):
                        col.append(v)
                    ranks[n] += 1
                    row += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(row and len(index), task), pa.int64()), pa.array(cols[0], pa.int64()), b.column("id").take(pa.array(index, pa.int64())), *(pa.array(c, pa.int64()) for c in cols[1:6]), pa.array(cols[6], pa.binary())],
                names=["task", "row", "doc_id", "start", "length", "rank", "doc_tokens", "crc", "ids"],
            )

    return docs.mapInArrow(run, _PIECE.format(id=kind))


def pack(documents: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, depth: int = DEPTH) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and task and row, which lead to its ids in `pieces`."""
    return place_pieces(saved(token_pieces(documents, tokenizer_path, id_col=id_col, text_col=text_col, window=window), "pieces"), window, depth)


def place_pieces(pieces: DataFrame, window: int = WINDOW, depth: int = DEPTH) -> DataFrame:
    """pieces: the saved table of token_pieces."""
    spark = pieces.sparkSession
    counts = saved(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "lengths")
    histogram = np.zeros(window + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most one row a length
        histogram[r.length] = r.n
    made = make_plan(histogram, window, depth)
    plan = spark.sparkContext.broadcast(made)
    before = F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("task", "length", before.alias("before"))
    offsets = F.broadcast(offsets) if counts.count() <= MAX_BROADCAST_OFFSETS else offsets.hint("merge")
    light = pieces.drop("ids").join(offsets, ["task", "length"])
    # Pieces with a slot in the plan stay whole; only the others are laid on the greedy line, where they may be cut.
    planned = (F.col("rank") + F.col("before") < F.element_at(F.lit(made.used.tolist()), F.col("length").cast("int") + 1)) | (F.col("length") == window)
    kind = dict(pieces.dtypes)["doc_id"]
    columns = ["task", "row", "doc_id", "start", "length", "doc_tokens", "crc"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        for b in batches:
            index, parts, first = [], [], []
            length, rank = b.column("length").to_pylist(), (b.column("rank").to_numpy() + b.column("before").to_numpy()).tolist()
            for i, (n, k) in enumerate(zip(length, rank, strict=True)):
                at = 0
                for part in place(p, n, k):
                    index.append(i)
                    parts.append(part)
                    first.append(at)
                    at += part[2]
            took = np.array(parts, np.int64).reshape(-1, 3)
            out = b.select(columns).take(pa.array(index, pa.int64()))
            yield pa.RecordBatch.from_arrays([*out.columns, *(pa.array(took[:, i].copy()) for i in range(3)), pa.array(first, pa.int64())], names=[*columns, "sequence_id", "offset", "part", "skip"])

    schema = f"task long, row long, doc_id {kind}, start long, length long, doc_tokens long, crc long, sequence_id long, offset long, part long, skip long"
    result = ["doc_id", (F.col("start") + F.col("skip")).alias("start"), F.col("part").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset", "task", "row"]
    whole = light.where(planned).mapInArrow(run, schema).withColumn("ids_crc32", F.col("crc")).select(*result)
    cut = light.where(~planned).mapInArrow(run, schema)
    # The plan knows how many pieces it cuts at most; few enough go to the tables of ids, not these to them.
    cut = (F.broadcast(cut) if int(made.left.sum()) <= MAX_BROADCAST_PIECES else cut).join(pieces.select("task", "row", "ids"), ["task", "row"])
    cut = cut.withColumn("ids_crc32", F.crc32(F.expr("substring(ids, cast(4 * skip + 1 as int), cast(4 * part as int))"))).select(*result)
    return whole.unionByName(cut)
