"""A Bloom filter of names, of bounded size: which runs of words may be one of very many names.

It holds the names' first words, so that most places of a text are passed over, and the whole names. Bits are set in
tasks, each for its own segments of the filter, and reach the driver as these segments: BITS_PER_NAME bits a name, and
never more than MAX_BITS in all, beyond which only the share of false candidates grows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_PER_NAME = 32
#: 64 MB in the driver, and in each Python worker.
MAX_BITS = 1 << 29
PROBES = 4
_SEGMENT = 1 << 20
_FIRST = np.uint64(0x51)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _hashes(words: Sequence[str]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ values >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return values ^ values >> np.uint64(31)


def _of_runs(hashes: np.ndarray, begins: np.ndarray, size: int) -> np.ndarray:
    """Hashes of runs of words, from those of the words."""
    out = np.full(len(begins), size, np.uint64)
    for j in range(size):
        out = _mixed(out * _FACTOR + hashes[begins + j])
    return out


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each key, one a row of the result."""
    step = _mixed(keys + _FACTOR) | np.uint64(1)
    return np.stack([(keys + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(PROBES)])


class NameFilter:
    def __init__(self, data: np.ndarray, sizes: Sequence[int]):
        """data: the bits, eight a byte. sizes: of the names, in words."""
        self.data, self.sizes = data, sorted(sizes)

    def _may_hold(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for place in _places(keys, 8 * len(self.data)):
            out &= (self.data[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return out

    def occurrences(self, words: Sequence[str]) -> list[tuple[int, int, str]]:
        """(first word, number of words, run of words) of all that may be names, from left to right, shorter ones first."""
        hashes = _hashes(words)
        begins = np.flatnonzero(self._may_hold(_mixed(hashes ^ _FIRST)))
        found: list[tuple[int, int]] = []
        for size in self.sizes:
            begins = begins[begins + size <= len(words)]
            if not len(begins):
                break
            found += [(i, size) for i in begins[self._may_hold(_of_runs(hashes, begins, size))].tolist()]
        return [(i, size, " ".join(words[i : i + size])) for i, size in sorted(found)]


def filter_bits(names: int) -> int:
    """A power of two."""
    return min(MAX_BITS, max(_SEGMENT, 1 << (BITS_PER_NAME * max(names, 1) - 1).bit_length()))


def name_filter(names: DataFrame, column: str = "name") -> Broadcast[NameFilter]:
    """Of names, one a row; each once, or the filter is larger than it need be."""
    spark = names.sparkSession
    rows = names.select(F.col(column).alias("name")).where("name <> ''")
    sizes = [(r.k, r.n) for r in rows.groupBy(F.size(F.split("name", " ")).alias("k")).agg(F.count("*").alias("n")).collect()]  # a few numbers
    bits = filter_bits(sum(n for _, n in sizes))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = [name.split(" ") for name in b.column("name").to_pylist()]
            if not each:
                continue
            hashes = _hashes([w for words in each for w in words])
            lengths = np.array([len(words) for words in each])
            begins = np.cumsum(lengths) - lengths
            keys = [_mixed(hashes[begins] ^ _FIRST), *(_of_runs(hashes, begins[lengths == k], int(k)) for k in np.unique(lengths))]
            place = np.unique(_places(np.concatenate(keys), bits)).astype(np.int64)
            segment, cut = np.unique(place // _SEGMENT, return_index=True)
            bits_of = np.split((place % _SEGMENT).astype("<u4"), cut[1:])
            yield pa.RecordBatch.from_arrays([pa.array(segment.astype(np.int32)), pa.array([x.tobytes() for x in bits_of], pa.binary())], names=["segment", "bits"])

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by segment: one segment is held."""
        now, held = None, np.zeros(_SEGMENT, bool)
        for b in batches:
            for segment, own in zip(b.column("segment").to_pylist(), b.column("bits"), strict=True):
                if segment != now:
                    if now is not None:
                        yield _segment(now, held)
                    now, held = segment, np.zeros(_SEGMENT, bool)
                held[np.frombuffer(own.as_py(), "<u4")] = True
        if now is not None:
            yield _segment(now, held)

    found = rows.mapInArrow(placed, "segment int, bits binary").repartition("segment").sortWithinPartitions("segment").mapInArrow(united, "segment int, bits binary")
    data = np.zeros(bits // 8, np.uint8)
    for r in found.toLocalIterator():
        data[r.segment * _SEGMENT // 8 : (r.segment + 1) * _SEGMENT // 8] = np.frombuffer(r.bits, np.uint8)
    return spark.sparkContext.broadcast(NameFilter(data, [k for k, _ in sizes]))


def _segment(number: int, held: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary())], names=["segment", "bits"])
