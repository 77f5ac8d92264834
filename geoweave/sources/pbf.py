"""OpenStreetMap's binary format (.osm.pbf): nodes, ways and relations as tables, in the columns of `osm`.

A file is a row of blobs. Each but the first begins with the same mark (its header's type, "OSMData"), so that
Spark's text reader, with the mark as the end of a line, hands out the blobs: a file is read in byte ranges, a blob is
whole in one task, and no task or driver reads a file from end to end. Blobs are unpacked and decoded in
Arrow batches; a task holds one batch of blobs (BATCH_BYTES, or one blob) and the rows of one blob. The lists of a
blob's elements are decoded, and encoded, all at once.

That a blob's bytes hold the mark by chance is excluded by the sizes that headers give: what does not fit them is an
error, as are blobs packed in a way that is not read (lz4, bzip2), and files that need what this reader does
not know (histories).

Positions are whole numbers of nanodegrees divided by 10^9, which is the nearest double, as for the decimal
numbers of XML. Elements come in no order. A file without elements gives empty tables.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.sources.wire import fields, packed_lists, running, signed, steps, unpacked, unpacked_lists, varint, zigzag

#: What each blob of elements begins with.
MARK = "\n\x07OSMData"
_FIRST = b"\n\x09OSMHeader"
#: What a header may ask of a reader.
FEATURES = ("OsmSchema-V0.6", "DenseNodes")
#: Bytes of blobs that a task hands to Python at a time.
BATCH_BYTES = 32 << 20
_KINDS = ("node", "way", "relation")
NODE = "ref long, point struct<lon:double,lat:double>"
WAY = "id long, tags map<string,string>, refs array<long>"
RELATION = "id long, tags map<string,string>, members array<struct<type:string,ref:long,role:string>>"
_POINT = pa.struct([("lon", pa.float64()), ("lat", pa.float64())])
_TAGS = pa.map_(pa.string(), pa.string())
_MEMBER = pa.struct([("type", pa.string()), ("ref", pa.int64()), ("role", pa.string())])


def _blob(record: bytes) -> bytes | None:
    """The packed blob of what stands between two marks; None for what stands before the first."""
    data, size = record, None
    first = record[4 : 4 + len(_FIRST)] == _FIRST
    at = 4 + len(_FIRST) if first else 0
    while size is None:
        key, at = varint(data, at)
        if key == 3 << 3:
            size, at = varint(data, at)
        elif key == 2 << 3 | 2:
            n, at = varint(data, at)
            at += n
        else:
            raise ValueError("the header of a blob has an unknown field")
    left = len(data) - at - size
    # After a blob stands the length of the next header, or the file ends.
    if left not in (0, 4):
        raise ValueError("the size of a blob does not fit its header")
    if not first:
        return data[at : at + size]
    needed = [v.decode() for n, v in fields(_opened(data[at : at + size])) if n == 4]
    unknown = sorted(set(needed) - set(FEATURES))
    if unknown:
        raise ValueError(f"the file needs features that are not read: {', '.join(unknown)}")
    return None


def _opened(blob: bytes) -> bytes:
    for number, value in fields(blob):
        if number == 1:
            return value
        if number == 3:
            return zlib.decompress(value)
        if number == 4:
            import lzma

            return lzma.decompress(value)
        if number == 7:
            import zstandard

            return zstandard.ZstdDecompressor().decompressobj().decompress(value)
        if number in (5, 6):
            raise ValueError("a blob is packed by bzip2 or lz4, which are not read")
    return b""


class _Block:
    """One block: its strings, its groups, and the scale of its positions. Strings are decoded when they are asked for."""

    def __init__(self, data: bytes):
        self._table = b""
        self.groups: list[bytes] = []
        self.granularity, self.lat, self.lon = 100, 0, 0
        for number, value in fields(data):
            if number == 1:
                self._table = value
            elif number == 2:
                self.groups.append(value)
            elif number == 17:
                self.granularity = value
            elif number == 19:
                self.lat = signed(value)
            elif number == 20:
                self.lon = signed(value)

    def elements(self, wanted: int) -> Iterator[bytes]:
        return (value for group in self.groups for number, value in fields(group) if number == wanted)

    def points(self, lon: np.ndarray, lat: np.ndarray) -> pa.StructArray:
        of = lambda base, each: pa.array((base + self.granularity * each) / 1e9)
        return pa.StructArray.from_arrays([of(self.lon, lon), of(self.lat, lat)], fields=list(_POINT))

    @cached_property
    def strings(self) -> pa.Array:
        return pa.array([s.decode(errors="replace") for n, s in fields(self._table) if n == 1], pa.string())

    def tags(self, each: list[dict]) -> pa.Array:
        """A key that comes twice keeps its last value."""
        (keys, begins), (values, same) = (unpacked_lists([own.get(n, b"") for own in each]) for n in (2, 3))
        if not np.array_equal(begins, same):
            raise ValueError("an element has more keys than values, or fewer")
        keys, items = self.strings.take(pa.array(keys)), self.strings.take(pa.array(values))
        codes = keys.dictionary_encode()
        rows = np.repeat(np.arange(len(each)), np.diff(begins))
        if len(np.unique(rows * (len(codes.dictionary) + 1) + codes.indices.to_numpy())) < len(rows):
            pairs = list(zip(keys.to_pylist(), items.to_pylist(), strict=True))
            return pa.array([list(dict(pairs[a:b]).items()) for a, b in zip(begins, begins[1:], strict=False)], _TAGS)
        return pa.MapArray.from_arrays(pa.array(begins), keys, items)


def _running(data: bytes) -> np.ndarray:
    """A list of differences, as the numbers themselves."""
    return np.cumsum(zigzag(unpacked(data)))


def _nodes(block: _Block) -> Iterator[pa.RecordBatch]:
    for dense in block.elements(2):
        own = dict(fields(dense))
        ids, lat, lon = (_running(own.get(n, b"")) for n in (1, 8, 9))
        yield pa.RecordBatch.from_arrays([pa.array(ids), block.points(lon, lat)], names=["ref", "point"])
    plain = [dict(fields(n)) for n in block.elements(1)]
    if plain:
        ids, lat, lon = (zigzag(np.array([own.get(n, 0) for own in plain], np.uint64)) for n in (1, 8, 9))
        yield pa.RecordBatch.from_arrays([pa.array(ids), block.points(lon, lat)], names=["ref", "point"])


def _tagged(block: _Block, wanted: int) -> tuple[list[dict], list[pa.Array]]:
    each = [dict(fields(x)) for x in block.elements(wanted)]
    return each, [pa.array([signed(own[1]) for own in each], pa.int64()), block.tags(each)] if each else []


def _ways(block: _Block) -> Iterator[pa.RecordBatch]:
    each, columns = _tagged(block, 3)
    if each:
        found, begins = unpacked_lists([own.get(8, b"") for own in each])
        refs = pa.ListArray.from_arrays(pa.array(begins), pa.array(running(found, begins)))
        yield pa.RecordBatch.from_arrays([*columns, refs], names=["id", "tags", "refs"])


def _relations(block: _Block) -> Iterator[pa.RecordBatch]:
    each, columns = _tagged(block, 4)
    if each:
        (roles, begins), (found, refs), (kinds, types) = (unpacked_lists([own.get(n, b"") for own in each]) for n in (8, 9, 10))
        if not np.array_equal(begins, refs) or not np.array_equal(begins, types):
            raise ValueError("the lists of a relation's members are not of one length")
        parts = [pa.array(_KINDS).take(pa.array(kinds)), pa.array(running(found, refs)), block.strings.take(pa.array(roles))]
        members = pa.ListArray.from_arrays(pa.array(begins), pa.StructArray.from_arrays(parts, fields=list(_MEMBER)))
        yield pa.RecordBatch.from_arrays([*columns, members], names=["id", "tags", "members"])


def _read(spark: SparkSession, path: str, decode: Callable[[_Block], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(limit, "2147483647").rstrip("b") or 0) > BATCH_BYTES:
        spark.conf.set(limit, str(BATCH_BYTES))
    blobs = spark.read.text(path, lineSep=MARK).select(F.col("value").cast("binary").alias("blob"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for record in b.column("blob"):
                blob = _blob(record.as_py())
                if blob is not None:
                    yield from decode(_Block(_opened(blob)))

    return blobs.mapInArrow(run, schema)


def nodes(spark: SparkSession, path: str) -> DataFrame:
    """ref, point (lon, lat)."""
    return _read(spark, path, _nodes, NODE)


def ways(spark: SparkSession, path: str) -> DataFrame:
    """id, tags, refs (node ids in order)."""
    return _read(spark, path, _ways, WAY)


def relations(spark: SparkSession, path: str) -> DataFrame:
    """id, tags, members (type, ref, role)."""
    return _read(spark, path, _relations, RELATION)


# ---------------------------------------------------------------- writing

#: A whole blob that holds nothing: Spark's text writer puts it between the rows of a file.
_NOTHING = "\0\0\0\x0b\n\x07OSMData\x18\x06\n\x02\n\0\x10\x02"
#: Elements of a blob.
BLOB_ROWS = 8000


def _number(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes([*out, value])


def _field(number: int, value: int | bytes) -> bytes:
    if isinstance(value, int):
        return _number(number << 3) + _number(value & (1 << 64) - 1)
    return _number(number << 3 | 2) + _number(len(value)) + value


def _list(values: list[int]) -> bytes:
    return b"".join(map(_number, values))


def _steps(values: list[int]) -> bytes:
    """Differences, as zigzag numbers."""
    return _list([(d << 1) ^ (d >> 63) for d in (b - a for a, b in zip([0, *values], values, strict=False))])


def _framed(kind: bytes, content: bytes) -> bytes:
    blob = _field(2, len(content)) + _field(3, zlib.compress(content))
    header = _field(1, kind) + _field(3, len(blob))
    return len(header).to_bytes(4, "big") + header + blob


def _known(values: pa.Array) -> pa.Array:
    if values.null_count:
        raise ValueError("an element without a number or position, or a tag without a value, cannot be written")
    return values


def _lists_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """What the lists (or maps) of a column hold, and where each begins and the last ends. A null is an empty list."""
    begins = column.offsets.to_numpy()
    return column.values.slice(begins[0], begins[-1] - begins[0]), begins - begins[0]


def _part(structs: pa.StructArray, name: str) -> pa.Array:
    return structs.flatten()[structs.type.get_field_index(name)]


def _units(values: pa.Array) -> np.ndarray:
    degrees = _known(values).to_numpy()
    if not np.isfinite(degrees).all():
        raise ValueError("a position that is no number cannot be written")
    return np.rint(degrees * 1e7).astype(np.int64)


def _written(kind: str, rows: pa.RecordBatch) -> bytes:
    if kind == "node":
        lat, lon = (_units(_part(rows.column("point"), c)) for c in ("lat", "lon"))
        whole = np.array([0, rows.num_rows])
        lists = [packed_lists(steps(v, whole), whole)[0] for v in (_known(rows.column("ref")).to_numpy(), lat, lon)]
        return _framed(b"OSMData", _field(1, _field(1, b"")) + _field(2, _field(2, b"".join(map(_field, (1, 8, 9), lists)))))
    tags, tagged = _lists_of(rows.column("tags"))
    keys, items = tags.flatten()
    texts = [_known(keys), _known(items)]
    if kind == "relation":
        members, begins = _lists_of(rows.column("members"))
        refs = _part(members, "ref")
        texts.append(_part(members, "role").fill_null(""))
    else:
        refs, begins = _lists_of(rows.column("refs"))
    coded = pa.concat_arrays(texts).dictionary_encode()
    # The first string is none.
    numbers = np.split(coded.indices.to_numpy() + 1, np.cumsum([len(x) for x in texts])[:-1])
    lists = [(2, packed_lists(numbers[0], tagged)), (3, packed_lists(numbers[1], tagged))]
    found = packed_lists(steps(_known(refs).to_numpy(), begins), begins)
    if kind == "relation":
        kinds = pc.index_in(_part(members, "type"), pa.array(_KINDS))
        lists += [(8, packed_lists(numbers[2], begins)), (9, found), (10, packed_lists(_known(kinds).to_numpy(), begins))]
    else:
        lists.append((8, found))
    ids = packed_lists(_known(rows.column("id")).to_numpy().astype(np.int64), np.arange(rows.num_rows + 1))
    columns = [[_number(n << 3 | 2) + _number(len(x)) + x for x in each] for n, each in lists]
    number = 3 if kind == "way" else 4
    group = b"".join(_field(number, b"".join([b"\x08", *parts])) for parts in zip(ids, *columns, strict=True))
    strings = ["", *coded.dictionary.to_pylist()]
    return _framed(b"OSMData", _field(1, b"".join(_field(1, x.encode()) for x in strings)) + _field(2, group))


def write(every_node: DataFrame, every_way: DataFrame, every_relation: DataFrame, path: str) -> None:
    """A folder of .osm.pbf files, each whole in itself; nodes first, then ways, then relations of a partition. Positions are rounded to 10^-7 degrees."""

    def blobs(kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            begun = False
            for b in batches:
                for at in range(0, b.num_rows, BLOB_ROWS):
                    found = [] if begun else [_framed(b"OSMHeader", b"".join(_field(4, f.encode()) for f in FEATURES))]
                    begun = True
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join([*found, _written(kind, b.slice(at, BLOB_ROWS))])], pa.binary())], names=["blob"])

        return run

    # A file is a partition of one kind, so that each begins with a header.
    parts = [df.mapInArrow(blobs(kind), "blob binary") for kind, df in zip(_KINDS, (every_node, every_way, every_relation), strict=True)]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    rows.select(F.col("blob").cast("string").alias("value")).write.mode("overwrite").text(path, lineSep=_NOTHING)
