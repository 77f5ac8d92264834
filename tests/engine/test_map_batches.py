"""Elements and areas of map files are decoded, written and put together in batches: the same results, without a call for each."""

import random

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__
from geoweave.functions import rings
from geoweave.operators import gazetteer
from geoweave.sources import osm, pbf, wire

TAGS = pa.map_(pa.string(), pa.string())
LINES = pa.list_(pa.list_(pa.struct([("lon", pa.float64()), ("lat", pa.float64())])))


def opened(written):
    """The block of a written blob (after the length, kind and size of its header)."""
    return pbf._Block(pbf._opened(pbf._blob(written[4 + len(pbf.MARK) :])))


def read(decode, written):
    return [r for b in decode(opened(written)) for r in b.to_pylist()]


def way(keys, values, refs=b""):
    return pbf._field(3, pbf._field(1, 5) + pbf._field(2, keys) + pbf._field(3, values) + pbf._field(8, refs))


def block(*elements):
    strings = b"".join(pbf._field(1, s) for s in (b"", b"k", b"a", b"b", b"k"))
    return pbf._Block(pbf._field(1, strings) + pbf._field(2, b"".join(elements)))


def test_lists_of_a_blob_are_unpacked_at_once(monkeypatch):
    calls = []
    for module in (wire, pbf):
        one = module.unpacked
        monkeypatch.setattr(module, "unpacked", lambda data, one=one: calls.append(1) or one(data))
    rows = [{"id": i, "tags": [("name", f"Way {i}")], "refs": [i, i + 1, i]} for i in range(500)]
    batch = pa.RecordBatch.from_pylist(rows, pa.schema([("id", pa.int64()), ("tags", TAGS), ("refs", pa.list_(pa.int64()))]))
    assert read(pbf._ways, pbf._written("way", batch)) == rows
    assert len(calls) < 10


def test_lists_of_all_sizes_and_slices_come_back():
    rng = random.Random(5)
    number = lambda: rng.choice([0, -1, 300, rng.getrandbits(62), -rng.getrandbits(62)])
    tags = lambda: rng.choice([None, list({rng.choice("abcé"): rng.choice(["", "x" * 200, "日"]) for _ in range(3)}.items())])
    ways = [{"id": number(), "tags": tags(), "refs": rng.choice([None, [], [number() for _ in range(9)]])} for _ in range(200)]
    batch = pa.RecordBatch.from_pylist(ways, pa.schema([("id", pa.int64()), ("tags", TAGS), ("refs", pa.list_(pa.int64()))]))
    member = lambda: {"type": rng.choice(["node", "way", "relation"]), "ref": number(), "role": rng.choice([None, "", "outer"])}
    relations = [{"id": number(), "tags": tags(), "members": rng.choice([None, [], [member() for _ in range(4)]])} for _ in range(200)]
    # A struct's fields go by their names.
    kind = pa.list_(pa.struct([("role", pa.string()), ("type", pa.string()), ("ref", pa.int64())]))
    joined = pa.RecordBatch.from_pylist(relations, pa.schema([("id", pa.int64()), ("tags", TAGS), ("members", kind)]))
    for at, n in ((0, 200), (7, 20), (199, 1)):
        want = [{"id": r["id"], "tags": r["tags"] or [], "refs": r["refs"] or []} for r in ways[at : at + n]]
        assert read(pbf._ways, pbf._written("way", batch.slice(at, n))) == want
        want = [{"id": r["id"], "tags": r["tags"] or [], "members": [m | {"role": m["role"] or ""} for m in r["members"] or []]} for r in relations[at : at + n]]
        assert read(pbf._relations, pbf._written("relation", joined.slice(at, n))) == want


def test_what_is_malformed_in_one_element_is_an_error():
    assert [r["tags"] for b in pbf._ways(block(way(b"\x01\x04", b"\x02\x03"), way(b"", b""))) for r in b.to_pylist()] == [[("k", "b")], []]  # the last value of a key
    for bad in (way(b"\x01", b"\x02\x03"), way(b"\x01", b"\x80"), way(b"", b"", b"\x80")):
        with pytest.raises(ValueError):
            list(pbf._ways(block(way(b"", b""), bad, way(b"\x01", b"\x02"))))
    with pytest.raises(IndexError):
        list(pbf._ways(block(way(b"\x01", b"\x09"))))
    points = pa.struct([("lon", pa.float64()), ("lat", pa.float64())])
    for point in (None, {"lon": None, "lat": 1.0}, {"lon": float("nan"), "lat": 1.0}):
        rows = pa.RecordBatch.from_pylist([{"ref": 1, "point": point}], pa.schema([("ref", pa.int64()), ("point", points)]))
        with pytest.raises(ValueError):
            pbf._written("node", rows)


def shapes(n):
    rng = random.Random(11)
    square = lambda x, y, n: [(x, y), (x + n, y), (x + n, y + n), (x, y + n), (x, y)][:: rng.choice([1, -1])]
    for i in range(n):
        if i % 9 == 0:
            yield rng.choice([None, []])
        elif i % 2:
            yield [square(rng.randint(0, 6), rng.randint(0, 6), rng.randint(1, 6)) for _ in range(rng.randint(1, 4))]
        else:
            loop = [(rng.randint(0, 5) / 10, rng.randint(0, 5) / 10) for _ in range(rng.randint(1, 7))]
            yield [[*loop, loop[0]], loop[:2]][: rng.randint(1, 2)]


def test_areas_of_a_batch_equal_each_by_itself():
    lines = list(shapes(2000))
    point = lambda p: {"lon": float(p[0]), "lat": float(p[1])}
    batch = pa.array([None if x is None else [[point(p) for p in line] for line in x] for x in lines], LINES)
    found = [None if x is None else rings.area_of([[(float(a), float(b)) for a, b in line] for line in x]) for x in lines]
    want = [None if x is None else [[[point(p) for p in ring] for ring in polygon] for polygon in x] for x in found]
    assert 200 < sum(x is not None for x in want) < 1800
    assert osm._areas_of_batch(batch).to_pylist() == want
    assert osm._areas_of_batch(batch.slice(100, 50)).to_pylist() == want[100:150]
    assert osm._areas_of_batch(batch.slice(0, 0)).to_pylist() == []


def test_few_and_many_edges_are_judged_alike(monkeypatch):
    units = [[[(round(x * rings.UNIT), round(y * rings.UNIT)) for x, y in line] for line in x] for x in shapes(1000) if x]
    few = [rings.polygons_of(x) for x in units]
    monkeypatch.setattr(rings, "FEW_EDGES", 0)
    assert [rings.polygons_of(x) for x in units] == few


def test_squares_are_put_together_without_arrays_of_their_own(monkeypatch):
    monkeypatch.setattr(np, "searchsorted", lambda *_: pytest.fail("a sweep in arrays for four edges"))
    assert rings.area_of([[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]]) is not None


def test_names_are_counted_and_merged_in_one_pass(spark, tmp_path):
    found = spark.createDataFrame([("b", "Été", "été"), ("a", "ÉTÉ", "été"), ("c", "Ill", "ill")], "polygon_id string, name string, normalized_name string")
    assert sorted(map(tuple, gazetteer.counted_names(found).collect())) == [("a", "ÉTÉ", "été", 2), ("c", "Ill", "ill", 1)]
    spark.createDataFrame([(k,) for k in range(1, 40)], "c_custkey long").write.parquet(str(tmp_path / "customer.parquet"))
    profiles = __spark_entry__.queries()["pbf_profiles"](spark, str(tmp_path))
    # Ways and relations: one assembly each.
    assert profiles._jdf.queryExecution().executedPlan().toString().count("[assemble(") == 2
