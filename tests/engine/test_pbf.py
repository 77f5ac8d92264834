"""The binary map format against the same elements in XML, and areas of lines."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from geoweave.functions import rings
from geoweave.sources import osm, pbf, wire

XML = """<?xml version="1.0"?><osm version="0.6">
<node id="1" lat="43.7312345" lon="7.4123457"/><node id="2" lat="43.7312345" lon="7.5"/><node id="3" lat="43.8" lon="7.5"/><node id="4" lat="43.8" lon="7.4123457"/>
<node id="-5" lat="-0.0000001" lon="-179.9999999"/><node id="6" lat="0.1" lon="0.3"/>
<way id="10"><nd ref="1"/><nd ref="2"/><nd ref="3"/><nd ref="4"/><nd ref="1"/><tag k="name" v="Prés d&#233;"/><tag k="name:fr" v="Bois"/></way>
<way id="11"><nd ref="1"/><nd ref="6"/></way><way id="12"/>
<relation id="20"><member type="way" ref="10" role="outer"/><member type="node" ref="6" role="label"/><tag k="type" v="multipolygon"/><tag k="name" v="Monaco"/></relation>
<relation id="21"/></osm>"""


def test_packed_lists_and_fields():
    rng = random.Random(1)
    values = [0, 1, 127, 128, 2**31, 2**64 - 1, *(rng.getrandbits(rng.randint(1, 64)) for _ in range(500))]
    assert wire.unpacked(pbf._list(values)).tolist() == values
    signed = [v - 2**63 for v in values if v < 2**64]
    signed = [v for v in signed if -(2**63) <= v < 2**63]
    assert pbf._running(pbf._steps([1, -5, 10**15, 3])).tolist() == [1, -5, 10**15, 3]
    assert list(wire.fields(pbf._field(3, 300) + pbf._field(2, b"ab"))) == [(3, 300), (2, b"ab")]
    for bad in (b"\x80", b"\x12\x05a", b"\x0b"):
        with pytest.raises((ValueError, IndexError)):
            list(wire.fields(bad))
    with pytest.raises(ValueError):
        wire.unpacked(b"\x01\x80")


def same(a, b):
    shown = lambda df: df.select(*(F.to_json(c) if t.startswith(("map", "struct", "array")) else F.col(c) for c, t in df.dtypes))
    return sorted(map(tuple, shown(a).collect()), key=str) == sorted(map(tuple, shown(b).collect()), key=str)


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("osm")
    xml = f"{folder}/small.osm"
    with open(xml, "w") as f:
        f.write(XML)
    binary = f"{folder}/small.osm.pbf"
    pbf.write(*osm.elements(spark, xml), binary)
    return xml, binary


def test_binary_and_xml_give_equal_elements_and_areas(spark, files):
    xml, binary = files
    for a, b in zip(osm.elements(spark, xml), osm.elements(spark, binary), strict=True):
        assert same(a, b)
    assert same(osm.areas(spark, xml, "m"), osm.areas(spark, binary, "m"))
    both = osm.areas_of_sources(spark, {"a": xml, "b": binary})
    assert both.groupBy("source_key").count().count() == 2
    named = {r.polygon_id: r.name for r in osm.named_areas(spark, binary).collect()}
    assert named == {"way/10": "Prés dé", "relation/20": "Monaco"}
    area = {r.polygon_id: r for r in osm.areas(spark, binary, "m").collect()}["m/way/10"]
    assert area.aliases == ["Bois"] and area.geometry[0][0][0] == (7.4123457, 43.7312345)


def frame(content, pack=3):
    inner = {1: lambda: pbf._field(1, content), 3: lambda: pbf._field(2, len(content)) + pbf._field(3, zlib.compress(content))}[pack]()
    header = pbf._field(1, b"OSMData") + pbf._field(2, b"index data") + pbf._field(3, len(inner))
    return len(header).to_bytes(4, "big") + header + inner


def single(path, *frames, features=(b"OsmSchema-V0.6", b"DenseNodes")):
    with open(path, "wb") as f:
        f.write(pbf._framed(b"OSMHeader", b"".join(pbf._field(4, x) for x in features)) + b"".join(frames))
    return str(path)


def block(*groups, extra=b"", strings=(b"", b"name", b"A")):
    return pbf._field(1, b"".join(pbf._field(1, s) for s in strings)) + b"".join(pbf._field(2, g) for g in groups) + extra


def test_plain_nodes_granularity_offsets_and_packings(spark, tmp_path):
    zig = lambda v: (v << 1) ^ (v >> 63)
    node = lambda i, lat, lon: pbf._field(1, pbf._field(1, zig(i)) + pbf._field(8, zig(lat)) + pbf._field(9, zig(lon)))
    plain = block(node(-7, 5, -6) + node(8, 1, 2), extra=pbf._field(17, 1000) + pbf._field(19, 2_000_000_000) + pbf._field(20, -1_000_000_000))
    path = single(tmp_path / "a.osm.pbf", frame(plain, pack=1), frame(block()), frame(block(pbf._field(3, pbf._field(1, 5) + pbf._field(2, b"\x01") + pbf._field(3, b"\x02")))))
    assert {r.ref: tuple(r.point) for r in pbf.nodes(spark, path).collect()} == {-7: (-1.000006, 2.000005), 8: (-0.999998, 2.000001)}
    assert [(r.id, r.tags, r.refs) for r in pbf.ways(spark, path).collect()] == [(5, {"name": "A"}, [])]
    assert pbf.relations(spark, path).count() == 0


def test_what_is_not_read_is_an_error(spark, tmp_path):
    history = single(tmp_path / "h.osm.pbf", features=(b"HistoricalInformation",))
    with pytest.raises(Exception, match="HistoricalInformation"):
        pbf.nodes(spark, history).collect()
    whole = single(tmp_path / "c.osm.pbf", frame(block()))
    with open(whole, "rb") as f:
        data = f.read()
    with open(tmp_path / "d.osm.pbf", "wb") as f:
        f.write(data[:-3])
    with pytest.raises(Exception, match="does not fit"):
        pbf.ways(spark, str(tmp_path / "d.osm.pbf")).collect()
    empty = single(tmp_path / "e.osm.pbf")
    assert pbf.nodes(spark, empty).count() == 0


def test_a_file_is_read_in_ranges(spark, tmp_path):
    nodes = spark.range(20000).select(F.col("id").alias("ref"), F.struct((F.col("id") / 1e4).alias("lon"), (F.rand(3) * 80).alias("lat")).alias("point"))
    none = spark.createDataFrame([], pbf.WAY), spark.createDataFrame([], pbf.RELATION)
    rows, pbf.BLOB_ROWS = pbf.BLOB_ROWS, 500
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        pbf.write(nodes.coalesce(1), *none, f"{tmp_path}/n.osm.pbf")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        found = pbf.nodes(spark, f"{tmp_path}/n.osm.pbf")
        assert found.rdd.getNumPartitions() > 5
        assert found.select("ref").distinct().count() == found.count() == 20000
    finally:
        pbf.BLOB_ROWS = rows
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


# ---------------------------------------------------------------- rings


def square(x, y, n):
    return [(x, y), (x + n, y), (x + n, y + n), (x, y + n), (x, y)]


def shape(*lines):
    found = rings.area_of([[(float(x), float(y)) for x, y in line] for line in lines])
    return None if found is None else [[len(r) - 1 for r in polygon] for polygon in found]


def test_islands_in_holes_nest():
    assert shape(square(0, 0, 10), square(1, 1, 8), square(2, 2, 6), square(3, 3, 1), square(20, 0, 2)) == [[4, 4], [4, 4], [4]]


def test_lines_in_pieces_and_any_direction():
    s = square(0, 0, 4)
    assert shape(s[:3], s[2:][::-1]) == [[4]]
    assert rings.area_of([[(4.0, 0.0), (0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0)]]) == [[[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]]]


def test_open_crossing_and_overlapping_edges_are_not_valid():
    assert shape(square(0, 0, 4)[:-1]) is None
    assert shape([(0, 0), (4, 4), (4, 0), (0, 4), (0, 0)]) is None
    assert shape(square(0, 0, 4), square(2, 2, 4)) is None
    assert shape(square(0, 0, 4), [(4, 1), (8, 1), (8, 2), (4, 2), (4, 1)]) is None  # an edge within an edge
    assert shape(square(0, 0, 4), [(2, 0), (3, 1), (1, 1), (2, 0)]) is None  # a corner on an edge
    assert shape([(0, 0), (1, 1), (0, 0)]) is None
    assert shape([(0, 0), (2, 0), (4, 0), (0, 0)]) is None
    assert shape() is None


def test_rings_that_meet_in_a_corner_only_are_valid():
    assert shape(square(0, 0, 4), square(4, 4, 4)) == [[4], [4]]
    assert shape([(0, 0), (2, 2), (4, 0), (4, 4), (2, 2), (0, 4), (0, 0)]) == [[3], [3]]
    assert shape(square(0, 0, 4), [(0, 0), (2, 1), (1, 2), (0, 0)]) == [[4, 3]]


def test_shared_edges_of_neighbours_cancel():
    assert shape(square(0, 0, 4), [(4, 0), (8, 0), (8, 4), (4, 4), (4, 0)]) == [[6]]


def test_crossings_equal_all_pairs():
    rng = random.Random(7)
    for _ in range(300):
        ring = [(rng.randint(0, 9), rng.randint(0, 9)) for _ in range(rng.randint(3, 6))]
        ring = list(dict.fromkeys(ring))
        if len(ring) < 3:
            continue
        edges = list(rings._edges(ring))
        want = any(rings._meet(*edges[i], *edges[j]) for i in range(len(edges)) for j in range(i))
        assert rings.cross([ring]) == want


def test_invalid_areas_count_and_have_no_geometry(spark):
    point = lambda x, y: {"lon": float(x), "lat": float(y)}
    corners = {1: (0, 0), 2: (4, 4), 3: (4, 0), 4: (0, 4)}
    nodes = spark.createDataFrame([(k, point(*p)) for k, p in corners.items()], pbf.NODE)
    ways = spark.createDataFrame([(1, {"name": "Bow"}, [1, 2, 3, 4, 1]), (2, {"name": "Square"}, [1, 3, 2, 4, 1]), (3, {}, [1, 3, 2, 4, 1]), (4, {"name": "Lost"}, [1, 3, 9, 1])], pbf.WAY)
    relations = spark.createDataFrame([(1, {"type": "boundary", "name": "Twice"}, [{"type": "way", "ref": 2, "role": "outer"}, {"type": "way", "ref": 2, "role": "outer"}]), (2, {"type": "multipolygon", "name": "Missing"}, [{"type": "way", "ref": 77, "role": ""}]), (3, {"type": "multipolygon", "name": "Empty"}, [])], pbf.RELATION)
    found = osm.areas_of(nodes, ways, relations, "m")
    assert {r.name: r.geometry is not None for r in found.collect()} == {"Bow": False, "Square": True, "": True, "Lost": False, "Twice": True, "Missing": False, "Empty": False}
    assert osm.area_counts(found).first().asDict() == {"named": 6, "unnamed": 1, "invalid": 4}
