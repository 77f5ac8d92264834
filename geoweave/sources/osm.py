"""Areas of OpenStreetMap files: closed ways and multipolygon relations, with tags and geometry.

XML (.osm) and the binary format (.osm.pbf, see `pbf`) are read as the same three tables of nodes, ways and relations; node
positions reach the ways, and ways the relations, by joins. What one area needs meets in one row; rings are put together,
tested and nested there (`functions.rings`).
"""

from __future__ import annotations

import sys
from collections.abc import Mapping
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.functions.geometry import GEOMETRY, centroid
from geoweave.functions.rings import UNIT, polygons_of
from geoweave.operators.gazetteer import aliases_of
from geoweave.sources import pbf

_TAGS = "tag array<struct<_k:string,_v:string>>"
_NODE = "_id long, _lat double, _lon double"
_WAY = f"_id long, nd array<struct<_ref:long>>, {_TAGS}"
_RELATION = f"_id long, member array<struct<_type:string,_ref:long,_role:string>>, {_TAGS}"
_POINT = pa.struct([("lon", pa.float64()), ("lat", pa.float64())])
AREA_TYPES = ("boundary", "multipolygon")


def _read(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)


def _tags(tag: Column) -> Column:
    empty = F.array().cast("array<struct<_k:string,_v:string>>")
    return F.map_from_entries(F.transform(F.coalesce(tag, empty), lambda t: F.struct(t["_k"], t["_v"])))


def ways(spark: SparkSession, path: str) -> DataFrame:
    """id, tags, refs (node ids in order)."""
    rows = _read(spark, path, "way", _WAY)
    refs = F.transform(F.coalesce("nd", F.array().cast("array<struct<_ref:long>>")), lambda n: n["_ref"])
    return rows.select(F.col("_id").alias("id"), _tags(F.col("tag")).alias("tags"), refs.alias("refs"))


def relations(spark: SparkSession, path: str) -> DataFrame:
    """id, tags, members (type, ref, role)."""
    rows = _read(spark, path, "relation", _RELATION)
    members = F.coalesce("member", F.array().cast("array<struct<_type:string,_ref:long,_role:string>>"))
    return rows.select(F.col("_id").alias("id"), _tags(F.col("tag")).alias("tags"), F.transform(members, lambda m: F.struct(m["_type"].alias("type"), m["_ref"].alias("ref"), m["_role"].alias("role"))).alias("members"))


def is_closed(refs: Column) -> Column:
    return (F.size(refs) >= 4) & (refs[0] == F.element_at(refs, -1))


def nodes(spark: SparkSession, path: str) -> DataFrame:
    """ref, point (lon, lat)."""
    return _read(spark, path, "node", _NODE).select(F.col("_id").alias("ref"), F.struct(F.col("_lon").alias("lon"), F.col("_lat").alias("lat")).alias("point"))


def elements(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, ways and relations of a file, or of the files of a folder; paths that end in .pbf are binary."""
    source = pbf if path.rstrip("/").endswith(".pbf") else sys.modules[__name__]
    return source.nodes(spark, path), source.ways(spark, path), source.relations(spark, path)


def named_areas(spark: SparkSession, path: str) -> DataFrame:
    return named_areas_of(*elements(spark, path)[1:])


def named_areas_of(every_way: DataFrame, every_relation: DataFrame) -> DataFrame:
    """polygon_id and name of closed ways and area relations, without geometry; the name is null where there is none."""
    closed = every_way.where(is_closed(F.col("refs"))).select(F.concat(F.lit("way/"), "id").alias("polygon_id"), F.col("tags")["name"].alias("name"))
    typed = every_relation.where(F.col("tags")["type"].isin(*AREA_TYPES)).select(F.concat(F.lit("relation/"), "id").alias("polygon_id"), F.col("tags")["name"].alias("name"))
    return closed.unionByName(typed)


def _lines(every_node: DataFrame, found: DataFrame) -> DataFrame:
    """id, points of ways; null where a node is missing."""
    each = found.select("id", F.posexplode("refs").alias("at", "ref")).join(every_node, "ref", "left")
    points = F.transform(F.array_sort(F.collect_list(F.struct("at", "point"))), lambda x: x["point"])
    rows = each.groupBy("id").agg(points.alias("points"), F.count(F.when(F.col("point").isNull(), 1)).alias("missing"))
    return rows.select("id", F.when(F.col("missing") == 0, F.col("points")).alias("points"))


def _areas_of_batch(areas: pa.ListArray) -> pa.ListArray:
    """Multipolygons of the lines of areas: points go in as whole units, and come out by their places among all of the batch."""
    first = areas.offsets.to_numpy().tolist()
    lines = areas.values
    begins = lines.offsets.to_numpy().tolist()
    points = lines.values
    lon, lat = (points.field(c).to_numpy(zero_copy_only=False) for c in ("lon", "lat"))
    used = slice(begins[first[0]], begins[first[-1]])
    if not (np.isfinite(lon[used]).all() and np.isfinite(lat[used]).all()):
        raise ValueError("a position is no number")
    whole = list(zip(*(np.rint(x[used] * UNIT).astype(np.int64).tolist() for x in (lon, lat)), strict=True))
    # Where each area's polygons begin, each polygon's rings, and each ring's points.
    each, polygons, rings, places, missing = [0], [0], [0], [], []
    for is_null, a, b in zip(areas.is_null().to_pylist(), first, first[1:], strict=False):
        at, end = begins[a] - used.start, begins[b] - used.start
        found = None if is_null else polygons_of([whole[x - used.start : y - used.start] for x, y in zip(begins[a:b], begins[a + 1 : b + 1], strict=True)])
        if found is not None:
            place = dict(zip(whole[at:end], range(at, end), strict=True))
            for polygon in found:
                for ring in polygon:
                    places += [place[p] for p in ring]
                    rings.append(len(places))
                polygons.append(len(rings) - 1)
        missing.append(found is None)
        each.append(len(polygons) - 1)
    taken = np.array(places, np.int64) + used.start
    found = pa.StructArray.from_arrays([pa.array(lon[taken]), pa.array(lat[taken])], fields=list(_POINT))
    for begin in (rings, polygons):
        found = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), found)
    return pa.ListArray.from_arrays(pa.array(each, pa.int32()), found, mask=pa.array(missing, pa.bool_()))


def _assembled(lines: Column) -> Column:
    """A multipolygon of the lines of each area, whatever their roles; null where it is not valid."""

    @F.arrow_udf(GEOMETRY)
    def assemble(areas: pa.Array) -> pa.Array:
        return _areas_of_batch(areas)

    return assemble(lines)


def areas(spark: SparkSession, path: str, source_key: str) -> DataFrame:
    return areas_of(*elements(spark, path), source_key)


def areas_of_sources(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """The areas of several files, told apart by their source keys."""
    if not paths:
        raise ValueError("no sources")
    return reduce(DataFrame.unionByName, (areas(spark, path, key) for key, path in paths.items()))


def areas_of(every_node: DataFrame, every_way: DataFrame, every_relation: DataFrame, source_key: str) -> DataFrame:
    """polygon_id, source_key, name, aliases, tags, geometry, centroid of every area, named or not. Geometry is null where it is invalid."""
    closed = every_way.where(is_closed(F.col("refs")))
    lines = _lines(every_node, every_way)
    simple = closed.join(lines, "id", "left").select(F.concat(F.lit("way/"), "id").alias("polygon_id"), "tags", F.when(F.col("points").isNotNull(), F.array("points")).alias("lines"))
    typed = every_relation.where(F.col("tags")["type"].isin(*AREA_TYPES))
    members = typed.select("id", F.explode("members").alias("m")).where("m.type = 'way'").select("id", F.col("m.ref").alias("way")).distinct()
    met = members.join(lines.withColumnRenamed("id", "way"), "way", "left")
    sides = met.groupBy("id").agg(F.collect_list("points").alias("lines"), F.count(F.when(F.col("points").isNull(), 1)).alias("missing"))
    built = sides.select("id", F.when(F.col("missing") == 0, F.col("lines")).alias("lines"))
    compound = typed.join(built, "id", "left").select(F.concat(F.lit("relation/"), "id").alias("polygon_id"), "tags", "lines")
    rows = simple.unionByName(compound).withColumn("geometry", _assembled(F.col("lines")))
    name = F.coalesce(F.col("tags")["name"], F.lit(""))
    # Areas of several sources are told apart by the source in their id.
    return rows.select(F.concat(F.lit(f"{source_key}/"), "polygon_id").alias("polygon_id"), F.lit(source_key).alias("source_key"), name.alias("name"), aliases_of(F.col("tags")).alias("aliases"), "tags", "geometry", F.when(F.col("geometry").isNotNull(), centroid(F.col("geometry"))).alias("centroid"))


def area_counts(found: DataFrame) -> DataFrame:
    """One row: named and unnamed areas, and named ones without a valid geometry."""
    named = F.col("name") != ""
    return found.agg(F.count(F.when(named, 1)).alias("named"), F.count(F.when(~named, 1)).alias("unnamed"), F.count(F.when(named & F.col("geometry").isNull(), 1)).alias("invalid"))
