"""Points in areas: a join by cells of a quadtree, and exact tests near borders only.

An area is covered by cells of a quadtree, from the level of its extent down to at most MAX_CELLS cells. A cell that no
edge of the area comes near lies wholly within or without; those without are dropped. A point is in one
cell of each level, so that points and areas meet by equal cells: within a cell that lies wholly within the area there is nothing left to
test, in others the point is tested against the area's rings (`functions.geometry.contains_point`).

Covers with few cells are broadcast, behind a count; others meet the points in a join in which frequented cells are
salted. Rings go only to the points that need them.

Defined results: areas without a geometry, and points with a null or a non-finite coordinate, meet nothing. Equal points and equal
areas meet each. Coordinates are plane, of any finite size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoweave.functions.geometry import contains_point
from geoweave.operators.matching import joined_by_name
from geoweave.session import saved

#: A cell of level n has a side of WIDTH / 2^n.
WIDTH = 512.0
MAX_LEVEL = 30
#: Cells of one cover, about.
MAX_CELLS = 64
#: Cells that are broadcast at most, about 100 bytes each.
MAX_BROADCAST_CELLS = 500_000
#: Areas that are broadcast at most, about 30 bytes each, and areas of a shape that one row carries.
MAX_BROADCAST_AREAS = 1_000_000
BLOCK_AREAS = 1000
_CELL = ["level", "column", "row"]


def _rings(geometry: list) -> list[list[np.ndarray]]:
    """Edges of each ring of each polygon: (x1, y1, x2, y2)."""
    out = []
    for polygon in geometry:
        rings = []
        for ring in polygon:
            points = np.array([(p["lon"], p["lat"]) for p in ring], float).reshape(-1, 2)
            rings.append(np.column_stack([points, np.roll(points, -1, axis=0)]))
        out.append(rings)
    return out


def _within(rings: list[list[np.ndarray]], x: float, y: float) -> bool:
    def odd(edges: np.ndarray) -> bool:
        x1, y1, x2, y2 = edges.T
        cut = (y1 > y) != (y2 > y)
        x1, y1, x2, y2 = x1[cut], y1[cut], x2[cut], y2[cut]
        return bool((x < (x2 - x1) * (y - y1) / (y2 - y1) + x1).sum() % 2)

    return any(polygon and odd(polygon[0]) and not any(odd(hole) for hole in polygon[1:]) for polygon in rings)


def _near(edges: np.ndarray, x: float, y: float, side: float) -> np.ndarray:
    """The edges that come into a cell, or so near to it that rounding could tell otherwise."""
    slack = 1e-9 * (side + abs(x) + abs(y)) + 1e-12
    x1, y1, x2, y2 = edges.T
    beside = (np.minimum(x1, x2) <= x + side + slack) & (np.maximum(x1, x2) >= x - slack) & (np.minimum(y1, y2) <= y + side + slack) & (np.maximum(y1, y2) >= y - slack)
    found = edges[beside]
    x1, y1, x2, y2 = found.T
    dx, dy = x2 - x1, y2 - y1
    # The cell lies on one side of the line, with room, if its middle is further from it than its corners reach.
    reach = (np.abs(dx) + np.abs(dy)) * (side / 2 + slack)
    away = np.abs(dx * (y + side / 2 - y1) - dy * (x + side / 2 - x1))
    return found[away <= reach * (1 + 1e-9) + slack]


def cover(geometry: list | None, max_cells: int = MAX_CELLS) -> list[tuple[int, int, int, bool]]:
    """(level, column, row, wholly within) of disjoint cells that hold all of an area."""
    rings = _rings(geometry or [])
    every = [r for polygon in rings for r in polygon if len(r)]
    if not every:
        return []
    edges = np.concatenate(every)
    if not np.isfinite(edges).all():
        return []
    low, high = edges.reshape(-1, 2).min(axis=0), edges.reshape(-1, 2).max(axis=0)
    extent = max(float((high - low).max()), WIDTH / 2**MAX_LEVEL)
    level = int(np.clip(np.floor(np.log2(WIDTH / extent)), -60, MAX_LEVEL))
    side = WIDTH / 2.0**level
    first, last = np.floor(low / side).astype(int), np.floor(high / side).astype(int)
    out: list[tuple[int, int, int, bool]] = []
    open_cells = [(level, c, r, edges) for c in range(first[0], last[0] + 1) for r in range(first[1], last[1] + 1)]
    while open_cells:
        level, column, row, around = open_cells.pop(0)
        side = WIDTH / 2.0**level
        near = _near(around, column * side, row * side, side)
        if not len(near):
            if _within(rings, (column + 0.5) * side, (row + 0.5) * side):
                out.append((level, column, row, True))
        elif level >= MAX_LEVEL or len(out) + len(open_cells) + 4 > max_cells:
            out.append((level, column, row, False))
        else:
            open_cells += [(level + 1, 2 * column + i, 2 * row + j, near) for i in (0, 1) for j in (0, 1)]
    return out


def covers(areas: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """polygon_id, level, column, row, whole: the cells of each area with a geometry."""
    rows = areas.where("geometry IS NOT NULL").select("polygon_id", "geometry")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            index, cells = [], []
            for i, geometry in enumerate(b.column("geometry")):
                own = cover(geometry.as_py(), max_cells)
                index += [i] * len(own)
                cells += own
            columns = list(zip(*cells, strict=True)) or [()] * 4
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("polygon_id").take(pa.array(index, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=["polygon_id", *_CELL, "whole"])

    return rows.mapInArrow(run, "polygon_id string, level int, column long, row long, whole boolean")


def _cell_at(level: int, lon: Column, lat: Column) -> Column:
    at = lambda x: F.floor(x / F.lit(WIDTH / 2.0**level)).cast("long")
    return F.struct(F.lit(level).alias("level"), at(lon).alias("column"), at(lat).alias("row"))


def points_in_areas(points: DataFrame, areas: DataFrame, *, key: Sequence[str], lon: str = "lon", lat: str = "lat", max_cells: int = MAX_CELLS) -> DataFrame:
    """points: key, lon, lat. areas: polygon_id (different ones), geometry. A row (key, polygon_id) for each point and each area that holds it.

    Areas of one shape are tested once. Rows for each of them are made last, from blocks of areas, where nothing moves any more.
    """
    placed = areas.where("geometry IS NOT NULL").select("polygon_id", "geometry", F.sha2(F.to_json("geometry"), 256).alias("_shape"))
    shapes = saved(placed.groupBy("_shape").agg(F.first("geometry").alias("geometry"), F.count("*").alias("_n")), "shapes")
    block = F.pmod(F.xxhash64("polygon_id"), F.ceil(F.col("_n") / BLOCK_AREAS)).alias("_block")
    blocks = saved(placed.select("polygon_id", "_shape").join(shapes.select("_shape", "_n"), "_shape").groupBy("_shape", block).agg(F.collect_list("polygon_id").alias("_areas")).drop("_block"), "areas-of-shapes")
    met = _points_in_shapes(points, shapes.select(F.col("_shape").alias("polygon_id"), "geometry"), key, lon, lat, max_cells).withColumnRenamed("polygon_id", "_shape")
    few = (shapes.agg(F.sum("_n")).first()[0] or 0) <= MAX_BROADCAST_AREAS
    rows = met.join(F.broadcast(blocks), "_shape") if few else joined_by_name(saved(met, "points-in-shapes"), blocks, "_shape", key)
    return rows.select(*key, F.explode("_areas").alias("polygon_id"))


def _points_in_shapes(points: DataFrame, areas: DataFrame, key: Sequence[str], lon: str, lat: str, max_cells: int) -> DataFrame:
    cells = saved(covers(areas, max_cells), "covers")
    levels = sorted(r.level for r in cells.select("level").distinct().collect())  # a few numbers
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    placed = points.select(*key, F.col(lon).cast("double").alias("_lon"), F.col(lat).cast("double").alias("_lat")).where(fine(F.col("_lon")) & fine(F.col("_lat")))
    if not levels:
        return placed.select(*key, F.lit(None).cast("string").alias("polygon_id")).where("false")
    each = placed.withColumn("_cell", F.explode(F.array(*(_cell_at(n, F.col("_lon"), F.col("_lat")) for n in levels)))).select(*key, "_lon", "_lat", "_cell.*")
    spread_by = [*key, "_lon", "_lat"]
    if cells.count() <= MAX_BROADCAST_CELLS:
        met = each.join(F.broadcast(cells), _CELL)
    else:
        met = joined_by_name(saved(each, "cells-of-points"), cells, _CELL, spread_by)
    met = saved(met.select(*key, "_lon", "_lat", "polygon_id", "whole"), "met")
    near = met.where("NOT whole").drop("whole")
    shapes = areas.where("geometry IS NOT NULL").select("polygon_id", "geometry")
    tested = joined_by_name(saved(near, "near-borders"), shapes, "polygon_id", spread_by)
    tested = tested.where(contains_point(F.col("geometry"), F.struct(F.col("_lon").alias("lon"), F.col("_lat").alias("lat"))))
    return met.where("whole").select(*key, "polygon_id").unionByName(tested.select(*key, "polygon_id"))
