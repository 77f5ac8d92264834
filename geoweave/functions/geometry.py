"""Planar geometry on nested arrays: multipolygon > polygon > ring > point (lon, lat). Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GEOMETRY = "array<array<array<struct<lon:double,lat:double>>>>"
EPSILON = 1e-15


def _open(ring: Column) -> Column:
    """Without the closing point."""
    closed = (F.size(ring) > 1) & (ring[0] == F.element_at(ring, -1))
    return F.when(closed, F.slice(ring, 1, F.size(ring) - 1)).otherwise(ring)


def _edges(ring: Column) -> Column:
    """Pairs (a, b) of each point and the one after it, the last with the first."""
    turned = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.zip_with(ring, turned, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _moment(ring: Column) -> Column:
    """Area and first moments, positive whatever the ring's direction."""
    zero = F.struct(F.lit(0.0).alias("area"), F.lit(0.0).alias("lon"), F.lit(0.0).alias("lat"))

    def add(m: Column, e: Column) -> Column:
        cross = e["a"]["lon"] * e["b"]["lat"] - e["b"]["lon"] * e["a"]["lat"]
        return F.struct((m["area"] + cross / 2).alias("area"), (m["lon"] + (e["a"]["lon"] + e["b"]["lon"]) * cross / 6).alias("lon"), (m["lat"] + (e["a"]["lat"] + e["b"]["lat"]) * cross / 6).alias("lat"))

    def positive(m: Column) -> Column:
        sign = F.when(m["area"] < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
        return F.struct((m["area"] * sign).alias("area"), (m["lon"] * sign).alias("lon"), (m["lat"] * sign).alias("lat"))

    return F.aggregate(_edges(_open(ring)), zero, add, positive)


def centroid(geometry: Column) -> Column:
    """Area-weighted centre with holes taken out; without area the mean of the outer points; null without points."""
    zero = F.struct(F.lit(0.0).alias("area"), F.lit(0.0).alias("lon"), F.lit(0.0).alias("lat"))
    signed = F.flatten(F.transform(geometry, lambda p: F.transform(p, lambda r, i: F.struct(F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("sign"), _moment(r).alias("m")))))
    total = F.aggregate(signed, zero, lambda t, x: F.struct((t["area"] + x["sign"] * x["m"]["area"]).alias("area"), (t["lon"] + x["sign"] * x["m"]["lon"]).alias("lon"), (t["lat"] + x["sign"] * x["m"]["lat"]).alias("lat")))
    outer = F.flatten(F.transform(F.filter(geometry, lambda p: F.size(p) > 0), lambda p: _open(p[0])))
    by_area = F.struct((total["lon"] / total["area"]).alias("lon"), (total["lat"] / total["area"]).alias("lat"))
    return F.when(F.abs(total["area"]) > EPSILON, by_area).otherwise(mean_point(outer))


def mean_point(points: Column) -> Column:
    n = F.size(points)
    mean = lambda axis: F.aggregate(points, F.lit(0.0), lambda s, p: s + p[axis]) / n
    return F.when(n > 0, F.struct(mean("lon").alias("lon"), mean("lat").alias("lat")))


def representative_point(geometry: Column) -> Column:
    """The mean of all vertices, closing points and holes included."""
    return mean_point(F.flatten(F.flatten(geometry)))


def _in_ring(lon: Column, lat: Column, ring: Column) -> Column:
    """Even-odd rule: how many edges a ray to the east crosses."""
    crossed = F.filter(
        _edges(ring),
        lambda e: ((e["a"]["lat"] > lat) != (e["b"]["lat"] > lat)) & (lon < (e["b"]["lon"] - e["a"]["lon"]) * (lat - e["a"]["lat"]) / F.nullif(e["b"]["lat"] - e["a"]["lat"], F.lit(0.0)) + e["a"]["lon"]),
    )
    return F.size(crossed) % 2 == 1


def contains_point(geometry: Column, point: Column) -> Column:
    """Inside the outer ring of any polygon and in none of its holes."""
    lon, lat = point["lon"], point["lat"]
    return F.exists(geometry, lambda p: (F.size(p) > 0) & _in_ring(lon, lat, p[0]) & ~F.exists(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda r: _in_ring(lon, lat, r)))
