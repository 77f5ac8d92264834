"""Gazetteers: area records to searchable names.

areas: polygon_id, source_key, name, aliases array<string>, tags map<string,string>, geometry.
profiles: polygon_id, name, normalized_name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoweave.functions.geometry import contains_point, representative_point
from geoweave.functions.text import exact_text, normalized

MIN_NAME_CHARS = 3


def is_meaningful(normal: Column) -> Column:
    """At least three characters and a letter among them."""
    return (F.length(normal) >= MIN_NAME_CHARS) & normal.rlike("\\p{L}")


def profiles(areas: DataFrame) -> DataFrame:
    """All named areas; percent escapes in names are decoded."""
    named = areas.where(F.coalesce("name", F.lit("")) != "")
    return named.select("polygon_id", "name", normalized(F.col("name"), decode_url=True).alias("normalized_name"))


def meaningful_profiles(areas: DataFrame) -> DataFrame:
    named = profiles(areas)
    # the filter reads names without decoding, the profile with
    return named.where(is_meaningful(normalized(F.col("name"))))


def name_occurrences(found: DataFrame) -> DataFrame:
    return found.groupBy("normalized_name").agg(F.count("*").alias("occurrences"))


def counted_names(found: DataFrame) -> DataFrame:
    """Of the profiles of a normalised name, that with the smallest id, and how many there are (occurrences)."""
    least = F.min(F.struct("polygon_id", "name")).alias("least")
    return found.groupBy("normalized_name").agg(least, F.count("*").alias("occurrences")).select("least.polygon_id", "least.name", "normalized_name", "occurrences")


def one_per_name(found: DataFrame) -> DataFrame:
    """Of the profiles of a normalised name, that with the smallest id."""
    return counted_names(found).drop("occurrences")


def is_boundary(name: Column, tags: Column, city: str) -> Column:
    """The administrative boundary of a city."""
    value = lambda k: F.coalesce(tags[k], F.lit(""))
    return (normalized(name, decode_url=True) == city) & (value("boundary") == "administrative") & (value("admin_level") == "8") & (value("place") == "city")


def within_boundary(areas: DataFrame, city: str, order: str = "polygon_id") -> DataFrame:
    """Areas whose representative point lies in the city's boundary, and the boundary itself. The last boundary counts.

    Only named areas with a geometry take part. ValueError without a boundary.
    """
    known = areas.where((F.coalesce("name", F.lit("")) != "") & F.col("geometry").isNotNull()).withColumn("point", representative_point(F.col("geometry"))).where("point IS NOT NULL")
    known = known.withColumn("is_boundary", is_boundary(F.col("name"), F.col("tags"), city))
    edge = known.where("is_boundary").agg(F.max_by("geometry", order).alias("boundary"))
    if edge.where("boundary IS NOT NULL").isEmpty():
        raise ValueError(f"no boundary of {city}")
    city_key = F.lit(city).alias("_city")
    inside = known.select("*", city_key).join(F.broadcast(edge.select("*", city_key)), "_city")  # the edge is one row
    return inside.where(F.col("is_boundary") | contains_point(F.col("boundary"), F.col("point"))).drop("boundary", "point", "is_boundary", "_city")


def candidate_names(areas: DataFrame) -> DataFrame:
    """Name and aliases of every area, one row each: polygon_id, source_key, alias, normalized_name. Equal spellings of an area once."""
    every = F.array_distinct(F.concat(F.array(F.coalesce("name", F.lit(""))), F.coalesce("aliases", F.array().cast("array<string>"))))
    rows = areas.select("polygon_id", "source_key", F.explode(every).alias("alias"))
    return rows.withColumn("normalized_name", normalized(F.col("alias"))).where("normalized_name <> ''").distinct()


def aliases_of(tags: Column) -> Column:
    """Values of the tags `name:*` in order of their keys, each value once."""
    named = F.filter(F.array_sort(F.map_entries(tags)), lambda e: e["key"].startswith("name:") & (F.trim(e["value"]) != ""))
    return F.array_distinct(F.transform(named, lambda e: e["value"]))


def tags_json(tags: Column) -> Column:
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(tags))))


def centroid_json(point: Column) -> Column:
    """Keys in the order lat, lon; an empty string without a point."""
    return F.when(point.isNull(), F.lit("")).otherwise(F.to_json(F.struct(point["lat"].alias("lat"), point["lon"].alias("lon"))))


def document_identity() -> Column:
    """What documents are told apart by: the id, or without one the URL and the text."""
    by_id = F.coalesce("document_id", F.lit("")) != ""
    by_content = F.struct(F.lit("url-text").alias("kind"), F.coalesce("url", F.lit("")).alias("a"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("b"))
    return F.when(by_id, F.struct(F.lit("id").alias("kind"), F.col("document_id").alias("a"), F.lit("").alias("b"))).otherwise(by_content)


def first_of(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The first row of each group in the given order."""
    return rows.withColumn("_rank", F.row_number().over(W.partitionBy(*group).orderBy(*order))).where("_rank = 1").drop("_rank")


def normal_name(name: str) -> str:
    return exact_text(name)


def document_key(frame: DataFrame) -> list[str]:
    """What tells documents apart: the row within its shard, and the shard where there are several."""
    return [c for c in ("shard", "row_index") if c in frame.columns]
