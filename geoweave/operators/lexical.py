"""Lexical candidates: every mention of every name or alias, with its sentence; then name classes; then scored evidence."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoweave.functions.text import exact_text, has_marker, normalized
from geoweave.operators.gazetteer import candidate_names, centroid_json, document_key, tags_json
from geoweave.operators.matching import sentence_mentions
from geoweave.operators.ordering import numbered
from geoweave.session import one_by_one, saved

BASE = ["polygon_id", "polygon_name", "matched_alias", "area_tags", "centroid", "url", "sentence", "context"]
#: Points of each sign of evidence, in the order of the reasons.
POINTS = (("distinctive_name", 2), ("name_in_url", 3), ("country_in_sentence", 3), ("country_in_context", 1), ("same_polygon_alias_nearby", 2), ("other_polygon_name_nearby", 1))


def _areas(areas: DataFrame) -> DataFrame:
    point = F.col("centroid") if "centroid" in areas.columns else F.lit(None).cast("struct<lon:double,lat:double>")
    return areas.select("polygon_id", "source_key", F.coalesce("name", F.lit("")).alias("polygon_name"), tags_json(F.col("tags")).alias("area_tags"), centroid_json(point).alias("centroid"))


def _found(documents: DataFrame, candidates: DataFrame, groups: DataFrame, *, gate: bool = False, countries: Mapping[str, str] | None = None, digest: bool = False) -> DataFrame:
    """A row for each mention and group of areas of its name: the document's key, url, normal_url, start, end, what is known of its sentence, and the group."""
    key = document_key(documents)
    docs = documents.select(*key, F.coalesce("url", F.lit("")).alias("url"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs if gate else docs.withColumn("normal_url", normalized(F.col("url"), decode_url=True))
    keep = ["url"] if gate else ["url", "normal_url"]
    markers = sorted({exact_text(c) for c in countries.values()} - {""}) if countries else ()
    return sentence_mentions(docs, candidates, groups, key=key, keep=keep, markers=markers, gate=gate, digest=digest)


#: Areas of a group that one row carries.
BLOCK_AREAS = 1000
#: Areas of the groups that are broadcast at most.
MAX_GROUPED = 200_000
#: What a group's areas have in common.
_SHARED = ["normalized_name", "matched_alias", "source_key"]


def _grouped(named: DataFrame, shared: list[str]) -> tuple[DataFrame, DataFrame]:
    """named: a row for each area and spelling. Groups of areas that no sign of evidence tells apart (shared columns, area_group, areas: how many),
    and their members (area_group, block, members), of at most BLOCK_AREAS areas a row.

    Areas of one name are as many as the input has, and so are its mentions: rows of both are only made at the very end, and not at all to be counted.
    """
    group = F.sha2(F.to_json(F.struct(*shared), {"ignoreNullFields": "false"}), 256)
    rows = named.withColumn("area_group", group)
    groups = rows.groupBy("area_group").agg(*(F.first(c).alias(c) for c in shared), F.count("*").alias("areas"), F.min("polygon_id").alias("_least"))
    block = F.pmod(F.xxhash64("polygon_id"), F.ceil(F.col("areas") / BLOCK_AREAS))
    member = F.struct("polygon_id", "polygon_name", "area_tags", "centroid")
    dealt = rows.join(groups.select("area_group", "areas"), "area_group").withColumn("block", block)
    members = dealt.groupBy("area_group", "block").agg(F.collect_list(member).alias("members"))
    return groups, members


def _with_members(rows: DataFrame, members: DataFrame, on: str, *fields: str) -> DataFrame:
    """A row for each of `rows` and member of its group. Members are broadcast where they are few; the rows are made in the tasks that hold `rows`."""
    few = members.agg(F.coalesce(F.sum(F.size("members")), F.lit(0)).alias("n")).first().n <= MAX_GROUPED
    met = rows.join(F.broadcast(members) if few else members, on)
    return met.withColumn("_member", one_by_one("members", *fields)).drop("members", "block").select("*", "_member.*").drop("_member")


def expanded(grouped: DataFrame, members: DataFrame) -> DataFrame:
    """A row for each mention and area."""
    return _with_members(grouped, members, "area_group", "polygon_id", "polygon_name", "area_tags", "centroid").drop("area_group", "areas", "_least")


def _shown(digest: bool) -> list[str]:
    return [f"{c}_sha256" if c == "context" and digest else c for c in BASE]


def grouped_mentions(documents: DataFrame, areas: DataFrame, *, digest: bool = False) -> tuple[DataFrame, DataFrame]:
    """Version 1 as mentions of groups of areas, and the members of these. digest: context_sha256 in place of context, here and in all versions."""
    candidates = candidate_names(areas)
    named = candidates.join(_areas(areas), ["polygon_id", "source_key"]).withColumnRenamed("alias", "matched_alias")
    groups, members = (saved(t, "area-groups") for t in _grouped(named, _SHARED))
    return _found(documents, candidates, groups, gate=True, digest=digest), members


def mentions(documents: DataFrame, areas: DataFrame, *, digest: bool = False) -> DataFrame:
    """Version 1: all names, also countries and single letters."""
    rows = expanded(*grouped_mentions(documents, areas, digest=digest))
    return rows.select("source_key", *document_key(rows), "start", "end", *_shown(digest))


def mention_places(documents: DataFrame, areas: DataFrame) -> DataFrame:
    """Version 1's mentions with their place in their document, by start, end, polygon_id and matched_alias, from one.

    Mentions times areas are neither shuffled nor sorted: mentions are numbered within their document, each weighed by the areas of its
    name, and areas within their name; a row's place is the sum of both. Only where several names take one and the same place in a text
    (a character that folds to several words) are the rows of these sorted.
    """
    key, order = document_key(documents), ["polygon_id", "matched_alias"]
    candidates = candidate_names(areas)
    ranked = numbered(candidates.withColumnRenamed("alias", "matched_alias").select("normalized_name", *order), ["normalized_name", *order])
    names = saved(ranked.groupBy("normalized_name").agg(F.min("place").alias("_first"), F.count("*").alias("areas")), "names")
    ranked = ranked.join(names, "normalized_name").withColumn("rank", F.col("place") - F.col("_first"))
    members = ranked.groupBy("normalized_name", F.floor(F.col("rank") / BLOCK_AREAS).alias("block")).agg(F.collect_list(F.struct("rank", *order)).alias("members"))
    members = saved(members, "areas-of-names")
    docs = documents.select(*key, F.coalesce("text", F.lit("")).alias("text"))
    spots = sentence_mentions(docs, candidates, names.drop("_first"), key=key, gate=True, digest=True).select(*key, "start", "end", "normalized_name", "areas")
    here = F.sum("areas").over(W.partitionBy(*key, "start", "end"))
    before = F.sum("areas").over(W.partitionBy(*key).orderBy("start", "end")) - F.col("_here")
    spots = saved(spots.withColumn("_here", here).withColumn("_before", before), "places")
    rows = lambda kept: _with_members(kept, members, "normalized_name", "rank", *order)
    shown = [*key, "start", "end", *order]
    alone = rows(spots.where("_here = areas")).select(*shown, (F.col("_before") + F.col("rank") + 1).alias("place"))
    among = F.row_number().over(W.partitionBy(*key, "start", "end").orderBy(*order))
    return alone.union(rows(spots.where("_here > areas")).select(*shown, (F.col("_before") + among).alias("place")))


def grouped_classed(documents: DataFrame, areas: DataFrame, inventory: DataFrame, countries: Mapping[str, str] | None = None, *, digest: bool = False) -> tuple[DataFrame, DataFrame]:
    """Version 2, of the names that are not discarded, as mentions of groups of areas, and the members of these. own_names: all such names of each area of the group."""
    names = inventory.where("decision <> 'discard'").select("normalized_name", F.explode("candidates").alias("c"), "decision", "polygon_count", "document_frequency")
    names = names.select("normalized_name", F.col("c.alias").alias("matched_alias"), "c.polygon_id", "c.source_key", "decision", "polygon_count", "document_frequency")
    names = saved(names, "classed-names")
    own = names.groupBy("polygon_id").agg(F.array_sort(F.collect_set("normalized_name")).alias("own_names"))
    named = names.join(own, "polygon_id").join(_areas(areas), ["polygon_id", "source_key"])
    kind = F.when(F.col("decision") == "generic", "generic_name").otherwise("distinctive_name").alias("name_match_class")
    shared = [*_SHARED, "own_names", "name_match_class", "polygon_count", "document_frequency"]
    groups, members = (saved(t, "area-groups") for t in _grouped(named.withColumn("name_match_class", kind), shared))
    return _found(documents, names, groups, countries=countries, digest=digest), members


def classed_mentions(documents: DataFrame, areas: DataFrame, inventory: DataFrame, *, digest: bool = False) -> DataFrame:
    """Version 2: names that are not discarded, with their class, number of areas and document frequency."""
    rows = expanded(*grouped_classed(documents, areas, inventory, digest=digest))
    return rows.select("source_key", *document_key(rows), "start", "end", "normalized_name", "sentence_index", *_shown(digest), "name_match_class", "polygon_count", "document_frequency")


def grouped_scored(documents: DataFrame, areas: DataFrame, inventory: DataFrame, countries: Mapping[str, str], *, digest: bool = False) -> tuple[DataFrame, DataFrame]:
    """Version 3 as mentions of groups of areas, and the members of these: the signs of evidence are the same for all areas of a group."""
    rows, members = grouped_classed(documents, areas, inventory, countries, digest=digest)
    return _scored(rows, countries), members


def scored_mentions(documents: DataFrame, areas: DataFrame, inventory: DataFrame, countries: Mapping[str, str], *, digest: bool = False) -> DataFrame:
    """Version 3: every mention of version 2 with signs of evidence, their score, and a tier.

    Nearby is what the sentence of a mention and one on each side hold. That is worked out once a
    sentence, as the names and, for each source, the least and largest area; a mention compares itself
    with these, so that neither pairs of mentions nor a shuffle of sentences arise.
    """
    rows = expanded(*grouped_scored(documents, areas, inventory, countries, digest=digest))
    return rows.select("source_key", *document_key(rows), "start", "end", *_shown(digest), "name_match_class", "polygon_count", "document_frequency", "decision_tier", "evidence_score", "evidence_reasons", "name_in_url", "country_in_sentence", "country_in_context", "same_polygon_alias_nearby", "other_polygon_name_nearby")


def _scored(rows: DataFrame, countries: Mapping[str, str]) -> DataFrame:
    country = F.create_map(*(F.lit(x) for k, v in countries.items() for x in (k, exact_text(v))))
    rows = rows.where(F.col("source_key").isin(*countries)).withColumn("_country", country[F.col("source_key")])
    reached = F.filter("reach", lambda r: r["source_key"] == F.col("source_key"))[0]
    others = F.array_remove(F.array_intersect("near", "own_names"), F.col("normalized_name"))
    rows = rows.withColumns(
        {
            "distinctive_name": F.col("name_match_class") == "distinctive_name",
            "name_in_url": has_marker(F.col("normal_url"), F.col("normalized_name")),
            "country_in_sentence": F.array_contains("inside", F.col("_country")),
            "country_in_context": ~F.array_contains("inside", F.col("_country")) & F.array_contains("around", F.col("_country")),
            "same_polygon_alias_nearby": (F.size("own_names") > 1) & (F.size(others) > 0),
            # Names nearby reach the mention's own area, so that another one is nearby unless they reach one area only.
            "other_polygon_name_nearby": reached["low"] != reached["high"],
        }
    )
    score = sum((F.when(F.col(name), F.lit(points)).otherwise(F.lit(0)) for name, points in POINTS), F.lit(0)).cast("long")
    reasons = F.concat_ws("|", *(F.when(F.col(name), F.lit(name)) for name, _ in POINTS))
    tier = F.when(F.col("evidence_score") >= 4, "high_confidence").when(F.col("evidence_score") >= 2, "possible").otherwise("rejected")
    return rows.withColumns({"evidence_score": score, "evidence_reasons": reasons}).withColumn("decision_tier", tier)


def _weight(found: DataFrame) -> Column:
    """How many areas, that is rows, a row stands for."""
    return F.col("areas") if "areas" in found.columns else F.lit(1).cast("long")


def different_areas(found: DataFrame, members: DataFrame | None, by: Sequence[str] = ()) -> DataFrame:
    """polygons_matched: how many areas the mentions have. members: of the mentions' groups of areas."""
    if members is None:
        return found.groupBy(*by).agg(F.countDistinct("polygon_id").alias("polygons_matched"))
    each = found.select(*by, "area_group").distinct().join(members, "area_group").select(*by, F.explode("members.polygon_id").alias("polygon_id"))
    return each.groupBy(*by).agg(F.countDistinct("polygon_id").alias("polygons_matched"))


def source_summary(found: DataFrame, areas: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Per source: areas, names, mentions, areas with a mention, mentions of each tier (where there are tiers). Sources without mentions stay.

    members: where found are mentions of groups of areas, the groups' members.
    """
    tiers = ("high_confidence", "possible", "rejected") if "decision_tier" in found.columns else ()
    lean = [c for c in ("source_key", "decision_tier", "areas", "area_group", "polygon_id") if c in found.columns]
    found = saved(found.select(*lean).groupBy(*lean).agg(F.count("*").alias("_n")), "counted")
    n = F.col("_n") * _weight(found)
    counts = found.groupBy("source_key").agg(F.sum(n).alias("mentions"), *(F.sum(F.when(F.col("decision_tier") == t, n)).alias(t) for t in tiers)).join(different_areas(found, members, ["source_key"]), "source_key")
    read = areas.groupBy("source_key").agg(F.count("*").alias("polygons_read"))
    names = candidate_names(areas).groupBy("source_key").agg(F.countDistinct("normalized_name").alias("names_indexed"))
    out = read.join(names, "source_key", "left").join(counts, "source_key", "left")
    return out.select("source_key", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("polygons_read", "names_indexed", "mentions", "polygons_matched", *tiers)))


def overall_summary(found: DataFrame, areas: DataFrame, inventory: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """One row over all sources: areas, names by decision, mentions, mentions of each tier, areas with a mention. Names of several sources count once. members: as for source_summary."""
    lean = [c for c in ("decision_tier", "areas", "area_group", "polygon_id") if c in found.columns]
    found = saved(found.select(*lean).groupBy(*lean).agg(F.count("*").alias("_n")), "counted")
    n, told = F.col("_n") * _weight(found), lambda c: F.coalesce(c, F.lit(0)).cast("long")
    count = lambda c, name: F.count(F.when(c, 1)).alias(name)
    names = inventory.agg(F.count("*").alias("names_considered"), count(F.col("decision") != "discard", "names_indexed"), count(F.col("decision") == "discard", "names_discarded"), count(F.col("decision") == "generic", "generic_names"))
    rows = found.agg(told(F.sum(n)).alias("mentions"), *(told(F.sum(F.when(F.col("decision_tier") == t, n))).alias(t) for t in ("high_confidence", "possible", "rejected")))
    rows = rows.join(F.broadcast(different_areas(found, members)))
    one = [f.withColumn("_k", F.lit(1)) for f in (areas.agg(F.count("*").alias("polygons_read")), names, rows)]
    return one[0].join(one[1], "_k").join(one[2], "_k").drop("_k")
