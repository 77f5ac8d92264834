"""Document frequencies of names, cutoffs, and the name policies that read them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.functions.text import exact_text, normalized
from geoweave.operators.gazetteer import candidate_names, document_key
from geoweave.operators.matching import name_pairs

FREQUENCY_RATIO = 0.001
MIN_LETTERS = 3


def document_frequency(documents: DataFrame, names: DataFrame, *, column: str = "normalized_name") -> DataFrame:
    """normalized_name, document_frequency: in how many documents each name occurs; names that occur nowhere have zero."""
    each = name_pairs(documents, names, key=document_key(documents), column=column).withColumnRenamed("name", column)
    counts = each.groupBy(column).agg(F.count("*").alias("document_frequency"))
    return names.select(column).distinct().join(counts, column, "left").select(column, F.coalesce("document_frequency", F.lit(0)).cast("long").alias("document_frequency"))


def retrieval_cutoff(documents: int, ratio: float = FREQUENCY_RATIO) -> int:
    """May be zero: then only names that no document has are specific."""
    return int(documents * ratio)


def lexical_cutoff(documents: int, ratio: float = FREQUENCY_RATIO) -> int:
    """At least one where there is any document."""
    return max(1, int(documents * ratio)) if documents else 0


def specific_profiles(counted: DataFrame, frequencies: DataFrame, *, country: str, cutoff: int) -> DataFrame:
    """Of gazetteer.counted_names, profiles of names that are not the country's, occur once in the gazetteer, and in at most cutoff documents."""
    joined = counted.join(frequencies, "normalized_name", "left")
    once = F.col("occurrences") == 1
    rare = F.coalesce("document_frequency", F.lit(0)) <= cutoff
    return joined.where((F.col("normalized_name") != exact_text(country)) & once & rare).select("polygon_id", "name", "normalized_name")


def letters(normal: Column) -> Column:
    return F.length(F.regexp_replace(normal, "[^\\p{L}]", ""))


def name_inventory(areas: DataFrame, documents: DataFrame | None, countries: dict[str, str], *, total: int = 0, ratio: float = FREQUENCY_RATIO, frequencies: DataFrame | None = None) -> DataFrame:
    """One row a normalised name: its candidates and the decision about it.

    countries: source_key -> country. A name that equals the country of any of its own sources is
    discarded. documents give the frequencies unless these are given; with neither, they are zero. total: how many documents there are.
    """
    spark: SparkSession = areas.sparkSession
    candidates = candidate_names(areas)
    country = spark.createDataFrame([(k, v, exact_text(v)) for k, v in countries.items()], "source_key string, country string, country_name string")
    named = candidates.join(F.broadcast(country), "source_key", "left")  # one row a source
    own = F.max(F.when(F.col("country_name") == F.col("normalized_name"), F.col("country"))).alias("country_name")
    grouped = named.groupBy("normalized_name").agg(
        F.array_sort(F.collect_set(F.struct("alias", "polygon_id", "source_key"))).alias("candidates"),
        F.countDistinct("polygon_id").cast("long").alias("polygon_count"),
        own,
    )
    if frequencies is None and documents is not None:
        frequencies = document_frequency(documents, grouped.where(letters(F.col("normalized_name")) >= MIN_LETTERS))
    if frequencies is not None:
        grouped = grouped.join(frequencies.select("normalized_name", "document_frequency"), "normalized_name", "left")
    else:
        grouped = grouped.withColumn("document_frequency", F.lit(0))
    grouped = grouped.withColumns({"document_frequency": F.coalesce("document_frequency", F.lit(0)).cast("long"), "letter_count": letters(F.col("normalized_name")).cast("long")})
    cutoff = lexical_cutoff(total, ratio)
    reason = (
        F.when(F.col("letter_count") == 0, "no_letters")
        .when(F.col("letter_count") < MIN_LETTERS, "too_few_letters")
        .when(F.col("country_name").isNotNull(), "country_name")
        .when(F.col("polygon_count") > 1, "osm_reuse")
        .when(F.col("document_frequency") > cutoff, "document_frequency")
        .otherwise("specific")
    )
    decision = F.when(F.col("reason").isin("no_letters", "too_few_letters", "country_name"), "discard").when(F.col("reason") == "specific", "distinctive").otherwise("generic")
    return grouped.withColumn("reason", reason).withColumn("decision", decision)


def searchable(inventory: DataFrame) -> DataFrame:
    """Names that are counted in documents: all but those with too few letters."""
    return inventory.where(~F.col("reason").isin("no_letters", "too_few_letters"))


def decision_counts(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("decision", "reason").agg(F.count("*").alias("names"))
