"""Runs: the versions end to end, from documents and areas to evidence, and the steps after it."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from geoweave.operators import gazetteer, lexical, retrieval, specificity
from geoweave.operators.classify import Classifier, Segmenter, keep_yes, labelled, segmented
from geoweave.operators.topics import Vocabulary, near_topics, with_topic
from geoweave.plans.chunks import ChunkRun, run_chunks
from geoweave.plans.manifest import produce
from geoweave.plans.versions import RetrievalVersion, retrieval_version
from geoweave.session import saved


def run_profiles(areas: DataFrame, documents: DataFrame, version: RetrievalVersion, *, country: str, ratio: float = specificity.FREQUENCY_RATIO, frequencies: DataFrame | None = None) -> DataFrame:
    """The profiles that a version searches. frequencies: of an earlier pass over the same documents and areas."""
    if version.areas == "named":
        return gazetteer.profiles(areas)
    if version.areas == "in_boundary":
        inside = gazetteer.within_boundary(areas, gazetteer.normal_name(country))
        return gazetteer.one_per_name(gazetteer.meaningful_profiles(inside))
    found = gazetteer.meaningful_profiles(areas)
    if version.areas == "meaningful":
        return gazetteer.one_per_name(found)
    once = gazetteer.counted_names(found)
    if frequencies is None:
        frequencies = specificity.document_frequency(documents, once)
    cutoff = specificity.retrieval_cutoff(documents.count(), ratio)
    return specificity.specific_profiles(once, frequencies, country=country, cutoff=cutoff)


def retrieve(documents: DataFrame, areas: DataFrame, version: str, *, country: str, ratio: float = specificity.FREQUENCY_RATIO, frequencies: DataFrame | None = None) -> DataFrame:
    """Evidence of a version: documents x areas, kept once an area and document where the version says so."""
    plan = retrieval_version(version)
    found = retrieval.evidence(documents, run_profiles(areas, documents, plan, country=country, ratio=ratio, frequencies=frequencies), rule=plan.rule, context=country, max_gap=plan.max_gap or 0)
    return retrieval.deduplicated(found, documents) if plan.deduplicated else found


def retrieve_in_chunks(documents: DataFrame, areas: DataFrame, version: str, path: str, settings: dict, *, country: str, rows_per_chunk: int, chunks_per_wave: int | None = None, ratio: float = specificity.FREQUENCY_RATIO, frequencies: DataFrame | None = None, tell: Callable[[dict], None] | None = None) -> ChunkRun:
    """`retrieve`, chunk by chunk: a run that ends early is taken up where it stopped. documents: with `shard` and `row_index`.

    Profiles are chosen once, over all documents; rows are deduplicated over all chunks at the end. settings: what the inputs and
    options are; a result of other ones is an error.
    """
    plan = retrieval_version(version)
    spark, settings = documents.sparkSession, settings | {"version": version, "country": country, "ratio": ratio}
    profiles, _ = produce(spark, f"{path}/profiles", settings, lambda: run_profiles(areas, documents, plan, country=country, ratio=ratio, frequencies=frequencies))
    find = lambda rows: retrieval.evidence(rows, profiles, rule=plan.rule, context=country, max_gap=plan.max_gap or 0)
    done = run_chunks(documents, path, settings, find, rows_per_chunk=rows_per_chunk, chunks_per_wave=chunks_per_wave, tell=tell)
    return replace(done, found=retrieval.deduplicated(done.found, documents)) if plan.deduplicated else done


def candidates_in_chunks(documents: DataFrame, areas: DataFrame, version: str, path: str, settings: dict, *, countries: Mapping[str, str], rows_per_chunk: int, chunks_per_wave: int | None = None, ratio: float = specificity.FREQUENCY_RATIO, frequencies: DataFrame | None = None, tell: Callable[[dict], None] | None = None) -> ChunkRun:
    """`find_candidates`, chunk by chunk, see `retrieve_in_chunks`. The inventory of names is made once, over all documents."""
    spark, settings = documents.sparkSession, settings | {"version": version, "countries": dict(countries), "ratio": ratio}
    if version == "v1":
        find = lambda rows: lexical.mentions(rows, areas)
    elif version in ("v2", "v3"):
        inventory, _ = produce(spark, f"{path}/inventory", settings, lambda: specificity.name_inventory(areas, documents, dict(countries), total=documents.count(), ratio=ratio, frequencies=frequencies))
        find = lambda rows: lexical.classed_mentions(rows, areas, inventory) if version == "v2" else lexical.scored_mentions(rows, areas, inventory, dict(countries))
    else:
        raise ValueError("lexical version must be v1, v2 or v3")
    return run_chunks(documents, path, settings, find, rows_per_chunk=rows_per_chunk, chunks_per_wave=chunks_per_wave, tell=tell)


def name_frequencies(documents: DataFrame, areas: DataFrame) -> DataFrame:
    """Document frequencies of all names and aliases of the areas: the pass that versions 5, 6 and the lexical ones share."""
    names = gazetteer.meaningful_profiles(areas).select("normalized_name").union(gazetteer.candidate_names(areas).select("normalized_name"))
    return specificity.document_frequency(documents, names.distinct())


def refine(found: DataFrame, vocabulary: Vocabulary, *, segmenter: Segmenter | None = None, classifier: Classifier | None = None, window: int = 2, strict: bool = True) -> dict[str, DataFrame]:
    """The steps after v6: v7 sentences, v8 topic documents, v9 topic sentences near the name, v10 (with a classifier) affirmed ones."""
    out = {"v7": segmented(found.drop("normalized_name"), segmenter)}
    out["v8"] = with_topic(out["v7"], vocabulary)
    out["v9"] = near_topics(out["v8"], vocabulary, window=window, strict=strict)
    if classifier is not None:
        out["v10"] = keep_yes(labelled(out["v9"], classifier))
    return out


def find_candidates(documents: DataFrame, areas: DataFrame, version: str, *, countries: Mapping[str, str], ratio: float = specificity.FREQUENCY_RATIO, frequencies: DataFrame | None = None, digest: bool = False) -> DataFrame:
    """Lexical candidates of a version. Versions 2 and 3 read the documents twice: for the frequencies (unless these are given), then for the mentions.

    digest: context_sha256 in place of context, worked out once a sentence and not for each row.
    """
    if version == "v1":
        return lexical.mentions(documents, areas, digest=digest)
    if version not in ("v2", "v3"):
        raise ValueError("lexical version must be v1, v2 or v3")
    inventory = _inventory(documents, areas, countries, ratio, frequencies)
    if version == "v2":
        return lexical.classed_mentions(documents, areas, inventory, digest=digest)
    return lexical.scored_mentions(documents, areas, inventory, dict(countries), digest=digest)


def _inventory(documents: DataFrame, areas: DataFrame, countries: Mapping[str, str], ratio: float, frequencies: DataFrame | None) -> DataFrame:
    return saved(specificity.name_inventory(areas, documents, dict(countries), total=documents.count(), ratio=ratio, frequencies=frequencies), "inventory")


def find_grouped(documents: DataFrame, areas: DataFrame, version: str, *, countries: Mapping[str, str], ratio: float = specificity.FREQUENCY_RATIO, frequencies: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """find_candidates of versions 2 and 3 as mentions of groups of areas, and the groups' members: linear in the documents, whatever areas share a name."""
    inventory = _inventory(documents, areas, countries, ratio, frequencies)
    if version == "v2":
        return lexical.grouped_classed(documents, areas, inventory)
    return lexical.grouped_scored(documents, areas, inventory, dict(countries))


#: What tells rows apart: an area, or a group of areas, which have all rows in common.
KEYS = ("source_key", "polygon_id", "matched_alias", "url", "sentence")


def _keyed(found: DataFrame, keys: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    """The rows' keys, in mentions of groups with the group for the area, texts by a hash of 256 bits; and how many rows each stands for."""
    grouped = "area_group" in found.columns
    names = ["area_group" if grouped and c == "polygon_id" else c for c in keys]
    texts = [c for c in names if c in ("url", "sentence")]
    rest = [c for c in names if c not in texts]
    told = F.unhex(F.sha2(F.to_json(F.struct(*texts)), 256)).alias("_texts")
    weight = F.col("areas") if grouped else F.lit(1).cast("long")
    more = ["name_match_class"] if "name_match_class" in found.columns else []
    return found.select(*rest, *more, told, weight.alias("_areas")), [*rest, "_texts"]


def comparison(v2: DataFrame, v3: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One row: rows of both, and rows that one has more often than the other; equal multisets have no such rows."""
    (a, on), (b, _) = _keyed(v2, keys), _keyed(v3, keys)
    both = a.withColumn("_side", F.lit(1)).unionByName(b.withColumn("_side", F.lit(-1)), allowMissingColumns=True)
    side = lambda s: F.count(F.when(F.col("_side") == s, 1))
    each = both.groupBy(*on, "_areas").agg(side(1).alias("a"), side(-1).alias("b"))
    total = lambda n: F.coalesce(F.sum(n * F.col("_areas")), F.lit(0)).cast("long")
    told = each.agg(total(F.col("a")).alias("rows_v2"), total(F.col("b")).alias("rows_v3"), total(F.greatest(F.col("a") - F.col("b"), F.lit(0))).alias("only_v2"), total(F.greatest(F.col("b") - F.col("a"), F.lit(0))).alias("only_v3"))
    return told.select("*", ((F.col("only_v2") == 0) & (F.col("only_v3") == 0)).alias("equal"))


def top_names(found: DataFrame, k: int = 10) -> DataFrame:
    """The k names with the most mentions; ties by the first document and place they occur at."""
    first = F.min(F.struct(*gazetteer.document_key(found), "start")).alias("first_seen")
    weight = F.col("areas") if "areas" in found.columns else F.lit(1).cast("long")
    return found.groupBy("matched_alias").agg(F.sum(weight).alias("mentions"), first).orderBy(F.desc("mentions"), "first_seen", "matched_alias").limit(k).select("matched_alias", "mentions")


def top_samples(scored: DataFrame, k: int = 5) -> DataFrame:
    """Of mentions of groups of areas, which are equal rows in this order, one row for each area, k at most."""
    order = [F.desc("evidence_score"), "matched_alias", "url", "sentence"]
    if "areas" not in scored.columns:
        return scored.orderBy(*order).limit(k)
    rows = scored.orderBy(*order).limit(k).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least("areas", F.lit(k).cast("long")).cast("int")))).drop("_copy", "areas")
    return rows.orderBy(*order).limit(k)


def result_counts(found: DataFrame, keys: tuple[str, ...] = KEYS, members: DataFrame | None = None) -> DataFrame:
    """Per source: rows, rows that repeat another in the keys, different areas, rows of each class. members: where found are mentions of groups of areas, the groups' members."""
    rows, on = _keyed(found, keys)
    once = rows.groupBy(*on, "_areas").agg(F.count("*").alias("n"), *(F.count(F.when(F.col("name_match_class") == c, 1)).alias(c) for c in ("distinctive_name", "generic_name")))
    lean = [c for c in on if c in ("source_key", "area_group", "polygon_id")]
    each = saved(once.groupBy(*lean, "_areas").agg(F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("again"), F.sum("distinctive_name").alias("distinctive_name"), F.sum("generic_name").alias("generic_name")), "counted")
    total = lambda c: F.sum(F.col(c) * F.col("_areas"))
    counts = each.groupBy("source_key").agg(total("n").alias("rows"), total("again").alias("duplicate_rows"), total("distinctive_name").alias("distinctive_name"), total("generic_name").alias("generic_name"))
    return counts.join(lexical.different_areas(each, members, ["source_key"]), "source_key").select("source_key", "rows", "duplicate_rows", F.col("polygons_matched").alias("polygons"), "distinctive_name", "generic_name")


def run_counters(documents: DataFrame, find: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One row: documents scanned, rows found, documents with a row. Documents are counted while they are searched."""
    scan = Observation()
    found = find(documents.observe(scan, F.count(F.lit(1)).alias("rows")))
    told = found.agg(F.count("*").alias("matches"), F.countDistinct(F.struct(*gazetteer.document_key(found))).alias("documents")).first()
    try:
        scanned = scan.get["rows"]
    except Exception:  # a plan that is known to be empty reads nothing
        scanned = documents.count()
    return documents.sparkSession.createDataFrame([(scanned, told.matches, told.documents)], "rows_scanned long, matches_written long, documents_matched long")
