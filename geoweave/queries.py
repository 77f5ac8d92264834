"""The engine's registered queries over the given tables, and the SQL that checks them.

Binding: documents are the shard (URL: that of the page with the same id); two gazetteers come from
the benchmark (first two words as name, the fifth as alias) and the pages' hosts (label as name);
two frequent words play the countries. Each area is a square that its number places on a grid, every other
one with a hole; the first country is a larger square, the boundary of version 2.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.functions import geometry
from geoweave.functions.text import normalized, sentences, terminal_sentences
from geoweave.operators import classify, gazetteer, lexical, retrieval, specificity, topics
from geoweave.plans import runs, versions
from geoweave.session import small_batches
from geoweave.sources.tables import spread

COUNTRIES = {"alpha": "thtion", "beta": "nicht"}
CONTEXT = COUNTRIES["alpha"]
#: On these small tables names are too frequent for the usual ratio of one in a thousand.
RATIO = 0.05
VOCABULARY = topics.Vocabulary({"land_use": ["ertion", "thing"], "soil_surface": ["mente", "ersch"], "vegetation": ["étion", "the the"]})


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, p = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pages").select("page_id", "url")
    rows = d.join(p, d["doc_id"] == p["page_id"], "left")
    return rows.select(F.col("doc_id").alias("row_index"), F.col("doc_id").cast("string").alias("document_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("url", F.lit("")).alias("url"))


def _ring(low: float, high: float) -> str:
    at = lambda dx, dy: f"named_struct('lon', CAST(x + {dx} AS DOUBLE), 'lat', CAST(y + {dy} AS DOUBLE))"
    return "array(" + ", ".join(at(*p) for p in ((low, low), (high, low), (high, high), (low, high), (low, low))) + ")"


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = lambda i: F.when(F.col(i) % 2 == 0, "alpha").otherwise("beta").alias("source_key")
    empty = F.array().cast("array<string>").alias("aliases")
    b = _table(spark, sf_dir, "benchmark").withColumn("w", F.split(normalized(F.col("text")), " ")).where("size(w) >= 5")
    a = b.select(F.concat(F.lit("bench/"), "item_id").alias("polygon_id"), source("item_id"), F.concat_ws(" ", F.col("w")[0], F.col("w")[1]).alias("name"), F.array(F.col("w")[4]).alias("aliases"), F.col("item_id").alias("i"))
    label = F.regexp_extract("url", "://(?:(?:m|www|blog)\\.)?([^./]+)", 1)
    h = _table(spark, sf_dir, "pages").select(F.concat(F.lit("host/"), "page_id").alias("polygon_id"), source("page_id"), label.alias("name"), empty, F.col("page_id").alias("i"))
    placed = a.unionByName(h).selectExpr("*", "i % 37 AS x", "i % 41 AS y")
    shape = F.expr(f"CASE WHEN i % 2 = 0 THEN array(array({_ring(0, 1)}, {_ring(0.25, 0.5)})) ELSE array(array({_ring(0, 1)})) END").cast(geometry.GEOMETRY)
    placed = placed.withColumns({"tags": F.create_map(F.lit("name"), F.col("name"), F.lit("name:xx"), F.upper("name")), "geometry": shape}).drop("i", "x", "y")
    boundary = {"boundary": "administrative", "admin_level": "8", "place": "city"}
    own = [(f"place/{k}", k, v, [], {"name": v} | (boundary if k == "alpha" else {})) for k, v in COUNTRIES.items()] + [("place/digits", "alpha", "123", [], {"name": "123"})]
    places = spark.createDataFrame(own, "polygon_id string, source_key string, name string, aliases array<string>, tags map<string,string>")
    square = F.expr(f"array(array({_ring(0, 20).replace('x + ', '').replace('y + ', '')}))").cast(geometry.GEOMETRY)
    return placed.unionByName(places.withColumn("geometry", F.when(F.col("polygon_id") == "place/alpha", square)))


def _listed(c: str) -> Column:
    return F.array_join(c, "|").alias(c)


def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "documents").select("doc_id", normalized(F.col("text")).alias("normal"))


def sentence_splits(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents")
    return docs.select("doc_id", F.size(sentences(F.col("text"))).cast("long").alias("n_sentences"), F.array_join(terminal_sentences(F.col("text")), "|").alias("terminal"))


def meaningful_names(spark: SparkSession, d: str) -> DataFrame:
    return gazetteer.meaningful_profiles(areas(spark, d)).select("polygon_id", "name", "normalized_name")


def gazetteer_dedup(spark: SparkSession, d: str) -> DataFrame:
    found = gazetteer.meaningful_profiles(areas(spark, d))
    return gazetteer.counted_names(found).select("polygon_id", "name", "normalized_name", "occurrences")


def doc_frequency(spark: SparkSession, d: str) -> DataFrame:
    return specificity.document_frequency(shard(spark, d), gazetteer.one_per_name(gazetteer.meaningful_profiles(areas(spark, d))))


def specific_names(spark: SparkSession, d: str) -> DataFrame:
    return runs.run_profiles(areas(spark, d), shard(spark, d), versions.retrieval_version("v5"), country=CONTEXT, ratio=RATIO).select("polygon_id", "normalized_name")


def _match(version: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        found = runs.retrieve(shard(spark, d), areas(spark, d), version, country=CONTEXT, ratio=RATIO)
        shown = ["text_excerpt", "url_excerpt"] if version != "v6" else ["name_country_distance", "polygon_name_sentence", "country_name_sentence"]
        return found.select("polygon_id", "polygon_name", "row_index", "document_id", _listed("matched_fields"), _listed("context_fields"), "context_phrase", *shown)

    return run


def _refined(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    found = runs.retrieve(shard(spark, d), areas(spark, d), "v4", country=CONTEXT)
    return runs.refine(found, VOCABULARY, classifier=_stub, strict=False)


def _stub(texts):
    """Stands for a model: sentences of an even number of characters are affirmed."""
    return ["yes" if len(t) % 2 == 0 else "no" for t in texts]


def topic_documents(spark: SparkSession, d: str) -> DataFrame:
    return topics.with_topic(_table(spark, d, "documents"), VOCABULARY).select("doc_id")


def topic_categories(spark: SparkSession, d: str) -> DataFrame:
    return topics.category_counts(_table(spark, d, "documents"), VOCABULARY)


def topic_proximity(spark: SparkSession, d: str) -> DataFrame:
    rows = _refined(spark, d)["v9"]
    return rows.select("polygon_id", "row_index", F.col("topic_sentence_count").cast("long").alias("topic_sentence_count"), F.array_join("topic_terms", "|").alias("topic_terms"), F.aggregate("relevant_sentence_metadata", F.lit(0), lambda a, m: a + m["place_sentence_distance"]).cast("long").alias("distance"))


def classified_topics(spark: SparkSession, d: str) -> DataFrame:
    rows = _refined(spark, d)["v10"]
    return rows.select("polygon_id", "row_index", F.col("topic_sentence_count").cast("long").alias("topic_sentence_count"), F.array_join(F.array_sort("topic_categories"), "|").alias("topic_categories"))


def name_inventory(spark: SparkSession, d: str) -> DataFrame:
    docs = shard(spark, d)
    found = specificity.name_inventory(areas(spark, d), docs, COUNTRIES, total=docs.count())
    return found.select("normalized_name", "polygon_count", "document_frequency", "letter_count", "country_name", "reason", "decision", F.size("candidates").cast("long").alias("candidates"))


def _lexical(version: str) -> DataFrame:
    def run(spark: SparkSession, d: str) -> DataFrame:
        found = runs.find_candidates(shard(spark, d), areas(spark, d), version, countries=COUNTRIES, digest=True)
        more = {"v1": [], "v2": ["name_match_class", "polygon_count", "document_frequency"], "v3": ["name_match_class", "decision_tier", "evidence_score", "evidence_reasons"]}[version]
        return found.select("source_key", "row_index", "start", "end", "polygon_id", "matched_alias", "sentence", "context_sha256", *more)

    return run


def lexical_summary(spark: SparkSession, d: str) -> DataFrame:
    a = areas(spark, d)
    found, members = runs.find_grouped(shard(spark, d), a, "v3", countries=COUNTRIES)
    return lexical.source_summary(found, a, members)


def lexical_comparison(spark: SparkSession, d: str) -> DataFrame:
    docs, a = shard(spark, d), areas(spark, d)
    return runs.comparison(*(runs.find_grouped(docs, a, v, countries=COUNTRIES)[0] for v in ("v2", "v3")))


def top_names(spark: SparkSession, d: str) -> DataFrame:
    return runs.top_names(runs.find_grouped(shard(spark, d), areas(spark, d), "v2", countries=COUNTRIES)[0])


def points_in_polygon(spark: SparkSession, d: str) -> DataFrame:
    """Customers as points on a grid against the areas whose number they share."""
    place = areas(spark, d).where("polygon_id LIKE 'host/%'").select(F.substring("polygon_id", 6, 20).cast("long").alias("n"), "geometry")
    point = F.struct((F.col("n") % 37 + F.col("c_custkey") % 11 / 10.0 - 0.13).alias("lon"), (F.col("n") % 41 + F.col("c_custkey") % 13 / 12.0 - 0.11).alias("lat"))
    people = _table(spark, d, "customer").join(place.select("n", "geometry"), F.col("c_custkey") % 200 == F.col("n"))
    return people.select("c_custkey", geometry.contains_point(F.col("geometry"), point).alias("inside"))


def centroids(spark: SparkSession, d: str) -> DataFrame:
    rows = areas(spark, d).select("polygon_id", geometry.centroid(F.col("geometry")).alias("c"), geometry.representative_point(F.col("geometry")).alias("p"))
    return rows.select("polygon_id", *(F.round(F.col(c), 6).alias(n) for n, c in (("lon", "c.lon"), ("lat", "c.lat"), ("point_lon", "p.lon"), ("point_lat", "p.lat"))))


def catalog_files(spark: SparkSession, d: str) -> DataFrame:
    return versions.catalog(spark)


def label_summary(spark: SparkSession, d: str) -> DataFrame:
    found = classify.labelled(_refined(spark, d)["v9"], _stub)
    return classify.label_counts(found).select(*(F.col(c).cast("long").alias(c) for c in ("rows_processed", "rows_kept", "yes_sentences", "no_sentences")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "doc_frequency": doc_frequency,
        "normalize_text": normalize_text,
        "sentence_splits": sentence_splits,
        "meaningful_names": meaningful_names,
        "gazetteer_dedup": gazetteer_dedup,
        "specific_names": specific_names,
        **{f"match_{v}": _match(v) for v in versions.RETRIEVAL},
        "topic_documents": topic_documents,
        "topic_categories": topic_categories,
        "topic_proximity": topic_proximity,
        "classified_topics": classified_topics,
        "label_summary": label_summary,
        "name_inventory": name_inventory,
        **{f"lexical_{v}": _lexical(v) for v in ("v1", "v2", "v3")},
        "lexical_summary": lexical_summary,
        "lexical_comparison": lexical_comparison,
        "top_names": top_names,
        "points_in_polygon": points_in_polygon,
        "centroids": centroids,
        "catalog_files": catalog_files,
    }


# ---------------------------------------------------------------- SQL


def _n(x: str) -> str:
    return f"trim(regexp_replace(replace(lower(coalesce({x}, '')), 'ß', 'ss'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def _has(n: str, m: str) -> str:
    return f"contains(' ' || {n} || ' ', ' ' || {m} || ' ')"


_RS = "chr(30)"
_STRIP = "regexp_replace(regexp_replace({0}, '^\\s+', ''), '\\s+$', '')"

_BASE = f"""
shard AS MATERIALIZED (SELECT d.doc_id AS row_index, CAST(d.doc_id AS VARCHAR) AS document_id, coalesce(d.text, '') AS text, coalesce(p.url, '') AS url, {_n('d.text')} AS nt, {_n('p.url')} AS nu FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id),
areas AS MATERIALIZED (
  SELECT 'bench/' || item_id AS polygon_id, CASE WHEN item_id % 2 = 0 THEN 'alpha' ELSE 'beta' END AS source_key, w[1] || ' ' || w[2] AS name, w[5] AS alias, item_id AS i FROM (SELECT item_id, string_split({_n('text')}, ' ') AS w FROM benchmark) WHERE len(w) >= 5
  UNION ALL SELECT 'host/' || page_id, CASE WHEN page_id % 2 = 0 THEN 'alpha' ELSE 'beta' END, regexp_extract(url, '://(?:(?:m|www|blog)\\.)?([^./]+)', 1), NULL, page_id FROM pages
  UNION ALL SELECT * FROM (VALUES ('place/alpha', 'alpha', '{COUNTRIES['alpha']}', NULL, NULL), ('place/beta', 'beta', '{COUNTRIES['beta']}', NULL, NULL), ('place/digits', 'alpha', '123', NULL, NULL))
),
named AS (SELECT polygon_id, name, {_n('name')} AS n, i FROM areas WHERE coalesce(name, '') <> ''),
meaningful AS (SELECT * FROM named WHERE length(n) >= 3 AND regexp_matches(n, '\\p{{L}}')),
once AS MATERIALIZED (SELECT n, arg_min(name, polygon_id) AS name, min(polygon_id) AS polygon_id, count(*) AS occurrences FROM meaningful GROUP BY n),
inside AS MATERIALIZED (SELECT n, arg_min(name, polygon_id) AS name, min(polygon_id) AS polygon_id FROM meaningful WHERE polygon_id = 'place/alpha' OR (i % 37 < 20 AND i % 41 < 20) GROUP BY n)
"""


def _grams(names: str, texts: str = "shard", text: str = "nt", key: str = "row_index", label: str = "grams") -> str:
    """label(key, pos, n): where the names of a table (column n) occur, in words."""
    return f"""
{label} AS MATERIALIZED (SELECT g.{key}, g.pos, g.n FROM (
  SELECT {key}, pos, array_to_string(w[pos : pos + k - 1], ' ') AS n
  FROM (SELECT {key}, w, k, unnest(range(1, len(w) - k + 2)) AS pos FROM (SELECT {key}, string_split({text}, ' ') AS w FROM {texts}) CROSS JOIN (SELECT DISTINCT len(string_split(n, ' ')) AS k FROM {names}) WHERE len(w) >= k)
) g SEMI JOIN {names} x ON g.n = x.n WHERE g.n <> '')
"""


_FREQUENCY = f"{_grams('once')}, freq AS (SELECT o.n, count(DISTINCT row_index) AS df FROM once o LEFT JOIN grams g ON g.n = o.n GROUP BY o.n)"
_SPECIFIC = f"specific AS MATERIALIZED (SELECT o.polygon_id, o.name, o.n FROM once o JOIN freq f ON f.n = o.n WHERE o.n <> '{CONTEXT}' AND occurrences = 1 AND df <= (SELECT floor(count(*) * {RATIO}) FROM shard))"


def _excerpt(field: str) -> str:
    return f"CASE WHEN NOT (list_contains(matched, '{field}') OR list_contains(context, '{field}')) THEN '' WHEN length({field}) <= 240 THEN {field} ELSE substr({field}, 1, 239) || '…' END AS {field}_excerpt"


def _match_sql(version: str) -> str:
    plan = versions.retrieval_version(version)
    names = {"named": "named", "in_boundary": "inside", "meaningful": "once", "specific": "specific"}[plan.areas]
    extra = f"{_FREQUENCY}, {_SPECIFIC}," if plan.areas == "specific" else ""
    accepted = {"any_field": "(it OR iu) AND (ct OR cu)", "url_or_context": "iu OR (it AND ct)", "url_and_text": "iu AND it AND ct", "text": "it AND ct", "nearby": "it AND ct"}[plan.rule]
    ctx = f"'{CONTEXT}'"
    rows = f"""
{_grams(names, label='in_text')}, {_grams(names, text='nu', label='in_url')},
hits AS MATERIALIZED (SELECT row_index, n, bool_or(t) AS it, bool_or(NOT t) AS iu FROM (SELECT DISTINCT row_index, n, true AS t FROM in_text UNION ALL SELECT DISTINCT row_index, n, false FROM in_url) GROUP BY row_index, n),
rows_ AS (SELECT s.*, p.polygon_id, p.name, h.n, it, iu, {_has('nt', ctx)} AS ct, {_has('nu', ctx)} AS cu FROM hits h JOIN shard s ON s.row_index = h.row_index JOIN {names} p ON p.n = h.n),
kept AS (SELECT *, list_filter([CASE WHEN it THEN 'text' END, CASE WHEN iu THEN 'url' END], lambda x: x IS NOT NULL) AS matched, list_filter([CASE WHEN ct THEN 'text' END, CASE WHEN cu THEN 'url' END], lambda x: x IS NOT NULL) AS context FROM rows_ WHERE {accepted})
"""
    columns = "polygon_id, name AS polygon_name, kept.row_index, document_id, array_to_string(matched, '|') AS matched_fields, array_to_string(context, '|') AS context_fields, CASE WHEN ct OR cu THEN " + ctx + " ELSE '' END AS context_phrase"
    first = "QUALIFY row_number() OVER (PARTITION BY polygon_id, document_id ORDER BY kept.row_index, kept.n, polygon_id) = 1" if plan.deduplicated else ""
    if plan.rule != "nearby":
        return f"WITH {_BASE}, {extra} {rows} SELECT {columns}, {_excerpt('text')}, {_excerpt('url')} FROM kept {first}"
    spans = f"""
offs AS (SELECT g.row_index, g.n, length(array_to_string(string_split(nt, ' ')[1 : pos - 1], ' ')) + CASE WHEN pos > 1 THEN 1 ELSE 0 END AS s FROM in_text g JOIN shard USING (row_index)),
ctx_names AS (SELECT {ctx} AS n), {_grams('ctx_names', label='ctx_at')},
coffs AS (SELECT g.row_index, length(array_to_string(string_split(nt, ' ')[1 : pos - 1], ' ')) + CASE WHEN pos > 1 THEN 1 ELSE 0 END AS s FROM ctx_at g JOIN shard USING (row_index)),
pairs AS (SELECT o.row_index, o.n, min({{'g': greatest(0, c.s - o.s - length(o.n), o.s - c.s - length({ctx})), 'a': o.s, 'b': c.s}}) AS p FROM offs o JOIN coffs c ON c.row_index = o.row_index GROUP BY o.row_index, o.n),
parts AS (SELECT row_index, i, {_STRIP.format('part')} AS sentence, length({_n('part')}) AS size FROM (SELECT row_index, unnest(string_split(regexp_replace(text, '([.!?])\\s+|\\n+', '\\1' || {_RS}, 'g'), {_RS})) AS part, generate_subscripts(string_split(regexp_replace(text, '([.!?])\\s+|\\n+', '\\1' || {_RS}, 'g'), {_RS}), 1) AS i FROM shard WHERE row_index IN (SELECT row_index FROM pairs))),
ranges AS (SELECT *, coalesce(sum(size + 1) OVER (PARTITION BY row_index ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at FROM parts WHERE size > 0)
"""
    told = lambda f: f"coalesce((SELECT sentence FROM ranges r WHERE r.row_index = kept.row_index AND r.at <= p.{f} AND p.{f} < r.at + r.size), '')"
    return f"WITH {_BASE}, {extra} {rows}, {spans} SELECT {columns}, CAST(p.g AS INTEGER) AS name_country_distance, {told('a')} AS polygon_name_sentence, {told('b')} AS country_name_sentence FROM kept JOIN pairs ON pairs.row_index = kept.row_index AND pairs.n = kept.n WHERE p.g <= {plan.max_gap} {first}"


_LISTED = ", ".join(f"('{_t}', '{_c}')" for _c, _ts in VOCABULARY.categories.items() for _t in _ts)
_VOCAB = f"vocab AS (SELECT term, category, term AS n FROM (VALUES {_LISTED}) v(term, category))"
_DOCS = f"docs AS MATERIALIZED (SELECT doc_id, {_n('text')} AS nt FROM documents)"
_TOPICS = f"WITH {_VOCAB}, {_DOCS}, {_grams('vocab', 'docs', 'nt', 'doc_id')}"


def _near_sql(last: str, version: str = "v4", where: str = "true") -> str:
    v4 = _match_sql(version).replace("SELECT polygon_id, name AS polygon_name", "SELECT kept.n, text, polygon_id, name AS polygon_name")
    cut = f"list_filter(string_split(regexp_replace(text, '([.!?]+\\s+|\\n+)', '\\1' || {_RS}, 'g'), {_RS}), lambda s: s <> '')"
    return f"""
WITH v4 AS MATERIALIZED (SELECT * FROM ({v4}) WHERE {where}), {_VOCAB},
sents AS MATERIALIZED (SELECT polygon_id, row_index, n, i, sentence, {_n('sentence')} AS ns FROM (SELECT polygon_id, row_index, n, unnest({cut}) AS sentence, generate_subscripts({cut}, 1) - 1 AS i FROM v4)),
anchors AS (SELECT polygon_id, row_index, list(i) FILTER (WHERE {_has('ns', 'n')}) AS own, list(i) FILTER (WHERE {_has('ns', f"'{CONTEXT}'")}) AS ctx FROM sents GROUP BY polygon_id, row_index),
far AS (SELECT s.*, list_min(list_transform(own, lambda a: abs(a - i))) AS pd, list_min(list_transform(ctx, lambda a: abs(a - i))) AS cd FROM sents s JOIN anchors USING (polygon_id, row_index) WHERE own IS NOT NULL AND ctx IS NOT NULL),
hits AS MATERIALIZED (SELECT polygon_id, row_index, i, sentence, pd, cd, term, category, instr(' ' || ns || ' ', ' ' || vocab.n || ' ') AS off FROM far JOIN vocab ON {_has('ns', 'vocab.n')} WHERE pd <= 2),
v9 AS (SELECT polygon_id, row_index, i, any_value(sentence) AS sentence, any_value(least(pd, cd)) AS distance FROM hits GROUP BY polygon_id, row_index, i)
{last}
"""


def _lexical_sql(version: str, last: str) -> str:
    cand = f"""
cand AS MATERIALIZED (SELECT DISTINCT polygon_id, source_key, alias, {_n('alias')} AS n FROM (SELECT polygon_id, source_key, coalesce(name, '') AS alias FROM areas UNION SELECT polygon_id, source_key, alias FROM areas WHERE alias IS NOT NULL) WHERE {_n('alias')} <> ''),
{_grams('cand', label='found')},
stat AS (SELECT c.n, count(DISTINCT polygon_id) AS polygon_count, count(*) AS candidates, max(CASE WHEN (source_key = 'alpha' AND n = '{COUNTRIES['alpha']}') THEN '{COUNTRIES['alpha']}' WHEN (source_key = 'beta' AND n = '{COUNTRIES['beta']}') THEN '{COUNTRIES['beta']}' END) AS country_name, length(regexp_replace(n, '[^\\p{{L}}]', '', 'g')) AS letter_count FROM cand c GROUP BY c.n),
dfs AS (SELECT n, count(DISTINCT row_index) AS df FROM found GROUP BY n),
inv AS MATERIALIZED (SELECT *, CASE WHEN reason IN ('no_letters', 'too_few_letters', 'country_name') THEN 'discard' WHEN reason = 'specific' THEN 'distinctive' ELSE 'generic' END AS decision FROM (
  SELECT s.*, CASE WHEN letter_count < 3 THEN 0 ELSE coalesce(df, 0) END AS document_frequency, CASE WHEN letter_count = 0 THEN 'no_letters' WHEN letter_count < 3 THEN 'too_few_letters' WHEN country_name IS NOT NULL THEN 'country_name' WHEN polygon_count > 1 THEN 'osm_reuse' WHEN coalesce(df, 0) > (SELECT greatest(1, floor(count(*) * 0.001)) FROM shard) THEN 'document_frequency' ELSE 'specific' END AS reason FROM stat s LEFT JOIN dfs ON dfs.n = s.n)),
cut AS MATERIALIZED (SELECT row_index, string_split(regexp_replace(text, '([.!?]+)(\\s|$)', '\\1' || {_RS} || '\\2', 'g'), {_RS}) AS parts FROM shard),
parts AS MATERIALIZED (SELECT row_index, i, part, len(list_filter(string_split({_n('part')}, ' '), lambda x: x <> '')) AS words FROM (SELECT row_index, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM cut) WHERE regexp_matches(part, '\\S')),
bounds AS MATERIALIZED (SELECT *, coalesce(sum(words) OVER (PARTITION BY row_index ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, row_number() OVER (PARTITION BY row_index ORDER BY i) AS si,
  {_STRIP.format('part')} AS sentence, {_STRIP.format("coalesce(lag(part) OVER o, '') || part || coalesce(lead(part) OVER o, '')")} AS context FROM parts WINDOW o AS (PARTITION BY row_index ORDER BY i)),
places AS MATERIALIZED (SELECT row_index, row_number() OVER (PARTITION BY row_index ORDER BY i) AS pos, off AS s, off + length(part) AS e FROM (
  SELECT row_index, i, part, coalesce(sum(length(part) + 1) OVER (PARTITION BY row_index ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM (SELECT row_index, unnest(string_split(m, ' ')) AS part, generate_subscripts(string_split(m, ' '), 1) AS i FROM (SELECT row_index, regexp_replace(text, '[^\\p{{L}}\\p{{N}}]', ' ', 'g') AS m FROM shard))) WHERE part <> ''),
begun AS MATERIALIZED (SELECT f.row_index, f.pos, f.n, a.s, f.pos + len(string_split(f.n, ' ')) - 1 AS last FROM found f JOIN places a ON a.row_index = f.row_index AND a.pos = f.pos),
placed AS MATERIALIZED (SELECT b.row_index, b.pos, b.n, b.s, z.e FROM begun b JOIN places z ON z.row_index = b.row_index AND z.pos = b.last),
spots AS MATERIALIZED (SELECT f.row_index, f.pos, f.n, f.s, f.e, si, sentence, context FROM placed f JOIN bounds b ON b.row_index = f.row_index AND f.pos - 1 >= before AND f.pos - 1 < before + words),
ment AS MATERIALIZED (SELECT c.source_key, f.row_index, f.pos, CAST(f.s AS INTEGER) AS start, CAST(f.e AS INTEGER) AS end_, c.polygon_id, c.alias AS matched_alias, f.n, si, sentence, context FROM spots f JOIN cand c ON c.n = f.n)
"""
    return f"WITH {_BASE}, {cand} {last}"


_V2 = "SELECT m.source_key, m.row_index, start, end_ AS \"end\", m.polygon_id, matched_alias, sentence, sha256(context) AS context_sha256, CASE decision WHEN 'generic' THEN 'generic_name' ELSE 'distinctive_name' END AS name_match_class, polygon_count, document_frequency FROM ment m JOIN inv ON inv.n = m.n WHERE decision <> 'discard'"
_V3 = f"""
, v2 AS MATERIALIZED (SELECT m.*, decision, {_n('sentence')} AS ns, {_n('context')} AS nc, nu, CASE source_key WHEN 'alpha' THEN '{COUNTRIES['alpha']}' ELSE '{COUNTRIES['beta']}' END AS country FROM ment m JOIN inv ON inv.n = m.n JOIN shard s ON s.row_index = m.row_index WHERE decision <> 'discard'),
signs AS (SELECT *, decision = 'distinctive' AS s1, {_has('nu', 'n')} AS s2, {_has('ns', 'country')} AS s3, NOT {_has('ns', 'country')} AND {_has('nc', 'country')} AS s4,
  min(n) OVER a <> n OR max(n) OVER a <> n AS s5, min(polygon_id) OVER b <> polygon_id OR max(polygon_id) OVER b <> polygon_id AS s6
  FROM v2 WINDOW a AS (PARTITION BY row_index, polygon_id ORDER BY si RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING), b AS (PARTITION BY row_index, source_key ORDER BY si RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING)),
v3 AS MATERIALIZED (SELECT *, CAST(2 * s1::INT + 3 * s2::INT + 3 * s3::INT + s4::INT + 2 * s5::INT + s6::INT AS BIGINT) AS evidence_score,
  concat_ws('|', CASE WHEN s1 THEN 'distinctive_name' END, CASE WHEN s2 THEN 'name_in_url' END, CASE WHEN s3 THEN 'country_in_sentence' END, CASE WHEN s4 THEN 'country_in_context' END, CASE WHEN s5 THEN 'same_polygon_alias_nearby' END, CASE WHEN s6 THEN 'other_polygon_name_nearby' END) AS evidence_reasons FROM signs),
tiered AS (SELECT *, CASE WHEN evidence_score >= 4 THEN 'high_confidence' WHEN evidence_score >= 2 THEN 'possible' ELSE 'rejected' END AS decision_tier FROM v3)
"""


#: The catalog as it is to be, row by row.
_CATALOG = """
('retrieval', 'frozen', 'v1', 'All named areas, name and context in any field', NULL, 'train', 'data/retrieval/v1/alpha.jsonl'),
('retrieval', 'frozen', 'v2', 'Meaningful areas in a boundary, name in the URL or both in the text', NULL, 'train', 'data/retrieval/v2/alpha.jsonl'),
('retrieval', 'frozen', 'v3', 'All meaningful areas, name in URL and text', NULL, 'train', 'data/retrieval/v3/alpha.jsonl'),
('retrieval', 'frozen', 'v4', 'All meaningful areas, name and context in the text', NULL, 'train', 'data/retrieval/v4/alpha.jsonl'),
('retrieval', 'frozen', 'v5', 'Specific names, country in the text', NULL, 'alpha', 'data/retrieval/v5/alpha.jsonl'),
('retrieval', 'frozen', 'v5', 'Specific names, country in the text', NULL, 'beta', 'data/retrieval/v5/beta.jsonl'),
('retrieval', 'frozen', 'v6', 'Specific names, country nearby in the text', 'v5', 'alpha', 'data/retrieval/v6/alpha.jsonl'),
('retrieval', 'frozen', 'v6', 'Specific names, country nearby in the text', 'v5', 'beta', 'data/retrieval/v6/beta.jsonl'),
('retrieval', 'frozen', 'v7', 'Sentence lists added', 'v6', 'alpha', 'data/retrieval/v7/alpha.jsonl'),
('retrieval', 'frozen', 'v7', 'Sentence lists added', 'v6', 'beta', 'data/retrieval/v7/beta.jsonl'),
('retrieval', 'frozen', 'v8', 'Documents with a topic term', 'v7', 'alpha', 'data/retrieval/v8/alpha.jsonl'),
('retrieval', 'frozen', 'v8', 'Documents with a topic term', 'v7', 'beta', 'data/retrieval/v8/beta.jsonl'),
('retrieval', 'frozen', 'v9', 'Topic sentences near the area''s name', 'v8', 'alpha', 'data/retrieval/v9/alpha.jsonl'),
('retrieval', 'frozen', 'v9', 'Topic sentences near the area''s name', 'v8', 'beta', 'data/retrieval/v9/beta.jsonl'),
('retrieval', 'frozen', 'v10', 'Topic sentences that a classifier affirms', 'v9', 'alpha', 'data/retrieval/v10/alpha.jsonl'),
('retrieval', 'frozen', 'v10', 'Topic sentences that a classifier affirms', 'v9', 'beta', 'data/retrieval/v10/beta.jsonl'),
('lexical', 'active', 'v1', 'Every mention of every name', NULL, 'alpha', 'data/lexical/v1/alpha.parquet'),
('lexical', 'active', 'v1', 'Every mention of every name', NULL, 'beta', 'data/lexical/v1/beta.parquet'),
('lexical', 'active', 'v2', 'Names classed by reuse and frequency', NULL, 'alpha', 'data/lexical/v2/alpha.parquet'),
('lexical', 'active', 'v2', 'Names classed by reuse and frequency', NULL, 'beta', 'data/lexical/v2/beta.parquet'),
('lexical', 'active', 'v3', 'Mentions scored by evidence', 'v2', 'alpha', 'data/lexical/v3/alpha.parquet'),
('lexical', 'active', 'v3', 'Mentions scored by evidence', 'v2', 'beta', 'data/lexical/v3/beta.parquet')
"""


def oracle_sql() -> dict[str, str]:
    inventory = "SELECT n AS normalized_name, polygon_count, document_frequency, CAST(letter_count AS BIGINT) AS letter_count, country_name, reason, decision, candidates FROM inv"
    found = {
        "doc_frequency": f"WITH {_BASE}, {_FREQUENCY} SELECT n AS normalized_name, df AS document_frequency FROM freq",
        "normalize_text": f"SELECT doc_id, {_n('text')} AS normal FROM documents",
        "sentence_splits": f"SELECT doc_id, CAST(len(list_filter(string_split(regexp_replace(coalesce(text, ''), '([.!?])\\s+|\\n+', '\\1' || {_RS}, 'g'), {_RS}), lambda s: {_n('s')} <> '')) AS BIGINT) AS n_sentences, array_to_string(list_filter(list_transform(string_split(regexp_replace(coalesce(text, ''), '([.!?]+)(\\s|$)', '\\1' || {_RS} || '\\2', 'g'), {_RS}), lambda s: {_STRIP.format('s')}), lambda s: s <> ''), '|') AS terminal FROM documents",
        "meaningful_names": f"WITH {_BASE} SELECT polygon_id, name, n AS normalized_name FROM meaningful",
        "gazetteer_dedup": f"WITH {_BASE} SELECT polygon_id, name, n AS normalized_name, occurrences FROM once",
        "specific_names": f"WITH {_BASE}, {_FREQUENCY}, {_SPECIFIC} SELECT polygon_id, n AS normalized_name FROM specific",
        "topic_documents": f"{_TOPICS} SELECT DISTINCT doc_id FROM grams",
        "topic_categories": f"{_TOPICS} SELECT category, count(DISTINCT doc_id) AS documents FROM grams JOIN vocab USING (n) GROUP BY category",
        "topic_proximity": _near_sql("SELECT polygon_id, row_index, count(*) AS topic_sentence_count, (SELECT string_agg(term, '|' ORDER BY fi, fp, term) FROM (SELECT term, min(i) AS fi, arg_min(off, i) AS fp FROM hits h WHERE h.polygon_id = v9.polygon_id AND h.row_index = v9.row_index GROUP BY term)) AS topic_terms, CAST(sum(distance) AS BIGINT) AS distance FROM v9 GROUP BY polygon_id, row_index"),
        "classified_topics": _near_sql("SELECT polygon_id, row_index, count(DISTINCT i) AS topic_sentence_count, string_agg(DISTINCT category, '|' ORDER BY category) AS topic_categories FROM hits WHERE length(sentence) % 2 = 0 GROUP BY polygon_id, row_index"),
        "label_summary": _near_sql("SELECT count(DISTINCT (polygon_id, row_index)) AS rows_processed, count(DISTINCT (polygon_id, row_index)) FILTER (WHERE length(sentence) % 2 = 0) AS rows_kept, count(*) FILTER (WHERE length(sentence) % 2 = 0) AS yes_sentences, count(*) FILTER (WHERE length(sentence) % 2 = 1) AS no_sentences FROM v9"),
        "name_inventory": _lexical_sql("v2", inventory),
        "lexical_v1": _lexical_sql("v1", "SELECT source_key, row_index, start, end_ AS \"end\", polygon_id, matched_alias, sentence, sha256(context) AS context_sha256 FROM ment"),
        "lexical_v2": _lexical_sql("v2", _V2),
        "lexical_v3": _lexical_sql("v3", _V3 + "SELECT source_key, row_index, start, end_ AS \"end\", polygon_id, matched_alias, sentence, sha256(context) AS context_sha256, CASE decision WHEN 'generic' THEN 'generic_name' ELSE 'distinctive_name' END AS name_match_class, decision_tier, evidence_score, evidence_reasons FROM tiered"),
        "lexical_summary": _lexical_sql("v3", _V3 + "SELECT a.source_key, a.polygons_read, c.names_indexed, coalesce(mentions, 0) AS mentions, coalesce(polygons_matched, 0) AS polygons_matched, coalesce(high_confidence, 0) AS high_confidence, coalesce(possible, 0) AS possible, coalesce(rejected, 0) AS rejected FROM (SELECT source_key, count(*) AS polygons_read FROM areas GROUP BY source_key) a JOIN (SELECT source_key, count(DISTINCT n) AS names_indexed FROM cand GROUP BY source_key) c ON c.source_key = a.source_key LEFT JOIN (SELECT source_key, count(*) AS mentions, count(DISTINCT polygon_id) AS polygons_matched, count(*) FILTER (WHERE decision_tier = 'high_confidence') AS high_confidence, count(*) FILTER (WHERE decision_tier = 'possible') AS possible, count(*) FILTER (WHERE decision_tier = 'rejected') AS rejected FROM tiered GROUP BY source_key) t ON t.source_key = a.source_key"),
        "lexical_comparison": _lexical_sql("v3", f"{_V3}, a AS ({_V2}), old AS (SELECT source_key, a.polygon_id, matched_alias, s.url, sentence FROM a JOIN shard s ON s.row_index = a.row_index), new AS (SELECT source_key, t.polygon_id, matched_alias, s.url, sentence FROM tiered t JOIN shard s ON s.row_index = t.row_index), only_old AS (SELECT * FROM old EXCEPT ALL SELECT * FROM new), only_new AS (SELECT * FROM new EXCEPT ALL SELECT * FROM old) SELECT (SELECT count(*) FROM old) AS rows_v2, (SELECT count(*) FROM new) AS rows_v3, (SELECT count(*) FROM only_old) AS only_v2, (SELECT count(*) FROM only_new) AS only_v3, (SELECT count(*) FROM only_old) + (SELECT count(*) FROM only_new) = 0 AS equal"),
        "top_names": _lexical_sql("v2", "SELECT matched_alias, count(*) AS mentions FROM ment m JOIN inv ON inv.n = m.n WHERE decision <> 'discard' GROUP BY matched_alias ORDER BY mentions DESC, min((row_index, pos)), matched_alias LIMIT 10"),
        "points_in_polygon": "SELECT c_custkey, (x > 0 AND y > 0 AND x < 1 AND y < 1 AND NOT (n % 2 = 0 AND x > 0.25 AND x < 0.5 AND y > 0.25 AND y < 0.5)) AS inside FROM (SELECT c_custkey, c_custkey % 11 / 10.0 - 0.13 AS x, c_custkey % 13 / 12.0 - 0.11 AS y, c_custkey % 200 AS n FROM customer) JOIN pages ON page_id = n",
        "centroids": f"WITH {_BASE} SELECT polygon_id, round(x + c, 6) AS lon, round(y + c, 6) AS lat, round(x + p, 6) AS point_lon, round(y + p, 6) AS point_lat FROM (SELECT polygon_id, CASE WHEN polygon_id = 'place/alpha' THEN 0.0 ELSE i % 37 END AS x, CASE WHEN polygon_id = 'place/alpha' THEN 0.0 ELSE i % 41 END AS y, CASE WHEN polygon_id = 'place/alpha' THEN 10.0 WHEN i % 2 = 0 THEN (0.5 - 0.375 * 0.0625) / 0.9375 ELSE 0.5 END AS c, CASE WHEN polygon_id = 'place/alpha' THEN 8.0 WHEN i % 2 = 0 THEN 0.375 ELSE 0.4 END AS p FROM areas)",
        "catalog_files": f"SELECT * FROM (VALUES {_CATALOG}) t(line, status, version, title, source_version, split, file)",
    }
    return found | {f"match_{v}": _match_sql(v) for v in versions.RETRIEVAL}
