"""URL filters: rules by host and path, and trust and distrust that spread over the link graph.

Rules: (host, path prefix, verdict). A rule fits its host and all subdomains where the path of
the URL starts with the rule's; of the rules that fit, the longest decides.

Hosts without a deciding rule: the absolute links of the pages make a graph of hosts, with edges
counted per pair. Personalised PageRank spreads trust from the hosts of allowed pages along the
links, and distrust from the hosts of blocked pages against them (who links to blocked hosts is
suspect). Both start as distributions over their seeds; what reaches a host without links is
lost, as it would only return to the seeds. A page without a rule is blocked if its host has
more than MARGIN times as much distrust as trust and more than LEAST of what one blocked page
starts with, so that the bound does not move with the number of blocked pages.

All steps are joins and grouped sums over hosts and host pairs, pre-aggregated before each
shuffle; a hot host is one row of the ranks. Every few rounds the ranks become a table in the
shared folder.

Defined results: a null URL, or one without `://`, has an empty host and path, no rule, and is
allowed. Null html has no links. Repeated rows are judged each, and count as seeds each. Other
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoweave.llm.common import saved

DAMPING = 0.85
ROUNDS = 20
ROUNDS_PER_TABLE = 5
MARGIN = 1.0
LEAST = 1e-6

#: The stated rules: host, path, verdict.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["']?\s*([a-z][a-z0-9+.-]*://[^"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as text, verdict); null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the last that fits wins
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def link_graph(pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """src, dst, n: links between different hosts."""
    links = pages.select(host_of(F.col(url_col)).alias("src"), F.explode(F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(_LINK), F.lit(1))).alias("link"))
    return links.select("src", host_of(F.col("link")).alias("dst")).where("src <> '' AND dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, *, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """edges: src, dst, n. seeds: kind (trust, distrust), host, n. Returns kind, host, rank."""
    edges = saved(edges, "links")
    start = seeds.join(seeds.groupBy("kind").agg(F.sum("n").alias("all")), "kind").select("kind", "host", (F.col("n") / F.col("all")).alias("rank"))
    start = saved(start, "seeds")
    if edges.isEmpty():  # no rank can move
        return start.withColumn("rank", F.col("rank") * (1 - damping))
    out = edges.groupBy("src").agg(F.sum("n").alias("all"))
    back = edges.groupBy("dst").agg(F.sum("n").alias("all"))
    steps = edges.join(out, "src").select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), (damping * F.col("n") / F.col("all")).alias("share"))
    steps = steps.union(edges.join(back, "dst").select(F.lit("distrust"), "dst", "src", damping * F.col("n") / F.col("all")))
    steps = saved(steps, "steps")
    base = start.withColumn("rank", F.col("rank") * (1 - damping))
    ranks = start
    for i in range(1, rounds + 1):
        moved = steps.join(ranks, ["kind", "host"]).groupBy("kind", F.col("to").alias("host")).agg(F.sum(F.col("share") * F.col("rank")).alias("rank"))
        ranks = moved.union(base).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if i % ROUNDS_PER_TABLE == 0 and i < rounds:
            ranks = saved(ranks, "ranks")
    return ranks


def judge_urls(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES, damping: float = DAMPING, rounds: int = ROUNDS, margin: float = MARGIN, least: float = LEAST) -> DataFrame:
    """Per row: id, host, path, rule, verdict, trust, distrust."""
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parts.withColumns({"rule": name, "ruled": verdict})
    seeds = ruled.where("ruled IS NOT NULL AND host <> ''").groupBy(F.when(F.col("ruled") == "allow", "trust").otherwise("distrust").alias("kind"), "host").agg(F.count("*").alias("n"))
    ranks = propagate(link_graph(pages, url_col=url_col, html_col=html_col), seeds, damping=damping, rounds=rounds)
    side = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0)).alias(kind)
    hosts = ranks.groupBy("host").agg(side("trust"), side("distrust"))
    found = ruled.join(hosts, "host", "left").withColumns({k: F.coalesce(k, F.lit(0.0)) for k in ("trust", "distrust")})
    blocked = ruled.where("ruled = 'block' AND host <> ''").count()
    suspect = (F.col("distrust") > margin * F.col("trust")) & (F.col("distrust") * blocked > least)
    return found.select("id", "host", "path", "rule", F.coalesce("ruled", F.when(suspect, "block").otherwise("allow")).alias("verdict"), "trust", "distrust")


def url_report(judged: DataFrame, id_name: str = "page_id") -> DataFrame:
    return judged.select(F.col("id").alias(id_name), "host", "path", "rule", "verdict")


def _report_sql(rounds: int = ROUNDS) -> str:
    """The same propagation, one table expression a round."""
    lower = f"translate(%s, '{_UPPER}', '{_LOWER}')"
    host = lower % r"regexp_extract(coalesce(%s, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1)"
    cases = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fit = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    link = _LINK.replace("'", "''")
    parts = [
        f"parts AS (SELECT page_id, html, {host % 'url'} AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages)",
        "ruled AS (SELECT *, CASE " + " ".join(f"WHEN {fit(h, p)} THEN '{h}{p}'" for h, p, _ in cases) + " END AS rule, CASE " + " ".join(f"WHEN {fit(h, p)} THEN '{v}'" for h, p, v in cases) + " END AS ruled FROM parts)",
        f"links AS (SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1)) AS link FROM ruled)",
        f"edges AS (SELECT src, dst, count(*) AS n FROM (SELECT src, {host % 'link'} AS dst FROM links) WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst)",
        "counted AS (SELECT CASE ruled WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS n FROM ruled WHERE ruled IS NOT NULL AND host <> '' GROUP BY ALL)",
        "r0 AS (SELECT kind, host, n / sum(n) OVER (PARTITION BY kind) AS rank FROM counted)",
        f"steps AS (SELECT 'trust' AS kind, src AS host, dst AS \"to\", {DAMPING} * n / sum(n) OVER (PARTITION BY src) AS share FROM edges UNION ALL SELECT 'distrust', dst, src, {DAMPING} * n / sum(n) OVER (PARTITION BY dst) FROM edges)",
    ]
    for i in range(1, rounds + 1):
        parts.append(f"r{i} AS MATERIALIZED (SELECT kind, host, sum(rank) AS rank FROM (SELECT s.kind, s.\"to\" AS host, s.share * r.rank AS rank FROM steps s JOIN r{i - 1} r ON s.kind = r.kind AND s.host = r.host UNION ALL SELECT kind, host, {1 - DAMPING} * rank FROM r0) GROUP BY kind, host)")
    parts.append(f"hosts AS (SELECT host, coalesce(sum(rank) FILTER (WHERE kind = 'trust'), 0) AS trust, coalesce(sum(rank) FILTER (WHERE kind = 'distrust'), 0) AS distrust FROM r{rounds} GROUP BY host)")
    last = f"SELECT page_id, ruled.host, path, rule, coalesce(ruled, CASE WHEN coalesce(distrust, 0) > {MARGIN} * coalesce(trust, 0) AND coalesce(distrust, 0) > {LEAST} THEN 'block' ELSE 'allow' END) AS verdict FROM ruled LEFT JOIN hosts ON ruled.host = hosts.host"
    return "WITH " + ",\n".join(parts) + "\n" + last


REPORT_SQL = _report_sql()
