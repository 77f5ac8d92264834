"""URL rules, and propagation against dense power iteration."""

import random
from collections import Counter

from geoweave.llm import urlfilter


def judged(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS id")
    return {r.id: r for r in urlfilter.judge_urls(df).collect()}


def test_parts_and_rules(spark):
    cases = {
        None: ("", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "http://A.Example.NET/en/x?q=/de/": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "http://example.net/de/": ("example.net", "/de/", "net/", "block"),
        "http://example.net": ("example.net", "", None, "block"),  # distrusted as a seed of its other pages
        "http://badexample.com/de/": ("badexample.com", "/de/", None, "allow"),
        "x://y://z/a#b": ("y:", "//z/a", None, "allow"),
        "https://b.org/fr/1": ("b.org", "/fr/1", "org/fr/", "allow"),
        "https://É.example.com/de/": ("É.example.com", "/de/", "example.com/de/", "block"),
        "http://h?x": ("h", "", None, "allow"),
    }
    got = judged(spark, [(i, u, None) for i, u in enumerate(cases)])
    assert [(r.host, r.path, r.rule, r.verdict) for _, r in sorted(got.items())] == list(cases.values())


def test_propagation_equals_dense_iteration(spark):
    rng = random.Random(4)
    hosts = [f"h{i}.com" for i in range(12)] + ["good.org", "bad.net"]
    rows = []
    for i in range(80):
        host = rng.choice(hosts)
        links = " ".join(f"<a class=x href='http://{rng.choice(hosts)}/p'>" for _ in range(rng.randint(0, 4)))
        rows.append((i, f"http://{host}{'/fr/' if host == 'good.org' else '/'}", links + '<a href="/rel">'))
    edges, seeds = Counter(), {"trust": Counter(), "distrust": Counter()}
    for _, url, html in rows:
        host = url.split("/")[2]
        for part in html.split("href='http://")[1:]:
            if part.split("/")[0] != host:
                edges[host, part.split("/")[0]] += 1
        if host == "good.org":
            seeds["trust"][host] += 1
        if host == "bad.net":
            seeds["distrust"][host] += 1
    rank = {}
    for kind, pairs in (("trust", edges), ("distrust", {(b, a): n for (a, b), n in edges.items()})):
        out = Counter()
        for (a, _), n in pairs.items():
            out[a] += n
        v = {h: seeds[kind][h] / sum(seeds[kind].values()) for h in hosts}
        r = dict(v)
        for _ in range(urlfilter.ROUNDS):
            new = {h: 0.15 * v[h] for h in hosts}
            for (a, b), n in pairs.items():
                new[b] += 0.85 * r[a] * n / out[a]
            r = new
        rank[kind] = r
    for r in judged(spark, rows).values():
        assert abs(r.trust - rank["trust"][r.host]) < 1e-9 and abs(r.distrust - rank["distrust"][r.host]) < 1e-9
        if r.rule is None:
            assert (r.verdict == "block") == (r.distrust > r.trust and r.distrust > 1e-6)


def test_edges(spark):
    assert judged(spark, []) == {}
    df = spark.createDataFrame([(1, None, None), (1, None, None), (None, "http://a.net/", "")], "page_id long, url string, html string")
    assert sorted(r.verdict for r in urlfilter.url_report(urlfilter.judge_urls(df)).collect()) == ["allow", "allow", "block"]


def test_verdicts_do_not_depend_on_unrelated_blocked_pages(spark):
    link = "<a href='http://%s/'>"
    rows = [(1, "http://bad.net/", None), (2, "http://near.com/", link % "bad.net"), (3, "http://far.com/", link % "near.com"), (4, "http://clean.com/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    unrelated = spark.range(1_000_000).selectExpr("id + 10 AS page_id", "concat('http://', id % 1000, '.other.net/') AS url", "CAST(NULL AS string) AS html")
    for given in (pages, pages.union(unrelated)):
        got = {r.id: r.verdict for r in urlfilter.judge_urls(given).where("id < 10").collect()}
        assert got == {1: "block", 2: "block", 3: "block", 4: "allow"}
