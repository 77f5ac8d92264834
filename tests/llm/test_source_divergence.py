"""Source divergence against SQL and brute force."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from geoweave.llm import source_divergence as sd

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least=10, top=10):
    """rows: (text, lang, source)."""
    counts, documents = {}, {}
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        counts.setdefault((lang, source), Counter()).update(words)
        documents.setdefault(lang, Counter()).update(set(words))
    out = []
    for lang, seen in documents.items():
        vocab = sorted(t for t, n in seen.items() if n >= least)
        own = {s: c for (own_lang, s), c in counts.items() if own_lang == lang}
        whole = sum(own.values(), Counter())

        def weights(c):
            total = sum(c[t] for t in vocab)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(vocab)) for t in vocab}

        p = {s: weights(c) for s, c in own.items()}
        q = weights(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in own:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in vocab), o) for o in own if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in vocab if own[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, n + 1) for n, (value, item) in enumerate(ranked[:most])]
    return sorted(out)


def got(df, **options):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in sd.audit(df, **options).collect())


def test_whole_table_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = sorted(tuple(r) for r in con.execute(sd.REPORT_SQL).fetchall())
    assert got(spark.read.parquet(f"{sf_dir}/documents.parquet")) == want


def test_tiles_chunks_and_slabs_equal_brute_force(spark):
    rng = random.Random(6)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)] + ["\xc9t\xe9", "中文"]
    rows = []
    for n in range(400):
        source = "hot" if n % 3 == 0 else f"s{rng.randrange(23)}"
        rows.append((" ".join(rng.choices(words, k=rng.randint(0, 30))), rng.choice(["en", "en", "de", None]), source))
    rows += [(None, "en", "silent"), ("only here 12", "xx", "a"), ("", "xx", None)]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    want = brute(rows)
    assert got(df) == want
    assert got(df, chunk=7, block=4, slab=2, max_terms=50) == want


def test_shares_are_exact_for_large_counts(spark):
    big = [0, 1, 5, 10**12 + 7, 8 * 10**15]
    total, kept = 9 * 10**15 - 10, 3
    want = [1 + 10**9 * (n + 2) // (total + 2 * kept) for n in big]
    assert sd.shares(np.array(big), total, kept).tolist() == want
    df = spark.createDataFrame([(n,) for n in big], "n long")
    assert [r[0] for r in df.select(sd.share(F.col("n"), F.lit(total).cast("long"), F.lit(kept).cast("long"))).collect()] == want


def test_edges(spark):
    df = spark.createDataFrame([(None, None, None), ("", None, "b"), ("x " * 200000, "en", "a"), ("X y", "en", "a")], "text string, lang string, source string").selectExpr("*", "1 AS term", "'z' AS n")
    assert got(df) == [("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]
    assert got(df, least=1) == brute([(r.text, r.lang, r.source) for r in df.collect()], least=1)
    assert got(df.limit(0)) == []
