"""SimHash near duplicates against brute force."""

import random

import xxhash
from pyspark.sql import functions as F

from geoweave.llm import simhash


def brute_fingerprint(text):
    b = bytearray((text or "").encode())
    for i, c in enumerate(b):
        if 65 <= c <= 90:
            b[i] = c + 32
    words = bytes(b).split()
    if not words:
        return 0
    k = min(4, len(words))
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << bit for bit in range(64) if 2 * sum(x >> bit & 1 for x in h) > len(h))


def brute_components(ids, fps, bits=4):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[root(i)] = root(j)
    least = {}
    for i in range(len(ids)):
        least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    return [least[root(i)] for i in range(len(ids))]


def report(df):
    return sorted((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicate_report(simhash.near_duplicates(df)).collect())


def test_position_sets_cover_every_four_positions():
    from itertools import combinations

    sets = simhash.position_sets()
    assert len(sets) == len(set(sets)) == 20
    assert all(any(set(t) <= set(four) for t in sets) for four in combinations(range(8), 4))


def test_fingerprint_equals_definition_and_spark_hash(spark):
    for text in [None, "", "  \n", "One", "one TWO", "a b c d e f g h a b c d", "é É ß " * 9]:
        assert simhash.fingerprint(text.encode() if text is not None else None) == brute_fingerprint(text)
    one = spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0]
    assert one & (1 << 64) - 1 == simhash.fingerprint(b"A b c D")


def test_whole_table_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    comps = brute_components([r.doc_id for r in rows], fps)
    assert report(docs) == sorted((r.doc_id, f"{f:016x}", c) for r, f, c in zip(rows, fps, comps))


def test_links_chains_and_blocks_equal_brute_force(spark):
    rng = random.Random(5)
    fps = [0, (1 << 64) - 1]
    for _ in range(60):
        f = rng.getrandbits(64)
        for _ in range(6):
            fps.append(f)
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                f ^= 1 << bit
    centre = rng.getrandbits(64)
    fps += [centre ^ (1 << i) ^ (1 << j) for i in range(24) for j in range(i)]
    fps = list(dict.fromkeys(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = brute_components(list(range(len(fps))), fps)
    for limit in (8192, 16):
        marked = spark.createDataFrame(list(zip(range(len(fps)), signed)), "id long, fp long")
        got = {r.id: r.component for r in simhash.grouped(marked, limit).collect()}
        assert [got[i] for i in range(len(fps))] == want


def test_edges(spark):
    rows = [(None, "x y"), (4, None), (3, ""), (9, "x y"), (9, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("id", F.lit(1))
    got = [(r.doc_id, r.component_id) for r in simhash.near_duplicate_report(simhash.near_duplicates(df)).collect()]
    assert sorted(got, key=str) == [(3, 3), (4, 3), (9, 9), (9, 9), (None, 9)]
    assert report(df.limit(0)) == []
