"""Elias-Fano sequences, and the sharded model against a dictionary of counts."""

import math
import zlib
from collections import Counter

import numpy as np

from geoweave.llm import elias_fano, lm_scoring


def test_sequences(tmp_path):
    rng = np.random.default_rng(1)
    for n, top in ((1, 0), (1, 2**60), (5, 3), (1000, 2**59), (70_000, 10**6), (70_000, 2**62)):
        values = np.sort(rng.integers(0, top + 1, n).astype(np.uint64))
        elias_fano.EliasFano.write(str(tmp_path / "x"), values)
        ef = elias_fano.EliasFano(str(tmp_path / "x"))
        assert (ef[np.arange(n)] == values).all()
        asked = np.r_[values, values + np.uint64(1), rng.integers(0, top + 2, 50).astype(np.uint64), np.uint64([0, 2**63])]
        assert (ef.successor(asked) == np.searchsorted(values, asked)).all()


def test_trie(tmp_path):
    rng = np.random.default_rng(2)
    pairs = np.unique(np.column_stack([rng.integers(0, 400, 20_000) << 40, rng.integers(0, 1 << 40, 20_000) % 97]), axis=0).astype(np.uint64)
    p = rng.random(len(pairs)) ** 4 + 1e-9
    elias_fano.NgramTrie.write(str(tmp_path), pairs[:, 0], pairs[:, 1], p)
    trie = elias_fano.NgramTrie(str(tmp_path))
    assert np.abs(np.log10(elias_fano.restored(trie.lookup(pairs[:, 0], pairs[:, 1]))) - np.log10(p)).max() < 2e-4
    held = {tuple(x) for x in pairs.tolist()}
    asked = np.column_stack([rng.integers(0, 500, 5000) << 40, rng.integers(0, 120, 5000)]).astype(np.uint64)
    assert [(c != elias_fano.ABSENT) for c in trie.lookup(asked[:, 0], asked[:, 1])] == [tuple(x) in held for x in asked.tolist()]


def tokens(text):
    b = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    return b.split() + [b""]


def brute(rows, mu=lm_scoring.MU):
    held = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows]
    texts = [tokens(t) for _, t in rows]
    one, two = Counter(), Counter()
    for h, t in zip(held, texts):
        if not h:
            one.update(t)
            two.update(zip([b"", *t], t))
    n, v = sum(one.values()), len(one)
    p = lambda w: (one[w] + 0.5) / (n + 0.5 * (v + 1))
    out = []
    for (d, _), h, t in zip(rows, held, texts):
        score = sum(math.log10((two[a, b] + mu * p(b)) / (one[a] + mu)) for a, b in zip([b"", *t], t))
        out.append((str(d), h, len(t), sum(one[w] > 0 for w in t), n, round(sum(math.log10(p(w)) for w in t), 6), score))
    return sorted(out)


def compare(df, **options):
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), r.score) for r in lm_scoring.score_report(lm_scoring.score_texts(df, **options)).collect())
    assert [g[:6] for g in got] == [w[:6] for w in want]
    assert all(abs(g[6] - w[6]) <= 2e-4 * w[2] + 1e-9 for g, w in zip(got, want))
    return got


def test_whole_table_and_held_out_gain(spark, sf_dir):
    got = compare(spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3), block_tokens=20_000, shard_tokens=5_000)
    held = [g for g in got if g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held)


def test_edges(spark):
    rows = [(None, "a b a"), (1, None), (1, None), (2, ""), (3, "A  b\x0bc\x85"), (19, "zz a b"), (21, "never é")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS block", "2 AS id")
    compare(df, block_tokens=4)
    assert lm_scoring.score_texts(df.limit(0)).collect() == []
