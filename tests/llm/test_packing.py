"""Packing against the tokenizer itself and the rules of a packing."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from geoweave.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check_packing(rows, texts, window):
    """rows: of pack(); texts: by doc_id, unique."""
    tok = Tokenizer.from_file(PATH)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for d, text in texts.items():
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(pieces[d], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_words_equal_the_tokenizer(spark):
    tok, own = Tokenizer.from_file(PATH), packing.tokenizer(PATH)
    texts = [
        "Hello  world\n\n it's we'll 'tis  x's  'S", "   lead", "tail   ", "a\tb\r\n c", "__init__ _ x_y 12a a12 ½ ²x", "ÀÉ straße naïve",
        "日本語 emoji 🙂 ok", "a<|endoftext|>b", "no-break space   x", "́mark é", "'s'd 're", "%%% the*** 1,000.50", "\x0b\x0c\x1c x", "a\n b \n",
    ]
    rows = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in texts + rows + [t * 3 for t in texts]:
        assert np.frombuffer(own(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, text


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(5)
    assert check_packing(packing.pack(docs, PATH).collect(), {r.doc_id: r.text for r in docs.collect()}, 1024) == 0


def test_small_windows_and_edges(spark):
    texts = {1: None, 2: "", 3: "a " * 40, 4: "word " * 7, 5: "b", 6: "c d", None: "e"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    df = df.withColumn("length", df["doc_id"]).withColumn("row", df["doc_id"])
    for window in (8, 13, 64):
        assert check_packing(packing.pack(df, PATH, window=window).collect(), texts, window) == 0
    assert packing.pack(df.limit(0), PATH).collect() == []
    twice = packing.pack(df.union(df), PATH).collect()
    assert sum(r.length for r in twice) == 2 * sum(r.length for r in packing.pack(df, PATH).collect())


def test_solution_and_plan_on_a_histogram():
    rng = np.random.default_rng(3)
    histogram = np.zeros(1025, np.int64)
    histogram[1:1025] = rng.integers(0, 400, 1024)
    plan = packing.make_plan(histogram)
    assert (plan.used <= histogram).all() and plan.left.sum() < 0.15 * histogram.sum()
    seen = defaultdict(int)
    for n in range(1, 1025):
        for k in range(int(histogram[n])):
            parts = packing.place(plan, n, k)
            assert sum(p[2] for p in parts) == n
            for s, o, t in parts:
                seen[s] += t
    assert all(t == 1024 or t & (t - 1) == 0 for t in seen.values())


def test_counts_fit_a_small_exact_case():
    histogram = np.zeros(11, np.int64)
    histogram[[7, 3, 5]] = 40, 40, 20
    combos = packing.combinations_filling(10, np.array([3, 5, 7]))
    x = {tuple(c): v for c, v in zip(combos.tolist(), packing.solve_counts(histogram, combos))}
    assert abs(x[7, 3, 0] - 40) < 0.1 and abs(x[5, 5, 0] - 10) < 0.1
