"""Language-model scores from a sharded Elias-Fano n-gram trie.

Tokens: words after lower-casing A-Z, then one end token a text. The model is a bigram model
with a Dirichlet prior of weight MU at the unigram model (add-half), learned from all training
texts: p(w | v) = (c(vw) + MU p(w)) / (c(v) + MU). The end token is also the context of a first word.

1. Tasks cut their documents into blocks of about BLOCK_TOKENS tokens and number the words of each
   block (`encoded`, a table: the only form of the corpus that later steps read).
2. Each block asks the shards for the counts of its different words and bigrams, and tells them its
   own training counts: one row a block and shard with packed arrays (`requests`). However common
   a word or bigram is, it is one entry a block. A shard is chosen by the first word; for the few
   first words with more than 1/HOT_SHARE of a block's tokens by both words.
3. A shard sums the counts, writes its n-grams as a trie of Elias-Fano levels with quantised
   probabilities, maps these, and answers every block's bigrams by successor search (`answers`).
4. Blocks meet their answers, and texts are scored.

Words are told apart exactly, the words of bigrams by 60 and 40 bits of a hash; probabilities of
bigrams are kept in 16 bits. A task holds one block or one shard. Shards grow in number, not in
size, with the corpus; nothing but two sums and the list of hot words (at most HOT_SHARE a block
by definition, HOT_WORDS in all) comes to the driver.

Defined results: a null text is empty and has the end token alone. A null id is a training text.
Repeated rows each count and are scored each. Other columns are not read. Without training tokens
the counts are zero. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import tempfile
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.llm.common import id_and_text, saved
from geoweave.llm.elias_fano import CONTEXT_BITS, SUCCESSOR_BITS, NgramTrie, restored

MU = 300.0
BLOCK_TOKENS = 1_000_000
SHARD_TOKENS = 1_500_000
HOT_SHARE = 256
#: Only a bound on what the driver reads: words beyond it are dealt like others.
HOT_WORDS = 4096
SEED = 42

_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_END = b""
WORDS, BIGRAMS, STATS = 0, 1, 2


def packed(array: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(array if isinstance(array, bytes) else np.ascontiguousarray(array).tobytes())


def unpacked(data: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype)


def unpacked_words(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split(b"\n")


def is_training(doc_id) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 != 1


def hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w, SEED) for w in words], np.uint64)


def encoded(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row a block: block, doc_ids, training (bytes of 0/1), lengths (int32), tokens (int32 numbers of words), words, n_tokens, n_training, hot (hashes)."""
    docs = id_and_text(documents, id_col, text_col)
    kind = dict(docs.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0

        def block() -> pa.RecordBatch:
            lengths = np.array([len(x) for x in tokens], np.int32)
            every, learn = np.concatenate(tokens), np.array([is_training(i) for i in ids], np.uint8)
            counts = np.bincount(every, minlength=len(numbers))
            words = list(numbers)
            common = np.flatnonzero(counts * HOT_SHARE > len(every)).tolist()
            hot = hashes([words[i] for i in common]).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([task << 32 | number], pa.int64()), pa.array([ids], pa.list_(id_type)), *(pa.array([packed(x)], pa.binary()) for x in (learn, lengths, every, b"\n".join(words))), pa.array([len(every)], pa.int64()), pa.array([int(lengths[learn == 1].sum())], pa.int64()), pa.array([hot.tolist()], pa.list_(pa.int64()))],
                names=["block", "doc_ids", "training", "lengths", "tokens", "words", "n_tokens", "n_training", "hot"],
            )

        ids, tokens, size, numbers, id_type = [], [], 0, None, None
        for b in batches:
            id_type = b.schema.field("id").type
            for doc_id, x in zip(b.column("id").to_pylist(), b.column("text"), strict=True):
                if numbers is None:
                    numbers = defaultdict(itertools.count().__next__)
                    numbers[_END]  # number 0
                words = (x.as_py() or b"").translate(_LOWER).split()
                words.append(_END)
                ids.append(doc_id)
                tokens.append(np.array([numbers[w] for w in words], np.int32))
                size += len(words)
                if size >= block_tokens:
                    yield block()
                    ids, tokens, size, numbers, number = [], [], 0, None, number + 1
        if ids:
            yield block()

    return docs.mapInArrow(run, f"block long, doc_ids array<{kind}>, training binary, lengths binary, tokens binary, words binary, n_tokens long, n_training long, hot array<long>")


class Block:
    """Arrays of one block, the same each time they are made: its words, its different bigrams, and their shards."""

    def __init__(self, row: dict, shards: int, hot: np.ndarray):
        self.words = unpacked_words(row["words"])
        self.tokens = unpacked(row["tokens"], "i4")
        self.lengths = unpacked(row["lengths"], "i4").astype(np.int64)
        self.learn = np.repeat(unpacked(row["training"], "u1").astype(bool), self.lengths)
        own = hashes(self.words)
        # A text ends with the end token, which is the context of the next text's first word.
        self.context = np.r_[np.int32(0), self.tokens[:-1]]
        codes, self.bigram = np.unique(self.context.astype(np.int64) * len(self.words) + self.tokens, return_inverse=True)
        self.v, self.w = codes // len(self.words), codes % len(self.words)
        mixed = own[self.v] ^ (own[self.w] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(7))
        self.word_shard = (own % np.uint64(shards)).astype(np.int64)
        self.bigram_shard = np.where(np.isin(own, hot)[self.v], mixed % np.uint64(shards), own[self.v] % np.uint64(shards)).astype(np.int64)
        self.own = own

    @staticmethod
    def parts(shard: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
        """(shard, positions in it), in a fixed order."""
        order = np.argsort(shard, kind="stable")
        ends = np.cumsum(np.bincount(shard, minlength=shards))
        for s in range(shards):
            part = order[ends[s - 1] if s else 0 : ends[s]]
            if len(part):
                yield s, part


_REQUEST = "shard int, block long, kind int, a binary, b binary, c binary, n binary"


def requests(blocks: DataFrame, shards: int, hot: np.ndarray) -> DataFrame:
    """Words: a joined, n training counts. Bigrams: a contexts, b how many successors each has, c five bytes of each successor, n training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                x = Block(row, shards, hot)
                seen = np.bincount(x.tokens[x.learn], minlength=len(x.words)).astype(np.uint32)
                both = np.bincount(x.bigram[x.learn], minlength=len(x.v)).astype(np.uint32)
                rows = [(s, WORDS, packed(b"\n".join([x.words[j] for j in part.tolist()])), None, None, packed(seen[part])) for s, part in Block.parts(x.word_shard, shards)]
                context = x.own >> np.uint64(64 - CONTEXT_BITS)
                successor = np.ascontiguousarray(x.own).view(np.uint8).reshape(-1, 8)[:, : SUCCESSOR_BITS // 8]
                for s, part in Block.parts(x.bigram_shard, shards):
                    v = x.v[part]
                    first = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
                    rows.append((s, BIGRAMS, packed(context[v[first]]), packed(np.diff(np.r_[first, len(v)]).astype(np.uint32)), packed(successor[x.w[part]]), packed(both[part])))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int32()), pa.array([row["block"]] * len(rows), pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[2:])],
                    names=["shard", "block", "kind", "a", "b", "c", "n"],
                )

    return blocks.select("block", "training", "lengths", "tokens", "words").mapInArrow(run, _REQUEST)


_ANSWER = "block long, shard int, kind int, found binary, tokens long, words long"


def answers(asked: DataFrame, n_training: int) -> DataFrame:
    """Words: found counts (uint32). Bigrams: found codes (uint16) of c(vw) / n_training. Stats: training tokens and different words of the shard."""

    def solve(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        out = []
        counts: dict[bytes, int] = {}
        lists = [(r["block"], unpacked_words(r["a"]), unpacked(r["n"], "u4").tolist()) for r in rows if r["kind"] == WORDS]
        for _, words, n in lists:
            for w, c in zip(words, n, strict=True):
                counts[w] = counts.get(w, 0) + c
        shard = rows[0]["shard"]
        for block, words, _ in lists:
            out.append((block, shard, WORDS, packed(np.array([counts[w] for w in words], np.uint32)), 0, 0))
        out.append((-1, shard, STATS, None, sum(counts.values()), sum(c > 0 for c in counts.values())))
        asked_by, contexts, successors, seen = [], [], [], []
        for r in rows:
            if r["kind"] == BIGRAMS:
                context = np.repeat(unpacked(r["a"], "u8"), unpacked(r["b"], "u4"))
                wide = np.zeros((len(context), 8), np.uint8)
                wide[:, : SUCCESSOR_BITS // 8] = unpacked(r["c"], "u1").reshape(-1, SUCCESSOR_BITS // 8)
                asked_by.append((r["block"], len(context)))
                contexts.append(context)
                successors.append(wide.view("<u8").ravel())
                seen.append(unpacked(r["n"], "u4"))
        if asked_by:
            context, successor, n = np.concatenate(contexts), np.concatenate(successors), np.concatenate(seen)
            known = n > 0
            order = np.lexsort((successor[known], context[known]))
            v, w, c = context[known][order], successor[known][order], n[known][order].astype(np.int64)
            with tempfile.TemporaryDirectory() as folder:
                codes = np.full(len(context), 65535, np.uint16)
                if len(v):
                    first = np.flatnonzero(np.r_[True, (v[1:] != v[:-1]) | (w[1:] != w[:-1])])
                    NgramTrie.write(folder, v[first], w[first], np.add.reduceat(c, first) / n_training)
                    codes = NgramTrie(folder).lookup(context, successor)
            at = 0
            for block, size in asked_by:
                out.append((block, shard, BIGRAMS, packed(codes[at : at + size]), 0, 0))
                at += size
        cols = list(zip(*out, strict=True))
        types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["block", "shard", "kind", "found", "tokens", "words"])

    return asked.groupBy("shard").applyInArrow(solve, _ANSWER)


def score_texts(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", mu: float = MU, block_tokens: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Per row: id, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities)."""
    spark = documents.sparkSession
    blocks = saved(encoded(documents, id_col=id_col, text_col=text_col, block_tokens=block_tokens), "blocks")
    sums = blocks.agg(F.sum("n_tokens").alias("every"), F.sum("n_training").alias("learned")).first()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(sums.every or 0) // shard_tokens))
    frequent = blocks.select(F.explode("hot").alias("h")).groupBy("h").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "h").limit(HOT_WORDS)
    hot = np.array([r.h for r in frequent.collect()], np.int64).view(np.uint64)
    found = saved(answers(requests(blocks, shards, hot), max(1, sums.learned or 0)), "answers")
    stats = found.where(F.col("kind") == STATS).agg(F.sum("tokens").alias("n"), F.sum("words").alias("v")).first()
    n_all, n_words = stats.n or 0, stats.v or 0
    learned = max(1, sums.learned or 0)
    id_kind = dict(blocks.dtypes)["doc_ids"].removeprefix("array<").removesuffix(">")

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        x = Block(row, shards, hot)
        words, bigrams = {}, {}
        for r in right.to_pylist():
            (words if r["kind"] == WORDS else bigrams)[r["shard"]] = r["found"]
        count, joint = np.zeros(len(x.words)), np.zeros(len(x.v))
        for s, part in Block.parts(x.word_shard, shards):
            count[part] = unpacked(words[s], "u4")
        for s, part in Block.parts(x.bigram_shard, shards):
            joint[part] = restored(unpacked(bigrams[s], "u2")) * learned
        p = (count + 0.5) / (n_all + 0.5 * (n_words + 1))
        smooth = np.log10((joint + mu * p[x.w]) / (count[x.v] + mu))
        starts = np.cumsum(x.lengths) - x.lengths
        per_text = lambda values: np.add.reduceat(values, starts)
        columns = [per_text((count > 0)[x.tokens].astype(np.int64)), np.full(len(starts), n_all), per_text(np.log10(p)[x.tokens]), per_text(smooth[x.bigram])]
        ids = left.column("doc_ids").chunk(0).flatten()
        return pa.table([ids, pa.array(x.lengths), *(pa.array(c) for c in columns)], names=["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    asked = found.where(F.col("kind") != STATS).select("block", "shard", "kind", "found")
    return blocks.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(solve, f"id {id_kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_report(scored: DataFrame, id_name: str = "doc_id") -> DataFrame:
    held = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    return scored.select(F.col("id").alias(id_name), held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
