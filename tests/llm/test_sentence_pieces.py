"""Sentence pieces against the library that defines them: ids, spans, decoded texts, normalisation."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from public_tokenizers import path

from geoweave.llm import sentence_pieces as sp
from geoweave.sources.wire import fields

MODEL = path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def model():
    return sp.Model(sp.read_model(MODEL))


ODD = ["", " ", "  a  b ", "a", "\n", "\t a\r\n", "ﬁ Ǻ \xbd 　x", "日本\U0001f600\0\xe9", "<s> </s> <unk> <0x41>", "a ⁇ b", "​\xad|▁x ▁", "▁", "▁▁ a", "x" * 3000, "word " * 2000, "é̂" * 50, "   " * 40 + "end"]


def random_texts(n, seed=3):
    rng = random.Random(seed)
    signs = ["a", "b", "the", " ", "  ", "\n", "\xe9", "中", "\U0001f680", "▁", "1", "ing", "-", "\0", "ل", "Z", "<s>", " "]
    return ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(n)]


def spans_of(library, text):
    return [(p.id, p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]


def test_ids_spans_and_decoding_equal_the_library(library, model):
    for text in ODD + random_texts(1500):
        ids, starts, ends = (x.tolist() for x in model.encode(text.encode()))
        want = library.encode(text, add_bos=True, add_eos=True)
        assert ids == want, text
        assert model.decode(ids) == library.decode(want), text
        assert list(zip(ids[1:-1], starts[1:-1], ends[1:-1])) == spans_of(library, text), text


def test_both_ways_of_merging_are_equal(model):
    for text in random_texts(500, seed=8):
        for word in model.words.findall(model.normalize(text.encode())[0]):
            assert model._merged(word) == model._merged_short(word), word
            assert model._word(word) == model._numbers(model._merged(word)), word


def test_every_piece_of_the_model_equals_the_library(library, model):
    """Also those that merging does not lead to."""
    texts = [p.replace(sp.SPACE, " ") for p in model.pieces]
    for text, want in zip(texts, library.encode(texts)):
        assert model.encode(text.encode(), mark=False)[0].tolist() == want, text


def test_unknown_pieces_without_bytes_are_joined(library):
    made = sp.Model(sp.read_model(MODEL))
    made.byte_fallback = False
    ids, starts, ends = made.encode("a \U00013000\U00013000 \U00013001b".encode(), mark=False)
    assert [(made.pieces[i], a, b) for i, a, b in zip(ids, starts, ends)] == [("▁a", 0, 1), ("▁", 1, 2), ("<unk>", 2, 10), ("▁", 10, 11), ("<unk>", 11, 15), ("b", 15, 16)]


def test_decoding_of_any_ids_equals_the_library(library, model):
    rng = random.Random(4)
    for _ in range(2000):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(259, 32000), 29871]) for _ in range(rng.randint(0, 12))]
        assert model.decode(ids) == library.decode(ids), ids


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("merge", [True, False])
def test_longest_prefixes_of_a_compiled_map_equal_the_library(model, rule, prefix, merge):
    own = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, escape_whitespaces=True, remove_extra_whitespaces=merge)
    spec = {}
    for number, value in fields(own.serialized_model_proto()):
        if number == 3:
            spec.update(fields(value))
    made = sp.Model(sp.read_model(MODEL))
    made.map, made.dummy_prefix, made.merge_spaces = sp.CharacterMap(spec.get(2, b"")), prefix, merge
    for text in ODD + random_texts(200) + ["① ㏁ ＡＢ ẞİ   ‍", "가가 é", " 　 lead", "trail 　 "]:
        normal, places = made.normalize(text.encode())
        want, offsets = own.normalize(text, with_offsets=True)
        assert normal == want, (rule, text)
        each = np.r_[0, np.cumsum([len(c.encode()) for c in normal])].astype(int)
        at = np.r_[0, np.cumsum([len(c.encode()) for c in text])].astype(int)
        if normal:
            assert places[each].tolist() == [int(at[o]) for o in offsets], (rule, text)


def test_bytes_that_are_no_text_count_as_replacements(model):
    ids, starts, ends = model.encode(b"a\xff\xc3b")
    assert model.decode(ids.tolist()) == "a��b"
    assert ends[-2] == 4 and starts[1] == 0


def test_whole_table_equals_the_library(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in sp.piece_report(sp.encode(docs, MODEL), MODEL).collect()}
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        assert got[r.doc_id] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())


def test_edges(spark, library):
    long = "lorem ipsum \xe9 " * 40000
    rows = [(1, None, "x"), (1, "", "x"), (None, "a b", "y"), (2, long, "z"), (2, long, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tokens string").selectExpr("*", "1 AS id", "'t' AS starts")
    encoded = sp.encode(docs, MODEL)
    got = [(r.doc_id, r.n_tokens, r.n_bytes) for r in sp.piece_report(encoded, MODEL).collect()]
    n = len(library.encode(long)) + 2
    assert sorted(got, key=str) == sorted([(1, 2, 0), (1, 2, 0), (None, 4, 3), (2, n, len(long.encode())), (2, n, len(long.encode()))], key=str)
    spans = sp.token_spans(encoded.where("id IS NULL"), MODEL).orderBy("position").collect()
    assert [(r.piece, r.start_byte, r.end_byte) for r in spans] == [("<s>", 0, 0), ("▁a", 0, 1), ("▁b", 1, 3), ("</s>", 3, 3)]
    assert sp.piece_report(sp.encode(docs.limit(0), MODEL), MODEL).count() == 0
    with pytest.raises(ValueError):
        sp.CharacterMap(b"\xff\0\0\0abc")
