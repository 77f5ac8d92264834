"""Secret scans: base spans against the stated patterns, layers against planted encodings."""

import base64
import bz2
import gzip
import hashlib
import lzma
import re
import time
import tracemalloc
import zlib
from urllib.parse import quote

import pytest

from geoweave.llm import secrets

SECRET = "password = Zk39dkfLLw02mmQ"
ORDER = {"assign": 0, "access": 1, "hex": 2}


def brute_base(text):
    out = []
    words = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    for m in re.finditer(rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            out.append((m.start(), "assign", m.end()))
    out += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out, key=lambda s: (s[0], ORDER[s[1]]))


def test_base_spans_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in secrets.secrets_report(secrets.scan_secrets(docs)).collect():
        want = brute_base(texts[r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for s, k, e in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for _, k, _ in want) for kind in ORDER)
        assert set(joined.split(",")) <= set(r.spans.split(","))


@pytest.mark.parametrize("text", ["secret: password: longvalue123456", "TOKEN='abc' token=abcdefghijkl", "paſword=abcdefghijkl", "AKIAAKIA" + "A" * 9, "api_key=" + "a" * 12 + " apiKEY:" + "b" * 12, "f" * 16 + "g" + "0" * 15])
def test_base_rules(text):
    assert [(s, secrets.KINDS[k], e) for s, k, e in secrets.all_spans(text)[0]] == brute_base(text)


def packed(data):
    return base64.b64encode(data).decode()


@pytest.mark.parametrize(
    "fragment",
    [
        quote(SECRET, safe=""),
        quote(quote(SECRET, safe=""), safe=""),
        "".join(f"\\u{ord(c):04x}" for c in SECRET),
        packed(SECRET.encode()),
        packed(packed(SECRET.encode()).encode()),
        packed(gzip.compress(SECRET.encode())),
        packed(zlib.compress(packed(SECRET.encode()).encode())),
        quote(packed(SECRET.encode()), safe="").replace("=", "%3D"),
        packed("".join(f"\\u{ord(c):04x}" for c in quote(SECRET)).encode()),
    ],
)
def test_layers_map_to_the_fragment(fragment):
    text = f"é lead {fragment} tail"
    base, spans = secrets.all_spans(text)
    start, end = text.index(fragment), text.index(fragment) + len(fragment)
    added = [s for s in spans if s not in base and s[1] == 0]
    assert added and all(start <= s < e <= end for s, _, e in added)
    assert SECRET[11:] not in secrets.redacted_text(text) and secrets.redacted_text(text).startswith("é lead")


def test_base64_span_is_narrow():
    inner = "x" * 30 + " " + SECRET + " " + "y" * 30
    text = packed(inner.encode())
    spans = [s for s in secrets.all_spans(text)[1] if s[1] == 0]
    a, b = inner.index(SECRET) * 4 // 3, -(-(inner.index(SECRET) + len(SECRET)) * 4 // 3)
    assert spans == [(a, 0, b)]


def test_bombs_are_opaque_and_cycles_end(monkeypatch):
    monkeypatch.setattr(secrets, "MAX_UNPACKED", 1000)
    for bomb in (packed(gzip.compress(b"0" * 100_000)), packed(gzip.compress(b"small") + gzip.compress(b"0" * 100_000))):
        assert any(kind == 3 and end == len(bomb.rstrip("=")) for _, kind, end in secrets.all_spans(bomb)[1])
    assert secrets.all_spans("%25" * 500 + " %41%" * 50)[0] == []


def test_large_layers_are_scanned_in_pieces():
    noise = b"lorem ipsum " * (4 << 20 >> 2)
    for at in (0, 1, 2):
        parts = [noise, noise, noise]
        parts[at] = parts[at] + b" " + SECRET.encode() + b" "
        text = "see " + packed(gzip.compress(b"".join(parts)))
        tracemalloc.start()
        spans = secrets.all_spans(text)[1]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert {s for s, k, _ in spans if k == 0} == {4} and peak < 300 << 20


def test_deep_escapes_cost_their_length():
    began = time.perf_counter()
    for escape in ("%" + "25" * 500_000 + "41", "\\" + "u005c" * 200_000 + "u0041", "%5C" + "u00255C" * 150_000 + "u0041"):
        text = f"password = abcdefghijkl{escape}mnop"
        assert (0, 0, len(text)) in secrets.all_spans(text)[1]
    assert time.perf_counter() - began < 20


@pytest.mark.parametrize(
    "fragment",
    [
        "password = " + "".join(f"%{ord(c):02x}" for c in SECRET[11:]),
        'password = "' + "".join(f"\\u{ord(c):04x}" for c in SECRET[11:]) + '"',
        "".join(f"%{ord(c):02x}" for c in "password") + " = " + SECRET[11:],
        quote(gzip.compress(SECRET.encode()), safe=""),
        "".join(f"\\x{c:02x}" for c in bz2.compress(SECRET.encode())),
        packed(SECRET.encode("utf-16-le")),
        packed(b"not packed \x00\xff" + gzip.compress(SECRET.encode()) + b" tail"),
        packed(gzip.compress(f"{'ab ' * 500}{SECRET}".encode()) [:-8]),
        "%25" * 3 + "70assword = Zk39dkfLLw02mmQ",
    ],
)
def test_whole_layers(fragment):
    text = f"lead {fragment} tail"
    found = [s for s in secrets.all_spans(text)[1] if s[1] == 0]
    assert found and all(5 <= s < e <= 5 + len(fragment) for s, _, e in found)
    assert SECRET[11:] not in secrets.redacted_text(text)


def test_edges(spark):
    df = spark.createDataFrame([(1, None), (None, "token=abcdefghijkl"), (1, ""), (1, "")], "doc_id long, text string").selectExpr("*", "1 AS spans", "2 AS id")
    got = secrets.secrets_report(secrets.scan_secrets(df)).collect()
    assert sorted(r.spans for r in got) == ["", "", "", "assign:0:18"]
    clean = {r.text for r in secrets.redact(df).collect()}
    assert clean == {None, "", "[redacted assign]"}
    assert secrets.scan_secrets(df.limit(0)).collect() == []


@pytest.mark.parametrize("text", [r'{"password": "\u005ak39dkfLLw02mmQ"}', "password = %5Ak39dkfLLw02mmQ", "a\ntoken: ab%2Bcdefghijklmn b", "secret = abcdefghijkl%2Bmnopqr", r"secret = %61bcdefghijk\x2bmnopqr"])
def test_plain_names_of_escaped_values(text):
    start = min(text.index(n) for n in ("password", "token", "secret") if n in text)
    end = start + len(text[start:].rstrip('b"} ').rstrip())
    assert (start, 0, end) in secrets.all_spans(text)[1]
    assert secrets.redacted_text(text) == text[:start] + "[redacted assign]" + text[end:]


NOISE = " ".join(hashlib.sha256(bytes([i])).hexdigest()[:15] for i in range(40))


def wrapped(blob, width):
    return "\n".join(blob[i : i + width] for i in range(0, len(blob), width))


@pytest.mark.parametrize(
    "fragment",
    [
        *(f"https://h.example/{'cbde'[:n]}/{packed(SECRET.encode())}" for n in range(1, 5)),
        *(f"https://h.example/{'cbde'[:n]}_{packed(gzip.compress(SECRET.encode()))}" for n in range(1, 5)),
        packed(SECRET.encode()).rstrip("=") + "/",
        wrapped(packed(gzip.compress(f"{NOISE} {SECRET} {NOISE}".encode())), 76),
        wrapped(packed(b"x" * 40 + b" " + SECRET.encode() + b" yy"), 64),
        *(packed(pack(b"first") + pack(b"second") + pack(SECRET.encode())) for pack in (gzip.compress, bz2.compress, lzma.compress)),
        packed(b"\xe9t\xe9 " + SECRET.encode()),
        packed(b"\x00\x01\x02\x03\x04\x05 " + SECRET.encode()),
    ],
)
def test_whole_base64(fragment):
    text = f"lead {fragment} tail"
    found = [s for s in secrets.all_spans(text)[1] if s[1] == 0]
    assert found and all(5 <= s < e <= 5 + len(fragment) for s, _, e in found)
