"""Secret scans by a recursive decoding worklist.

Three kinds of spans are searched in a text: assignments of long values to telling names,
access key ids, and long runs of hexadecimal digits. The text is the first layer of a worklist.
From each layer, new layers are unwrapped:

- the whole layer with its URL and Unicode escapes replaced; an escape whose result opens another
  escape is followed on the spot, so that repeated escaping costs its length, not its square;
- base64 runs, also over line ends and of all four phases;
- compressed streams (gzip, zlib, bzip2, xz) that begin anywhere in decoded bytes, also several
  of them and cut ones, in pieces of about PIECE bytes that overlap by OVERLAP;
- text of two bytes a character, without the zero bytes between.

All patterns are ASCII, so that bytes are read as Latin-1, one character a byte; nothing has to
be valid. Each layer knows for its characters the span of the original text that they came
from, as a function that asks the layer above, so that findings map to spans of the text and layers hold
no tables but for escapes. All that comes from one compressed stream has the span of the stream.
The worklist runs to its fixpoint; a layer whose content has been seen over the same span is not
entered again, which ends cycles.

A text whose streams unpack to more than MAX_UNPACKED bytes together (a bomb) is not unpacked further:
the stream at hand is a finding of the kind `opaque`, so that nothing is passed over silently.

Narrow: one pass over the documents, no shuffle. Spans are code points, end exclusive.

Defined results: a null text counts as empty. Repeated rows are scanned each. Other columns are
not read by `scan_secrets`, and kept by `redact`. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoweave.llm.common import fresh_name, id_and_text, sha256_text

KINDS = ("assign", "access", "hex", "opaque")
#: Bytes that the streams of one text unpack to at most, and that one layer of them holds.
MAX_UNPACKED = 1 << 30
PIECE = 8 << 20
OVERLAP = 1 << 16
#: Shorter base64 runs cannot hold any finding.
MIN_BASE64 = 16

_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_AFTER = {"%": r"([0-9A-Fa-f]{2})", "\\": r"(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2}))"}
_ESCAPE = re.compile("|".join(re.escape(sign) + rest for sign, rest in _AFTER.items()))
#: What must follow a decoded sign for it to open another escape.
_OPENED = {ord(sign): re.compile(rest) for sign, rest in _AFTER.items()}
_LOW_SURROGATE = re.compile(r"\\u([Dd][C-Fc-f][0-9A-Fa-f]{2})")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_BASE64)
#: Runs of which all lines but the last could be runs themselves.
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{%d,}+\r?\n[\x20\t]*)+[A-Za-z0-9+/_-]+={0,2}" % MIN_BASE64)
_MAGIC = re.compile(r"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]1AY|\xfd7zXZ\x00")
#: Bytes without any such run hold no finding and nothing to unwrap.
_TELLING = re.compile(rb"[A-Za-z0-9+/_.=-]{12,}|%[0-9A-Fa-f]{2}|\\[uUx][0-9A-Fa-f]{2}|\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]1AY|\xfd7zXZ\x00|(?:[\x20-\x7e]\x00){12}")

Span = tuple[int, int, int]  # start, number of the kind, end
Place = Callable[[int], int]


def plain_spans(text: str) -> list[Span]:
    """Leftmost, non-overlapping for each kind."""
    out: list[Span] = []
    lowered = text.lower()
    if any(name in lowered for name in _NAMES):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return out


@dataclass(frozen=True)
class Layer:
    """A text; lo, hi: where in the original text a character of it begins and ends."""

    text: str
    lo: Place
    hi: Place

    def key(self) -> tuple[bytes, int, int]:
        return hashlib.sha256(self.text.encode("utf-8", "surrogatepass")).digest(), self.lo(0), self.hi(len(self.text) - 1)


def _value(m: re.Match) -> int:
    return int(next(g for g in m.groups() if g), 16)


def _unescaped(layer: Layer) -> Layer | None:
    """The whole layer with its escapes replaced; None without any."""
    text, m = layer.text, _ESCAPE.search(layer.text)
    if m is None:
        return None
    parts, first, last, at = [], array("q"), array("q"), 0
    while m is not None:
        parts.append(text[at : m.start()])
        first.extend(range(at, m.start()))
        last.extend(range(at, m.start()))
        code, end = _value(m), m.end()
        while (rest := _OPENED.get(code)) and (more := rest.match(text, end)):
            code, end = _value(more), more.end()
        if 0xD800 <= code < 0xDC00 and (low := _LOW_SURROGATE.match(text, end)):
            code, end = 0x10000 + (code - 0xD800 << 10) + int(low[1], 16) - 0xDC00, low.end()
        parts.append(chr(0xFFFD if code > 0x10FFFF or 0xD800 <= code < 0xE000 else code))
        first.append(m.start())
        last.append(end - 1)
        at, m = end, _ESCAPE.search(text, end)
    rest = range(at, len(text))
    first.extend(rest)
    last.extend(rest)
    return Layer("".join(parts) + text[at:], lambda i: layer.lo(first[i]), lambda i: layer.hi(last[i]))


def _decoded(layer: Layer, at: Sequence[int], body: str, phase: int) -> Layer | None:
    """What a base64 run holds from its phase on; at: where its characters are in the layer. A last character that is no whole byte goes."""
    body = body[phase : len(body) - ((len(body) - phase) % 4 == 1)]
    raw = base64.b64decode(body + "=" * (-len(body) % 4), altchars=b"-_")
    if not _TELLING.search(raw):
        return None
    end = len(at) - 1
    return Layer(raw.decode("latin-1"), lambda i: layer.lo(at[phase + i * 4 // 3]), lambda i: layer.hi(at[min(end, phase + (i * 8 + 7) // 6)]))


def _base64_layers(layer: Layer) -> Iterator[Layer]:
    text = layer.text
    for m in _BASE64.finditer(text):
        body = m.group().rstrip("=")
        body = body.replace("+", "-").replace("/", "_")
        for phase in range(4):  # what comes before the encoded bytes may be of any length
            if (found := _decoded(layer, range(m.start(), m.start() + len(body)), body, phase)) is not None:
                yield found
    for m in _WRAPPED.finditer(text) if "\n" in text else ():
        at = array("q", (i for i in range(m.start(), m.end()) if text[i] not in "\r\n\t ="))
        body = "".join(m.group().split()).rstrip("=").replace("+", "-").replace("/", "_")
        for phase in range(4):
            if (found := _decoded(layer, at, body, phase)) is not None:
                yield found


class Stream:
    """A compressed stream: its pieces as they are unpacked, and how many bytes it took."""

    def __init__(self, raw: memoryview):
        self.raw, self.used = raw, 0

    def __iter__(self) -> Iterator[bytes]:
        raw, head = self.raw, bytes(self.raw[:2])
        unpack = zlib.decompressobj(31) if head == b"\x1f\x8b" else zlib.decompressobj() if head[:1] == b"\x78" else bz2.BZ2Decompressor() if head == b"BZ" else lzma.LZMADecompressor()
        rest: bytes | memoryview = b""
        while not unpack.eof:
            if not len(rest) and getattr(unpack, "needs_input", True):
                rest = raw[self.used : self.used + OVERLAP]
                if not len(rest):
                    return
                self.used += len(rest)
            try:
                out = unpack.decompress(rest, PIECE)
            except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError):
                return
            rest = getattr(unpack, "unconsumed_tail", b"")
            if out:
                yield out
        self.used -= len(unpack.unused_data)


def _unpacked_layers(layer: Layer, found: set[Span], budget: list[int]) -> Iterator[Layer]:
    if not (m := _MAGIC.search(layer.text)):
        return
    raw = memoryview(layer.text.encode("latin-1", "replace"))
    while m:
        stream = Stream(raw[m.start() :])
        lo, tail, size = layer.lo(m.start()), b"", 0
        parts: list[bytes] = []
        end = lambda: layer.hi(m.start() + max(1, stream.used) - 1)  # noqa: B023, E731

        def piece(text: bytes, until: int, lo: int = lo) -> Layer:
            return Layer(text.decode("latin-1"), lambda i: lo, lambda i: until)

        for part in stream:
            budget[0] -= len(part)
            if budget[0] < 0:
                found.add((lo, 3, layer.hi(len(layer.text) - 1)))
                return
            parts.append(part)
            size += len(part)
            if size >= PIECE:
                whole = tail + b"".join(parts)
                # More is to come, and how far the stream reaches is known at its end only.
                yield piece(whole, layer.hi(len(layer.text) - 1))
                tail, parts, size = whole[-OVERLAP:], [], 0
        if size:
            yield piece(tail + b"".join(parts), end())
        m = _MAGIC.search(layer.text, m.start() + (stream.used if stream.used and size else 1))


def _children(layer: Layer, found: set[Span], budget: list[int], first: bool) -> Iterator[Layer]:
    if (inner := _unescaped(layer)) is not None:
        yield inner
    yield from _base64_layers(layer)
    if first:
        return
    yield from _unpacked_layers(layer, found, budget)
    text = layer.text
    if text.count("\0") * 3 > len(text):
        kept = array("q", (i for i, c in enumerate(text) if c != "\0"))
        if kept:
            yield Layer(text.replace("\0", ""), lambda i: layer.lo(kept[i]), lambda i: layer.hi(kept[i]))


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """(spans of the text itself, those and the ones that layers add), sorted."""
    base = sorted(plain_spans(text))
    found = set(base)
    if text:
        seen: set[tuple[bytes, int, int]] = set()
        budget = [MAX_UNPACKED]
        # The worklist: layers that may still give others. Only one piece of a stream is held at a time.
        work = [_children(Layer(text, lambda i: i, lambda i: i + 1), found, budget, True)]
        while work:
            child = next(work[-1], None)
            if child is None:
                work.pop()
            elif child.text and (key := child.key()) not in seen:
                seen.add(key)
                found.update((child.lo(s), kind, child.hi(e - 1)) for s, kind, e in plain_spans(child.text))
                work.append(_children(child, found, budget, False))
    return base, sorted(found)


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan_secrets(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, base and spans (arrays of kind, start, end in order of start, then kind)."""
    docs = id_and_text(documents, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = lambda spans: [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans]
        for b in batches:
            base, spans = [], []
            for x in b.column("text"):
                raw = x.as_py()
                one, every = all_spans(raw.decode() if raw else "")
                base.append(named(one))
                spans.append(named(every))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(base, _SPANS), pa.array(spans, _SPANS)], names=["id", "base", "spans"])

    kind = "array<struct<kind:string,start:long,end:long>>"
    return docs.mapInArrow(run, f"id {dict(docs.dtypes)['id']}, base {kind}, spans {kind}")


def redacted_text(text: str) -> str:
    """The text with every span, overlapping ones merged, replaced by the kind of its first."""
    out, at, open_to, kind = [], 0, -1, ""
    for start, k, end in all_spans(text)[1]:
        if start >= open_to:
            if open_to >= 0:
                out.append(f"[redacted {kind}]")
                at = open_to
            out.append(text[at:start])
            open_to, kind = end, KINDS[k]
        else:
            open_to = max(open_to, end)
    if open_to >= 0:
        out.append(f"[redacted {kind}]")
        at = open_to
    return "".join(out) + text[at:]


def redact(documents: DataFrame, *, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """All columns, the text without its secrets. A null text stays null. length_col gets the length of changed texts."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: redacted_text(t) if t is not None else None)

    if not length_col:
        return documents.withColumn(text_col, clean(F.col(text_col)))
    new = fresh_name(documents, "redacted")
    length = F.when(F.col(new) != F.col(text_col), F.length(new)).otherwise(F.col(length_col)).cast(dict(documents.dtypes)[length_col])
    return documents.withColumn(new, clean(F.col(text_col))).withColumns({length_col: length, text_col: F.col(new)}).drop(new)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets_report(found: DataFrame, id_name: str = "doc_id") -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(F.col("id").alias(id_name), count("assign"), count("access"), count("hex"), sha256_text(_joined(F.col("base"))).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
