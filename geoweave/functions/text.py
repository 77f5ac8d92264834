"""Search normalisation, sentence splits, and small text expressions.

Normalised text: NFKC, percent escapes decoded on request, case-folded, every run of characters
that are neither letters nor digits one space, trimmed. Null counts as empty.
"""

from __future__ import annotations

import re
import unicodedata
from urllib.parse import unquote

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_SEPARATORS = re.compile(r"[\W_]+")
#: Characters for which lower case with ß as ss, and the categories L and N, give the exact result.
PLAIN = "^[\\x00-\\x7F\\u00C0-\\u00D6\\u00D8-\\u00F6\\u00F8-\\u00FF\\u2010\\u2012-\\u2015\\u2018-\\u201F]*$"
EXCERPT_CHARS = 240
SENTENCE_BREAK = "(?<=[.!?])\\s+|\\n+"


#: Of Latin-1, all but what NFKC changes: lower case letters and digits stay themselves, other bytes are spaces. Sharp s is spelled out before.
_LATIN = bytes(ord(chr(b).lower()) if b in range(0x30, 0x3A) or chr(b).isalpha() and b not in (0xAA, 0xB5, 0xBA) else 0x20 for b in range(256))
_CHANGED = re.compile(b"[\xa8\xaa\xaf\xb2-\xb5\xb8-\xba\xbc-\xbe]")
#: Common signs beyond Latin-1 that are separators: dashes and quotation marks.
_SIGNS = re.compile("[\u2010\u2012-\u2015\u2018-\u201f]")


def _latin_bytes(value: str) -> bytes | None:
    """One byte a character if normalising changes no more than case, sharp s and separators; else None."""
    try:
        raw = (value if value.isascii() else _SIGNS.sub(" ", value)).encode("latin-1")
    except UnicodeEncodeError:
        return None
    return None if _CHANGED.search(raw) else raw


def exact_text(value: str | None, decode_url: bool = False) -> str:
    if not value:
        return ""
    if not decode_url or "%" not in value:
        raw = _latin_bytes(value)
        if raw is not None:
            return b" ".join(raw.replace(b"\xdf", b"ss").translate(_LATIN).split()).decode("latin-1")
    value = unicodedata.normalize("NFKC", value)
    return _SEPARATORS.sub(" ", (unquote(value) if decode_url else value).casefold()).strip()


@F.pandas_udf(StringType())
def _exact(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else exact_text(v))


@F.pandas_udf(StringType())
def _exact_decoded(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else exact_text(v, True))


def fast(value: Column) -> Column:
    """Built-in expressions only; exact for texts that match PLAIN."""
    return F.trim(F.regexp_replace(F.replace(F.lower(value), F.lit("ß"), F.lit("ss")), "[^\\p{L}\\p{N}]+", " "))


def normalized(value: Column, *, decode_url: bool = False, mode: str = "auto") -> Column:
    """mode: fast, exact, or auto, which sends only texts outside PLAIN (or with escapes to decode) to Python."""
    value = F.coalesce(value, F.lit(""))
    if mode == "fast" and not decode_url:
        return fast(value)
    exact = _exact_decoded if decode_url else _exact
    if mode == "exact":
        return exact(value)
    plain = value.rlike(PLAIN)
    if decode_url:
        plain = plain & ~F.contains(value, F.lit("%"))
    return F.coalesce(F.when(plain, fast(value)), exact(F.when(~plain, value)))


def has_marker(normal: Column, marker: Column) -> Column:
    """Whether a normalised text holds a normalised marker as whole words; an empty marker is in no text."""
    around = lambda x: F.concat(F.lit(" "), x, F.lit(" "))
    return (marker != "") & F.contains(around(normal), around(marker))


def excerpt(value: Column) -> Column:
    """At most EXCERPT_CHARS characters, the last an ellipsis where something is missing."""
    return F.when(F.length(value) <= EXCERPT_CHARS, value).otherwise(F.concat(F.substring(value, 1, EXCERPT_CHARS - 1), F.lit("…")))


def shortened(value: Column) -> Column:
    """Like excerpt, without spaces before the ellipsis."""
    return F.when(F.length(value) <= EXCERPT_CHARS, value).otherwise(F.concat(F.rtrim(F.substring(value, 1, EXCERPT_CHARS - 1)), F.lit("…")))


def sentences(text: Column) -> Column:
    """Sentences after terminal punctuation or line ends, trimmed, those without any letter or digit dropped."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), SENTENCE_BREAK), lambda s: F.regexp_replace(s, "^\\s+|\\s+$", ""))
    return F.filter(parts, lambda s: s.rlike("[\\p{L}\\p{N}]"))


def terminal_sentences(text: Column) -> Column:
    """Sentences that end with a run of terminal punctuation before a space or the end; a rest without one is kept."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), "([.!?]+)(?=\\s|$)", "$1\u001e")
    return F.filter(F.transform(F.split(marked, "\u001e"), lambda s: F.regexp_replace(s, "^\\s+|\\s+$", "")), lambda s: s != "")


def lossless_segments(text: Column) -> Column:
    """Segments that join to the text again: each ends with its punctuation and the space after it, or with line ends.

    A text that holds the mark used for splitting (U+001E) is one segment.
    """
    text = F.coalesce(text, F.lit(""))
    cut = F.filter(F.split(F.regexp_replace(text, "([.!?]+\\s+|\\n+)", "$1\u001e"), "\u001e"), lambda s: s != "")
    return F.when(F.contains(text, F.lit("\u001e")), F.array(text)).otherwise(cut)


class _Folds(dict):
    """Code point -> what it counts as, character by character: its folded letters and digits, a space for any other."""

    def __missing__(self, code: int) -> str:
        folded = unicodedata.normalize("NFKC", chr(code)).casefold()
        self[code] = out = "".join(c if c.isalnum() else " " for c in folded)
        return out


_FOLDS = _Folds()


class PlacedWords:
    """The words of a text whose characters are folded one by one, and where they are in the text itself.

    Words come from one translation of the text. Positions are only worked out when they are asked
    for: from the word bounds in the folded text, and the sizes of the characters that fold to several.
    """

    def __init__(self, text: str):
        self.text = text
        raw = _latin_bytes(text)
        self.wide = np.frombuffer(raw, np.uint8) == 0xDF if raw is not None and b"\xdf" in raw else None
        self.folded = raw.replace(b"\xdf", b"ss").translate(_LATIN).decode("latin-1") if raw is not None else text.translate(_FOLDS)
        self.latin = raw is not None
        self.words = self.folded.split()

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """For each word the index of its first character in the text, and that after its last."""
        letters = np.frombuffer(self.folded.encode("utf-32-le"), np.uint32) != 0x20
        edges = np.flatnonzero(np.diff(letters, prepend=False, append=False))
        first, last = edges[::2], edges[1::2]
        if len(self.folded) == len(self.text):
            return first, last
        sizes = 1 + self.wide if self.latin else np.array([len(_FOLDS[ord(c)]) for c in self.text])
        ends = np.cumsum(sizes)
        return np.searchsorted(ends, first, "right"), np.searchsorted(ends, last - 1, "right") + 1


_TERMINAL = re.compile(r"[.!?]+(?=\s|$)")


def sentence_bounds(text: str) -> list[tuple[int, int]]:
    """Bounds of terminal_sentences in the text, untrimmed."""
    cuts = [m.end() for m in _TERMINAL.finditer(text)] + [len(text)]
    return [(a, b) for a, b in zip([0, *cuts], cuts) if text[a:b].strip()]
