"""Encoding to sentence pieces with the byte span of each piece in the original text, and decoding.

A text is normalised first, by longest prefixes: at each place the compiled character map (a double
array of prefixes, read from the model file) gives the replacement of the longest prefix it knows,
and where it knows none, one character stays. Each byte of the normalised text keeps the place in
the original at which its prefix began, so that a piece's bytes lead back to the span it stands for:
from the place of its first byte to the place of the byte after its last. Spaces become the visible
space (U+2581), one is put in front, and runs are merged, as the model says.

Pieces are then merged pair by pair: of all neighbours whose joined string is a piece, that with
the highest score, and of equals the leftmost, until none is left. Characters that are no piece
become the pieces of their bytes (the last of which has the span, the others an empty one before it), or
the unknown piece. Where no piece of the vocabulary continues over a visible space, what stands between
such places merges by itself, and is kept in a bounded cache.

Scale: a narrow pass in Arrow batches; nothing is shuffled. The model is a broadcast (its file is
read by the driver, once); a task holds one batch, a cache of at most CACHE_WORDS words, and for a text
some ten times its bytes. Merging takes n log n steps for n characters without a space.

Defined results: a null or empty text has the begin and end ids alone, which decode to the empty
text. Bytes that are no UTF-8 count as U+FFFD each. Repeated rows are encoded each. Other columns are
not read, whatever their names. An empty table gives an empty result. Models other than BPE, and
models with a map for decoding, are a ValueError.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoweave.llm.common import id_and_text
from geoweave.sources.wire import fields, signed

SPACE = "▁"
_SPACE = SPACE.encode()
_BAD = "�".encode()
BPE = 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Words that the cache of a worker holds at most; it starts anew when full.
CACHE_WORDS = 300_000
#: Longer words are not kept in it.
CACHE_CHARS = 48
#: Rows of a batch that Python turns into results at a time.
_ROWS = 100


def character_at(data: bytes, at: int) -> tuple[bytes, int]:
    """One character in UTF-8 and the bytes it takes; a byte that begins none is U+FFFD."""
    lead = data[at]
    size = 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0
    one = data[at : at + size]
    if size > 1:
        try:
            one.decode()
        except UnicodeDecodeError:
            size = 0
    return (one, size) if size else (_BAD, 1)


class CharacterMap:
    """The compiled map: the size of the double array, its units, then replacements that end with a zero byte.

    A unit holds, from low to high bits: a label (8; with bit 31 if it is a value), a mark of a value below (bit 8), a wide
    offset (bit 9), and the offset (22 bits).
    """

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        if compiled and (size > len(compiled) - 4 or size % 4):
            raise ValueError("the character map is cut off")
        self.units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist() if size else []
        self.replacements = compiled[4 + size :]
        #: First bytes of the prefixes that the map knows.
        self.first = {c for c in range(256) if self.units and self._step(self._offset(self.units[0]), c) is not None}

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _step(self, base: int, byte: int) -> int | None:
        place = base ^ byte
        return place if place < len(self.units) and self.units[place] & 0x800000FF == byte else None

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest known prefix from a place, and the bytes that it replaces."""
        if not self.units or data[at] not in self.first:
            return None
        found, base = None, self._offset(self.units[0])
        for end in range(at, len(data)):
            place = self._step(base, data[end])
            if place is None:
                break
            unit = self.units[place]
            base = place ^ self._offset(unit)
            if unit & 0x100:
                found = self.units[base] & 0x7FFFFFFF, end + 1 - at
        if found is None:
            return None
        value, taken = found
        return self.replacements[value : self.replacements.index(b"\0", value)], taken


class Model:
    """What a model file says; its methods are those of the module's docstring."""

    def __init__(self, serialized: bytes):
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        trainer, normalizer, decoder = {}, {}, {}
        for number, value in fields(serialized):
            if number == 1:
                piece = dict(fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(float(np.frombuffer(piece.get(2, bytes(4)), "<f4")[0]))
                self.kinds.append(piece.get(3, NORMAL))
            elif number in (2, 3, 5):
                {2: trainer, 3: normalizer, 5: decoder}[number].update(fields(value))
        if trainer.get(3, 1) != BPE:
            raise ValueError("the model is no BPE")
        if decoder.get(2):
            raise ValueError("maps for decoding are not read")
        self.map = CharacterMap(normalizer.get(2, b""))
        self.dummy_prefix, self.merge_spaces, self.visible = (bool(normalizer.get(n, 1)) for n in (3, 4, 5))
        self.suffix = bool(trainer.get(24, 0))
        self.byte_fallback = bool(trainer.get(35, 0))
        self.unknown_text = trainer.get(44, " ⁇ ".encode()).decode()
        self.unknown = self.kinds.index(UNKNOWN)
        self.begin, self.end = (self._control(trainer, n, d) for n, d in ((41, 1), (42, 2)))
        merged = (NORMAL, USER, UNUSED)
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k in merged}
        self.others = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k not in merged}
        self.order = {p: -scores[i] for p, i in self.ids.items()}
        self.bytes = [self.others.get(f"<0x{c:02X}>", self.unknown) for c in range(256)]
        self.byte_of = {i: bytes([c]) for c, i in enumerate(self.bytes) if self.kinds[i] == BYTE}
        user = sorted((p for p, k in zip(self.pieces, self.kinds, strict=True) if k == USER), key=len, reverse=True)
        self.user = re.compile("|".join(map(re.escape, user))) if user else None
        apart = not self.suffix and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+") if apart else None
        self.shown = [b"" if k == CONTROL else self.byte_of.get(i) or p.replace(SPACE, " ").encode() for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True))]
        self.shown[self.unknown] = self.unknown_text.encode()
        self.silent = frozenset(i for i, own in enumerate(self.shown) if not own)
        self.plain = self.user is None and UNUSED not in self.kinds
        self.cache: dict[str, bytes] = {}
        self._prepare_core()

    def _control(self, trainer: dict, number: int, default: int) -> list[int]:
        found = signed(trainer.get(number, default))
        return [found] if 0 <= found < len(self.kinds) and self.kinds[found] == CONTROL else []

    # ------------------------------------------------------------ normalisation

    def normalize(self, text: bytes) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes, and for its end, the place in the original."""
        if not text:
            return "", np.zeros(1, np.int64)
        if not self.map.units and not self.merge_spaces and self.visible and not self.suffix and self.user is None:
            try:
                plain = text.decode()
            except UnicodeDecodeError:
                pass
            else:
                raw = np.frombuffer(text, np.uint8)
                places = np.repeat(np.arange(len(raw)), np.where(raw == 0x20, len(_SPACE), 1))
                front = SPACE if self.dummy_prefix else ""
                return front + plain.replace(" ", SPACE), np.concatenate([np.zeros(len(front.encode()), np.int64), places, [len(raw)]])
        return self._normalized(text)

    def _prefix(self, text: bytes, at: int) -> tuple[bytes, int]:
        if self.user is not None:
            own = self.user.match(text[at : at + 4096].decode(errors="replace"))
            if own:
                found = own.group().encode()
                return found, len(found)
        return self.map.longest(text, at) or character_at(text, at)

    def _normalized(self, text: bytes) -> tuple[str, np.ndarray]:
        space = _SPACE if self.visible else b" "
        out, places, at = bytearray(), [], 0
        if self.merge_spaces:
            while at < len(text):
                new, taken = self._prefix(text, at)
                if new != b" ":
                    break
                at += taken
        if at == len(text):
            return "", np.array([at])
        if self.dummy_prefix and not self.suffix:
            out += space
            places += [at] * len(space)
        after_space = self.merge_spaces
        while at < len(text):
            new, taken = self._prefix(text, at)
            if after_space:
                new = new.lstrip(b" ")
            if new:
                shown = new.replace(b" ", space)
                out += shown
                places += [at] * len(shown)
                after_space = new.endswith(b" ") and self.merge_spaces
            at += taken
        if self.merge_spaces:
            while out.endswith(space):
                del out[-len(space) :]
                at = places[len(out)]
                del places[len(out) :]
        if self.dummy_prefix and self.suffix:
            out += space
            places += [at] * len(space)
        return out.decode(errors="replace"), np.array([*places, at], np.int64)

    # ------------------------------------------------------------ merging

    def _symbols(self, word: str) -> list[tuple[str, bool]]:
        """Characters, and user-defined pieces, which stay as they are."""
        if self.user is None:
            return [(c, False) for c in word]
        out, at = [], 0
        for m in self.user.finditer(word):
            out += [(c, False) for c in word[at : m.start()]]
            out.append((m.group(), True))
            at = m.end()
        return out + [(c, False) for c in word[at:]]

    def merged(self, word: str) -> list[str]:
        """The strings that are left when no pair can be merged."""
        return self._merged_short(word) if self.plain and len(word) <= CACHE_CHARS else self._merged(word)

    def _merged_short(self, word: str) -> list[str]:
        """By looking all pairs through for each merge, which is quickest for a few characters."""
        parts, rank, none = list(word), self.order.get, float("inf")
        ranks = [rank(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            i = ranks.index(least)
            both = parts[i] + parts[i + 1]
            parts[i : i + 2] = (both,)
            del ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] + both, none)
            if i < len(ranks):
                ranks[i] = rank(both + parts[i + 1], none)
        return parts

    def _merged(self, word: str) -> list[str]:
        """By a queue of pairs."""
        marked = self._symbols(word)
        parts: list[str | None] = [s for s, _ in marked]
        fixed = [f for _, f in marked]
        before, after = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        order, halves, agenda = self.order, {}, []

        def offer(left: int, right: int) -> None:
            if left < 0 or right >= len(parts) or fixed[left] or fixed[right]:
                return
            both = parts[left] + parts[right]
            rank = order.get(both)
            if rank is not None:
                heapq.heappush(agenda, (rank, left, right, both))
                if self.kinds[self.ids[both]] == UNUSED:
                    halves[both] = parts[left], parts[right]

        for i in range(1, len(parts)):
            offer(i - 1, i)
        while agenda:
            _, left, right, both = heapq.heappop(agenda)
            if parts[left] is None or parts[right] is None or len(parts[left]) + len(parts[right]) != len(both):
                continue
            parts[left], parts[right] = both, None
            after[left] = after[right]
            if after[left] < len(parts):
                before[after[left]] = left
            offer(before[left], left)
            offer(left, after[left])
        found = [p for p in parts if p is not None]
        while halves and any(p in halves for p in found):
            found = [q for p in found for q in halves.get(p, (p,))]
        return found

    def _prepare_core(self) -> None:
        """A merger of pieces of single bytes, for words that have a byte for each character (U+0000 to U+00FF, the visible space as a space).

        It takes the pair of the lowest rank first, as merging here does where no two scores are equal; words with
        pieces that share their score are left out.
        """
        self.core = None
        if not self.plain:
            return
        import tiktoken

        merged = {p: score for p, score in self.order.items() if len(p) > 1}
        times = Counter(merged.values())
        tied = [re.escape(p) for p, score in merged.items() if times[score] > 1]
        self.tied = re.compile("|".join([" ", *tied]))

        ranks: dict[bytes, int] = {}
        self.packed: list[bytes] = []
        narrow = {p: p.replace(SPACE, " ") for p in sorted(self.order, key=self.order.__getitem__) if " " not in p}
        singles = {c: SPACE if c == " " else c for c in map(chr, range(256))}
        for piece, shown in [*narrow.items(), *((own, c) for c, own in singles.items() if own not in self.order)]:
            try:
                ranks[shown.encode("latin-1")] = len(ranks)
            except UnicodeEncodeError:
                continue
            self.packed.append(self._numbers([piece]))
        self.core = tiktoken.Encoding("pieces", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def _word(self, word: str) -> bytes:
        """Ids, and the normalised bytes of each, in turn, as 32-bit numbers; of a character by its bytes, the last has them all."""
        if self.core is not None and not self.tied.search(word):
            try:
                found = self.core(word.replace(SPACE, " ").encode("latin-1"))
            except UnicodeEncodeError:
                found = []
            # The merger returns what is a piece without merging, which may not lead there.
            if len(found) > 1:
                packed = self.packed
                return b"".join([packed[r] for r in found])
        return self._numbers(self.merged(word))

    def _numbers(self, pieces: list[str]) -> bytes:
        out: list[int] = []
        for piece in pieces:
            found = self.others.get(piece) or self.ids.get(piece, self.unknown)
            size = len(piece) if piece.isascii() else len(piece.encode())
            if found == self.unknown and self.byte_fallback:
                for c in piece.encode():
                    out += (self.bytes[c], 0)
                out[-1] = size
            else:
                out += (found, size)
        return np.array(out, "<u4").tobytes()

    def _cached(self, word: str) -> bytes:
        found = self._word(word)
        if len(word) <= CACHE_CHARS:
            self.cache[word] = found
        return found

    def encode(self, text: bytes | None, mark: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the first and the end byte of each in the original. mark: with the begin and end ids."""
        normal, places = self.normalize(text or b"")
        if self.words is None:
            found = self._word(normal)
        else:
            if len(self.cache) > CACHE_WORDS:
                self.cache.clear()
            known, new = self.cache.get, self._cached
            found = b"".join([known(w) or new(w) for w in self.words.findall(normal)])
        ids, sizes = np.frombuffer(found, "<u4").astype(np.int64).reshape(-1, 2).T
        after = np.cumsum(sizes)
        starts, ends = places[after - sizes], places[after]
        if not self.byte_fallback:
            # Unknown pieces that follow each other are one.
            goes = np.r_[False, (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)][: len(ids)]
            last = np.r_[~goes[1:], True][: len(ids)]
            ids, starts, ends = ids[~goes], starts[~goes], ends[last]
        if mark:
            n = len(text or b"")
            front, back = len(self.begin), len(self.end)
            ids = np.concatenate([np.array(self.begin, np.int64), ids, np.array(self.end, np.int64)])
            starts, ends = (np.concatenate([np.zeros(front, np.int64), x, np.full(back, n)]) for x in (starts, ends))
        return ids, starts, ends

    # ------------------------------------------------------------ decoding

    def decode(self, ids: list[int]) -> str:
        shown, kinds = self.shown, self.kinds
        out, at, begins = [], 0, True
        while begins and at < len(ids):
            i = ids[at]
            own = shown[i]
            seen = kinds[i] not in (CONTROL, BYTE, UNKNOWN) and (self.dummy_prefix or self.merge_spaces) and self.pieces[i].startswith(SPACE)
            if seen:
                own = own[1:]
            out.append(own)
            at += 1
            begins = not own and not (seen and not self.merge_spaces)
        out += [shown[i] for i in ids[at:]]
        if not self.silent.isdisjoint(ids[1:-1]):
            # Bytes on both sides of a piece without text are no character together.
            runs = [list(run) for bare, run in groupby(out, key=bool) if bare]
            return "".join(_repaired(b"".join(run)) for run in runs)
        return _repaired(b"".join(out))


def _repaired(raw: bytes) -> str:
    """UTF-8, with U+FFFD for each byte that is none."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            one, taken = character_at(raw, at)
            out.append(one)
            at += taken
        return b"".join(out).decode()


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


_models: dict[int, Model] = {}


def _model(serialized: bytes) -> Model:
    """One a worker, so that its cache of words outlives a task."""
    key = hash(serialized)
    if key not in _models:
        _models.clear()
        _models[key] = Model(serialized)
    return _models[key]


def encode(documents: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text", mark: bool = True) -> DataFrame:
    """Per row: id, n_bytes (of the text), tokens (ids as little-endian unsigned 32-bit integers), starts and ends (the
    byte span of each token in the text, as little-endian signed 64-bit integers).

    `token_spans` has them as rows.
    """
    docs = id_and_text(documents, id_col, text_col)
    serialized = read_model(model_path)
    Model(serialized)  # errors belong to the caller
    shared = docs.sparkSession.sparkContext.broadcast(serialized)
    names = ["id", "n_bytes", "tokens", "starts", "ends"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared.value)
        for b in batches:
            for at in range(0, b.num_rows, _ROWS):
                part = b.slice(at, _ROWS)
                rows = []
                for x in part.column("text"):
                    text = x.as_py() or b""
                    ids, starts, ends = model.encode(text, mark)
                    rows.append((len(text), ids.astype("<u4").tobytes(), starts.astype("<i8").tobytes(), ends.astype("<i8").tobytes()))
                n_bytes, *packed = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n_bytes, pa.int64()), *(pa.array(p, pa.binary()) for p in packed)], names=names)

    return docs.mapInArrow(run, f"id {dict(docs.dtypes)['id']}, n_bytes long, tokens binary, starts binary, ends binary")


def decoded(spark, model_path: str, tokens: Column) -> Column:
    """The text of a column of tokens, as `encode` gives them; null for null."""
    serialized = read_model(model_path)
    shared = spark.sparkContext.broadcast(serialized)

    @F.pandas_udf("string")
    def texts(found: pd.Series) -> pd.Series:
        model = _model(shared.value)
        return found.map(lambda t: None if t is None else model.decode(np.frombuffer(t, "<u4").tolist()))

    return texts(tokens)


def token_spans(encoded: DataFrame, model_path: str) -> DataFrame:
    """One row a token: id, position, token, piece, start_byte, end_byte."""
    serialized = read_model(model_path)
    shared = encoded.sparkSession.sparkContext.broadcast(serialized)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(_model(shared.value).pieces)
        for b in batches:
            for i in range(b.num_rows):
                ids, starts, ends = (np.frombuffer(b.column(c)[i].as_py(), t) for c, t in (("tokens", "<u4"), ("starts", "<i8"), ("ends", "<i8")))
                key = b.column("id").take(pa.array(np.full(len(ids), i)))
                yield pa.RecordBatch.from_arrays([key, pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids.astype(np.int32)), pieces.take(pa.array(ids.astype(np.int64))), pa.array(starts), pa.array(ends)], names=["id", "position", "token", "piece", "start_byte", "end_byte"])

    found = encoded.select("id", "tokens", "starts", "ends")
    return found.mapInArrow(run, f"id {dict(found.dtypes)['id']}, position int, token int, piece string, start_byte long, end_byte long")


def piece_report(encoded: DataFrame, model_path: str, id_name: str = "doc_id") -> DataFrame:
    text = decoded(encoded.sparkSession, model_path, F.col("tokens"))
    return encoded.select(F.col("id").alias(id_name), (F.length("tokens") / 4).cast("long").alias("n_tokens"), F.sha2("tokens", 256).alias("ids_sha256"), F.sha2(text.cast("binary"), 256).alias("decoded_sha256"), "n_bytes", F.sha2("ends", 256).alias("ends_sha256"))
