"""The wire format of protocol buffers: fields of a message, and packed lists of numbers as arrays.

Lists of many messages are read and written at once: as all their numbers, and where each list begins among them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

VARINT, WIDE, BYTES, NARROW = 0, 1, 2, 5


def varint(data: bytes, at: int) -> tuple[int, int]:
    """The unsigned number at a place, and the place after it."""
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7
        if shift > 63:
            raise ValueError("a number is longer than 64 bits")


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) in order: unsigned numbers, or bytes of what has a length or a fixed width."""
    at, end = 0, len(data)
    while at < end:
        # Most keys and sizes are one byte.
        key = data[at]
        at += 1
        if key > 0x7F:
            key, at = varint(data, at - 1)
        kind = key & 7
        if kind == VARINT:
            value, at = varint(data, at)
            yield key >> 3, value
            continue
        if kind == BYTES:
            size = data[at]
            at += 1
            if size > 0x7F:
                size, at = varint(data, at - 1)
        elif kind in (WIDE, NARROW):
            size = 8 if kind == WIDE else 4
        else:
            raise ValueError(f"wire type {kind}")
        if at + size > end:
            raise ValueError("a message ends early")
        yield key >> 3, data[at : at + size]
        at += size


def signed(value: int) -> int:
    """The number of a plain (not zigzag) signed field."""
    return value - (1 << 64) if value >> 63 else value


def unpacked(data: bytes) -> np.ndarray:
    """A packed list of varints, as unsigned 64-bit numbers."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    last = np.flatnonzero(raw < 0x80)
    if not len(last) or last[-1] != len(raw) - 1:
        raise ValueError("a packed list ends within a number")
    first = np.r_[0, last[:-1] + 1]
    sizes = last - first + 1
    if sizes.max() > 10:
        raise ValueError("a number is longer than 64 bits")
    place = np.arange(len(raw)) - np.repeat(first, sizes)
    return np.add.reduceat((raw & 0x7F).astype(np.uint64) << (7 * place).astype(np.uint64), first)


def zigzag(values: np.ndarray) -> np.ndarray:
    """Signed numbers of zigzag ones."""
    return (values >> np.uint64(1)).astype(np.int64) ^ -(values & np.uint64(1)).astype(np.int64)


def unpacked_lists(each: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of packed lists, one list after the other, and where each begins and the last ends (32 bits)."""
    data = b"".join(each)
    ends = np.cumsum([len(x) for x in each], dtype=np.int64)
    last = np.frombuffer(data, np.uint8) < 0x80
    full = ends[np.diff(ends, prepend=0) > 0]
    if not last[full - 1].all():
        raise ValueError("a packed list ends within a number")
    before = np.r_[0, np.cumsum(last, dtype=np.int32)]
    return unpacked(data), np.r_[0, before[ends]].astype(np.int32)


def running(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Lists of differences (zigzag numbers), as the numbers themselves."""
    total = np.r_[0, np.cumsum(zigzag(values))]
    return total[1:] - np.repeat(total[begins[:-1]], np.diff(begins))


def packed_lists(values: np.ndarray, begins: np.ndarray) -> list[bytes]:
    """What unpacked_lists reads."""
    values = values.astype(np.uint64)  # a negative number takes all 64 bits
    sizes = np.ones(len(values), np.int64)
    for k in range(1, 10):
        sizes += values >= np.uint64(1 << 7 * k)
    ends = np.r_[0, np.cumsum(sizes)]
    out = np.empty(ends[-1], np.uint8)
    for k in range(sizes.max(initial=0)):
        on = np.flatnonzero(sizes > k)
        part = (values[on] >> np.uint64(7 * k)).astype(np.uint8) & 0x7F
        out[ends[on] + k] = part | (sizes[on] > k + 1).astype(np.uint8) << 7
    data, cuts = out.tobytes(), ends[begins].tolist()
    return [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def steps(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """What running reads."""
    values = values.astype(np.int64)
    d = np.diff(values, prepend=0)
    first = begins[:-1][np.diff(begins) > 0]
    d[first] = values[first]
    return ((d << 1) ^ (d >> 63)).view(np.uint64)
