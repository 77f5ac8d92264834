"""Spans in normalised texts, by their starts."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence


def nearest(left: Sequence[int], left_size: int, right: Sequence[int], right_size: int) -> tuple[int, int, int] | None:
    """(gap, left start, right start) of the closest two spans; ties by the left, then the right start. None without a pair.

    left, right: starts in rising order of spans of one size each. The gap is the number of
    characters between two spans, zero where they touch or overlap. Only the neighbours of a
    span can be closest to it, so that the time is linear but for a binary search.
    """
    best = None
    for start in left:
        i = bisect_left(right, start - right_size)  # from here on, spans that touch or come after
        for other in right[max(0, i - 1) : i + 1]:
            found = max(0, other - start - left_size, start - other - right_size), start, other
            if best is None or found < best:
                best = found
    return best
