"""Key ranges a reader wants, as an index over sorted, disjoint intervals.

A split whose range meets none of them is dropped before any relation or task exists; a split that meets some reads only
those.  Lookups are two binary searches, however many intervals there are.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import Any


@dataclass(frozen=True)
class KeyRanges:
    """Inclusive ranges, sorted, none touching the next."""

    ranges: tuple[tuple[int, int], ...] = ()

    @classmethod
    def of(cls, ranges: Any) -> "KeyRanges":
        """From ``(lo, hi)`` pairs and single keys, or text such as ``"1:100,250,9000:9999"``."""
        if isinstance(ranges, KeyRanges):
            return ranges
        if isinstance(ranges, str):
            ranges = [part.split(":") for part in ranges.split(",") if part.strip()]
        pairs = []
        for r in ranges:
            ends = [r] if isinstance(r, (int, str)) else list(r)
            try:
                ends = [int(str(e).strip()) for e in ends]
            except ValueError:
                raise ValueError(f"'scan.key-ranges': {r!r} is not a range of integers") from None
            if len(ends) not in (1, 2) or ends[0] > ends[-1]:
                raise ValueError(f"'scan.key-ranges': {r!r} is not a range lo:hi with lo <= hi")
            pairs.append((ends[0], ends[-1]))
        return cls(tuple(_merged(pairs)))

    def __bool__(self) -> bool:
        return bool(self.ranges)

    def hits(self, lo: int, hi: int) -> list[tuple[int, int]]:
        """The parts of ``[lo, hi]`` that are wanted, in order."""
        first = bisect_left(self.ranges, lo, key=lambda r: r[1])
        last = bisect_right(self.ranges, hi, key=lambda r: r[0])
        return [(max(lo, a), min(hi, b)) for a, b in self.ranges[first:last]]

    def sql(self, key: str, lo: int | None = None, hi: int | None = None, literal: Callable[[int], str] = str) -> str:
        """The condition on a key's SQL text, inside ``[lo, hi]`` when given."""
        parts = self.ranges if lo is None else self.hits(lo, hi)
        if not parts:
            return "1 = 0"
        return "(" + " OR ".join(f"{key} = {literal(a)}" if a == b else f"{key} BETWEEN {literal(a)} AND {literal(b)}" for a, b in parts) + ")"


def _merged(pairs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(pairs):
        if out and lo <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out
