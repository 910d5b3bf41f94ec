"""Shared pieces of the operators that find spans in texts."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<kind:string,start:int,end:int>"
SPANS = f"array<{SPAN}>"


def joined(spans: str | Column) -> Column:
    """kind:start:end of each span, comma-joined, in the array's order."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


class SpanIndex:
    """Which of a text's spans lie at or near a place, by binary search."""

    def __init__(self, spans: Iterable[tuple[str, int, int]]):
        self.spans = set(spans)
        self.starts = sorted(s for _, s, _ in self.spans)
        self.ends = sorted(e for _, _, e in self.spans)

    def __contains__(self, span: tuple[str, int, int]) -> bool:
        return span in self.spans

    def free(self, start: int, end: int) -> bool:
        """Whether no span covers a place of [start, end)."""
        return bisect_left(self.starts, end) == bisect_right(self.ends, start)

    def near(self, start: int, end: int, gap: int) -> int:
        """Spans that begin at most ``gap`` after ``end`` and end at most ``gap`` before ``start``."""
        return bisect_right(self.starts, end + gap) - bisect_left(self.ends, start - gap)


def replace(text: str, spans: Sequence[tuple[str, int, int]], mark: str = "[{}]") -> str:
    """The text with each covered stretch replaced by its first span's mark."""
    out, at, last = [], 0, -1
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= last:
            out += [text[at:s], mark.format(kind)]
        last = max(last, e)
        at = last
    return "".join(out) + text[at:]
