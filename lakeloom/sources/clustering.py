"""Rewriting a table along a space-filling curve, so that files narrow on several columns at once."""

from __future__ import annotations

import heapq
from bisect import bisect_left, bisect_right
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import committed_row_count

#: Bits of a column's rank, and of all together; rows whose values set the borders of ranks.
BITS, MOST_BITS, SAMPLE = 8, 60, 20_000


def sampled(df: DataFrame, columns: Sequence[str], sample: int = SAMPLE, seed: int = 1) -> list[tuple]:
    """The columns of about ``sample`` rows, dealt over the whole table."""
    rows = df.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(columns)])
    return [tuple(r) for r in rows.sample(min(1.0, sample / max(1, rows.count())), seed).collect()]


def rank_borders(rows: Sequence[tuple], ranges: int) -> list[list]:
    """For each column at most ``ranges - 1`` rising values that cut the rows into ranges of about equal size.

    A value that many rows share is one border.
    """
    out = []
    for column in zip(*rows):
        values = sorted(v for v in column if v is not None and v == v)
        out.append(sorted({values[len(values) * i // ranges] for i in range(1, ranges)}) if values else [])
    return out


def rank_of(value: object, borders: Sequence) -> int:
    """How many borders are at or below the value; 0 for null, all for NaN."""
    return 0 if value is None else len(borders) if value != value else bisect_right(borders, value)


def range_rank(column: str, borders: Sequence, values: Sequence[int] | None = None) -> Column:
    """``rank_of`` as a column, by halving. With ``values`` the one of that rank."""
    c = F.col(f"`{column}`")
    values = range(len(borders) + 1) if values is None else values

    def at(low: int, high: int) -> Column:
        if low == high:
            return F.lit(values[low]).cast("long")
        mid = (low + high) // 2
        return F.when(c < F.lit(borders[mid]), at(low, mid)).otherwise(at(mid + 1, high))

    return F.when(c.isNull(), values[0]).otherwise(at(0, len(borders)))


def spread(rank: int, bits: int, columns: int, at: int) -> int:
    """A rank's bits at the places of column ``at`` on the curve, which takes the columns' bits in turn, highest first."""
    return sum((rank >> b & 1) << (b * columns + columns - 1 - at) for b in range(bits))


def curve_place(columns: Sequence[str], borders: Sequence[list], bits: int) -> Column:
    """A row's place on the curve over the columns: rows near on it are near in every column."""
    place = F.lit(0).cast("long")
    for k, (c, own) in enumerate(zip(columns, borders)):
        place = place.bitwiseOR(range_rank(c, own, [spread(r, bits, len(columns), k) for r in range(len(own) + 1)]))
    return place


def boxes(places: Sequence[int], bits: int, files: int) -> list[tuple[int, int]]:
    """The curve cut into at most ``files`` files: rows (first place, files), in order.

    The fullest stretch is halved until there are enough, so every stretch is
    a box in the ranks. One place that holds more than its share gets several
    files.
    """
    places = sorted(places)
    count = lambda low, high: bisect_left(places, high) - bisect_left(places, low)
    heap = [(-len(places), 0, 1 << bits, 1)]
    for _ in range(files - 1):
        share, low, high, n = heapq.heappop(heap)
        if high - low == 1:
            heapq.heappush(heap, (share * n / (n + 1), low, high, n + 1))
            continue
        mid = (low + high) // 2
        heapq.heappush(heap, (-count(low, mid), low, mid, 1))
        heapq.heappush(heap, (-count(mid, high), mid, high, 1))
    return sorted((low, n) for _, low, _, n in heap)


def rewrite_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int) -> int:
    """The same rows in at most ``files`` files, each a box of the columns' values.

    Each column's values are ranked by the ranges they fall in, and the ranks'
    bits are interleaved, so that a filter on any one of the columns meets few
    files; one column alone gives plain ranges. Ranges and boxes come from one
    sample of about ``SAMPLE`` rows, which decides where rows lie and no more.
    Rows of a box that one file
    cannot hold are dealt over several by a hash. Within a file rows are
    sorted by the curve, then by the columns. Returns the rows written.
    """
    if not columns:
        raise ValueError("name at least one column")
    names = [f"`{c}`" for c in columns]
    plain = [f"`{f.name}`" for f in df.schema if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    write = lambda d: d.write.mode("overwrite").parquet(path)
    if len(columns) == 1:
        ranged = df.withColumn("_tie", F.xxhash64(*plain)).repartitionByRange(files, *names, "_tie").sortWithinPartitions(*names)
        return committed_row_count(ranged.drop("_tie"), write)
    each = min(BITS, MOST_BITS // len(columns))
    found = sampled(df, columns)
    borders = rank_borders(found, 1 << each) or [[]] * len(columns)
    places = [sum(spread(rank_of(v, own), each, len(columns), k) for k, (v, own) in enumerate(zip(r, borders))) for r in found]
    place, cut = curve_place(columns, borders, each), boxes(places, each * len(columns), files)
    starts, first = [low for low, _ in cut], [sum(n for _, n in cut[:k]) for k in range(len(cut))]
    rows = df.withColumn("_place", place)
    box = range_rank("_place", starts[1:]).cast("int") + 1
    at, n = (F.element_at(F.array(*map(F.lit, x)), box) for x in (first, [n for _, n in cut]))
    rows = rows.withColumn("_file", (at + F.pmod(F.xxhash64(*plain), n)).cast("int"))
    rows = rows.repartitionById(files, "_file").sortWithinPartitions("_place", *names)
    return committed_row_count(rows.drop("_place", "_file"), write)


def file_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (file, rows, least_<column>, greatest_<column>, ...): what a filter can skip files by."""
    ends = [end for k, c in enumerate(columns) for end in (F.min(f"`{c}`").alias(f"least_{c}"), F.max(f"`{c}`").alias(f"greatest_{c}"))]
    return df.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("rows"), *ends)


def files_met(df: DataFrame, column: str, value: object) -> DataFrame:
    """One row (met, files): how many of a table's files a filter ``column = value`` has to open."""
    ranges = file_ranges(df, [column])
    met = (F.col(f"`least_{column}`") <= F.lit(value)) & (F.col(f"`greatest_{column}`") >= F.lit(value))
    return ranges.agg(F.count_if(met).alias("met"), F.count("*").alias("files"))
