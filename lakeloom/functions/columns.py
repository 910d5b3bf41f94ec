"""Column expressions that several operators share; all run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Leading articles that titles carry at their end.
ARTICLES = ("The", "A", "An", "Le", "La", "Les", "Das", "Der", "Die", "El", "Il", "Los", "Las")
_ARTICLE = rf",\s*({'|'.join(ARTICLES)})\s*$"
_YEAR = r"\((\d{4})\)\s*$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_int(c: str | Column) -> Column:
    """INT, or NULL where the value is no number."""
    return _col(c).try_cast("int")


def as_double(c: str | Column) -> Column:
    return _col(c).try_cast("double")


def from_epoch(c: str | Column) -> Column:
    """Timestamp of epoch seconds."""
    return F.timestamp_seconds(_col(c).try_cast("bigint"))


def day_key(ts: str | Column) -> Column:
    """yyyymmdd as a number."""
    ts = _col(ts)
    return (F.year(ts) * 10_000 + F.month(ts) * 100 + F.day(ts)).cast("int")


def squeeze(c: str | Column) -> Column:
    """Every run of white space as one space, ends trimmed."""
    return F.trim(F.regexp_replace(_col(c), r"\s+", " "))


def proper(c: str | Column) -> Column:
    return F.initcap(_col(c))


def keep_chars(c: str | Column, chars: str = r"a-zA-Z0-9\s\-") -> Column:
    return F.regexp_replace(_col(c), f"[^{chars}]", "")


def trailing_year(c: str | Column, low: int = 1800, high: int = 2199) -> Column:
    """The year in brackets that ends a title, if it is within the bounds."""
    year = F.regexp_extract(_col(c), _YEAR, 1).try_cast("int")
    return F.when((year >= low) & (year <= high), year)


def without_year(c: str | Column) -> Column:
    return F.trim(F.regexp_replace(_col(c), r"\s*" + _YEAR, ""))


def front_article(c: str | Column) -> Column:
    """'Name, The' as 'The Name'; other titles stay."""
    return F.trim(F.regexp_replace(_col(c), rf"(?s)^(.*?){_ARTICLE}", "$2 $1"))


def members(c: str | Column, sep: str = r"\|", none_like: str = "no genres listed") -> Column:
    """A separated list as an array; empty for null, blank and placeholder values."""
    c = _col(c)
    empty = c.isNull() | (F.trim(c) == "") | F.contains(F.lower(c), F.lit(none_like))
    each = F.transform(F.split(c, sep), lambda x: F.initcap(F.trim(x)))
    return F.when(empty, F.array().cast("array<string>")).otherwise(each)


def mean_exact(c: str | Column, scale: int, places: int) -> Column:
    """Mean rounded half up, exact for non-negative values of ``scale`` decimals.

    Sums whole units as bigint, so neither the order of rows nor a tie in the
    last place shows in the result.
    """
    units, known, _ = mean_parts(c, scale)
    return mean_of_parts(units, known, scale, places)


def mean_parts(c: str | Column, scale: int) -> tuple[Column, Column, Column]:
    """What ``mean_of_parts`` needs of a group, to be summed over groups: whole units, known values; and all rows."""
    return F.sum(F.round(_col(c) * 10**scale).cast("bigint")), F.count(_col(c)), F.count("*")


def mean_of_parts(units: Column, known: Column, scale: int, places: int) -> Column:
    n = known * 10**scale
    return _div(units * (2 * 10**places) + n, n * 2).cast("double") / float(10**places)


def percent_exact(part: str | Column, whole: str | Column, places: int) -> Column:
    """100 * part / whole, rounded half up, exact for non-negative counts."""
    part, whole = _col(part).cast("bigint"), _col(whole).cast("bigint")
    return _div(part * (200 * 10**places) + whole, whole * 2).cast("double") / float(10**places)


def _div(a: Column, b: Column) -> Column:
    return F.when(b != 0, F.call_function("div", a, F.when(b != 0, b)))
