"""Row-level quality flags and table-level contract checks.

Flags never drop a row; checks give one-pass report tables. A rule is a pair
(name, failing condition); a condition that is NULL does not fail.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as fn

Rule = tuple[str, Column]
PASS, QUARANTINE = "PASS", "QUARANTINE"
#: Fixed value: events before this day are not plausible.
FLOOR = "1995-01-01"


def _missing(c: str) -> Column:
    return F.col(c).isNull()


def _outside(c: str, low: float, high: float) -> Column:
    return (F.col(c) < low) | (F.col(c) > high)


def _early(ts: str) -> Column:
    return F.col(ts) < F.lit(FLOOR).cast("timestamp")


def rules_ratings() -> list[Rule]:
    ts = "interaction_timestamp"
    return [
        ("NULL_USER_ID", _missing("user_id")),
        ("NULL_MOVIE_ID", _missing("movie_id")),
        ("NULL_RATING", _missing("rating")),
        ("NULL_TIMESTAMP", _missing(ts)),
        ("INVALID_TIMESTAMP_FLOOR", _early(ts)),
        ("INVALID_RATING_RANGE", _outside("rating", 0.0, 5.0)),
        ("DATE_KEY_MISMATCH", F.col("date_key") != fn.day_key(ts)),
    ]


def rules_tags() -> list[Rule]:
    ts = "tag_timestamp"
    return [
        ("NULL_USER_ID", _missing("user_id")),
        ("NULL_MOVIE_ID", _missing("movie_id")),
        ("NULL_TAG", _missing("tag")),
        ("EMPTY_TAG", F.trim("tag") == ""),
        ("NULL_TIMESTAMP", _missing(ts)),
        ("INVALID_TIMESTAMP_FLOOR", _early(ts)),
        ("SHORT_TAG", F.length("tag") < 3),
        ("DATE_KEY_MISMATCH", F.col("date_key") != fn.day_key(ts)),
    ]


def rules_movies() -> list[Rule]:
    return [
        ("NULL_MOVIE_ID", _missing("movie_id")),
        ("NULL_TITLE", F.trim(F.coalesce("title", F.lit(""))) == ""),
        ("INVALID_RELEASE_YEAR", _outside("release_year", 1800, 2199)),
    ]


def rules_links() -> list[Rule]:
    return [("NULL_MOVIE_ID", _missing("movie_id")), ("NO_EXTERNAL_IDS", ~F.col("has_external_ids"))]


def rules_genome_scores() -> list[Rule]:
    return [
        ("NULL_MOVIE_ID", _missing("movie_id")),
        ("NULL_TAG_ID", _missing("tag_id")),
        ("NULL_RELEVANCE", _missing("relevance")),
        ("INVALID_RELEVANCE_RANGE", _outside("relevance", 0.0, 1.0)),
    ]


def rules_genome_tags() -> list[Rule]:
    return [
        ("NULL_TAG_ID", _missing("tag_id")),
        ("NULL_TAG", _missing("tag")),
        ("EMPTY_TAG", F.trim("tag") == ""),
    ]


def dq_flag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``_dq_failed_rules`` (in rule order) and ``_dq_status``.

    Both come from the conditions and by compiled expressions; a lambda over the array would be interpreted row by row.
    """
    none = F.array().cast("array<string>")
    failed = F.concat(none, *[F.when(bad, F.array(F.lit(name))).otherwise(none) for name, bad in rules])
    broken = reduce(Column.__or__, [bad for _, bad in rules], F.lit(False))
    return df.withColumns({"_dq_failed_rules": failed, "_dq_status": F.when(broken, QUARANTINE).otherwise(PASS)})


def filter_pass(df: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """The PASS rows, and total and quarantined counts from one pass.

    Runs one aggregate; raises if no row passes.
    """
    n = df.agg(F.count("*").alias("total"), F.count_if(F.col("_dq_status") == PASS).alias("passed")).first()
    if not n.passed:
        raise ValueError("no row passes the quality rules")
    return passing(df), {"total": n.total, "quarantined": n.total - n.passed}


def passing(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_dq_status") == PASS)


def filter_current(df: DataFrame) -> DataFrame:
    return df.filter("is_current")


def filter_batches(df: DataFrame, batches: Sequence[int], column: str = "_batch_year") -> DataFrame:
    return df.filter(F.col(column).isin(*batches))


def dq_batch_metrics(df: DataFrame, by: str | None = None, late: str | None = None) -> DataFrame:
    """Total, quarantined and (optionally) late rows, per batch or at all."""
    counts = [F.count("*").alias("total"), F.count_if(F.col("_dq_status") == QUARANTINE).alias("quarantined")]
    counts += [F.count_if(F.col(late)).alias("late")] if late else []
    return (df.groupBy(by) if by else df.groupBy()).agg(*counts)


def dq_rule_breakdown(df: DataFrame) -> DataFrame:
    """Rows and percent per set of failed rules; the window is over those few rows."""
    sets = df.groupBy(F.array_join("_dq_failed_rules", ",").alias("failed_rules")).agg(F.count("*").alias("rows"))
    whole = F.sum("rows").over(Window.partitionBy())
    return sets.withColumn("pct", fn.percent_exact(F.col("rows"), whole, 2))


def check_pk_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    found = df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("violations"))
    return found.select(F.lit("pk_unique:" + ",".join(keys)).alias("check"), "violations")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column in one pass: rows (check, violations)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "violations").select(
        F.concat(F.lit("not_null:"), F.col("column")).alias("check"), "violations"
    )


def check_constraints(df: DataFrame, constraints: dict[str, Sequence[str]], table: str) -> DataFrame:
    """The NOT NULL columns that ``constraints`` declares for ``table``."""
    return check_not_null(df, constraints[table])


def check_lineage_contract(df: DataFrame, generated: str = "GENERATED") -> DataFrame:
    """Violations of each lineage column's contract."""
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    rules = {
        "_source_table": blank("_source_table"),
        "_job_run_id": blank("_job_run_id"),
        "_notebook_path": _missing("_notebook_path"),
        "_model_version": _missing("_model_version"),
        "_aggregation_timestamp": _missing("_aggregation_timestamp"),
        "_source_silver_version": _missing("_source_silver_version") != F.coalesce(F.col("_source_table") == generated, F.lit(False)),
    }
    counts = df.agg(*[F.count_if(bad).alias(c) for c, bad in rules.items()])
    return counts.unpivot([], list(rules), "column", "violations").select(
        F.concat(F.lit("lineage:"), F.col("column")).alias("check"), "violations"
    )


def check_foreign_keys(df: DataFrame, links: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Distinct non-null keys without a parent, per (column, parent, key).

    All keys of a row go as (link, key) through one distinct and one anti
    join, so the table is read once for any number of links. Keys compare as
    the parent's type shows them.
    """
    if not links or any(fk not in df.columns or key not in parent.columns for fk, parent, key in links):
        raise ValueError("each link names a column of the table and one of its parent")
    own, parents = [], []
    for k, (fk, parent, key) in enumerate(links):
        shown = F.coalesce(F.col(fk).try_cast(parent.schema[key].dataType).cast("string"), F.col(fk).cast("string"))
        own.append(F.struct(F.lit(k).alias("link"), shown.alias("key")))
        parents.append(parent.select(F.lit(k).alias("link"), F.col(key).cast("string").alias("key")).filter("key is not null"))
    keys = df.select(F.explode(F.array(*own)).alias("k")).select("k.*").filter("key is not null").distinct()
    orphans = keys.join(reduce(DataFrame.unionByName, parents), ["link", "key"], "left_anti")
    counts = orphans.agg(*[F.count_if(F.col("link") == k).alias(f"c{k}") for k in range(len(links))])
    each = [F.struct(F.lit(f"fk:{fk}").alias("check"), F.col(f"c{k}").alias("violations")) for k, (fk, _, _) in enumerate(links)]
    return counts.select(F.explode(F.array(*each)).alias("c")).select("c.*")


def check_row_count(df: DataFrame, expected: int | Column) -> DataFrame:
    want = expected if isinstance(expected, Column) else F.lit(expected)
    return df.agg(F.count("*").alias("actual"), F.first(want).alias("expected")).withColumn("ok", F.expr("actual = expected"))


def check_date_continuity(df: DataFrame, date: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows (before, after) where days are missing between.

    Without ``by`` the sort is global, which suits a calendar; event tables
    name their entity in ``by``.
    """
    before = F.lag(date).over(Window.partitionBy(*by).orderBy(date))
    gaps = df.withColumn("before", before).filter(F.date_diff(F.col(date), F.col("before")) > 1)
    return gaps.select(*by, "before", F.col(date).alias("after"))


def validate_table(
    df: DataFrame,
    pk: Sequence[str],
    not_null: Sequence[str],
    links: Sequence[tuple[str, DataFrame, str]] = (),
    lineage: bool | None = None,
    fail: bool = True,
) -> DataFrame:
    """All checks in one report; raises on any violation if ``fail``.

    The lineage contract is part of it where the table has a lineage column,
    or as ``lineage`` says.
    """
    parts = [check_pk_unique(df, pk), check_not_null(df, not_null)]
    parts += [check_lineage_contract(df)] if ("_source_table" in df.columns if lineage is None else lineage) else []
    parts += [check_foreign_keys(df, links)] if links else []
    report = reduce(DataFrame.unionByName, parts)
    bad = report.filter("violations > 0").collect() if fail else []  # one row per declared check
    if bad:
        raise ValueError(", ".join(f"{r.check}: {r.violations}" for r in bad))
    return report


def detect_cross_batch(df: DataFrame, batch: str, epoch: str) -> DataFrame:
    """Rows per batch and event year, and each batch's rows of other years."""
    years = df.groupBy(F.col(batch).alias("batch_year"), F.year(fn.from_epoch(epoch)).alias("event_year"))
    years = years.agg(F.count("*").alias("rows"))
    own = Window.partitionBy("batch_year")
    cross = F.sum(F.when(F.col("event_year") != F.col("batch_year"), F.col("rows")).otherwise(0)).over(own)
    return years.withColumn("cross_rows", cross).withColumn("cross_pct", fn.percent_exact("cross_rows", F.sum("rows").over(own), 2))


def orphan_report(df: DataFrame, parent: DataFrame, on: str) -> DataFrame:
    """How many rows an inner join on ``on`` would drop."""
    return df.join(parent.select(on), on, "left_anti").agg(F.count("*").alias("orphans"))
