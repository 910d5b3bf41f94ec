"""Deduplication, type-2 history, merges, change feeds and load audits.

All are functions from tables to a new table: history is recomputed for the
keys that a batch touches and the rest passes through, so a result can be
written beside its input and nothing is changed in place.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

CURRENT, START, END = "is_current", "effective_start_date", "effective_end_date"


#: One of ``"name"`` (ascending, nulls first), ``"name desc"`` (nulls last) or any sort expression.
Order = Sequence[str | Column]


def _parts(order: Order) -> list[tuple[str, bool]] | None:
    """(name, descending) of each, if all are names."""
    if not all(isinstance(o, str) for o in order):
        return None
    return [(o.removesuffix(" desc"), o.endswith(" desc")) for o in order]


def _sorts(order: Order) -> list[Column]:
    columns = []
    for o in order:
        parts = _parts([o])
        columns.append(o if parts is None else F.col(parts[0][0]).desc_nulls_last() if parts[0][1] else F.col(parts[0][0]).asc_nulls_first())
    return columns


def _turned(name: str, kind: str) -> Column | None:
    """A value that rises as the column falls, for types that have one; nulls come out greatest."""
    c = F.col(name)
    if kind in ("tinyint", "smallint", "int", "bigint"):
        turned = F.bitwise_not(c.cast("bigint"))
    elif kind == "date":
        turned = F.bitwise_not(F.unix_date(c))
    elif kind == "timestamp":
        turned = F.bitwise_not(F.unix_micros(c))
    elif kind == "boolean":
        turned = ~c
    elif kind in ("float", "double"):
        turned = F.struct(~F.isnan(c), -c)
    elif kind.startswith("decimal"):
        turned = -c
    else:
        return None
    return F.struct(c.isNull(), turned)


def _rank_value(df: DataFrame, order: Order) -> tuple[Column, bool] | None:
    """(value, whether the first row has the greatest one), if an aggregate can compare by it."""
    parts, kinds = _parts(order), dict(df.dtypes)
    if not parts:
        return None
    if not any(desc for _, desc in parts):
        return F.struct(*[F.col(name) for name, _ in parts]), False
    values = [F.col(name) if desc else _turned(name, kinds[name]) for name, desc in parts]
    return (F.struct(*values), True) if all(v is not None for v in values) else None


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """The first row of each key by ``order``, which must be total.

    Orders by name are an aggregate: every task keeps one row per key before
    the shuffle, so a key that holds much of the table moves one row a task.
    Other expressions, and texts that rise beside columns that fall, go by a
    window.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ranked = _rank_value(df, order)
    if ranked is None:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*_sorts(order)))
        return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
    pick = F.max_by if ranked[1] else F.min_by
    best = df.groupBy(*keys).agg(pick(F.struct(*[F.col(f"`{c}`") for c in rest]), ranked[0]).alias("_row"))
    return best.select(*[c if c in keys else F.col(f"_row.`{c}`") for c in df.columns])


def _timeline(df: DataFrame, natural_key: Sequence[str], ts: str, event_key: Sequence[str]) -> DataFrame:
    """Version columns of each natural key's events, which are distinct: the last one is open.

    One window over one sort; events of the same moment follow by event key.
    """
    later = [k for k in event_key if k not in natural_key and k != ts]
    oldest = Window.partitionBy(*natural_key).orderBy(F.col(ts).asc_nulls_first(), *later)
    rows = df.withColumns({"_after": F.lead(F.lit(True)).over(oldest), "_end": F.lead(ts).over(oldest)})
    return rows.withColumns({CURRENT: F.col("_after").isNull(), START: F.col(ts), END: F.col("_end")}).drop("_after", "_end")


def scd2_bootstrap(df: DataFrame, event_key: Sequence[str], natural_key: Sequence[str], ts: str, order: Order) -> DataFrame:
    """First load: one row per event, the latest per natural key current.

    Where the natural key and the time are of the event key and the order is
    by name, rows are shuffled and sorted once, by natural key: the first row
    of an event and the next event's moment are both told by that order, and
    only columns that the result uses are carried. Rows of a key are then held
    in one task's sort, which spills.
    """
    if _parts(order) is None or not {*natural_key, ts} <= set(event_key):
        return _timeline(dedup_latest(df, event_key, order), natural_key, ts, event_key).select(df.columns)
    later = [k for k in event_key if k not in natural_key and k != ts]
    sorted_rows = Window.partitionBy(*natural_key).orderBy(F.col(ts).asc_nulls_first(), *later, *_sorts(order))
    # Plain columns, not a struct of them, which would be built before the shuffle and sent through it.
    lagged = {f"_before{k}": F.lag(c).over(sorted_rows) for k, c in enumerate([ts, *later])}
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_before{k}")) for k, c in enumerate([ts, *later])])
    seen = df.withColumns({"_before": F.lag(F.lit(True)).over(sorted_rows), **lagged})
    once = seen.filter(F.col("_before").isNull() | ~same).drop("_before", *lagged)
    return _timeline(once, natural_key, ts, event_key).select(df.columns)


#: Parts that target rows with a NULL key, which only pass through, are dealt over.
_LONE = 1024


def scd2_apply(
    target: DataFrame,
    incoming: DataFrame,
    event_key: Sequence[str],
    natural_key: Sequence[str],
    ts: str,
    order: Order,
    valid_only: bool = False,
    null_safe: bool = False,
) -> DataFrame:
    """The target with a batch's events merged into their keys' timelines.

    Incoming rows win over target rows of the same event. Keys that the batch
    does not touch pass through as they are. NULL natural keys match nothing
    unless ``null_safe``; ``valid_only`` keeps quarantined rows out of
    timelines. The target holds an event once.

    Both tables are read once: the batch is reduced to one row per event, and
    target and batch meet in one exchange by natural key, whose sorted rows
    tell a replaced row, the next moment and whether the batch touched the key.
    """
    columns = target.columns
    if valid_only:
        incoming = incoming.filter("_dq_status = 'PASS'")
    new = dedup_latest(incoming.select(columns), event_key, order)
    both = target.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    unknown = F.lit(False)
    for k in () if null_safe else natural_key:
        unknown |= F.col(k).isNull()
    lone = F.when(F.col("_new") == 1, 0).otherwise(1 + F.pmod(F.xxhash64(*event_key), F.lit(_LONE)))
    both = both.withColumn("_apart", F.when(unknown, lone).otherwise(F.lit(0)).cast("int"))

    later = [k for k in event_key if k not in natural_key and k != ts]
    key = Window.partitionBy(*natural_key, "_apart").orderBy(F.col(ts).asc_nulls_first(), *later, "_new")
    after = F.lead(F.struct(F.struct(ts, *later).alias("event"), F.col(ts).alias("ts"), F.col("_new").alias("new")))
    seen = both.withColumns({
        "_touched": F.max("_new").over(key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) == 1,
        "_after": after.over(key),
    })
    replaced = (F.col("_after.new") == 1) & F.struct(ts, *later).eqNullSafe(F.col("_after.event"))
    kept = seen.filter(~(F.col("_touched") & F.coalesce(replaced, F.lit(False))))
    touched, history = F.col("_touched"), {CURRENT: F.col("_after").isNull(), START: F.col(ts), END: F.col("_after.ts")}
    return kept.select(*[F.when(touched, history[c]).otherwise(F.col(c)).alias(c) if c in history else c for c in columns])


def scd2_check(df: DataFrame, natural_key: Sequence[str]) -> DataFrame:
    """Violations of the four history invariants, from one grouped pass."""
    per_key = df.groupBy(*natural_key).agg(
        F.count_if(CURRENT).alias("current"),
        F.count_if(F.col(CURRENT) & F.col(END).isNotNull()).alias("ended"),
        F.count_if(~F.col(CURRENT) & F.col(END).isNull()).alias("open"),
    )
    return per_key.agg(
        F.count_if(F.col("current") > 1).alias("several_current"),
        F.count_if(F.col("current") == 0).alias("none_current"),
        F.coalesce(F.sum("ended"), F.lit(0)).alias("current_with_end"),
        F.coalesce(F.sum("open"), F.lit(0)).alias("history_without_end"),
    )


def scd2_as_of(df: DataFrame, at: Column | str) -> DataFrame:
    """The versions that hold at a moment."""
    at = F.lit(at).cast("timestamp") if isinstance(at, str) else at
    return df.filter((F.col(START) <= at) & (F.col(END).isNull() | (at < F.col(END))))


def merge_upsert(
    target: DataFrame | None, source: DataFrame, keys: Sequence[str], order: Order, delete_unmatched_in: Sequence[str] = ()
) -> DataFrame:
    """Matched rows replaced, others inserted; without a target a full load.

    ``delete_unmatched_in`` names columns of a scope: target rows in a scope
    that the source has, but without a source row, go as well.
    """
    new = dedup_latest(source, keys, order)
    if target is None:
        return new
    kept = target.join(new.select(*keys), list(keys), "left_anti")
    if delete_unmatched_in:
        kept = kept.join(new.select(*delete_unmatched_in).distinct(), list(delete_unmatched_in), "left_anti")
    return kept.select(target.columns).unionByName(new.select(target.columns))


def merge_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: inserted, updated and dropped (repeated) source rows."""
    new = source.groupBy(*keys).agg(F.count("*").alias("_n")).withColumn("_s", F.lit(True))
    old = target.select(*keys, F.lit(True).alias("_t"))
    return new.join(old, list(keys), "left").agg(
        F.count_if(F.col("_t").isNull()).alias("inserted"),
        F.count_if(F.col("_t").isNotNull()).alias("updated"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("dropped"),
    )


def merge_insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str], fold_case: bool = False) -> DataFrame:
    """Source rows of new keys appended; one row per new key."""
    folded = lambda c: F.lower(c) if fold_case else F.col(c)
    names = [f"_m_{k}" for k in keys]
    source = source.withColumns({n: folded(k) for n, k in zip(names, keys)})
    new = dedup_latest(source, names, target.columns)
    new = new.join(target.select([folded(k).alias(n) for n, k in zip(names, keys)]), names, "left_anti")
    return target.unionByName(new.select(target.columns))


def merge_delete_keys(target: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the given keys removed; NULL keys never match."""
    return target.join(gone.select(*keys).distinct(), list(keys), "left_anti")


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changed rows between two versions, with ``_change_type``.

    Updates give a preimage and a postimage row; unchanged rows give none.
    Keys are unique within a version and compare null-safe.
    """
    columns = old.columns
    a = old.select([F.col(k).alias(f"_a_{k}") for k in keys] + [F.struct(*columns).alias("_old")])
    b = new.select([F.col(k).alias(f"_b_{k}") for k in keys] + [F.struct(*columns).alias("_new")])
    same = [F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}")) for k in keys]
    both = a.join(b, same, "full_outer").filter(~F.col("_old").eqNullSafe(F.col("_new")))
    image = lambda row, kind: F.struct(F.lit(kind).alias("kind"), F.col(row).alias("row"))
    images = (
        F.when(F.col("_old").isNull(), F.array(image("_new", "insert")))
        .when(F.col("_new").isNull(), F.array(image("_old", "delete")))
        .otherwise(F.array(image("_old", "update_preimage"), image("_new", "update_postimage")))
    )
    return both.select(F.explode(images).alias("c")).select("c.row.*", F.col("c.kind").alias("_change_type"))


def impacted_batches(feed: DataFrame, batch: Column | str) -> DataFrame:
    """Distinct batches that a feed touches; empty for an empty feed."""
    batch = F.col(batch) if isinstance(batch, str) else batch
    return feed.select(batch.alias("batch")).filter("batch is not null").distinct()


def select_batches_to_process(available: DataFrame, impacted: DataFrame, baseline: int | None, force: str = "") -> DataFrame:
    """Batches to load: forced ones, all without a baseline, else the impacted.

    ``force`` is empty, ``ALL`` or a comma-separated list; a listed batch that
    is not available raises.
    """
    if force.upper() == "ALL" or (not force and baseline is None):
        return available
    if not force:
        return available.join(impacted, "batch", "left_semi")
    listed = available.sparkSession.createDataFrame([(int(x),) for x in force.split(",")], "batch int").distinct()
    unknown = listed.join(available, "batch", "left_anti").collect()  # no more than were listed
    if unknown:
        raise ValueError(f"batches not available: {sorted(r.batch for r in unknown)}")
    return available.join(listed, "batch", "left_semi")


AUDIT = (
    "run_id string, target_table string, source_table string, batch int, start_version int, end_version int, "
    "model_version string, status string, rows_written bigint"
)


def audit_append(audit: DataFrame, rows: Sequence[Row | tuple]) -> DataFrame:
    return audit.unionByName(audit.sparkSession.createDataFrame(list(rows), audit.schema))


def audit_processed(audit: DataFrame, target: str, source: str, version: int | None, model: str) -> DataFrame:
    """Batches loaded with success for a source version (null-safe) and model."""
    same = (F.col("target_table") == target) & (F.col("source_table") == source) & (F.col("model_version") == model)
    same &= F.col("end_version").eqNullSafe(F.lit(version).cast("int")) & (F.col("status") == "SUCCESS")
    return audit.filter(same).select("batch").distinct()


def audit_latest_version(audit: DataFrame, target: str, source: str) -> DataFrame:
    same = (F.col("target_table") == target) & (F.col("source_table") == source) & (F.col("status") == "SUCCESS")
    return audit.filter(same).agg(F.max("end_version").alias("latest_version"))


def lineage_trace(gold: DataFrame, silver_at: DataFrame, bronze: DataFrame, keys: Sequence[str], bronze_keys: Sequence[str]) -> DataFrame:
    """Gold rows with the silver row they came from and that row's raw file.

    ``silver_at`` is the silver table as of the version the gold rows record;
    it holds an event once. A row whose event several raw rows tell comes once
    for each of these.
    """
    keyed = bronze.select([F.col(b).alias(k) for k, b in zip(keys, bronze_keys)] + ["_input_file_name"])
    return gold.join(silver_at, list(keys)).join(keyed, list(keys), "left")
