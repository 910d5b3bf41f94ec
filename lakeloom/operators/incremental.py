"""Aggregates that follow a change feed instead of the whole table.

A KPI's state is what can be added up and taken away again: whole units, known
values and rows per group, and per group the rows of each member that is
counted once. A feed's inserted rows and postimages count forward, its deleted
rows and preimages backward, so a state that took a feed equals one built from
the new version of the table.

States are stored by key: a feed reads and writes the buckets of its own groups
and members. Groups and members that no row is left of stay as zeros, which
the results leave out.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from ..session import delete, work_dir
from ..sources.tables import BUCKETS, bucket_count, bucket_of, buckets_for, current_version, snapshot_read_as_of, snapshot_write


def sign_of_change(kind: str = "_change_type") -> Column:
    """1 for a row that came, -1 for one that went."""
    return F.when(F.col(kind).isin("insert", "update_postimage"), 1).otherwise(-1)


@dataclass(frozen=True)
class GroupState:
    """``sums``: group, units, known, rows; ``members``: group, kind, member, rows."""

    group: tuple[str, ...]
    sums: DataFrame
    members: DataFrame

    def plus(self, other: GroupState) -> GroupState:
        return GroupState(self.group, _added(self.sums, other.sums, self.group), _added(self.members, other.members, (*self.group, *_MEMBER)))


_MEMBER, _FIGURES = ("kind", "member"), ("units", "known", "rows")


def _total(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in df.columns if c in _FIGURES])


def _added(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _total(a.unionByName(b), keys)


def group_state(rows: DataFrame, group: Sequence[str], value: str, scale: int, members: Mapping[str, str], sign: Column | None = None, lists: str | None = None) -> GroupState:
    """The state of ``rows``, each of which counts as ``sign`` says (forward without it).

    ``value`` is averaged and has ``scale`` decimals; ``members`` names the
    columns whose distinct values are counted, by the figure's name. With
    ``lists`` a row counts for each group of that array column; few unlike
    arrays are taken for granted, so rows are added up by array before they
    are multiplied.
    """
    sign = F.lit(1) if sign is None else sign
    rows = rows.withColumn("_sign", sign.cast("bigint"))
    units = F.round(F.col(value) * 10**scale).cast("bigint")
    by = group if lists is None else [lists]
    sums = rows.groupBy(*by).agg(
        F.coalesce(F.sum(units * F.col("_sign")), F.lit(0)).alias("units"),
        F.coalesce(F.sum(F.when(F.col(value).isNotNull(), F.col("_sign"))), F.lit(0)).alias("known"),
        F.sum("_sign").alias("rows"),
    )
    each = [F.struct(F.lit(name).alias("kind"), F.col(c).cast("string").alias("member")) for name, c in members.items()]
    own = rows.select(*by, "_sign", F.explode(F.array(*each)).alias("m")).select(*by, "_sign", "m.*").filter("member is not null")
    own = own.groupBy(*by, *_MEMBER).agg(F.sum("_sign").alias("rows"))
    if lists is not None:
        one = lambda df: df.withColumn(group[0], F.explode(lists)).drop(lists)
        sums = _total(one(sums), group)
        own = _total(one(own.repartition(*_MEMBER)), (*group, *_MEMBER))  # a member's rows are few by now, and meet once
    return GroupState(tuple(group), sums, own)


def figures(state: GroupState, scale: int, places: int, members: Sequence[str]) -> DataFrame:
    """Group, avg_rating, rating_count and the distinct members of each kind."""
    group = list(state.group)
    sums = state.sums.filter("rows > 0").select(
        *group, fn.mean_of_parts(F.col("units"), F.col("known"), scale, places).alias("avg_rating"), F.col("rows").alias("rating_count")
    )
    counts = state.members.filter("rows > 0").groupBy(*group).agg(*[F.count_if(F.col("kind") == m).alias(m) for m in members])
    return sums.join(counts, group, "left").fillna(0, list(members))


def store_state(spark: SparkSession, root: str, delta: GroupState, note: str) -> GroupState:
    """Add ``delta`` to the state under ``root`` and return the new one.

    ``note`` names the feed. A part of the state that has it already is left
    as it is, so a run that stopped half-way may be repeated. The first delta
    is the first state.

    Each part of ``delta`` is computed once: a first state is dealt anew only
    if it turns out to need more buckets, and a later one is stored before it
    is asked which buckets it hits. The sum of old and new is shuffled by
    bucket, as which it is written.
    """
    parts = {"sums": (delta.sums, delta.group), "members": (delta.members, (*delta.group, *_MEMBER))}
    for name, (rows, keys) in parts.items():
        path = f"{root}/{name}"
        last = current_version(spark, path)
        if last is None:
            first = snapshot_read_as_of(spark, path, snapshot_write(rows, path, note, keys))
            need = buckets_for(first)
            if need > BUCKETS:
                snapshot_write(first, path, f"{need} buckets", keys, need)
        elif spark.read.parquet(f"{path}/versions").filter(F.col("note") == note).isEmpty():
            stored = f"{work_dir(spark)}/delta-{uuid.uuid4().hex}"
            rows.write.parquet(stored)
            rows = spark.read.parquet(stored)
            of = bucket_count(spark, path, last)
            hit = [r[0] for r in rows.select(bucket_of(keys, of)).distinct().collect()]  # no more than there are buckets
            both = snapshot_read_as_of(spark, path, last, hit).select(rows.columns).unionByName(rows)
            snapshot_write(both, path, note, keys, sums=[c for c in rows.columns if c not in keys])
            delete(spark, stored)
    return read_state(spark, root, delta.group)


def read_state(spark: SparkSession, root: str, group: Sequence[str]) -> GroupState:
    parts = (snapshot_read_as_of(spark, f"{root}/{p}", current_version(spark, f"{root}/{p}")) for p in ("sums", "members"))
    return GroupState(tuple(group), *parts)


# The two KPIs that count users and movies.

MEMBERS = {"unique_users": "user_id", "unique_movies": "movie_sk"}
MONTH, GENRE = ("year", "month", "month_name"), ("genre_name",)


def monthly_state(fact: DataFrame, dates: DataFrame, sign: Column | None = None, movie: str = "movie_sk") -> GroupState:
    """Of a fact, or of a feed of it by ``sign_of_change()``; ``movie`` is the column that tells movies apart."""
    named = fact.join(dates.select("date_key", *MONTH), "date_key")
    return group_state(named, MONTH, "rating", 1, {**MEMBERS, "unique_movies": movie}, sign)


def genre_state(fact: DataFrame, bridge: DataFrame, genres: DataFrame, sign: Column | None = None, movie: str = "movie_sk") -> GroupState:
    """The same by genre, of a bridge by ``movie``: rows go to their movie's list of genres, and are multiplied where they lie."""
    lists = bridge.join(genres.select("genre_sk", "genre_name"), "genre_sk").groupBy(movie).agg(F.collect_list("genre_name").alias("_genres"))
    rows = fact.join(lists, movie).withColumn("_genres", F.sort_array("_genres"))
    return group_state(rows, GENRE, "rating", 1, {**MEMBERS, "unique_movies": movie}, sign, "_genres")


def kpi_figures(state: GroupState) -> DataFrame:
    return figures(state, 1, 2, list(MEMBERS))
