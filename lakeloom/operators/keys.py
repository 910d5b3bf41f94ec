"""Surrogate keys, lookups, dimensions, bridges and facts."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..session import work_dir
from .checks import filter_batches, filter_current, passing

#: Rows, and bytes of text, up to which a looked-up dimension may be broadcast by hint.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def surrogate_key(df: DataFrame, name: str, *columns: str) -> DataFrame:
    """SHA-256 of the columns' texts, joined by a bar; a single NULL stays NULL."""
    if not columns:
        raise ValueError("a key needs at least one column")
    texts = [F.col(c).cast("string") for c in columns]
    return df.withColumn(name, F.sha2(texts[0] if len(texts) == 1 else F.concat_ws("|", *texts), 256))


def join_lookup_inner(df: DataFrame, dim: DataFrame, on: str | list[str]) -> DataFrame:
    """Resolve keys and drop orphans; Spark picks the strategy by size."""
    return df.join(dim, on, "inner")


def join_lookup_broadcast(
    df: DataFrame, dim: DataFrame, on: str | list[str], most: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The same with a dimension that is broadcast if it has at most ``most`` rows and ``most_bytes``.

    Reads up to ``most + 1`` rows of the dimension first; a larger one is
    joined like any table.
    """
    size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))
    rows, width = dim.limit(most + 1).agg(F.count("*"), size).first()
    small = rows <= most and width <= most_bytes
    return df.join(F.broadcast(dim) if small else dim, on, "inner")


def explode_members(df: DataFrame, keep: str, array: str, name: str) -> DataFrame:
    """(id, member) rows; null and blank members go."""
    rows = df.select(keep, F.explode(array).alias(name))
    return rows.filter(F.trim(name) != "")


def join_anti_new_members(members: DataFrame, dim: DataFrame, name: str) -> DataFrame:
    """Members whose name, case folded, is not in the dimension."""
    known = dim.select(F.lower(name).alias("_folded"))
    return members.withColumn("_folded", F.lower(name)).join(known, "_folded", "left_anti").drop("_folded")


def join_anti_orphans(fact: DataFrame, parent: DataFrame, on: str) -> DataFrame:
    return fact.join(parent.select(on), on, "left_anti")


def join_semi_affected_keys(df: DataFrame, touched: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are among the touched ones; NULL keys match nothing."""
    return df.join(touched.select(*keys).distinct(), keys, "left_semi")


def join_star_chain(fact: DataFrame, *links: tuple[DataFrame, str]) -> DataFrame:
    for dim, on in links:
        fact = fact.join(dim, on)
    return fact


def dim_movies(movies: DataFrame) -> DataFrame:
    keyed = surrogate_key(passing(movies), "movie_sk", "movie_id")
    return keyed.select("movie_sk", "movie_id", "title", "release_year")


def dim_genome_tags(tags: DataFrame) -> DataFrame:
    return surrogate_key(passing(tags), "tag_sk", "tag_id").select("tag_sk", "tag_id", "tag")


def dim_external_links(links: DataFrame, movies: DataFrame) -> DataFrame:
    """Links of known movies, under the movies' key."""
    kept = passing(links).join(movies.select("movie_id"), "movie_id", "left_semi")
    return surrogate_key(kept, "movie_sk", "movie_id").select("movie_sk", "movie_id", "imdb_id", "tmdb_id")


def number_rows(df: DataFrame, order: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """``df`` with gapless numbers from ``start + 1`` in the order of the columns, which must be total.

    Rows are dealt out by ranges of the order and sorted where they lie; a
    number is the row's place there after the rows of the ranges before. The
    dealt rows are written once, so numbers and counts are of the same ranges
    even if a task is run again; only the ranges' counts reach the driver.
    """
    spark, path = df.sparkSession, f"{work_dir(df.sparkSession)}/numbered-{uuid.uuid4().hex}"
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    dealt.write.parquet(path)
    dealt = spark.read.parquet(path)
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = {r.part: r.n for r in dealt.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}  # one per range
    before, total = [], start
    for k in range(max(counts, default=-1) + 1):
        before.append(total)
        total += counts.get(k, 0)
    first = F.element_at(F.array(*map(F.lit, before or [start])).cast("array<bigint>"), (part + 1).cast("int"))
    return dealt.withColumn(name, first + place + 1).drop("_at")


def dim_genres_incremental(existing: DataFrame | None, members: DataFrame) -> DataFrame:
    """The dimension with new members appended, ids on from the largest.

    Names compare case-folded; the least spelling stands for a new one. Ids
    follow the names' order among the new ones, however many there are.
    """
    names = members.groupBy(F.lower("genre_name").alias("_f")).agg(F.min("genre_name").alias("genre_name")).drop("_f")
    new = names if existing is None else join_anti_new_members(names, existing, "genre_name")
    top = 0 if existing is None else existing.agg(F.max("genre_id")).first()[0] or 0
    new = number_rows(new, ["genre_name"], "genre_id", top)
    out = surrogate_key(new, "genre_sk", "genre_name").select("genre_sk", F.col("genre_id").cast("int").alias("genre_id"), "genre_name")
    return out if existing is None else existing.select("genre_sk", "genre_id", "genre_name").unionByName(out)


def dim_date(df: DataFrame, ts: str) -> DataFrame:
    """One row per day from the first to the last event."""
    ends = df.agg(F.min(F.to_date(ts)).alias("a"), F.max(F.to_date(ts)).alias("b"))
    days = ends.filter("a is not null").select(F.explode(F.sequence("a", "b")).alias("full_date"))
    d = F.col("full_date")
    return days.select(
        fn.day_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.day(d).alias("day"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.weekofyear(d).alias("week_of_year"),
    )


def bridge_movies_genres(movies: DataFrame, dim: DataFrame, genres: DataFrame, by_id: bool = False) -> DataFrame:
    """Each pair once; told apart by movie id and folded name, which are shorter than the keys they stand for.

    ``by_id`` gives (movie_id, genre_sk), for facts that are grouped by the id.
    """
    pairs = explode_members(passing(movies), "movie_id", "genres", "genre_name").withColumn("_f", F.lower("genre_name"))
    movie = ["movie_id"] if by_id else ["movie_id", "movie_sk"]
    pairs = pairs.join(dim.select(*movie), "movie_id").select(*movie, "_f").distinct()
    return pairs.join(genres.select(F.lower("genre_name").alias("_f"), "genre_sk"), "_f").select(movie[-1], "genre_sk")


def fact_ratings(
    ratings: DataFrame, movies: DataFrame, dates: DataFrame, batches: list[int] | None = None, also: Sequence[str] = ()
) -> DataFrame:
    """PASS, current rows (of the batches), with their keys resolved; ``also`` names further columns to keep.

    ``_processing_timestamp`` is that of the row, or now where it has none.
    """
    rows = filter_current(passing(ratings))
    rows = rows if batches is None else filter_batches(rows, batches)
    rows = join_star_chain(rows, (movies.select("movie_id", "movie_sk"), "movie_id"), (dates.select("date_key"), "date_key"))
    stamp = F.col("_processing_timestamp") if "_processing_timestamp" in rows.columns else F.current_timestamp()
    measures = ["rating", "interaction_timestamp", "date_key", "rating_year", "is_late_arrival", "_batch_year"]
    return rows.select("movie_sk", "user_id", *measures, stamp.alias("_processing_timestamp"), *also)


def fact_genome_scores(scores: DataFrame, movies: DataFrame, tags: DataFrame) -> DataFrame:
    rows = join_star_chain(passing(scores), (movies.select("movie_id", "movie_sk"), "movie_id"), (tags.select("tag_id", "tag_sk"), "tag_id"))
    return rows.select("movie_sk", "tag_sk", "relevance")
