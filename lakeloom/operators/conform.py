"""Raw tables to typed, cleaned ones, and the lineage columns of each layer.

Raw values that do not parse become NULL (no row is dropped); quality rules
judge them later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn


def conform_ratings(df: DataFrame) -> DataFrame:
    """(userId, movieId, rating, timestamp, _batch_year) -> 12 typed columns.

    A row is late if its event year is not its batch's. Version columns start
    as an open current version.
    """
    event = fn.from_epoch("timestamp")
    return df.select(
        fn.as_int("userId").alias("user_id"),
        fn.as_int("movieId").alias("movie_id"),
        F.round(fn.as_double("rating"), 1).alias("rating"),
        event.alias("interaction_timestamp"),
        fn.day_key(event).alias("date_key"),
        (F.year(event) != F.col("_batch_year")).alias("is_late_arrival"),
        F.year(event).alias("rating_year"),
        F.lit(True).alias("is_current"),
        event.alias("effective_start_date"),
        F.lit(None).cast("timestamp").alias("effective_end_date"),
        "_ingestion_timestamp",
        "_batch_year",
    )


def conform_movies(df: DataFrame) -> DataFrame:
    title = F.trim("title")
    return df.select(
        fn.as_int("movieId").alias("movie_id"),
        fn.proper(fn.front_article(fn.without_year(title))).alias("title"),
        fn.trailing_year(title).alias("release_year"),
        fn.members("genres").alias("genres"),
        "_ingestion_timestamp",
    )


def conform_tags(df: DataFrame) -> DataFrame:
    event = fn.from_epoch("timestamp")
    return df.select(
        fn.as_int("userId").alias("user_id"),
        fn.as_int("movieId").alias("movie_id"),
        fn.proper(fn.squeeze(fn.keep_chars("tag"))).alias("tag"),
        event.alias("tag_timestamp"),
        fn.day_key(event).alias("date_key"),
        "_ingestion_timestamp",
    )


def conform_links(df: DataFrame) -> DataFrame:
    imdb = F.concat(F.lit("tt"), F.col("imdbId").cast("string"))  # NULL stays NULL
    return df.select(
        fn.as_int("movieId").alias("movie_id"),
        imdb.alias("imdb_id"),
        F.col("tmdbId").cast("string").alias("tmdb_id"),
        (F.col("imdbId").isNotNull() | F.col("tmdbId").isNotNull()).alias("has_external_ids"),
        "_ingestion_timestamp",
    )


def conform_genome_scores(df: DataFrame) -> DataFrame:
    return df.select(
        fn.as_int("movieId").alias("movie_id"),
        fn.as_int("tagId").alias("tag_id"),
        F.round(fn.as_double("relevance"), 3).alias("relevance"),
        "_ingestion_timestamp",
    )


def conform_genome_tags(df: DataFrame) -> DataFrame:
    return df.select(
        fn.as_int("tagId").alias("tag_id"), fn.proper(fn.squeeze("tag")).alias("tag"), "_ingestion_timestamp"
    )


def _stamped(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns({f"_{name}": c for name, c in columns.items()})


def lineage_static(df: DataFrame, run_id: str, job_path: str, source: str) -> DataFrame:
    """Ingest lineage of a file scan; reads the hidden file metadata."""
    return _stamped(
        df,
        input_file_name=F.col("_metadata.file_path"),
        ingestion_timestamp=F.current_timestamp(),
        job_run_id=F.lit(run_id),
        notebook_path=F.lit(job_path),
        source_system=F.lit(source),
    )


def lineage_incremental(df: DataFrame, table: str, run_id: str, job_path: str, source: str) -> DataFrame:
    """As ``lineage_static``, with the batch that each row's file name carries.

    All files of a scan are stamped in one job.
    """
    year = F.regexp_extract("_metadata.file_name", r"_(\d{4})\.", 1).try_cast("int")
    stamped = _stamped(df, batch_year=year)
    stamped = _stamped(stamped, batch_id=F.concat_ws("_", F.lit(table), "_batch_year"))
    return lineage_static(stamped, run_id, job_path, source)


def lineage_silver_static(df: DataFrame, run_id: str, job_path: str, source: str) -> DataFrame:
    """Processing lineage; the ingest time moves to its own column."""
    return _stamped(
        df.withColumnRenamed("_ingestion_timestamp", "_bronze_ingestion_timestamp"),
        processing_timestamp=F.current_timestamp(),
        job_run_id=F.lit(run_id),
        notebook_path=F.lit(job_path),
        source_system=F.lit(source),
    )


def lineage_silver_incremental(df: DataFrame, run_id: str, job_path: str, source: str, batch: Column) -> DataFrame:
    return _stamped(lineage_silver_static(df, run_id, job_path, source), batch_year=batch.cast("int"))


def lineage_gold(
    df: DataFrame, source_table: str, run_id: str, job_path: str, model_version: str, source_version: int | None
) -> DataFrame:
    """``source_version`` is None for generated tables."""
    return _stamped(
        df,
        source_table=F.lit(source_table),
        job_run_id=F.lit(run_id),
        notebook_path=F.lit(job_path),
        model_version=F.lit(model_version),
        aggregation_timestamp=F.current_timestamp(),
        source_silver_version=F.lit(source_version).cast("int"),
    )
