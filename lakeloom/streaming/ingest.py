"""Incremental ingestion as a file stream into versioned snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checks import dq_flag, rules_ratings
from ..operators.conform import conform_ratings
from ..operators.versioning import scd2_apply, scd2_bootstrap
from ..sources.tables import (
    BUCKET_BYTES,
    CSV_SCHEMAS,
    bucket_count,
    bucket_of,
    buckets_for,
    current_version,
    snapshot_read_as_of,
    snapshot_write,
)

EVENT_KEY = ("user_id", "movie_id", "interaction_timestamp")
NATURAL_KEY = ("user_id", "movie_id")


def event_order() -> list[str]:
    """A total order among the rows of one event."""
    return ["rating desc", "_batch_year desc", "_ingestion_timestamp desc"]


def flagged_ratings(raw: DataFrame) -> DataFrame:
    return _flagged(conform_ratings(raw))


def _flagged(rows: DataFrame) -> DataFrame:
    return dq_flag(rows, rules_ratings())


def apply_batch(raw: DataFrame, root: str, note: str, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Conform, flag and merge raw rows into the next snapshot of ``root``.

    Snapshots are kept by natural key: only the buckets with keys of the batch
    are read, merged and written again. The first batch's size sets the number
    of buckets, and a table that has outgrown them is dealt anew over more, so
    a batch of some keys touches a share of the table that falls as it grows.
    A first batch is told its flags as it is written: no row's place in the
    history depends on them, and so they are not shuffled.
    """
    spark = raw.sparkSession
    last = current_version(spark, root)
    if last is None:
        rows = conform_ratings(raw)
        merged = scd2_bootstrap(rows, EVENT_KEY, NATURAL_KEY, "interaction_timestamp", event_order())
        return snapshot_write(merged, root, note, NATURAL_KEY, buckets_for(rows, bucket_bytes), finish=_flagged)
    rows = flagged_ratings(raw)
    if last and last & (last + 1) == 0:  # seldom: before versions 2, 4, 8 and so on
        last = rebucket(spark, root, last, bucket_bytes)
    of = bucket_count(spark, root, last)
    touched = [r[0] for r in rows.select(bucket_of(NATURAL_KEY, of)).distinct().collect()]  # no more than there are buckets
    target = snapshot_read_as_of(spark, root, last, touched)
    merged = scd2_apply(target, rows, EVENT_KEY, NATURAL_KEY, "interaction_timestamp", event_order())
    return snapshot_write(merged, root, note, NATURAL_KEY)


def rebucket(spark: SparkSession, root: str, version: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """The version to go on from: one with more buckets if these have grown to twice their size, else the same."""
    rows = snapshot_read_as_of(spark, root, version)
    need = buckets_for(rows, bucket_bytes)
    if need < 2 * bucket_count(spark, root, version):
        return version
    return snapshot_write(rows, root, f"{need} buckets", NATURAL_KEY, need)


def stream_ingest_incremental(spark: SparkSession, folder: str, root: str, checkpoint: str, files_per_batch: int = 1000, bucket_bytes: int = BUCKET_BYTES) -> int | None:
    """Ingest the new ``ratings_<YYYY>.csv`` files of ``folder``; returns the version.

    The stream's checkpoint knows the files that were read. A micro-batch that
    is run again after a failure is recognised by its note, which names the
    checkpoint and the batch, and not applied twice. Several streams, each
    with a checkpoint of its own, may feed one ``root`` in turn.
    """
    raw = (
        spark.readStream.schema(CSV_SCHEMAS["ratings"])
        .option("header", True)
        .option("pathGlobFilter", "ratings_*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
        .withColumn("_batch_year", F.regexp_extract("_metadata.file_name", r"_(\d{4})\.", 1).try_cast("int"))
        .withColumn("_ingestion_timestamp", F.col("_metadata.file_modification_time"))
    )

    def merge(batch: DataFrame, batch_id: int) -> None:
        note = f"{checkpoint} batch {batch_id}"
        own = batch.sparkSession
        done = current_version(own, root) is not None and not own.read.parquet(f"{root}/versions").filter(F.col("note") == note).isEmpty()
        if not done:
            batch.persist()
            try:
                apply_batch(batch, root, note, bucket_bytes)
            finally:
                batch.unpersist()

    stream = raw.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()
    return current_version(spark, root)
