"""Incremental loads of a table's slices from a versioned source.

A run asks the audit which source version each batch was last loaded from,
reads what changed since, and replaces the slices of the batches that the
changes touch. The audit is written last: a run that stops before it is done
again by the next, which replaces the same slices, and a run with nothing new
writes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.versioning import AUDIT, change_feed, impacted_batches, select_batches_to_process
from .tables import available_batches, changed_buckets, current_version, replace_slices, schema_at, snapshot_read_as_of, write_append

#: A batch whose slice holds a version's rows: it was loaded, or the version changed nothing of it.
LOADED, SAME = "SUCCESS", "UNCHANGED"


def snapshot_changes(spark: SparkSession, root: str, old: int, new: int, keys: Sequence[str], kept: Column | str = "true") -> DataFrame:
    """``change_feed`` between two versions of a snapshot, among the rows that ``kept`` holds for.

    Of a table kept by key only the buckets are read that a version in between wrote.
    """
    buckets = changed_buckets(spark, root, old, new)
    before, after = (snapshot_read_as_of(spark, root, v, buckets).filter(kept) for v in (old, new))
    return change_feed(before, after, keys)


@dataclass(frozen=True)
class SliceLoad:
    """A table loaded by batches from the snapshots under ``source_root``.

    ``build`` makes the table's rows of some batches from the source's rows;
    ``kept`` is the condition under which a source row counts, and ``keys``
    tell such rows apart. ``model`` is the version of ``build``: another one
    loads all batches anew.
    """

    source_root: str
    path: str
    audit_path: str
    build: Callable[[DataFrame, list[int]], DataFrame]
    keys: Sequence[str]
    target: str
    source: str
    model: str
    kept: str = "true"
    batch: str = "_batch_year"

    def loaded_versions(self, spark: SparkSession) -> dict[int, int]:
        """Each batch's last loaded source version; one entry per batch."""
        if schema_at(spark, self.audit_path) is None:
            return {}
        own = F.col("target_table") == self.target
        own &= (F.col("source_table") == self.source) & (F.col("model_version") == self.model) & F.col("status").isin(LOADED, SAME)
        found = spark.read.schema(AUDIT).parquet(self.audit_path).filter(own).groupBy("batch").agg(F.max("end_version").alias("v"))
        return {r.batch: r.v for r in found.collect()}

    def touched(self, spark: SparkSession, old: int, new: int) -> set[int]:
        feed = snapshot_changes(spark, self.source_root, old, new, self.keys, self.kept)
        return {r.batch for r in impacted_batches(feed, self.batch).collect()}  # no more than there are batches

    def run(self, spark: SparkSession, run_id: str, force: str = "") -> list[tuple]:
        """Load what the audit says is due, or the batches that ``force`` names; returns the audit's new rows."""
        version = current_version(spark, self.source_root)
        if version is None:
            raise ValueError(f"{self.source_root} has no version")
        rows = snapshot_read_as_of(spark, self.source_root, version).filter(self.kept)
        have, last = available_batches(rows, self.batch), self.loaded_versions(spark)
        if force:
            due = {r.batch for r in select_batches_to_process(have, have.limit(0), None, force).collect()}
            same: set[int] = set()
        else:
            due = {r.batch for r in have.join(_listed(spark, last), "batch", "left_anti").collect()}
            same = set()
            for old in sorted({v for v in last.values() if v < version}):  # mostly one
                batches, hit = {b for b, v in last.items() if v == old}, self.touched(spark, old, version)
                due, same = due | batches & hit, same | batches - hit
        written = replace_slices(self.build(rows, sorted(due)), self.path, self.batch, sorted(due)) if due else {}
        status = [(b, LOADED, written[b]) for b in sorted(due)] + [(b, SAME, 0) for b in sorted(same)]
        audit = [(run_id, self.target, self.source, b, last.get(b), version, self.model, how, n) for b, how, n in status]
        if audit:
            write_append(spark.createDataFrame(audit, AUDIT), self.audit_path)
        return audit


def _listed(spark: SparkSession, batches) -> DataFrame:
    return spark.createDataFrame([(b,) for b in batches], "batch int")
