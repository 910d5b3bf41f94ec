"""Sharding over fixed virtual slots.

Records hash into ``SLOTS`` virtual slots that never change; only the map
from slot to shard does. Bytes are summed per slot, and rebalancing (or
growing) edits a few entries of the map into its next version, which is
stored beside the earlier ones under ``root``: a run starts from the latest
stored map, and stores a new one only where it moved a slot. The law this gives is ``bytes``: shard sizes
near equal, to within what the smallest slots can even out.

Edge cases: a null text has no bytes (size 1, checksum 0); null ids hash with
their text; equal records share a virtual slot, not a task; an empty table keeps the first map;
only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import heapq
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import exists, work_dir
from .storage import materialize

SLOTS = 4096
#: Rows that one task ranks at a time, on average.
RANKED = 20_000
_SALTS = 1024


@dataclass(frozen=True)
class SlotMap:
    """Version ``version`` of the assignment: ``shard[slot]``."""

    version: int
    shard: np.ndarray

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(self.version, s, int(x)) for s, x in enumerate(self.shard)]
        return spark.createDataFrame(rows, "version int, vslot int, shard int")

    def save(self, spark: SparkSession, root: str) -> None:
        """Add this version to those under ``root``; a version is written once."""
        self.frame(spark).drop("version").coalesce(1).write.parquet(f"{root}/version={self.version}")


def load_map(spark: SparkSession, root: str, version: int | None = None) -> SlotMap | None:
    """The latest map under ``root`` (None without one), or the named version; ``SLOTS`` rows."""
    if not exists(spark, root):
        return None
    every = spark.read.parquet(root)
    if version is None:
        version = every.agg(F.max("version")).first()[0]
    rows = every.filter(F.col("version") == version).orderBy("vslot").collect()
    return SlotMap(version, np.array([r.shard for r in rows], np.int64))


def first_map(shards: int, slots: int = SLOTS) -> SlotMap:
    """Version 0: contiguous runs of slots, equal in number."""
    return SlotMap(0, np.arange(slots) * shards // slots)


def _even_out(shard: np.ndarray, load: np.ndarray, gap: int, hi: int, lo: int) -> bool:
    """The move or swap between two shards that best halves their gap, if any."""
    mine = np.flatnonzero((shard == hi) & (load > 0))
    theirs = np.append(-1, np.flatnonzero((shard == lo) & (load > 0)))
    if not len(mine):
        return False
    give, take = load[mine], np.where(theirs < 0, 0, load[theirs])
    order = np.argsort(take, kind="stable")
    at = np.searchsorted(take[order], give - gap / 2)
    best = gap, 0, -1
    for near in (at.clip(0, len(take) - 1), (at - 1).clip(0)):
        left = np.abs(gap - 2 * (give - take[order[near]]))
        k = int(left.argmin())
        if left[k] < best[0]:
            best = left[k], mine[k], theirs[order[near[k]]]
    if best[0] >= gap:
        return False
    shard[best[1]] = lo
    if best[2] >= 0:
        shard[best[2]] = hi
    return True


def rebalance(old: SlotMap, load: np.ndarray, shards: int) -> SlotMap:
    """The next version: few slots move until shard loads are near equal.

    Shards from ``shards`` on are closed and release all their slots, empty
    ones too. Overloaded shards release slots down to the mean, released slots go to
    the lightest shards, largest first, and then single moves or swaps
    between the heaviest and the lightest shard even out the rest.
    """
    shard = old.shard.copy()
    open_ = shard < shards
    total = np.bincount(shard[open_], load[open_], shards).astype(np.int64)
    mean = load.sum() / shards
    free: list[int] = np.flatnonzero(~open_).tolist()
    for s in range(shards):
        own = np.flatnonzero(shard == s)
        for slot in own[np.argsort(-load[own], kind="stable")]:
            if total[s] - load[slot] >= mean and load[slot]:
                total[s] -= load[slot]
                free.append(slot)
    heap = [(int(total[s]), s) for s in range(shards)]
    heapq.heapify(heap)
    for slot in sorted(free, key=lambda x: (-load[x], x)):
        have, s = heapq.heappop(heap)
        shard[slot] = s
        heapq.heappush(heap, (have + int(load[slot]), s))
    for _ in range(len(shard)):
        total = np.bincount(shard, load, shards).astype(np.int64)
        pairs = sorted(((total[h] - total[l], h, l) for h in range(shards) for l in range(shards)), reverse=True)
        if not any(_even_out(shard, load, *pair) for pair in pairs if pair[0] > 1):
            break
    return SlotMap(old.version + 1, shard)


def slot_records(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """Rows (id, size, crc, vslot, salt): a record's bytes, its virtual slot, and what parts equal records."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    crc = F.crc32(text.cast("binary"))
    return df.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        crc.alias("crc"),
        F.pmod(F.xxhash64(F.col(id_col), crc), F.lit(slots)).cast("int").alias("vslot"),
        F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS)).cast("int").alias("salt"),
    )


def slot_loads(records: DataFrame, slots: int = SLOTS) -> tuple[np.ndarray, int]:
    """Bytes per slot, and the number of rows."""
    load, rows = np.zeros(slots, np.int64), 0
    for r in records.groupBy("vslot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect():
        load[r.vslot] = r.b  # at most ``slots`` rows
        rows += r.n
    return load, rows


def place(records: DataFrame, mapping: SlotMap, rows: int) -> DataFrame:
    """Add each record's shard and its gapless place there, from 0.

    Slots are ranked in pieces of about ``RANKED`` rows; a piece's first
    place is the sum of the pieces before it in the shard.
    """
    pieces = max(1, -(-rows // (len(mapping.shard) * RANKED)))
    spark = records.sparkSession
    cut = records.withColumn("piece", F.pmod(F.xxhash64("crc", "id", "salt"), F.lit(pieces)).cast("int"))
    sizes = cut.groupBy("vslot", "piece").agg(F.count("*").alias("n")).join(mapping.frame(spark), "vslot")
    before = Window.partitionBy("shard").orderBy("vslot", "piece").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("vslot", "piece", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rank = F.row_number().over(Window.partitionBy("vslot", "piece").orderBy("id", "crc", "size"))
    ranked = cut.withColumn("rank", rank)
    return ranked.join(first, ["vslot", "piece"]).select(
        "id", "size", "crc", "vslot", "shard", (F.col("first") + F.col("rank") - 1).alias("place")
    )


def shard_records(
    df: DataFrame, shards: int = 16, root: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, SlotMap]:
    """Place every row of ``df`` by the map under ``root``; returns the rows and the map.

    The latest stored map is rebalanced for these rows and ``shards`` shards,
    and becomes the next version if that moves a slot. A first map is stored
    as version 0. Without ``root`` the map lives as long as the application.
    """
    spark = df.sparkSession
    root = root or f"{work_dir(spark)}/slot-map-{uuid.uuid4().hex}"
    records = materialize(slot_records(df, id_col, text_col), "slots")
    load, rows = slot_loads(records)
    old = load_map(spark, root)
    if old is None:
        old = first_map(shards)
        old.save(spark, root)
    new = rebalance(old, load, shards)
    if np.array_equal(new.shard, old.shard):
        return place(records, old, rows), old
    new.save(spark, root)
    return place(records, load_map(spark, root, new.version), rows), new


def op10_fixed_slot_sharding(spark, sf_dir: str) -> DataFrame:
    placed, mapping = shard_records(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("vslot").alias("virtual_slot"),
        F.lit(mapping.version).alias("map_version"),
    )
