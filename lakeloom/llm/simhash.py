"""SimHash near-duplicates by a generalised pigeonhole principle.

Each text gets a 64-bit fingerprint. Fingerprints within ``tau`` bits link.
The 64 bits are grouped into ``tau + 1`` parts of correlated bits, and each
fingerprint gets its own threshold per part, chosen by dynamic programming on
estimated candidate counts, such that the thresholds add up to
``tau - parts + 1 = 0``: two fingerprints within ``tau`` bits then agree
within the threshold on some part (Qin et al., "GPH: Similarity Search in
Hamming Space", ICDE 2018). A part with threshold -1 is not probed, so a
fingerprint avoids parts where its bits are common. Probes meet the index by
(part, value); large buckets are cut into blocks; every candidate is verified.

Edge cases: null, empty and all-blank texts have fingerprint zero and are
linked like any other; repeated rows and equal texts share a fingerprint and
so a component; null ids get a row, but never name a component (a component
of null ids only is null); only the id and text columns are read, so other
columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected_components, forest
from .storage import materialize

BITS = 64
#: Cells of the candidate-count histogram per part; bounds what is broadcast.
SKETCH = 1 << 16
#: Rows of a bucket above which it is cut into blocks of about this many.
BLOCK = 2048
_PIECE = 1 << 16


def fingerprint(text: bytes | None, width: int) -> int:
    """Majority bits over XXH64(seed 42) of the word shingles, as unsigned."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(width, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    ones, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for k in range(0, len(starts), _PIECE):
        spans = zip(starts[k : k + _PIECE], ends[k : k + _PIECE])
        hashes = np.array([digest(joined[s:e], 42) for s, e in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """One row (id, fp) per document; fp is the fingerprint as a signed long."""
    ids = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(x.as_py(), width) for x in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    schema = T.StructType([T.StructField("id", ids), T.StructField("fp", T.LongType())])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, schema)


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_correlations(reps: DataFrame) -> np.ndarray:
    """Absolute correlations of the 64 bits over all rows; 64 x 64 numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            x = _bits(b.column(0).to_numpy(zero_copy_only=False).astype("<i8")).astype(np.float32)
            both += x.T @ x
            n += len(x)
        i, j = np.triu_indices(BITS)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(i, -1)), pa.array(np.append(j, -1)), pa.array(np.append(both[i, j], float(n)))],
                ["i", "j", "n"],
            )

    sums = reps.select("fp").mapInArrow(run, "i long, j long, n double").groupBy("i", "j").agg(F.sum("n").alias("n"))
    both, n = np.zeros((BITS, BITS)), 1.0
    for i, j, x in sums.collect():  # 2081 rows, whatever the input
        if i < 0:
            n = x
        else:
            both[i, j] = both[j, i] = x
    p = np.diag(both) / n
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    return np.abs((both / n - np.outer(p, p)) / np.outer(sd, sd))


def group_bits(corr: np.ndarray, parts: int) -> list[list[int]]:
    """Parts of near-equal width; each grows by the bit most correlated to it."""
    left, out = set(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        rest = sorted(left)
        own = corr[np.ix_(rest, rest)] - np.eye(len(rest))
        part = [rest[int(own.max(axis=1).argmax())]]
        left.remove(part[0])
        while len(part) < size:
            rest = sorted(left)
            part.append(rest[int(corr[np.ix_(rest, part)].mean(axis=1).argmax())])
            left.remove(part[-1])
        out.append(sorted(part))
    return out


def part_values(fps: np.ndarray, part: list[int]) -> np.ndarray:
    fps, out = fps.view(np.uint64), np.zeros(len(fps), np.int64)
    for k, bit in enumerate(part):
        out |= ((fps >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << k
    return out


def _cell(values: np.ndarray) -> np.ndarray:
    return ((values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 16)).astype(np.int64)


def allocate(costs: np.ndarray, tau: int) -> np.ndarray:
    """Thresholds per row and part that minimise the summed cost.

    ``costs[p, e + 1]`` holds each row's cost of threshold ``e`` (-1 to tau)
    on part ``p``. Dynamic programming over parts and threshold sums; the
    sum is ``tau - parts + 1``, as the generalised pigeonhole asks.
    """
    parts, levels, n = costs.shape
    total = tau + 1  # of the thresholds, each counted from -1
    best, back = np.full((total + 1, n), np.inf), np.zeros((parts, total + 1, n), np.int8)
    best[0] = 0
    for p in range(parts):
        new = np.full_like(best, np.inf)
        for s in range(total + 1):
            for e in range(min(levels - 1, s) + 1):
                c = best[s - e] + costs[p, e]
                better = c < new[s]
                new[s][better], back[p, s][better] = c[better], e
        best = new
    out, s, rows = np.zeros((n, parts), np.int64), np.full(n, total), np.arange(n)
    for p in reversed(range(parts)):
        out[:, p] = back[p, s, rows]
        s = s - out[:, p]
    return out - 1


def neighbours(values: np.ndarray, width: int, radius: int) -> np.ndarray:
    """Values within ``radius`` bits of each value, as rows."""
    masks, ring = [0], [0]
    for _ in range(radius):
        ring = sorted({m | 1 << k for m in ring for k in range(width) if not m >> k & 1})
        masks += ring
    return values[:, None] ^ np.array(masks, np.int64)[None, :]


INDEX, PROBE = 1, 2


def _probes(reps: DataFrame, parts: list[list[int]], tau: int) -> DataFrame:
    """Rows (part, value, fp, role): every fingerprint indexed and probing."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(parts), SKETCH), np.int64)
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False)
            for p, part in enumerate(parts):
                seen[p] += np.bincount(_cell(part_values(fps, part)), minlength=SKETCH)
        p, c = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(c), pa.array(seen[p, c])], ["p", "c", "n"])

    counts = reps.select("fp").mapInArrow(cells, "p long, c long, n long").groupBy("p", "c").agg(F.sum("n").alias("n"))
    sketch = np.zeros((len(parts), SKETCH))
    for b in counts.toArrow().to_batches():  # at most len(parts) * SKETCH rows
        sketch[b.column(0).to_numpy(), b.column(1).to_numpy()] = b.column(2).to_numpy()
    shared = reps.sparkSession.sparkContext.broadcast(sketch)  # len(parts) * 512 KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = shared.value
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False)
            for k in range(0, len(fps), 20_000):
                some = fps[k : k + 20_000]
                vals = [part_values(some, x) for x in parts]
                costs = np.zeros((len(parts), tau + 2, len(some)))
                for p, part in enumerate(parts):
                    w = len(part)
                    zero = seen[p][_cell(vals[p])]
                    one = seen[p][_cell(neighbours(vals[p], w, 1))].sum(axis=1) if tau else zero
                    costs[p, 1] = zero + 1
                    for e in range(1, tau + 1):  # rings beyond the first by extrapolation
                        grow = np.prod([(w - i) / (i + 1) for i in range(1, e)]) if e > 1 else 1
                        costs[p, e + 1] = costs[p, e] + (one - zero + w) * grow
                chosen = allocate(costs, tau)
                out: list[list[np.ndarray]] = []
                for p, part in enumerate(parts):
                    probing = chosen[:, p] >= 0
                    role = np.where(probing, INDEX | PROBE, INDEX)
                    out.append([np.full(len(some), p), vals[p], some, role])
                    for e in range(1, tau + 1):
                        wide = chosen[:, p] == e
                        if wide.any():
                            near = neighbours(vals[p][wide], len(part), e)[:, 1:]
                            far = near.shape[1]
                            out.append(
                                [
                                    np.full(near.size, p),
                                    near.ravel(),
                                    np.repeat(some[wide], far),
                                    np.full(near.size, PROBE),
                                ]
                            )
                cols = [np.concatenate(x) for x in zip(*out)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0].astype(np.int32)), pa.array(cols[1]), pa.array(cols[2]), pa.array(cols[3].astype(np.int32))],
                    ["part", "value", "fp", "role"],
                )

    return reps.select("fp").mapInArrow(run, "part int, value long, fp long, role int")


def _links(tau: int):
    """Verify the candidates of each bucket block; emit a forest per block."""

    def bucket(fps: np.ndarray, role: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        index, probe = fps[role & INDEX > 0], fps[role & PROBE > 0]
        a, b = [], []
        for k in range(0, len(probe), 1024):
            far = np.bitwise_count(probe[k : k + 1024, None].view(np.uint64) ^ index[None, :].view(np.uint64))
            i, j = np.nonzero((far <= tau) & (probe[k : k + 1024, None] < index[None, :]))
            a.append(probe[k + i])
            b.append(index[j])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        return forest(a, b) if len(a) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def emit(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            keys, fps, role = cols[:-2], cols[-2], cols[-1]
            new = np.zeros(len(fps), bool)
            new[0] = True
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            starts = np.flatnonzero(new)
            sizes = np.diff(np.append(starts, len(fps)))
            found = [bucket(fps[s : s + n], role[s : s + n]) for s, n in zip(starts[sizes > 1], sizes[sizes > 1])]
            found = [x for x in found if x]
            if found:
                a, b = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(cols[0]):
                continue
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            last = np.ones(len(cols[0]), bool)
            for k in cols[:-2]:
                last &= k == k[-1]
            cut = int(np.argmax(last))  # sorted by key: the last key's rows are a suffix
            held = [c[cut:] for c in cols]
            if cut:
                yield from emit([c[:cut] for c in cols])
        if held is not None:
            yield from emit(held)

    return run


def near_links(reps: DataFrame, tau: int = 2, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that join all distinct ``fp`` values within ``tau`` bits.

    Per bucket block only a spanning forest is emitted, so a bucket of n
    fingerprints yields under n edges. A bucket of over ``block`` rows is cut
    into index blocks and probe blocks that meet pairwise in separate tasks.
    """
    parts = group_bits(bit_correlations(reps), tau + 1)
    rows = _probes(reps, parts, tau)
    rows = materialize(rows, "probes")
    sizes = rows.groupBy("part", "value").agg(F.count("*").alias("n")).filter(F.col("n") > block)
    large = materialize(sizes.select("part", "value", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "large")
    at = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    cut = rows.join(large, ["part", "value"], "left")
    small = cut.filter("blocks is null").select(
        "part", "value", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp", "role"
    )
    hot = cut.filter("blocks is not null").withColumn("at", at)
    index = hot.filter(F.col("role").bitwiseAND(INDEX) > 0).select(
        "part", "value", F.col("at").alias("i"), F.explode(every).alias("j"), "fp", F.lit(INDEX).alias("role")
    )
    probe = hot.filter(F.col("role").bitwiseAND(PROBE) > 0).select(
        "part", "value", F.explode(every).alias("i"), F.col("at").alias("j"), "fp", F.lit(PROBE).alias("role")
    )
    keys = ["part", "value", "i", "j"]
    dealt = small.unionByName(index).unionByName(probe).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(_links(tau), "a long, b long")


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, tau: int = 2
) -> DataFrame:
    """Rows (id, fp, component_id), one per input row; see the module's notes.

    ``component_id`` is the smallest id reachable over links of at most
    ``tau`` differing bits, the document itself included.
    """
    fps = materialize(fingerprints(docs, id_col, text_col, width), "fingerprints")
    reps = materialize(fps.groupBy("fp").agg(F.min("id").alias("least")), "reps")
    nodes = connected_components(near_links(reps, tau))
    # Only fingerprints in a component of several have a node; labels are fingerprints.
    named = reps.join(nodes.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.select("fp", "least", F.coalesce("component", "fp").alias("component"))
    named = materialize(named, "named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    least = materialize(named.join(least, "component").select("fp", "component_id"), "least")
    return fps.join(least, "fp", "left").select("id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` of which each group's smallest id remains.

    Columns stay as they are, whatever their names. Rows that repeat an id are one document and
    one row of them stays. Rows with a null id stay only where their whole
    group has no id, one per fingerprint group.
    """
    groups = materialize(simhash_groups(docs, id_col, text_col), "groups")
    keep = groups.filter("id = component_id").select(F.col("id").alias(id_col)).distinct()
    kept = docs.join(keep, id_col, "left_semi").dropDuplicates([id_col])
    nameless = docs.filter(F.col(id_col).isNull())
    if nameless.isEmpty():
        return kept
    lone = groups.filter("id is null and component_id is null").select("fp").distinct()
    number = F.monotonically_increasing_id().alias("number")
    marked = materialize(nameless.select(number, F.struct("*").alias("row")), "nameless")
    texts = marked.select("number", F.col("row")[text_col].alias("text"))
    own = fingerprints(texts, "number", "text").join(lone, "fp", "left_semi")
    first = own.groupBy("fp").agg(F.min("id").alias("number")).select("number")
    return kept.unionByName(marked.join(first, "number", "left_semi").select("row.*"))


def op8_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash_groups(docs).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
