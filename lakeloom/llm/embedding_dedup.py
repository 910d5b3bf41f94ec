"""Near-duplicate embeddings by spherical k-means cells.

Equal vectors form one class, and classes are compared instead of rows.
Spherical k-means on a bounded sample (``SAMPLE`` classes of least hash, at
most ``SAMPLE_BYTES``) gives cells; every class is assigned to its home cell
and also visits cells whose border with its home is near. A step to a vector
at the threshold's angle, in a direction drawn from the spread that the sample
shows around its centroids, crosses a border with a normal's length; the two
vectors' distances from the border add up to it, so one of them is at most
half of it away. So vectors visit as far as half of ``Z`` deviations, and a
pair is missed with the probability of a normal beyond ``Z``. A cell's home
and visiting vectors are cut into blocks, and each pair of blocks is compared
in one task, as products in double precision; two visitors meet in another
cell, and a pair that meets in both its home cells counts in the later one.
Per pair of blocks only link counts and a spanning forest leave the task. The
smallest id of a group is kept.

Cells hold about ``max(CELL, 4 sqrt(n))`` classes, so small tables have one
cell and are compared exactly; at most ``CELLS`` centroids travel to tasks. A
vector is sent once per block of the cells that it is in, so blocks are as
large as a task can hold (``BLOCK`` vectors, at most ``BLOCK_BYTES``).

Edge cases: vectors that are null, empty or zero, or hold null or non-finite
components, link with nothing; vectors of different lengths do not link;
repeated rows link with each other; a null id names no group unless its group
has no id; an empty table gives an empty table; only the id and the vector
are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components, forest
from .runs import runs
from .storage import materialize

SAMPLE, SAMPLE_BYTES = 20_000, 32 << 20
#: Least classes that a cell is made for, and most cells: fewer, larger cells have fewer visitors.
CELL, CELLS = 4096, 4096
BLOCK, BLOCK_BYTES = 8192, 16 << 20
Z = 2.8
#: Rows of a block whose products are held at once.
_STEP = 256
_ROUNDS = 12


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # norms neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int) -> np.ndarray:
    """Unit centroids of unit vectors; deterministic, empty cells dropped."""
    picked = [0]
    far = x @ x[0]
    for _ in range(min(k, len(x)) - 1):  # farthest-first start
        picked.append(int(far.argmin()))
        far = np.maximum(far, x @ x[picked[-1]])
    c = x[picked]
    for _ in range(_ROUNDS):
        home = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, home, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), c)
    return c[np.unique((x @ c.T).argmax(axis=1))]


def spread(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Centroids in coordinates where distance is the deviation of a step from a vector to a neighbour.

    A step has unit length and the directions of the sample around its
    centroids; no direction counts for less than one of all ``d`` alike.
    """
    rest = x - c[(x @ c.T).argmax(axis=1)]
    values, axes = np.linalg.eigh(rest.T @ rest)
    share = values / max(values.sum(), 1e-300)
    return (c @ axes) * np.sqrt(np.maximum(share, 1 / max(x.shape[1] - 1, 1)))


def visits(x: np.ndarray, c: np.ndarray, wide: np.ndarray, threshold: float, z: float = Z) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each unit vector, and which others it visits; ``wide`` is the centroids' ``spread``."""
    dots = x @ c.T
    home = dots.argmax(axis=1)
    own, norm = wide[home], (wide**2).sum(axis=1)
    sd = np.sqrt(np.maximum(norm[home][:, None] + norm[None, :] - 2 * (own @ wide.T), 0))
    gap = dots[np.arange(len(x)), home][:, None] - dots
    reach = z / 2 * math.sqrt(1 - threshold**2) / threshold
    return home, (gap <= reach * sd) & (np.arange(len(c))[None, :] != home[:, None])


def _classes(rows: DataFrame) -> DataFrame:
    usable = F.size("v") > 0
    usable &= ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable &= F.exists("v", lambda x: x != 0)
    good = rows.filter(F.coalesce(usable, F.lit(False)))
    found = good.groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    return found.withColumn("node", F.monotonically_increasing_id())


def _train(classes: DataFrame) -> tuple[int, tuple[np.ndarray, np.ndarray] | None]:
    """Number of components that most vectors have, their centroids and the centroids' spread."""
    sizes = classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return 0, None
    d, n = sizes
    k = min(CELLS, math.ceil(n / max(CELL, 4 * math.sqrt(n))))
    if k < 2:
        return d, None
    take = min(SAMPLE, SAMPLE_BYTES // (8 * d))
    sample = classes.filter(F.size("v") == d).select("v").orderBy(F.xxhash64("v"), "v").limit(take)
    x = _unit(np.array([r.v for r in sample.collect()]))
    c = spherical_kmeans(x, k)
    return d, (c, spread(x, c))


def _assign(classes: DataFrame, d: int, trained: tuple[np.ndarray, np.ndarray] | None, threshold: float) -> DataFrame:
    shared = classes.sparkSession.sparkContext.broadcast(trained)  # at most 2 * CELLS vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = shared.value
        for b in batches:
            homes, others = np.zeros(b.num_rows, np.int32), [[]] * b.num_rows
            lens = b.column(1).value_lengths().to_numpy()
            at = np.flatnonzero(lens == d)
            if trained is not None and len(at):
                x = b.column(1).take(pa.array(at)).flatten().to_numpy().reshape(-1, d)
                for k in range(0, len(at), 2048):
                    home, visit = visits(_unit(x[k : k + 2048]), *trained, threshold)
                    homes[at[k : k + 2048]] = home
                    for i, row in zip(at[k : k + 2048].tolist(), visit):
                        others[i] = np.flatnonzero(row).tolist()
            cols = [*b.columns, pa.array(lens), pa.array(homes), pa.array(others, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([x.cast(pa.int32()) if k == 3 else x for k, x in enumerate(cols)], names)

    names = ["node", "v", "n", "d", "home", "visits"]
    kind = dict(classes.dtypes)["v"]
    return classes.select("node", "v", "n").mapInArrow(run, f"node long, v {kind}, n long, d int, home int, visits array<int>")


def _dealt(placed: DataFrame) -> DataFrame:
    """Rows per pair of blocks i <= j of a cell: (d, cell, i, j, side, own, node, n, v, home, visits).

    Only a cell's own rows tell which cells they visit, to find the pairs that meet there as well.
    """
    home = placed.select("d", F.col("home").alias("cell"), F.lit(True).alias("own"), "node", "n", "v", "home", "visits")
    visit = placed.select("d", F.explode("visits").alias("cell"), F.lit(False).alias("own"), "node", "n", "v", "home")
    visit = visit.withColumn("visits", F.lit(None).cast("array<int>"))
    rows = home.unionByName(visit)
    most = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_BYTES) / (8 * F.col("d")))))
    sizes = rows.groupBy("d", "cell").agg(F.count("*").alias("m"))
    sizes = materialize(sizes.select("d", "cell", F.ceil(F.col("m") / most).cast("int").alias("blocks")), "sizes")
    pair = lambda i, j, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))
    none = F.array().cast("array<int>")
    b, last = F.col("b"), F.col("blocks") - 1
    earlier = F.when(b > 0, F.sequence(F.lit(0), b - 1)).otherwise(none)
    to = F.concat(F.transform(F.sequence(b, last), lambda j: pair(b, j, 0)), F.transform(earlier, lambda i: pair(i, b, 1)))
    cut = rows.join(sizes, ["d", "cell"]).withColumn("b", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    sent = cut.select("d", "cell", F.explode(to).alias("to"), "own", "node", "n", "v", "home", "visits")
    return sent.select("d", "cell", "to.i", "to.j", "to.side", "own", "node", "n", "v", "home", "visits")


def _also_met(cell: int, own: np.ndarray, home: np.ndarray, visits: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """What tells a cell's pairs that meet in a later home cell too: ``table[own row, at[visitor]]``."""
    homes = np.unique(home[~own & (home > cell)])
    table = np.zeros((len(own), len(homes) + 1), bool)
    row = np.repeat(np.arange(len(own)), visits.value_lengths().fill_null(0).to_numpy())
    to = visits.flatten().to_numpy()
    place = np.searchsorted(homes, to)
    hit = place < len(homes)
    hit[hit] = homes[place[hit]] == to[hit]
    table[row[hit], place[hit]] = True
    at = np.full(len(own), len(homes))
    late = ~own & (home > cell)
    at[late] = np.searchsorted(homes, home[late])
    return table, at


def _compare(threshold: float):
    def found(x: np.ndarray, n: np.ndarray, own: np.ndarray, met: tuple, left: np.ndarray, right: np.ndarray, links: np.ndarray):
        """Near pairs of rows, a few left rows at a time; adds to ``links``."""
        same, (table, place) = left is right, met
        for mine in (left[own[left]], left[~own[left]]):
            first = bool(mine.size and own[mine[0]])
            others = right if first else right[own[right]]
            y = x[others].T
            for k in range(0, len(mine), _STEP):
                at = mine[k : k + _STEP]
                near = x[at] @ y >= threshold
                if table.shape[1] > 1:
                    near &= ~(table[at][:, place[others]] if first else table[others][:, place[at]].T)
                if same:
                    near &= at[:, None] != others[None, :]
                else:
                    links[others] += n[at] @ near
                links[at] += near @ n[others]
                a, b = np.nonzero(near)
                if len(a):
                    yield at[a], others[b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, 4):
            d, cell, i, j = (t.column(k)[0].as_py() for k in range(4))
            side, own = t.column(4).to_numpy(), t.column(5).to_numpy()
            node, n = t.column(6).to_numpy(), t.column(7).to_numpy()
            x = _unit(t.column(8).combine_chunks().flatten().to_numpy().reshape(-1, d))
            left = np.flatnonzero(side == 0)
            right = left if i == j else np.flatnonzero(side == 1)
            links, trees = np.zeros(len(x), np.int64), []
            met = _also_met(cell, own, t.column(9).to_numpy(), t.column(10).combine_chunks())
            for a, b in found(x, n, own, met, left, right, links):
                trees.append(forest(node[a], node[b]))
            if not trees:
                continue
            low, high = forest(*(np.concatenate(side) for side in zip(*trees)))
            who = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([node[who], low])),
                    pa.array([None] * len(who) + high.tolist(), pa.int64()),
                    pa.array(np.concatenate([links[who], np.zeros(len(low), np.int64)])),
                ],
                ["a", "b", "links"],
            )

    return run


def embedding_groups(
    df: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Rows (id, n_links, component_id, kept), one per row of ``df``."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    classes = materialize(_classes(rows), "classes")
    placed = materialize(_assign(classes, *_train(classes), threshold), "placed")
    keys = ["d", "cell", "i", "j"]
    dealt = _dealt(placed).repartition(*keys).sortWithinPartitions(*keys)
    found = materialize(dealt.mapInArrow(_compare(threshold), "a long, b long, links long"), "links")
    links = found.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    nodes = connected_components(found.filter("b is not null").select("a", "b"))
    named = classes.join(nodes, "node", "left").join(links, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = materialize(named.select("v", "n", "least", "component", F.coalesce("links", F.lit(0)).alias("links")), "named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    done = materialize(named.join(least, "component").select("v", "n", "links", "component_id", F.lit(True).alias("usable")), "done")
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("id"))
    return rows.join(done, "v", "left").select(
        "id",
        F.coalesce(F.col("n") - 1 + F.col("links"), F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def op6_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return embedding_groups(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumnRenamed("id", "vec_id")


ORACLE_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(embedding) > 0 AND list_aggregate(list_transform(embedding, lambda x: (x IS NULL OR NOT isfinite(x))::INT), 'sum') = 0
    AND list_aggregate(list_transform(embedding, lambda x: abs(x)), 'max') > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = least.vec_id) AS n_links, component_id,
  vec_id = component_id AS kept FROM least
"""
