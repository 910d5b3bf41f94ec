import duckdb
import numpy as np
from lakeloom.llm import embedding_dedup as e


def slow(rows, t=0.9):
    ok = lambda v: v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    n, root = len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * n
    for i in range(n):
        for j in range(i):
            (a, x), (b, y) = rows[i], rows[j]
            if ok(x) and ok(y) and len(x) == len(y):
                x, y = np.array(x, float), np.array(y, float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= t:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    least = {}
    for i, (a, _) in enumerate(rows):
        if a is not None:
            least[find(i)] = min(a, least.get(find(i), a))
    out = [(a, links[i], least.get(find(i)), a == least.get(find(i))) for i, (a, _) in enumerate(rows)]
    return sorted(out, key=str)


def test_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf_dir}/embeddings.parquet'")
    got = sorted(map(tuple, e.op6_embedding_near_dedup(spark, sf_dir).collect()))
    assert got == sorted(con.execute(e.ORACLE_SQL).fetchall())


def test_cells_and_blocks_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = []
    for g in range(60):
        base = rng.normal(size=24)
        for _ in range(1 + g % 9):
            rows.append(base + rng.normal(size=24) * rng.choice([0.0, 0.05, 0.25]))
    hot = rng.normal(size=24)
    rows += [hot + rng.normal(size=24) * 0.02 for _ in range(120)] + [hot] * 80
    data = [(i, x.astype(np.float32).tolist()) for i, x in enumerate(rows)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").selectExpr("*", "1 as id", "2 as v")
    want = slow(data)
    monkeypatch.setattr(e, "BLOCK", 32)
    assert sorted((tuple(r) for r in e.embedding_groups(df).collect()), key=str) == want
    monkeypatch.setattr(e.math, "ceil", lambda x: 8)  # eight cells
    got = sorted((tuple(r) for r in e.embedding_groups(df).collect()), key=str)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert found <= there and found >= 0.99 * there


def planted(rng, n, d, rank):
    """Vectors of the given rank, half of them partners of the other half at cosine 0.90 to 0.93."""
    axes = np.linalg.qr(rng.normal(size=(d, rank)))[0].T
    a = e._unit(rng.normal(size=(n // 2, rank)) @ axes)
    step = rng.normal(size=(n // 2, rank)) @ axes
    step = e._unit(step - (step * a).sum(1, keepdims=True) * a)
    t = rng.uniform(0.90, 0.93, size=(n // 2, 1))
    return np.concatenate([a, t * a + np.sqrt(1 - t**2) * step])


def test_recall_on_larger_table(spark, monkeypatch):
    """Over 5,000 classes in several cells, with links planted just over the threshold."""
    monkeypatch.setattr(e, "CELL", 1024)
    x = planted(np.random.default_rng(1), 5000, 48, 48).astype(np.float32)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    y = e._unit(x)
    want = (y @ y.T >= 0.9).sum(axis=1) - 1
    groups = e.embedding_groups(df)
    got = {r.id: r.n_links for r in groups.collect()}
    assert e._train(e._classes(df.selectExpr("vec_id id", "embedding v")))[1][0].shape[0] >= 4
    assert len(got) == len(x) and all(got[i] <= want[i] for i in got)
    assert sum(got.values()) >= 0.99 * want.sum() > 4000


def test_pairs_meet_in_hundreds_of_cells():
    """Share of planted pairs in one cell, for vectors of full and of low rank."""
    rng = np.random.default_rng(8)
    for d, rank, n in ((64, 64, 20_000), (64, 8, 20_000), (256, 24, 12_000)):
        x = planted(rng, n, d, rank)
        c = e.spherical_kmeans(x[rng.permutation(n)[:6000]], 200)
        home, visit = e.visits(x, c, e.spread(x[:6000], c), 0.9)
        a, b = home[: n // 2], home[n // 2 :]
        meet = (a == b) | visit[np.arange(n // 2), b] | visit[n // 2 + np.arange(n // 2), a]
        assert len(c) >= 150 and meet.mean() >= 0.99, (d, rank, meet.mean())
        assert visit.sum(axis=1).mean() < 0.25 * len(c)


def test_few_cells_are_visited_where_vectors_share_a_direction():
    """200 cells, pairs at cosine 0.905; unlike in all directions, or about a common mean."""
    rng, d, n = np.random.default_rng(3), 128, 6000
    for mean, most in ((0.0, 5), (0.2, 6), (0.5, 8), (0.7, 15)):
        x = e._unit(rng.normal(size=(n, d)))
        x = e._unit(np.sqrt(1 - mean) * x + np.sqrt(mean) * np.eye(d)[0])
        step = rng.normal(size=(n, d))
        step = e._unit(step - (step * x).sum(1, keepdims=True) * x)
        y = 0.905 * x + np.sqrt(1 - 0.905**2) * step
        c = e.spherical_kmeans(x, 200)
        wide = e.spread(x, c)
        (a, va), (b, vb) = (e.visits(v, c, wide, 0.9) for v in (x, y))
        k = np.arange(n)
        met = (a == b) | va[k, b] | vb[k, a]
        assert len(c) == 200 and met.mean() >= 0.99 and va.sum(axis=1).mean() <= most, (mean, met.mean(), va.sum(axis=1).mean())


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]),
            (8, [2.0, 0.0]), (8, [2.0, 0.0]), (None, [1.0, 0.1]), (None, [0.0, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [-0.0, -1.0]), (11, [0.0, -1.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = sorted((tuple(r) for r in e.embedding_groups(df).collect()), key=str)
    assert got == [(a, n, c, a == c) for a, n, c, _ in slow(data)]
    assert e.embedding_groups(df.limit(0)).count() == 0
