import math

import numpy as np
import pytest
from lakeloom.llm import whitening as w


def brute(rows):
    """Rows (vec_id, x) and what the covariance of the distinct x gives."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = (n * np.array(fit) - np.array(sums)) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return kept, n, sums, values[::-1], vectors[:, ::-1]


def check(got, rows, components=w.COMPONENTS):
    kept, n, sums, values, vectors = brute(rows)
    k = min(components, int((values > 1e-12 * values[0]).sum()))
    assert sorted((r.vec_id, r.component) for r in got) == sorted((i, c + 1) for i, _ in kept for c in range(k))
    x = dict(kept)
    table = {(r.vec_id, r.component): r for r in got}
    sign = {}
    for (i, c), r in table.items():
        far = [n * a - s for a, s in zip(x[i], sums)]
        assert r.n == n and r.deviation == sum(a * a for a in far)
        z = float(np.array(far) / n @ vectors[:, c - 1]) / math.sqrt(values[c - 1])
        s = sign.setdefault(c, 1 if z * r.whitened >= 0 else -1)
        assert abs(s * r.whitened - z) < 1e-6, (i, c)
        assert abs(r.explained - values[c - 1] / values.sum()) < 1e-9 and r.identity_error < 1e-9


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    df = w.op12_jacobi_davidson_whitening(spark, sf_dir)
    assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(df.collect(), rows)


def test_odd_rows(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(k, [float(c) for c in rng.standard_normal(5) * [5, 4, 3, 2, 0]]) for k in range(60)]
    rows += [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] * 5), (103, [float("inf")] * 5), *[(200 + k, rows[0][1]) for k in range(50)]]
    extra = [(300, []), (301, [1.0]), (302, [1e30, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows + extra, "vec_id long, embedding array<float>").selectExpr("*", "1 as x", "2 as id", "3 as deviation", "4 as `a.b`")
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    check(w.op12_jacobi_davidson_whitening(spark, str(tmp_path)).collect(), rows)  # a constant entry gives no component
    for k, bare in enumerate((df.limit(0), df.filter("vec_id = 1"), df.filter("vec_id > 199 and vec_id < 300"))):
        path = str(tmp_path / str(k))
        bare.write.parquet(f"{path}/embeddings.parquet")
        assert w.op12_jacobi_davidson_whitening(spark, path).count() == 0
        assert w.whiten(bare)[0].count() == bare.count()
    far = spark.createDataFrame([(1, [2.0**44]), (2, [-(2.0**44)])], "vec_id long, embedding array<float>")
    assert [r.deviation for r in w.whiten(far)[0].collect()] == [None, None]


@pytest.mark.parametrize(("d", "kind"), [(64, "even"), (200, "decay"), (200, "even"), (30, "ties"), (20, "rank"), (3, "even")])
def test_pairs_equal_a_dense_solver(d, kind):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((8 if kind == "rank" else 1500, d))
    x *= {"decay": 0.9 ** np.arange(d)}.get(kind, 1)
    x = np.linalg.qr(x)[0] * 50 if kind == "ties" else x
    a = x.T @ x / len(x)
    passes = []
    values, vectors = w.leading_pairs(lambda b: passes.append(b.shape[1]) or a @ b, d, 16)
    k = min(16, d)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:k]).max() < 1e-12 * values[0]
    assert np.linalg.norm(a @ vectors - vectors * values, axis=0).max() < 1e-12 * values[0]
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13
    assert len(passes) < 150 and max(passes) <= k + k // 2  # blocks only: the matrix is never asked for as a whole


def test_minres_solves_the_projected_equation():
    rng = np.random.default_rng(6)
    a = rng.standard_normal((12, 12))
    a = a @ a.T
    off = np.linalg.qr(rng.standard_normal((12, 3)))[0]
    p = np.eye(12) - off @ off.T
    r, shifts = p @ rng.standard_normal((12, 2)), np.array([0.3, 50.0])
    t = w.corrections(lambda b: a @ b, off, shifts, r, 40, 0.0)
    for k in range(2):
        assert np.linalg.norm(p @ (a @ t[:, k] - shifts[k] * t[:, k]) + r[:, k]) < 1e-8 and np.linalg.norm(off.T @ t[:, k]) < 1e-12
