import re
from collections import Counter

import numpy as np
import pytest
from lakeloom.llm import quality as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_base(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(grams)
    rep = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)}
    n = len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = n < 10 or 100 * len(rep) > 20 * n
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(rep), failed


def distances(x, m, cov):
    return (np.linalg.solve(np.linalg.cholesky(cov), (x - m).T) ** 2).sum(0)


def floored(x, w, factor):
    m = w @ x / w.sum()
    return m, factor * ((x - m).T * w) @ (x - m) / w.sum() + np.diag(np.array(q.FLOORS) ** 2)


def random_starts(x, starts=60, seed=0):
    """Least determinant over many random starts, steps by sorting: (log-determinant, mean, covariance)."""
    rng, best, mass = np.random.default_rng(seed), None, q.SHARE * len(x)
    for _ in range(starts):
        part = x[rng.choice(len(x), min(len(x), 6), replace=False)]
        m, cov = floored(part, np.ones(len(part)), 1.0)
        last = np.inf
        for _ in range(100):
            w = np.zeros(len(x))
            order = np.argsort(distances(x, m, cov), kind="stable")
            w[order] = np.clip(mass - np.arange(len(x)), 0, 1)
            m, cov = floored(x, w, q.consistency())
            now = np.linalg.slogdet(cov)[1]
            if last - now < 1e-9:
                break
            last = now
        if best is None or now < best[0]:
            best = now, m, cov
    return best


def slow_fit(x):
    _, m, cov = random_starts(x)
    inner = x[distances(x, m, cov) <= q.chi2_quantile(q.INNER, 4)]
    return distances(x, *floored(inner, np.ones(len(inner)), q.consistency(q.INNER)))


def slow_distances(docs):
    good = [r for r in docs if not slow_base(r.text)[-1]]
    by, lang = Counter((r.lang, r.source) for r in good), Counter()
    for (a, b), n in by.items():
        lang[a] += n if n < q.LEAST else 0
    name = lambda r: (r.lang, r.source) if by[r.lang, r.source] >= q.LEAST else (r.lang,) if lang[r.lang] >= q.LEAST else ()
    cells = {}
    for r in good:
        n, chars, sym, dup, rep, _ = slow_base(r.text)
        x = [np.log((chars + 100) / (n + 20)), *(np.log1p(10 * v / (n + 20)) for v in (sym, dup, rep))]
        cells.setdefault(name(r), []).append((r.doc_id, x))
    out = {}
    for rows in cells.values():
        x = np.array([v for _, v in rows])
        out |= dict(zip((i for i, _ in rows), slow_fit(x) if len(x) >= q.LEAST else [None] * len(x)))
    return out


def test_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want, far = {r.doc_id: slow_base(r.text) for r in docs}, slow_distances(docs)
    got = {r.doc_id: r for r in q.op2_robust_quality_rules(spark, sf_dir).collect()}
    limit, near = q.chi2_quantile(1 - q.TAIL, 4), []
    for i, r in got.items():
        assert tuple(r)[1:7] == want[i]
        assert (r.distance is None) == (far.get(i) is None)
        if far.get(i) is not None:
            near.append(abs(r.distance - far[i]) <= 0.05 * (1 + far[i]))
            assert r.kept == (far[i] <= limit) or 0.8 < far[i] / limit < 1.25
        else:
            assert r.kept != want[i][-1]
    assert np.mean(near) > 0.97
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert all(got[i].kept for i, y in labels.items() if y == 1 and not want[i][-1])
    bad = [got[i].kept for i, y in labels.items() if y == 0 and not want[i][-1]]
    assert sum(bad) <= 0.1 * len(bad)


def test_odd_rows(spark):
    rep = " ".join("abcdefghij") + " " + " ".join("abcdefghij")
    texts = [None, "", " \n\t", "a b c d e", "a b c d e f", rep, "x " * 50_000, "a\n\na\nb\n a\n", "é\x0b\x0c\rü\x85 #|#\x1c",
             "w " * 5 + "v " * 5, rep, "l1\nl1\nl1 " + " ".join(map(str, range(300)))]
    rows = [(None if i == 2 else i, t, None if i % 2 else "en", None if i % 3 else "s") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    df = df.selectExpr("*", "1 as n_words", "2 as row", "3 as cell", "4 as key", "5 as `a.b`")
    assert q.assess(df).select("row.*").columns == df.columns
    got = q.assess(df).collect()
    assert len(got) == len(texts)
    for r in got:
        want = slow_base(r.row.text)
        assert tuple(r)[1:7] == want and r.kept == (not want[-1]) and r.row.n_words == 1 and r.row["a.b"] == 5
    assert q.assess(df.limit(0)).count() == 0


def test_chi2():
    assert abs(q.chi2_quantile(0.95, 4) - 9.4877) < 1e-3 and abs(q.chi2_quantile(0.975, 2) - 7.3778) < 1e-3


def planted(seed):
    """Cells with 30 % outliers: in a tight cluster, along a line, and spread widely; the last has none."""
    rng = np.random.default_rng(seed)
    root = np.linalg.cholesky(np.array([[1, 0.8, 0.3, 0], [0.8, 1, 0.5, 0], [0.3, 0.5, 1, 0.2], [0, 0, 0.2, 1]]))
    cells = {}
    for name, bad in (
        ("tight", lambda n: np.array([6, -6, 5, 4]) + 0.05 * rng.normal(size=(n, 4))),
        ("line", lambda n: np.array([2, -2, 2, 0]) + rng.normal(size=(n, 1)) * np.array([0.1, 5, 5, 0.1]) + 0.1 * rng.normal(size=(n, 4))),
        ("wide", lambda n: rng.normal(size=(n, 4)) * 12 + 20),
        ("none", lambda n: rng.normal(size=(n, 4)) @ root.T),
    ):
        cells[name] = np.concatenate([rng.normal(size=(700, 4)) @ root.T, bad(300)])
    return cells


def frame(spark, cells):
    rows = [(name, *map(float, x)) for name, xs in cells.items() for x in xs]
    return spark.createDataFrame(rows, "cell string, x0 double, x1 double, x2 double, x3 double").repartition(7)


@pytest.fixture(scope="module")
def cells():
    """Planted outliers, and a cell of which nine tenths are one value, so that a bin holds more than the mass."""
    both = {f"{name}{k}": x for k in (3, 11) for name, x in planted(k).items()}
    return both | {"same": np.concatenate([np.zeros((900, 4)), np.random.default_rng(1).normal(size=(100, 4))])}


def test_least_determinant_against_random_starts(spark, cells):
    rows = frame(spark, cells)
    want = {name: random_starts(x, 30)[0] for name, x in cells.items()}
    got = {r.cell: r.log_det for r in q.least_determinant(rows).collect()}
    assert all(got[name] <= want[name] + 0.01 for name in cells), (got, want)
    assert abs(got["same"] - 2 * np.log(np.array(q.FLOORS)).sum()) < 1e-6  # the sums are those of the mass, not of the bin
    each = q._starts(rows, lambda df: df)
    for _ in range(q.STEPS):
        each = q._concentrate(rows, each, lambda df: df)
    each = [(r.start, r.cell, r.log_det) for r in each.collect()]
    assert len(each) == 4 * len(cells)
    assert any(d > want[c] + 0.1 for _, c, d in each) and all(min(d for _, c, d in each if c == x) < want[x] + 0.5 for x in cells)


def test_outliers_are_far_and_others_near(spark, cells):
    fitted = {r.cell: r for r in q.fit(frame(spark, cells)).collect()}
    limit = q.chi2_quantile(1 - q.TAIL, 4)
    for name, x in cells.items():
        if name == "same":
            continue
        r, low = fitted[name], np.zeros((4, 4))
        for i, j in q._PAIRS:
            low[i, j] = r[f"l{i}{j}"]
        d = (np.linalg.solve(low, (x - np.array([r[f"m{i}"] for i in range(4)])).T) ** 2).sum(0)
        least = {"tight": 0.99, "wide": 0.9, "line": 0.9, "none": 0}[name.rstrip("13")]
        assert (d[:700] <= limit).all() and (d[700:] > limit).mean() >= least, name


def test_small_cells_reject_nothing(spark):
    words = "the cat sat on a mat and then it went away to see other cats in town".split()
    rows = [(k, " ".join(words[k % 5 :] + ["x" * (300 if k == 0 else 3)] * 3 + [str(k)]), "en", "s") for k in range(q.LEAST - 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert all(r.kept and r.distance is None for r in q.assess(df).collect())
    more = df.unionByName(df.selectExpr("doc_id + 100 as doc_id", "text", "lang", "source").filter("doc_id > 100"))
    assert [r.row.doc_id for r in q.assess(more).filter("not kept").collect()] == [0]
