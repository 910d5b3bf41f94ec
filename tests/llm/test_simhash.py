import itertools
import random

import numpy as np
import xxhash
from lakeloom.llm import simhash


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(rows, tau=2):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    fps = sorted({f for _, f in rows})
    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= tau:
            root[find(a)] = find(b)
    least = {}
    for i, f in rows:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return sorted(((i, f, least.get(find(f))) for i, f in rows), key=str)


def test_matches_brute_force_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = simhash.op8_simhash_near_dedup(spark, sf_dir).collect()
    rows = [(r.doc_id, slow_fingerprint(r.text)) for r in docs.collect()]
    want = slow_components(rows)
    assert sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got), key=str) == want
    assert len({c for *_, c in want}) < len(want)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (None, "ONE"), (6, "a b"), (None, "x y z q"),
            (7, "w " * 70_000), (8, "é\x85à b c")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "2 as id", "3 as component_id", "4 as _row", "5 as number", "6 as row")
    got = simhash.simhash_groups(df).collect()
    want = slow_components([(i, slow_fingerprint(t)) for i, t in rows])
    assert sorted(((r.id, r.fp % 2**64, r.component_id) for r in got), key=str) == want
    assert simhash.simhash_groups(df.limit(0)).count() == 0
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "6", "7", "8", "None"]


def test_links_of_planted_fingerprints_with_small_blocks(spark):
    rng = random.Random(5)
    fps = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        for _ in range(12):
            base ^= 1 << rng.randrange(64)
            fps.add(base)
    shared = rng.getrandbits(64) & ~((1 << 40) - 1)
    fps |= {shared | rng.getrandbits(12) for _ in range(300)}
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    reps = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = {(r.a, r.b) for r in simhash.near_links(reps, 2, block=16).collect()}
    nodes = simhash.connected_components(spark.createDataFrame(list(edges), "a long, b long")).collect()
    got = {r.node: r.component for r in nodes}
    want = slow_components([(f, f % 2**64) for f in signed])
    sets = lambda pairs: sorted(sorted(g) for g in pairs.values() if len(g) > 1)
    left, right = {}, {}
    for n, c in got.items():
        left.setdefault(c, []).append(n)
    for i, _, c in want:
        right.setdefault(c, []).append(i)
    assert sets(left) == sets(right)


def test_allocation_is_the_cheapest_valid_one():
    rng = np.random.default_rng(1)
    costs = np.cumsum(rng.random((3, 4, 50)), axis=1)
    got = simhash.allocate(costs, 2)
    assert (got.sum(axis=1) == 0).all()
    for r in range(50):
        options = [t for t in itertools.product(range(-1, 3), repeat=3) if sum(t) == 0]
        best = min(sum(costs[p, t[p] + 1, r] for p in range(3)) for t in options)
        assert abs(sum(costs[p, got[r, p] + 1, r] for p in range(3)) - best) < 1e-9
