import hashlib
import random
import re

import duckdb
from lakeloom.llm import decontaminate as d


def brute(text, items, n=d.WORDS):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, own = split(text), set(), set()
    for item, t in items:
        v = split(t)
        size = min(n, len(v))
        for i in range(len(v) - size + 1) if v else ():
            for s in range(len(w) - size + 1):
                if w[s : s + size] == v[i : i + size]:
                    hit.update(range(s, s + size))
                    own.add("" if item is None else str(item))
    return len(w), len(hit), sorted(own)


def test_equals_sql(spark, sf_dir):
    df = d.op13_benchmark_decontamination(spark, sf_dir)
    got = sorted(map(tuple, df.collect()))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    found = con.execute(d.ORACLE_SQL)
    assert [c[0] for c in found.description] == df.columns
    assert got == sorted(found.fetchall())
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_odd_rows_equal_brute_force(spark):
    rng = random.Random(4)
    some = lambda n: rng.choice(" \n-,").join(rng.choice(["a", "B", "é", "É", "x1", "longer"]) for _ in range(n))
    items = [(k, some(rng.randint(1, 14))) for k in range(30)]
    items += [(3, some(12)), (None, some(11)), (50, None), (51, "  --\n"), (52, ""), (53, items[0][1]), (53, items[0][1])]
    texts = [None, "", " ., ", "w" * 300_000, some(20_000), *(some(rng.randint(1, 60)) for _ in range(40)), *(f"Zz {t or ''}; yy" for _, t in items)]
    docs = [(k % 60, t) for k, t in enumerate(texts)] + [(None, texts[-1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as runs", "2 as items", "3 as n_words", "4 as `a.b`")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (d.BLOCK_BYTES, 3000):  # one block, several blocks
        got = d.hit_words(df, bench, block_bytes=size).collect()
        want = [(i, *brute(t, items)) for i, t in docs]
        have = [(r.id, r.n_words, sum(x.last - x.first + 1 for x in r.runs), r.items) for r in got]
        assert sorted(have, key=str) == sorted(want, key=str)
    assert d.hit_words(df.limit(0), bench).count() == 0
    assert all(r.items == [] for r in d.hit_words(df, bench.limit(0)).collect())


def test_spans_are_places_of_the_original_text(spark):
    bench = spark.createDataFrame([("q", "What is the capital of the old Republic of Ñandú land, then?"), ("s", "short one")], "item_id string, text string")
    text = "Été: WHAT -- is the\ncapital of the old republic of Ñandú LAND! Also a Short\tone."
    docs = spark.createDataFrame([(1, text), (2, "nothing here"), (3, None)], "doc_id long, text string")
    by = {r.id: r for r in d.contaminated_spans(docs, bench).collect()}
    assert [text[s.start : s.end] for s in by[1].spans] == ["WHAT -- is the\ncapital of the old republic of Ñandú LAND", "Short\tone"]
    assert (by[1].n_words, by[1].n_hit, by[1].items) == (16, 13, ["q", "s"])
    assert by[2].spans == by[3].spans == [] and by[2].n_hit == 0


def test_digest_columns(spark, tmp_path):
    spark.createDataFrame([(1, "one two three"), (2, "x")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(10, "two Three"), (9, "two")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    one, two = sorted(d.op13_benchmark_decontamination(spark, str(tmp_path)).collect())
    assert tuple(one) == (1, 3, 2, 2, hashlib.sha256(b"10,9").hexdigest(), True)
    assert tuple(two) == (2, 1, 0, 0, hashlib.sha256(b"").hexdigest(), False)
