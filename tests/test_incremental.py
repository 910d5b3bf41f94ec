import random
from pathlib import Path

import pytest
from lakeloom.operators import incremental as inc
from lakeloom.operators import versioning as v
from lakeloom.sources import loads
from lakeloom.sources import tables as s
from pyspark.sql import functions as F

FACT = "movie_sk string, user_id int, rating double, year int, month int, month_name string, _batch_year int, _dq_status string, is_current boolean"


def some_fact(spark, rng, pairs):
    rows = [(f"m{m}", u, rng.choice([None, 0.5, 3.0, 4.5]), 2000 + u % 2, 1, "January", 2000 + m % 3, "PASS", True) for m, u in pairs]
    return spark.createDataFrame(rows, FACT)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def full(fact):
    return fact.groupBy(*inc.MONTH).agg(
        F.round(F.avg("rating"), 2).alias("avg_rating"), F.count("*").alias("rating_count"),
        F.countDistinct("user_id").alias("unique_users"), F.countDistinct("movie_sk").alias("unique_movies"),
    )


def state_of(fact, sign=None):
    return inc.group_state(fact, inc.MONTH, "rating", 1, inc.MEMBERS, sign)


def near(a, b):
    return [(*x[:3], None if x[3] is None else round(x[3], 2), *x[4:]) for x in a] == [(*x[:3], None if x[3] is None else round(x[3], 2), *x[4:]) for x in b]


def test_a_state_follows_inserts_updates_and_deletes(spark, tmp_path):
    rng, root = random.Random(2), str(tmp_path / "state")
    every = [(m, u) for m in range(8) for u in range(8)]
    now = some_fact(spark, rng, rng.sample(every, 30)).cache()
    assert near(rows(inc.kpi_figures(inc.store_state(spark, root, state_of(now), "first"))), rows(full(now)))
    for k, pairs in enumerate((rng.sample(every, 40), rng.sample([p for p in every if p[1] % 2], 5))):  # the second empties a month
        new = some_fact(spark, rng, pairs).cache()
        feed = v.change_feed(now, new, ["movie_sk", "user_id"])
        delta = state_of(feed, inc.sign_of_change())
        got = inc.store_state(spark, root, delta, f"feed {k}")
        assert near(rows(inc.kpi_figures(got)), rows(full(new)))
        assert near(rows(inc.kpi_figures(inc.store_state(spark, root, delta, f"feed {k}"))), rows(full(new)))  # the same feed again
        now = new
    assert now.select("year").distinct().count() == 1
    assert rows(inc.kpi_figures(inc.store_state(spark, root, state_of(v.change_feed(now, now, ["movie_sk", "user_id"]), inc.sign_of_change()), "none"))) == rows(inc.kpi_figures(got))


def test_a_feed_leaves_the_files_of_other_members(spark, tmp_path):
    root = str(tmp_path / "state")
    now = some_fact(spark, random.Random(1), [(m, u) for m in range(40) for u in range(10)]).cache()
    inc.store_state(spark, root, state_of(now), "first")
    feed = v.change_feed(now, now.filter("movie_sk <> 'm7' or user_id <> 3"), ["movie_sk", "user_id"])
    inc.store_state(spark, root, state_of(feed, inc.sign_of_change()), "one")
    old, new = (set(s.snapshot_read_as_of(spark, f"{root}/members", k).inputFiles()) for k in (0, 1))
    assert len(new - old) <= 2 and len(new & old) > 20  # a user and a movie


def make_load(spark, tmp_path, model="1"):
    build = lambda df, batches: df.filter(F.col("_batch_year").isin(batches)).select("movie_sk", "user_id", "rating", "_batch_year")
    names = [str(tmp_path / n) for n in ("silver", "fact", "audit")]
    return loads.SliceLoad(*names, build, ("user_id", "movie_sk"), "fact", "silver", model, "_dq_status = 'PASS' and is_current")


def files(path):
    return {p.relative_to(path).as_posix() for p in Path(path).rglob("*.parquet")}


def test_a_load_replaces_only_the_slices_that_changes_touch(spark, tmp_path, monkeypatch):
    load, keys = make_load(spark, tmp_path), ("user_id", "movie_sk")
    fact = lambda: rows(spark.read.parquet(load.path).select("movie_sk", "user_id", "rating", "_batch_year"))
    want = lambda df: rows(df.filter(load.kept).select("movie_sk", "user_id", "rating", "_batch_year"))
    with pytest.raises(ValueError):
        load.run(spark, "none")
    one = some_fact(spark, random.Random(5), [(m, u) for m in range(9) for u in range(20)]).cache()
    s.snapshot_write(one, load.source_root, keys=keys)
    assert sorted(r[3] for r in load.run(spark, "r1")) == [2000, 2001, 2002] and fact() == want(one)
    before = files(load.path)
    assert load.run(spark, "r2") == [] and files(load.path) == before  # nothing new
    assert spark.read.parquet(load.audit_path).count() == 3

    two = one.withColumn("rating", F.when(F.col("movie_sk") == "m1", 1.5).otherwise(F.col("rating")))  # m1 is of 2001
    s.snapshot_write(two.filter("movie_sk = 'm1'").unionByName(two.filter("movie_sk <> 'm1'")), load.source_root, keys=keys)
    monkeypatch.setattr(loads, "write_append", lambda *a: (_ for _ in ()).throw(OSError("stopped before the audit")))
    with pytest.raises(OSError):
        load.run(spark, "r3")
    monkeypatch.undo()
    got = load.run(spark, "r4")
    assert sorted((r[3], r[7]) for r in got) == [(2000, "UNCHANGED"), (2001, "SUCCESS"), (2002, "UNCHANGED")] and fact() == want(two)
    after = files(load.path)
    assert {f for f in before if "2001" not in f} == {f for f in after if "2001" not in f} and not {f for f in before & after if "2001" in f}
    assert load.run(spark, "r5") == [] and files(load.path) == after

    three = two.withColumn("is_current", F.col("_batch_year") != 2002)  # a slice loses all its rows
    s.snapshot_write(three, load.source_root, keys=keys)
    assert {r[3]: r[8] for r in load.run(spark, "r6") if r[7] == "SUCCESS"} == {2002: 0} and fact() == want(three)
    assert sorted(r[3] for r in make_load(spark, tmp_path, "2").run(spark, "r7")) == [2000, 2001]  # another model loads all there is
    assert [r[3] for r in load.run(spark, "r8", "2000")] == [2000] and len(load.run(spark, "r9", "ALL")) == 2 and fact() == want(three)
    with pytest.raises(ValueError):
        load.run(spark, "r10", "1990")


def test_a_forced_batch_does_not_hide_changes_of_others(spark, tmp_path):
    load, keys = make_load(spark, tmp_path), ("user_id", "movie_sk")
    one = some_fact(spark, random.Random(5), [(m, u) for m in range(6) for u in range(5)]).cache()
    s.snapshot_write(one, load.source_root, keys=keys)
    load.run(spark, "r1")
    s.snapshot_write(one.withColumn("rating", F.lit(2.0)), load.source_root, keys=keys)
    load.run(spark, "r2", "2001")
    assert sorted(r[3] for r in load.run(spark, "r3")) == [2000, 2002]


def test_slices_of_other_values_are_refused(spark, tmp_path):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, None)], "x int, b int")
    path = str(tmp_path / "t")
    assert s.replace_slices(df.filter("b is not null"), path, "b", [1, 2, 3]) == {1: 1, 2: 1, 3: 0}
    for bad in (df.filter("b = 2"), df.filter("b is null")):
        with pytest.raises(Exception, match="none of those to replace"):
            s.replace_slices(bad, path, "b", [1])
    assert s.replace_slices(df.limit(0), path, "b", [1]) == {1: 0} and spark.read.parquet(path).count() == 1
