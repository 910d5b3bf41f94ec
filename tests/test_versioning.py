import datetime as dt
import random

import pytest
from lakeloom.operators import keys, versioning as v
from pyspark.sql import functions as F

SCHEMA = "user_id int, movie_id int, rating double, ts timestamp, is_current boolean, effective_start_date timestamp, effective_end_date timestamp"
EVENT, NATURAL = ["user_id", "movie_id", "ts"], ["user_id", "movie_id"]


def day(n):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


def events(spark, rows):
    return spark.createDataFrame([(u, m, r, day(t), True, day(t), None) for u, m, r, t in rows], SCHEMA)


def order():
    return [F.desc("rating")]


def apply(target, incoming, **more):
    return v.scd2_apply(target, incoming, EVENT, NATURAL, "ts", order(), **more)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_expire_and_insert_and_retroactive(spark):
    old = v.scd2_bootstrap(events(spark, [(1, 1, 3.0, 10)]), EVENT, NATURAL, "ts", order())
    later = {r.ts: r for r in apply(old, events(spark, [(1, 1, 4.0, 20)])).collect()}
    assert later[day(10)].effective_end_date == day(20) and not later[day(10)].is_current and later[day(20)].is_current
    early = {r.ts: r for r in apply(old, events(spark, [(1, 1, 4.0, 5)])).collect()}
    assert early[day(10)].is_current and early[day(5)].effective_end_date == day(10) and not early[day(5)].is_current


def test_any_batch_order_gives_the_history_of_all(spark):
    rng = random.Random(1)
    all_rows = list({(u, m, t): (u, m, float(rng.randint(1, 5)), t) for u, m, t in ((rng.randint(1, 6), rng.randint(1, 4), rng.randint(0, 40)) for _ in range(80))}.values())
    want = rows(v.scd2_bootstrap(events(spark, all_rows), EVENT, NATURAL, "ts", order()))
    for seed in (2, 3):
        random.Random(seed).shuffle(all_rows)
        state = v.scd2_bootstrap(events(spark, all_rows[:25]), EVENT, NATURAL, "ts", order())
        for k in (25, 50):
            state = apply(state, events(spark, all_rows[k : k + 25] if k == 25 else all_rows[50:]))
        assert rows(state) == want
        assert tuple(v.scd2_check(state, NATURAL).first()) == (0, 0, 0, 0)
    again = apply(state, events(spark, all_rows[:25]))
    assert rows(again) == want  # idempotent


def test_incoming_wins_and_null_keys(spark):
    old = v.scd2_bootstrap(events(spark, [(1, 1, 3.0, 1), (None, 1, 2.0, 1)]), EVENT, NATURAL, "ts", order())
    new = events(spark, [(1, 1, 1.0, 1), (None, 1, 2.0, 1)])
    assert sorted(str((r.user_id, r.rating)) for r in apply(old, new).collect()) == ["(1, 1.0)", "(None, 2.0)", "(None, 2.0)"]
    assert apply(old, new, null_safe=True).count() == 2
    flagged = old.withColumn("_dq_status", F.lit("PASS"))
    bad = new.withColumn("_dq_status", F.lit("QUARANTINE"))
    assert rows(apply(flagged, bad, valid_only=True).drop("_dq_status")) == rows(old)


def test_check_counts_each_violation(spark):
    df = spark.createDataFrame(
        [(1, 1, 0.0, day(1), True, day(1), None), (1, 1, 0.0, day(2), True, day(2), day(3)), (2, 1, 0.0, day(1), False, day(1), None)], SCHEMA
    )
    assert tuple(v.scd2_check(df, NATURAL).first()) == (1, 1, 1, 1)


def test_merges(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, x string")
    s = spark.createDataFrame([(2, "B"), (2, "C"), (3, "d")], "k int, x string")
    merged = v.merge_upsert(t, s, ["k"], [F.desc("x")])
    assert rows(merged) == rows(spark.createDataFrame([(1, "a"), (None, "n"), (2, "C"), (3, "d")], "k int, x string"))
    assert rows(v.merge_upsert(merged, s, ["k"], [F.desc("x")])) == rows(merged)
    assert tuple(v.merge_counts(t, s, ["k"]).first()) == (1, 1, 1)
    assert v.merge_upsert(None, s, ["k"], [F.desc("x")]).count() == 2
    assert rows(v.merge_delete_keys(t, spark.createDataFrame([(1,), (None,)], "k int"), ["k"])) == rows(t.filter("k is null or k = 2"))
    n = v.merge_insert_only(spark.createDataFrame([("a",)], "k string"), spark.createDataFrame([("A",), ("b",), ("B",)], "k string"), ["k"], True)
    assert n.count() == 2
    scoped = v.merge_upsert(t.withColumn("s", F.lit(1)), s.withColumn("s", F.lit(1)), ["k"], [F.desc("x")], delete_unmatched_in=["s"])
    assert scoped.count() == 2


def test_change_feed_rebuilds_the_new_version(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (None, "n")], "k int, x string")
    new = spark.createDataFrame([(2, "B"), (3, None), (4, "d"), (None, "m")], "k int, x string")
    feed = v.change_feed(old, new, ["k"])
    kinds = sorted((r._change_type, str(r.k)) for r in feed.collect())
    assert kinds == [("delete", "1"), ("insert", "4"), ("update_postimage", "2"), ("update_postimage", "None"), ("update_preimage", "2"), ("update_preimage", "None")]
    gone = feed.filter("_change_type in ('delete', 'update_preimage')").drop("_change_type")
    come = feed.filter("_change_type in ('insert', 'update_postimage')").drop("_change_type")
    assert rows(old.exceptAll(gone).unionByName(come)) == rows(new)
    assert v.impacted_batches(v.change_feed(old, old, ["k"]), "k").count() == 0


def test_batches_to_process(spark):
    have = spark.createDataFrame([(1,), (2,), (3,)], "batch int")
    hit = spark.createDataFrame([(2,), (9,)], "batch int")
    pick = lambda *a: sorted(r.batch for r in v.select_batches_to_process(have, hit, *a).collect())
    assert (pick(None), pick(1), pick(1, "ALL"), pick(1, "1,3")) == ([1, 2, 3], [2], [1, 2, 3], [1, 3])
    with pytest.raises(ValueError):
        pick(1, "7")


def test_affected_keys_and_processing_time(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, x string")
    assert sorted(r.x for r in keys.join_semi_affected_keys(df, df.filter("x in ('a', 'b', 'd')"), ["k"]).collect()) == ["a", "b"]


def test_surrogate_keys(spark):
    df = spark.createDataFrame([(1, 100, None), (11, 0, None)], "a int, b int, c string")
    two = [r.k for r in keys.surrogate_key(df, "k", "a", "b").collect()]
    assert two[0] != two[1] and all(len(k) == 64 and k == k.lower() for k in two)
    assert keys.surrogate_key(df, "k", "c").first().k is None
    with pytest.raises(ValueError):
        keys.surrogate_key(df, "k")
    hinted = lambda **k: keys.join_lookup_broadcast(df, df.select("a"), "a", **k)._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted() and "broadcast" not in hinted(most=1) and "broadcast" not in hinted(most_bytes=5)
    big = keys.join_lookup_broadcast(df, df.select("a", F.lit(1).alias("z")), "a", most=1)
    assert big.count() == 2 and "BroadcastHashJoin" in keys.join_lookup_broadcast(df, df.select("a"), "a")._jdf.queryExecution().toString()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_orders_by_name_need_no_window(spark):
    nan, hot = float("nan"), [(7, i % 50, float(i), f"t{i % 9}", None) for i in range(200)]
    data = [(1, 5, 2.0, "a", None), (1, None, 2.0, "b", day(1)), (1, 5, None, "c", day(2)), (2, 3, nan, "d", None), (2, 3, 1.0, "e", day(3)), (None, 1, 1.0, "f", None), (None, 2, 0.5, "g", None), *hot]
    df = spark.createDataFrame(data, "k int, n int, x double, s string, t timestamp")  # one key holds nearly all rows
    columns = {"n": F.col("n").asc_nulls_first(), "n desc": F.col("n").desc_nulls_last(), "x": F.col("x").asc_nulls_first(), "x desc": F.col("x").desc_nulls_last(),
               "s": F.col("s").asc_nulls_first(), "s desc": F.col("s").desc_nulls_last(), "t": F.col("t").asc_nulls_first(), "t desc": F.col("t").desc_nulls_last()}
    for order in (["n desc", "x desc", "s desc"], ["n", "x", "s"], ["n desc", "x", "s desc"], ["x desc", "n", "s desc"], ["t", "x desc", "n", "s desc"], ["t desc", "x", "n", "s desc"]):
        got = v.dedup_latest(df, ["k"], order)
        assert got.columns == df.columns and "Window" not in plan(got)
        assert list(map(str, rows(got))) == list(map(str, rows(v.dedup_latest(df, ["k"], [columns[o] for o in order])))), order
    assert "partial_max_by" in plan(v.dedup_latest(df, ["k"], ["n desc", "x desc", "s desc"]))  # a task sends one row a key
    mixed = v.dedup_latest(df, ["k"], ["n desc", "s"])
    assert "Window" in plan(mixed) and mixed.count() == 4
    assert v.dedup_latest(df.select("k"), ["k"], []).count() == 4
    dotted = v.dedup_latest(df.withColumn("a.b", F.col("n")), ["k"], ["n desc", "x desc", "s desc"])
    assert dotted.columns == [*df.columns, "a.b"] and all(r["a.b"] == r.n for r in dotted.collect())


def test_history_reads_target_and_batch_once(spark, tmp_path):
    by_name = ["rating desc"]
    old = v.scd2_bootstrap(events(spark, [(u, m, 3.0, 10 * m) for u in range(5) for m in range(5)] + [(None, 1, 1.0, 1)] * 3), EVENT, NATURAL, "ts", order())
    new = events(spark, [(1, 1, 4.0, 10), (1, 1, 5.0, 10), (2, 2, 2.0, 90), (9, 9, 1.0, 1), (None, 1, 2.0, 1), (None, 1, 2.5, 1), (3, 3, 1.0, 5)])
    for df, name in ((old, "old"), (new, "new")):
        df.write.parquet(str(tmp_path / name))
    old, new = (spark.read.parquet(str(tmp_path / name)) for name in ("old", "new"))
    got = v.scd2_apply(old, new, EVENT, NATURAL, "ts", by_name)
    assert plan(got).count("FileScan") == 2 and "Join" not in plan(got)
    by = {(r.user_id, r.movie_id, r.ts): r for r in got.filter("user_id is not null").collect()}
    assert got.count() == old.count() + 3 + 1 and len(by) == 25 + 3  # the NULL key's event of the batch stands beside those of the target
    assert by[1, 1, day(10)].rating == 5.0 and by[1, 1, day(10)].is_current and by[3, 3, day(5)].effective_end_date == day(30)
    assert by[2, 2, day(20)].effective_end_date == day(90) and not by[2, 2, day(20)].is_current
    kept = rows(old.filter("user_id in (0, 4)"))
    assert rows(got.filter("user_id in (0, 4)")) == kept
    broken = old.withColumn("is_current", F.lit(True))  # what the batch does not touch is not mended
    assert rows(v.scd2_apply(broken, new, EVENT, NATURAL, "ts", by_name).filter("user_id in (0, 4)")) == rows(broken.filter("user_id in (0, 4)"))
    assert rows(v.scd2_apply(old, new.limit(0), EVENT, NATURAL, "ts", by_name)) == rows(old)
