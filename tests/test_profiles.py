import pytest
from lakeloom.operators import checks, keys
from lakeloom.sources import tables as s
from pyspark.sql import functions as F


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sketches_of_batches_unite_to_those_of_the_table(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 7).alias("batch"), F.col("id").alias("n"), F.when(F.col("id") % 4 > 0, F.col("id") % 10_007).alias("few"),
        (F.sqrt("id")).alias("x"), F.concat(F.lit("k"), F.col("id") % 20_000).alias("s"), F.lit(None).cast("int").alias("none"), F.lit(1).alias("a.b"),
    )
    per_batch = s.profile_sketches(df, "batch")
    assert "Expand" not in plan(per_batch) and per_batch.count() == 7
    united = {r.column: r for r in s.sketched_profile(s.unite_sketches(per_batch)).collect()}
    whole = {r.column: r for r in s.sketched_profile(s.unite_sketches(s.profile_sketches(df.drop("batch")))).collect()}
    exact = {r.column: r for r in s.table_profile(df.drop("batch", "a.b")).collect()}
    assert set(united) == set(whole) == {*exact, "a.b"}
    for name, e in exact.items():
        got = united[name]
        assert (got.rows, got.nulls, got.least, got.greatest) == (e.rows, e.nulls, e.least, e.greatest)
        assert got.distinct == whole[name].distinct  # the same registers
        assert abs(got.distinct - e.distinct) <= 0.05 * e.distinct  # three standard errors of 1.6 %
    assert [abs(q - want) < 1200 for q, want in zip((united["n"].lower, united["n"].median, united["n"].upper), (15_000, 30_000, 45_000))] == [True] * 3
    assert united["none"].median is None and united["s"].median is None and united["a.b"].distinct == 1
    more = s.profile_sketches(df.filter("n < 100").withColumn("batch", F.lit(9).cast("bigint")), "batch")
    again = s.sketched_profile(s.unite_sketches(per_batch.unionByName(more), "batch"), "batch")
    assert again.filter("column = 'n'").count() == 8


def test_all_foreign_keys_in_one_scan(spark, tmp_path):
    spark.createDataFrame([(1, "x", 5), (2, "y", 5), (2, None, 6), (None, "z", 7), (9, "q", 8)], "a int, b string, c int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    pa, pb = spark.createDataFrame([(1,), (2,), (None,)], "k bigint"), spark.createDataFrame([("x",), ("x",), ("z",)], "k string")
    pc = spark.createDataFrame([(5.0,), (7.0,)], "k double")
    got = checks.check_foreign_keys(df, [("a", pa, "k"), ("b", pb, "k"), ("c", pc, "k"), ("b", pb, "k")])
    assert plan(got).count("FileScan") == 1
    assert [tuple(r) for r in got.collect()] == [("fk:a", 1), ("fk:b", 2), ("fk:c", 2), ("fk:b", 2)]
    assert [r.violations for r in checks.check_foreign_keys(df.limit(0), [("a", pa, "k")]).collect()] == [0]
    assert [r.violations for r in checks.check_foreign_keys(df, [("b", pa, "k")]).collect()] == [4]  # texts that are no numbers have no parent
    with pytest.raises(ValueError):
        checks.check_foreign_keys(df, [("zz", pa, "k")])


def test_broken_lines_are_kept_with_a_reason(spark, tmp_path):
    lines = ["1,2,3.5,915148800", "x,2,3.5,9", "1,2", "1,2,3,4,5", "1,2,,9", "1,2,bad,z", ",,,", '"1,2",3,4.0,5', "é,1,2,3"]
    (tmp_path / "ratings_1999.csv").write_text("userId,movieId,rating,timestamp\n" + "\n".join(lines) + "\n")
    df = s.scan_csv_checked(spark, str(tmp_path / "ratings_*.csv"), "ratings")
    want = {lines[1]: "BAD_VALUE:userId", lines[2]: "FEW_FIELDS", lines[3]: "MANY_FIELDS", lines[5]: "BAD_VALUE:rating,timestamp", lines[7]: "BAD_VALUE:userId", lines[8]: "BAD_VALUE:userId"}
    assert {r[0]: r[1] for r in s.quarantine(df).collect()} == want
    fit = s.accepted(df)
    assert sorted(map(str, map(tuple, fit.collect()))) == sorted(map(str, [(1, 2, 3.5, 915148800), (1, 2, None, 9), (None, None, None, None)]))
    assert fit.schema == s.scan_csv_typed(spark, str(tmp_path / "ratings_*.csv"), "ratings").schema
    assert df.count() == len(lines) and df.select("rating").count() == len(lines)
    assert {r.rating for r in df.filter(F.col(s.RAW) == "x,2,3.5,9").collect()} == {3.5}  # what can be read is
    with pytest.raises(ValueError):
        s.scan_csv_checked(spark, str(tmp_path), "unknown")


def test_numbers_are_gapless_over_several_ranges(spark):
    df = spark.range(5000).select(F.xxhash64("id").alias("v"), F.col("id").alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = keys.number_rows(df, ["v", "k"], "n", 100)
        rows = got.orderBy("n").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert "Window" not in plan(got) and got.rdd.getNumPartitions() >= 1
    assert [r.n for r in rows] == list(range(101, 5101)) and [(r.v, r.k) for r in rows] == sorted((r.v, r.k) for r in rows)
    assert keys.number_rows(df.limit(0), ["v"], "n").count() == 0
    old = spark.createDataFrame([("s", 4, "Drama")], "genre_sk string, genre_id int, genre_name string")
    members = spark.createDataFrame([(1, "drama"), (1, "War"), (2, "war"), (2, "Action")], "movie_id int, genre_name string")
    new = keys.dim_genres_incremental(old, members)
    assert sorted((r.genre_id, r.genre_name) for r in new.collect()) == [(4, "Drama"), (5, "Action"), (6, "War")]
    assert "Window" not in plan(new)
