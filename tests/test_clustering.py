import datetime as dt

import pytest
from lakeloom.sources import clustering as c
from pyspark.sql import functions as F


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def share(spark, path, column, values):
    ends = [(r[2], r[3]) for r in c.file_ranges(spark.read.parquet(path), [column]).collect()]
    assert tuple(c.files_met(spark.read.parquet(path), column, values[0]).first()) == (sum(a <= values[0] <= b for a, b in ends), len(ends))
    return max(sum(a <= v <= b for a, b in ends) / len(ends) for v in values)


@pytest.mark.parametrize("files", [16, 40])
def test_a_filter_on_either_column_meets_few_files(spark, tmp_path, files):
    df = spark.range(40_000).select((F.xxhash64("id") % 997).alias("movie_id"), (F.xxhash64("id", F.lit(1)) % 5003).alias("user_id"))
    path = str(tmp_path / "t")
    assert c.rewrite_clustered(df, path, ["movie_id", "user_id"], files) == 40_000
    assert rows(spark.read.parquet(path)) == rows(df)
    assert share(spark, path, "movie_id", [-900, -333, 0, 5, 400, 990]) <= 1 / 3
    assert share(spark, path, "user_id", [-4000, -7, 0, 1234, 5000]) <= 1 / 3
    plain = str(tmp_path / "plain")
    df.repartitionByRange(files, "movie_id", "user_id").write.parquet(plain)
    assert share(spark, plain, "user_id", [0]) == 1.0  # what a sort by the first column gives


def test_hot_values_texts_dates_and_nulls(spark, tmp_path):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("https://"), F.xxhash64("id").cast("string"))).when(F.col("id") % 9 > 0, "hot").alias("a.b"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 400).cast("int")).alias("day"),
        F.when(F.col("id") % 2 > 0, F.col("id") / 7).otherwise(F.lit(float("nan"))).alias("x"),
        F.create_map(F.lit("k"), "id").alias("m"),
    )
    path = str(tmp_path / "t")
    assert c.rewrite_clustered(df, path, ["a.b", "day", "x"], 8) == 6000
    back = spark.read.parquet(path)
    assert list(map(str, rows(back))) == list(map(str, rows(df))) and back.schema.simpleString() == df.schema.simpleString()
    sizes = [r.rows for r in c.file_ranges(back, ["day"]).collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * min(sizes)  # a third of the rows share one value of the first column
    same = spark.range(1000).select(F.lit(1).alias("k"), "id")
    assert c.rewrite_clustered(same, str(tmp_path / "same"), ["k"], 4) == 1000
    assert c.file_ranges(spark.read.parquet(str(tmp_path / "same")), ["k"]).count() > 1
    assert c.rewrite_clustered(df.limit(0), str(tmp_path / "none"), ["day"], 4) == 0
    with pytest.raises(ValueError):
        c.rewrite_clustered(df, path, [], 4)


def test_places_interleave_the_ranks(spark):
    df = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a int, b int")
    borders = [[1, 2, 3, 4, 5, 6, 7]] * 2
    for r in df.select("a", "b", c.range_rank("a", borders[0]).alias("r"), c.curve_place(["a", "b"], borders, 3).alias("z")).collect():
        assert r.r == r.a == c.rank_of(r.a, borders[0]) and r.z == int("".join(x + y for x, y in zip(f"{r.a:03b}", f"{r.b:03b}")), 2)
