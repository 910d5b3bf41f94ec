import pytest
from lakeloom.sources import clustering
from lakeloom.sources import tables as s
from lakeloom.streaming import ingest
from pyspark.sql import functions as F


def write_csv(folder, year, lines):
    folder.mkdir(exist_ok=True)
    (folder / f"ratings_{year}.csv").write_text("userId,movieId,rating,timestamp\n" + "".join(f"{x}\n" for x in lines))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_csv_and_discovery(spark, tmp_path):
    d = tmp_path / "raw"
    write_csv(d, 1999, ["1,2,3.5,915148800", "x,2,,9"])
    write_csv(d, 2001, ["1,2,4,978307200"])
    (d / "tags_2000.csv").write_text("a\n")
    df = s.scan_csv_typed(spark, str(d / "ratings_*.csv"), "ratings")
    assert df.count() == 3 and df.schema.simpleString() == "struct<userId:int,movieId:int,rating:double,timestamp:bigint>"
    assert sorted(r.batch for r in s.discover_batches(spark, str(d), "ratings").collect()) == [1999, 2001]
    with pytest.raises(FileNotFoundError):
        s.discover_batches(spark, str(d), "links")
    with pytest.raises(ValueError):
        s.scan_csv_typed(spark, str(d), "unknown")


def test_partition_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2000), (2, 2000), (3, 2001), (4, None)], "x int, y int")
    assert s.write_overwrite(df, path, ["y"]) == 4
    two = df.filter("x = 1")
    for _ in range(2):
        assert s.write_replace_partition(two, path, "y", 2000) == 1
    assert rows(spark.read.parquet(path).select("x", "y")) == [(1, 2000), (3, 2001), (4, None)]
    with pytest.raises(Exception, match="a row is not of y=2000"):
        s.write_replace_partition(df.filter("x = 3"), path, "y", 2000)
    assert s.write_replace_touched_partitions(df.withColumn("x", F.col("x") * 10), path, "y") == 3
    assert rows(spark.read.parquet(path).select("x", "y")) == [(10, 2000), (20, 2000), (30, 2001), (4, None)]
    assert s.write_replace_touched_partitions(df.limit(0), path, "y") == 0 and spark.read.parquet(path).count() == 4


def test_pruning_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    s.write_overwrite(spark.range(10).selectExpr("id", "id * 2 as v", "cast(id % 3 as int) as p"), path, ["p"])
    plan = s.scan_partition_slice(spark.read.parquet(path), "p", 1).select("v")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(p" in plan and "ReadSchema: struct<v:bigint>" in plan


def test_schema_guard(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert s.schema_guard(df.withColumn("z", F.lit(1)), df.schema).columns == ["x", "y", "z"]
    assert s.schema_guard(df.select("x"), df.schema, "null").first().y is None
    for bad in (df.select("x"), df.withColumn("x", F.lit("s"))):
        with pytest.raises(TypeError):
            s.schema_guard(bad, df.schema)
    path = str(tmp_path / "a")
    assert s.write_append(df, path) == 1 and s.write_append(df, path) == 1
    with pytest.raises(TypeError):
        s.write_append(df.withColumn("x", F.lit("s")), path)


def test_snapshots_and_clustering(spark, tmp_path):
    root = str(tmp_path / "snap")
    assert s.current_version(spark, root) is None
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    assert [s.snapshot_write(df.filter(f"id < {n}"), root) for n in (10, 20)] == [0, 1]
    assert s.snapshot_read_as_of(spark, root, 0).count() == 10 and s.current_version(spark, root) == 1
    with pytest.raises(ValueError):
        s.snapshot_read_as_of(spark, root, 5)
    out = str(tmp_path / "clustered")
    assert clustering.rewrite_clustered(df, out, ["k", "id"], 3) == 100
    assert rows(spark.read.parquet(out)) == rows(df) and len([p for p in (tmp_path / "clustered").iterdir() if p.name.startswith("part")]) <= 3


def test_registration_and_batches(spark, tmp_path):
    path = str(tmp_path / "reg")
    s.write_overwrite(spark.createDataFrame([(1, 2000), (2, 2001)], "x int, y int"), path, ["y"])
    for _ in range(2):
        s.register_table(spark, "lakeloom_reg_test", path, {"layer": "silver"})
    assert sorted(r.batch for r in s.partition_batches(spark, "lakeloom_reg_test", "y").collect()) == [2000, 2001]
    s.analyze_table(spark, "lakeloom_reg_test")
    assert s.scan_table(spark, "lakeloom_reg_test").count() == 2
    have = s.available_batches(s.scan_table(spark, path), "y")
    done = s.processed_batches(None, "y", spark)
    assert s.pending_batches(have, done).count() == 2 and s.skipped_batches(have, done).count() == 0
    with pytest.raises(ValueError):
        s.available_batches(spark.table("lakeloom_reg_test").limit(0), "y")
    spark.sql("DROP TABLE lakeloom_reg_test")


def test_stream_is_idempotent_and_incremental(spark, tmp_path):
    d, root, mark = tmp_path / "in", str(tmp_path / "silver"), str(tmp_path / "mark")
    write_csv(d, 1999, ["1,2,3.5,915148800", "1,2,4.5,930000000"])
    run = lambda: ingest.stream_ingest_incremental(spark, str(d), root, mark)
    assert run() == 0 and run() == 0
    write_csv(d, 2000, ["1,2,2.0,946684800", "5,6,1.0,946684801"])
    assert run() == 1
    got = s.snapshot_read_as_of(spark, root, 1)
    assert got.count() == 4 and got.filter("is_current").count() == 2
    assert ingest.apply_batch(spark.createDataFrame([(1, 2, 1.0, 1, 1970)], "userId int, movieId int, rating double, timestamp long, _batch_year int").withColumn("_ingestion_timestamp", F.current_timestamp()), root, "late") == 2


def test_streams_with_their_own_checkpoints_feed_one_table(spark, tmp_path):
    root = str(tmp_path / "silver")
    for k in (1, 2):
        write_csv(tmp_path / f"in{k}", 1999, [f"{k},2,3.5,915148800"])
    run = lambda k: ingest.stream_ingest_incremental(spark, str(tmp_path / f"in{k}"), root, str(tmp_path / f"mark{k}"))
    assert [run(1), run(2), run(1)] == [0, 1, 1]
    assert sorted(r.user_id for r in s.snapshot_read_as_of(spark, root, 1).collect()) == [1, 2]


def test_a_batch_run_again_is_not_applied_twice(spark, tmp_path):
    root, mark = str(tmp_path / "silver"), tmp_path / "mark"
    write_csv(tmp_path / "in", 1999, ["1,2,3.5,915148800"])
    run = lambda: ingest.stream_ingest_incremental(spark, str(tmp_path / "in"), root, str(mark))
    assert run() == 0
    for name in ("0", ".0.crc"):  # as if the batch had been applied and the stream had stopped before it was marked as done
        (mark / "commits" / name).unlink()
    assert run() == 0 and s.snapshot_read_as_of(spark, root, 0).count() == 1


def test_a_batch_leaves_the_files_of_other_keys(spark, tmp_path):
    root = str(tmp_path / "silver")
    row = lambda u, at: (u, 7, 3.0, at, 1999)
    raw = lambda rows: spark.createDataFrame(rows, "userId int, movieId int, rating double, timestamp long, _batch_year int").withColumn(
        "_ingestion_timestamp", F.lit("1999-01-01").cast("timestamp")
    )
    assert ingest.apply_batch(raw([row(u, 915148800) for u in range(500)]), root, "a") == 0
    assert ingest.apply_batch(raw([row(3, 915148900)]), root, "b") == 1
    old, new = (set(s.snapshot_read_as_of(spark, root, v).inputFiles()) for v in (0, 1))
    assert len(old - new) == len(new - old) == 1 and len(old & new) > 40
    got = s.snapshot_read_as_of(spark, root, 1)
    assert got.count() == 501 and got.filter("is_current").count() == 500
    assert [r.is_current for r in got.filter("user_id = 3").orderBy("interaction_timestamp").collect()] == [False, True]
    assert s.snapshot_read_as_of(spark, root, 0).count() == 500
    assert ingest.apply_batch(raw([]), root, "none") == 2 and s.snapshot_read_as_of(spark, root, 2).count() == 501
    with pytest.raises(ValueError):
        s.snapshot_write(got, root)
    empty = str(tmp_path / "empty")
    assert ingest.apply_batch(raw([]), empty, "none") == 0 and s.snapshot_read_as_of(spark, empty, 0).count() == 0
    assert ingest.apply_batch(raw([row(3, 915148900)]), empty, "one") == 1 and s.snapshot_read_as_of(spark, empty, 1).count() == 1


def test_discovery_takes_several_files_a_year(spark, tmp_path):
    for name in ("ratings_1999.0.csv", "ratings_1999.12.csv", "ratings_2000.csv", "ratings_2001.x.csv"):
        (tmp_path / name).write_text("userId,movieId,rating,timestamp\n")
    assert sorted(r.batch for r in s.discover_batches(spark, str(tmp_path), "ratings").collect()) == [1999, 2000]


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from lakeloom import session

    conf = SimpleNamespace(get=lambda *a: None, set=lambda *a: None)
    bare = lambda master: SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: conf))
    assert session.shared_dir(bare("local[2]"))
    for master in ("spark://host:7077", "yarn", "k8s://x"):
        with pytest.raises(RuntimeError):
            session.shared_dir(bare(master))


def test_buckets_follow_the_size_of_the_table(spark, tmp_path):
    root = str(tmp_path / "silver")
    raw = lambda users, at: spark.range(users[0], users[1]).selectExpr(
        "cast(id as int) userId", "7 movieId", "3.0d rating", f"cast({at} as bigint) timestamp", "1999 _batch_year", "timestamp '1999-01-01' _ingestion_timestamp"
    )
    assert ingest.apply_batch(raw((0, 3000), 915148800), root, "a", bucket_bytes=1000) == 0
    of = s.bucket_count(spark, root, 0)
    assert 200 < of < 1000
    assert ingest.apply_batch(raw((10, 30), 915148900), root, "b", bucket_bytes=1000) == 1
    old, new = (set(s.snapshot_read_as_of(spark, root, v).inputFiles()) for v in (0, 1))
    assert len(new - old) <= 20 < 0.1 * len(old) and s.changed_buckets(spark, root, 0, 1) is not None  # twenty keys of three thousand
    got = s.snapshot_read_as_of(spark, root, 1)
    assert got.count() == 3020 and got.filter("is_current").count() == 3000

    # The table grows fourfold: before the next batch it is dealt over more buckets.
    assert ingest.apply_batch(raw((3000, 14_000), 915148800), root, "c", bucket_bytes=1000) == 2
    assert ingest.apply_batch(raw((0, 5), 915149000), root, "d", bucket_bytes=2**30) == 3
    assert ingest.apply_batch(raw((0, 5), 915149100), root, "e", bucket_bytes=1000) == 5  # version 4 deals anew
    assert s.bucket_count(spark, root, 5) > 2 * of == 2 * s.bucket_count(spark, root, 3)
    assert s.changed_buckets(spark, root, 3, 5) is None and len(s.changed_buckets(spark, root, 4, 5)) <= 5
    got = s.snapshot_read_as_of(spark, root, 5)
    assert got.count() == 14_030 and got.filter("is_current").count() == 14_000 and s.snapshot_read_as_of(spark, root, 0).count() == 3000
    assert s.snapshot_read_as_of(spark, root, 3).count() == 14_025
