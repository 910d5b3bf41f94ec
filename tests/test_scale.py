"""Queries on repeated events, and what a larger table would be shuffled or computed twice for."""

import duckdb
import pytest
from lakeloom.operators import incremental, kpi, versioning
from lakeloom.plans import catalog
from lakeloom.plans.roles import Roles
from lakeloom.sources import tables
from lakeloom.streaming import ingest
from pyspark.sql import functions as F

TABLES = "customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def repeated(sf_dir, tmp_path_factory):
    """The tables with every third line twice, and every ninth of another order's day beside it."""
    folder = tmp_path_factory.mktemp("repeated")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    more = {
        "lineitem": "from lineitem union all select * from lineitem where l_partkey % 3 = 0 union all "
        "select * replace (l_orderkey + 1000000 as l_orderkey, l_quantity / 2 as l_quantity) from lineitem where l_partkey % 9 = 0",
        "orders": "from orders union all select * replace (o_orderkey + 1000000 as o_orderkey, o_orderdate - interval 1 year as o_orderdate) from orders",
    }
    for t in TABLES:
        con.execute(f"copy ({more.get(t, f'from {t}')}) to '{folder}/{t}.parquet' (format parquet)")
    return str(folder)


def same_as_sql(spark, folder, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    df = catalog.QUERIES[name](spark, folder)
    found = con.execute(catalog.ORACLES[name])
    names = [d[0] for d in found.description]
    want = sorted(str(tuple(r[names.index(c)] for c in df.columns)) for r in found.fetchall())
    assert want and sorted(str(tuple(r)) for r in df.collect()) == want


@pytest.mark.parametrize("name", ["lineage_trace", "scd2_bootstrap", "kpi_genre_performance", "kpi_genre_performance_incremental"])
def test_repeated_events(spark, repeated, name):
    same_as_sql(spark, repeated, name)


@pytest.mark.parametrize("name", ["kpi_genre_trends_yearly", "kpi_top_genres_trend", "dq_flag"])
def test_repeated_events_by_compiled_flags(spark, repeated, name):
    same_as_sql(spark, repeated, name)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_history_is_shuffled_and_sorted_once_and_carries_what_is_used(spark, sf_dir):
    text = plan(Roles(spark, sf_dir).versions.select("user_id", "movie_id", "is_current"))
    assert text.count("Exchange hashpartitioning(user_id") == 1 and "SortAggregate" not in text and "_dq_failed_rules" not in text


def test_flags_are_compiled_and_a_history_sends_plain_columns(spark, sf_dir):
    roles = Roles(spark, sf_dir)
    assert "lambda" not in plan(roles.ratings)
    assert "struct(" not in plan(roles.versions)


def test_a_history_keeps_one_row_of_an_event_without_a_moment(spark):
    rows = spark.createDataFrame([(1, None, 1, 2.0), (1, None, 1, 3.0), (1, 5, 1, 1.0), (1, 5, 2, 4.0), (2, None, 1, 1.0)], "k int, ts int, e int, rating double")
    rows = rows.selectExpr("*", "false is_current", "0 effective_start_date", "0 effective_end_date")
    got = versioning.scd2_bootstrap(rows, ["k", "ts", "e"], ["k"], "ts", ["rating desc"]).select("k", "ts", "e", "rating", "is_current", "effective_end_date")
    want = [(1, None, 1, 3.0, False, 5), (1, 5, 1, 1.0, False, 5), (1, 5, 2, 4.0, True, None), (2, None, 1, 1.0, True, None)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_yearly_trends_are_grouped_by_the_movies_id(spark, sf_dir):
    assert "movie_sk" not in plan(Roles(spark, sf_dir).genre_trend)


def test_the_largest_genres_trend_computes_its_fact_once(spark, sf_dir):
    assert plan(catalog.BUILDS["kpi_top_genres_trend"](Roles(spark, sf_dir))).count("lineitem.parquet") <= plan(Roles(spark, sf_dir).genre_trend).count("lineitem.parquet")
    trend = spark.createDataFrame([(y, g, 3.0, n) for y in (2000, 2001) for g, n in zip("abcd", (2, 5, 2, 1))], "year int, genre_name string, avg_rating double, rating_count bigint")
    ranking = trend.groupBy("genre_name").agg(F.sum("rating_count").alias("rating_count"))
    for got in (kpi.top_genres_trend(trend, n=2), kpi.top_genres_trend(trend, ranking, 2)):
        assert got.columns == trend.columns and sorted(map(tuple, got.collect())) == [(2000, "a", 3.0, 2), (2000, "b", 3.0, 5), (2001, "a", 3.0, 2), (2001, "b", 3.0, 5)]


def test_titles_are_parsed_once_for_the_bridge(spark, sf_dir):
    assert "regexp" not in plan(Roles(spark, sf_dir).bridge)


def test_a_first_state_computes_its_delta_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def told(x):
        seen.add(1)
        return x

    rows = spark.createDataFrame([(2000, 1, "January", u, f"m{u % 3}", 1.0) for u in range(50)], "year int, month int, month_name string, user_id int, movie_sk string, rating double")
    rows = rows.withColumn("rating", F.udf(told, "double").asNondeterministic()("rating")).filter("rating > 0")
    incremental.store_state(spark, str(tmp_path / "s"), incremental.group_state(rows, incremental.MONTH, "rating", 1, incremental.MEMBERS), "first")
    assert seen.value == 100  # once for the sums, once for the members


def test_rows_count_for_each_group_of_their_list(spark, tmp_path):
    fact = spark.createDataFrame([(m, u, None if u == 3 else u / 2.0) for m in range(6) for u in range(5)], "movie_id int, user_id int, rating double")
    bridge = spark.createDataFrame([(m, g) for m in range(5) for g in range(3) if m % (g + 1) == 0], "movie_id int, genre_sk int")
    genres = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "genre_sk int, genre_name string")
    sign, root = F.when(F.col("user_id") == 4, -1).otherwise(1), str(tmp_path / "s")
    incremental.store_state(spark, root, incremental.genre_state(fact, bridge, genres, None, "movie_id"), "first")
    gone = fact.filter("user_id = 4")
    got = incremental.kpi_figures(incremental.store_state(spark, root, incremental.genre_state(gone, bridge, genres, sign, "movie_id"), "gone"))
    assert sorted(map(tuple, got.collect())) == [("a", 0.5, 20, 4, 5), ("b", 0.5, 12, 4, 3), ("c", 0.5, 8, 4, 2)]


def test_slices_store_hexadecimal_keys_in_half_their_length(spark, tmp_path):
    rows = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), (F.col("id") % 2).cast("int").alias("b"))
    tables.replace_slices(rows, str(tmp_path / "t"), "b", [0, 1])
    tables.snapshot_write(rows, str(tmp_path / "s"))
    for folder in ("t", "s/v=0"):
        assert sum(p.stat().st_size for p in (tmp_path / folder).rglob("*.parquet")) < 20_000 * 45


def test_numbers_and_times_are_only_counted_to_choose_buckets(spark):
    broken = F.udf(lambda x: 1 // 0, "int").asNondeterministic()("id")
    rows = spark.range(1000).select(broken.alias("a"), F.current_timestamp().alias("b"))
    assert tables.buckets_for(rows, 50) > tables.buckets_for(rows, 1 << 30) == tables.BUCKETS
    text = spark.range(1000).select(F.lit("x" * 1000).alias("a"))
    nested = text.select(F.array("a").alias("a"))
    for df in (text, nested):
        assert 240 < tables.buckets_for(df, 1000) < 270
    assert tables.buckets_for(text.limit(0), 1) == tables.BUCKETS


def test_a_first_batch_shuffles_no_flags(spark, sf_dir, tmp_path, monkeypatch):
    seen, raw, root = [], Roles(spark, sf_dir).raw_ratings, str(tmp_path / "s")
    write = tables.committed_row_count
    monkeypatch.setattr(tables, "committed_row_count", lambda df, w: seen.append(df) or write(df, w))
    assert ingest.apply_batch(raw, root, "first") == 0
    (df,) = seen
    below = df._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions")[1]
    assert "QUARANTINE" not in below and "NULL_USER_ID" not in below
    flagged = ingest.flagged_ratings(raw)
    want = versioning.scd2_bootstrap(flagged, ingest.EVENT_KEY, ingest.NATURAL_KEY, "interaction_timestamp", ingest.event_order())
    got = tables.snapshot_read_as_of(spark, root, 0)
    assert got.columns == want.columns and got.schema["_dq_failed_rules"].dataType == want.schema["_dq_failed_rules"].dataType
    shown = lambda d: sorted(map(str, map(tuple, d.collect())))
    assert shown(got) == shown(want) and got.filter("_dq_status = 'QUARANTINE'").count() > 0
