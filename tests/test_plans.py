"""Plans: what reaches the scan, and what is shuffled."""

from lakeloom.operators import checks, keys, kpi, versioning
from lakeloom.plans.roles import Roles
from pyspark.sql import functions as F


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_columns_and_filters_reach_the_scan(spark, sf_dir):
    text = plan(spark.read.parquet(f"{sf_dir}/orders.parquet").filter("o_custkey = 5").select("o_orderkey"))
    assert "EqualTo(o_custkey,5)" in text and "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text
    text = plan(kpi.rating_distribution(Roles(spark, sf_dir).fact))
    assert "l_extendedprice" not in text and "o_orderpriority" not in text


def test_flags_and_conforming_do_not_shuffle(spark, sf_dir):
    r = Roles(spark, sf_dir)
    assert "Exchange" not in plan(r.movies) and "Exchange" not in plan(r.tags)
    assert "Python" not in plan(r.ratings) and "Arrow" not in plan(r.ratings)


def test_timeline_windows_share_one_exchange_per_key(spark, sf_dir):
    text = plan(versioning.scd2_bootstrap(Roles(spark, sf_dir).ratings, ["user_id", "movie_id", "interaction_timestamp"], ["user_id", "movie_id"], "interaction_timestamp", [F.desc("rating")]))
    assert text.count("Exchange hashpartitioning(user_id") == 2  # by event, then by natural key


def test_checks_are_one_scan(spark, sf_dir):
    r = Roles(spark, sf_dir)
    for df in (checks.check_not_null(r.movies, ["movie_id", "title"]), checks.dq_batch_metrics(r.movies), kpi.silver_stats_movies(r.movies)):
        assert plan(df).count("FileScan") == 1


def test_star_joins_have_no_product(spark, sf_dir):
    r = Roles(spark, sf_dir)
    chain = keys.join_star_chain(r.fact, (r.dim_date, "date_key"), (r.bridge, "movie_sk"), (r.dim_genres, "genre_sk"))
    assert "CartesianProduct" not in plan(chain) and "NestedLoop" not in plan(chain)
