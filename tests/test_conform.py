import datetime as dt

import pytest
from lakeloom.operators import checks, conform
from pyspark.sql import functions as F

NOW = "current_timestamp() as _ingestion_timestamp"


def ratings(spark, *rows):
    df = spark.createDataFrame(list(rows), "userId string, movieId string, rating string, timestamp bigint, _batch_year int")
    return checks.dq_flag(conform.conform_ratings(df.selectExpr("*", NOW)), checks.rules_ratings())


def movies(spark, *rows):
    df = spark.createDataFrame(list(rows), "movieId string, title string, genres string")
    return conform.conform_movies(df.selectExpr("*", NOW))


@pytest.mark.parametrize(
    "title, name, year",
    [
        ("Toy Story (1995)", "Toy Story", 1995), ("Toy Story (1995)  ", "Toy Story", 1995), ("Se7en (Seven) (1995)", "Se7en (seven)", 1995),
        ("(2001) A Space Odyssey", "(2001) A Space Odyssey", None), ("Future (9999)", "Future", None), ("Old (1800)", "Old", 1800),
        ("Future (2199)", "Future", 2199), ("Dark Knight, The (2008)", "The Dark Knight", 2008), ("Boot, Das (1981)", "Das Boot", 1981),
        ("A, The, The", "The A, The", None), (None, None, None), ("", "", None),
    ],
)
def test_titles(spark, title, name, year):
    assert tuple(movies(spark, ("1", title, None)).select("title", "release_year").first()) == (name, year)


@pytest.mark.parametrize("raw, want", [("sci-fi|action", ["Sci-fi", "Action"]), ("(no genres listed)", []), ("", []), (None, [])])
def test_genres(spark, raw, want):
    assert movies(spark, ("1", "x", raw)).first().genres == want


def test_ratings(spark):
    rows = ratings(
        spark,
        ("1", "2", "3.55", 1640995200, 2022), (None, "1", None, 0, 2022), ("1", "1", "0.0", 788918400, 1995), ("1", "1", "5.0", 1546300800, 2022),
        (None, "100", "6.0", 0, 1970), ("1", "1", "4", None, 2022),
    ).collect()
    assert (rows[0].rating, rows[0].date_key, rows[0].is_late_arrival, rows[0]._dq_status) == (3.6, 20220101, False, "PASS")
    assert rows[0].is_current and rows[0].effective_start_date == rows[0].interaction_timestamp and rows[0].effective_end_date is None
    assert rows[1]._dq_failed_rules == ["NULL_USER_ID", "NULL_RATING", "INVALID_TIMESTAMP_FLOOR"]
    assert rows[2]._dq_status == "PASS" and (rows[3].is_late_arrival, rows[3].rating_year, rows[3]._dq_status) == (True, 2019, "PASS")
    assert rows[4]._dq_failed_rules == ["NULL_USER_ID", "INVALID_TIMESTAMP_FLOOR", "INVALID_RATING_RANGE"]
    assert (rows[5].interaction_timestamp, rows[5].date_key, rows[5].rating_year, rows[5].is_late_arrival) == (None,) * 4


def test_tags_links_scores(spark):
    tags = spark.createDataFrame([("1", "2", t, 0) for t in ("h@ck!ng$", "DARK COMEDY", "dark\tcomedy", "ab", None)], "userId string, movieId string, tag string, timestamp long")
    rows = checks.dq_flag(conform.conform_tags(tags.selectExpr("*", NOW)), checks.rules_tags()).collect()
    assert [r.tag for r in rows] == ["Hckng", "Dark Comedy", "Dark Comedy", "Ab", None]
    assert "SHORT_TAG" in rows[3]._dq_failed_rules and "NULL_TAG" in rows[4]._dq_failed_rules
    links = spark.createDataFrame([("1", "0114709", 5), ("2", None, None)], "movieId string, imdbId string, tmdbId int")
    rows = checks.dq_flag(conform.conform_links(links.selectExpr("*", NOW)), checks.rules_links()).collect()
    assert (rows[0].imdb_id, rows[0].tmdb_id, rows[1].imdb_id, rows[1]._dq_failed_rules) == ("tt0114709", "5", None, ["NO_EXTERNAL_IDS"])
    scores = spark.createDataFrame([("1", "2", x) for x in ("0.12345", "0.9999", "1.2", "-0.1", "0", "1")], "movieId string, tagId string, relevance string")
    rows = checks.dq_flag(conform.conform_genome_scores(scores.selectExpr("*", NOW)), checks.rules_genome_scores()).collect()
    assert [r.relevance for r in rows[:2]] == [0.123, 1.0] and [r._dq_status for r in rows[2:]] == ["QUARANTINE"] * 2 + ["PASS"] * 2
    tag = spark.createDataFrame([("1", "  dark\t\n  comedy  ")], "tagId string, tag string")
    assert conform.conform_genome_tags(tag.selectExpr("*", NOW)).first().tag == "Dark Comedy"


def test_rules_that_conformed_rows_cannot_fail(spark):
    df = spark.createDataFrame([(1, 2, 3.0, dt.datetime(2020, 1, 2), 20200101)], "user_id int, movie_id int, rating double, interaction_timestamp timestamp, date_key int")
    assert checks.dq_flag(df, checks.rules_ratings()).first()._dq_failed_rules == ["DATE_KEY_MISMATCH"]
    df = spark.createDataFrame([(1, "t", 1500)], "movie_id int, title string, release_year int")
    assert checks.dq_flag(df, checks.rules_movies()).first()._dq_failed_rules == ["INVALID_RELEASE_YEAR"]


def test_filter_pass_counts_and_fails_without_pass_rows(spark):
    df = spark.createDataFrame([("PASS",), ("PASS",), ("QUARANTINE",), ("QUARANTINE",)], "_dq_status string")
    kept, n = checks.filter_pass(df)
    assert kept.count() == 2 and n == {"total": 4, "quarantined": 2}
    with pytest.raises(ValueError):
        checks.filter_pass(df.filter("_dq_status <> 'PASS'"))


def test_validate_table_raises(spark):
    df = spark.createDataFrame([(1, 1), (1, None)], "k int, p int")
    with pytest.raises(ValueError, match="pk_unique:k: 1"):
        checks.validate_table(df, ["k"], ["p"], [("p", spark.range(0).withColumnRenamed("id", "q"), "q")])
    with pytest.raises(ValueError):
        checks.check_foreign_keys(df, [("absent", df, "k")])
    assert checks.dq_batch_metrics(df.withColumn("_dq_status", F.lit("PASS"))).first().total == 2
