"""Analytic aggregates over the star schema, and figures derived from them.

Counts of distinct values go by Spark's own expansion, averages and percents
by exact integer arithmetic, and every top list has a total order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as fn

#: Users by how many ratings they gave; the last is open.
BUCKETS = ((10, "01 — 1-10"), (50, "02 — 11-50"), (200, "03 — 51-200"), (500, "04 — 201-500"), (1000, "05 — 501-1000"))
OVER = "06 — 1000+"

def _avg() -> Column:
    return fn.mean_exact("rating", 1, 2).alias("avg_rating")


def _rows() -> Column:
    return F.count("*").alias("rating_count")


def _users() -> Column:
    return F.countDistinct("user_id").alias("unique_users")


def _movies() -> Column:
    return F.countDistinct("movie_sk").alias("unique_movies")


def all_time_summary(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count("*").alias("total_ratings"), _users(), _movies(), _avg())


def rating_trends_monthly(fact: DataFrame, dates: DataFrame) -> DataFrame:
    named = fact.join(dates.select("date_key", "year", "month", "month_name"), "date_key")
    return named.groupBy("year", "month", "month_name").agg(_avg(), _rows(), _users(), _movies())


def by_genre(fact: DataFrame, bridge: DataFrame, genres: DataFrame, movie: str = "movie_sk") -> DataFrame:
    return fact.join(bridge, movie).join(genres.select("genre_sk", "genre_name"), "genre_sk")


def genre_performance(fact: DataFrame, bridge: DataFrame, genres: DataFrame) -> DataFrame:
    """The fact is grouped by movie before the bridge multiplies it; for users it is joined as it is, mostly one row per movie and user."""
    named = bridge.join(genres.select("genre_sk", "genre_name"), "genre_sk").select("movie_sk", "genre_name")
    units, known, rows = fn.mean_parts("rating", 1)
    movies = fact.groupBy("movie_sk").agg(units.alias("units"), known.alias("known"), rows.alias("rows"))
    sums = movies.join(named, "movie_sk").groupBy("genre_name").agg(
        fn.mean_of_parts(F.sum("units"), F.sum("known"), 1, 2).alias("avg_rating"),
        F.sum("rows").alias("rating_count"),
        F.count("*").alias("unique_movies"),
    )
    users = fact.select("movie_sk", "user_id").join(named, "movie_sk").groupBy("genre_name").agg(_users())
    return sums.join(users, "genre_name")


def movie_stats(fact: DataFrame) -> DataFrame:
    return fact.groupBy("movie_sk").agg(_avg(), _rows())


def _top_movies(stats: DataFrame, movies: DataFrame, order: list[Column], n: int) -> DataFrame:
    named = stats.join(movies, "movie_sk").select("movie_id", "title", "release_year", "avg_rating", "rating_count")
    return named.orderBy(*order, "movie_id").limit(n)


def top_rated_movies(fact: DataFrame, movies: DataFrame, least: int = 100, n: int = 30) -> DataFrame:
    stats = movie_stats(fact).filter(F.col("rating_count") >= least)
    return _top_movies(stats, movies, [F.desc("avg_rating"), F.desc("rating_count")], n)


def most_popular_movies(fact: DataFrame, movies: DataFrame, n: int = 30) -> DataFrame:
    return _top_movies(movie_stats(fact), movies, [F.desc("rating_count")], n)


def genre_trends_yearly(fact: DataFrame, dates: DataFrame, bridge: DataFrame, genres: DataFrame, movie: str = "movie_sk") -> DataFrame:
    """The fact is grouped by movie and year before the bridge multiplies it.

    ``movie`` names the movie's key in fact and bridge; an integer one is shuffled in a sixteenth of a surrogate key's bytes.
    """
    dated = fact.join(dates.select("date_key", "year"), "date_key")
    units, known, rows = fn.mean_parts("rating", 1)
    movies = dated.groupBy(movie, "year").agg(units.alias("units"), known.alias("known"), rows.alias("rows"))
    return by_genre(movies, bridge, genres, movie).groupBy("year", "genre_name").agg(
        fn.mean_of_parts(F.sum("units"), F.sum("known"), 1, 2).alias("avg_rating"), F.sum("rows").alias("rating_count")
    )


def user_activity_distribution(fact: DataFrame) -> DataFrame:
    n, bucket = F.col("n"), F.lit(OVER)
    for most, name in reversed(BUCKETS):
        bucket = F.when(n <= most, name).otherwise(bucket)
    users = fact.groupBy("user_id").agg(F.count("*").alias("n"))
    counts = users.groupBy(bucket.alias("activity_bucket")).agg(F.count("*").alias("user_count"))
    whole = F.sum("user_count").over(Window.partitionBy())  # over six rows
    return counts.withColumn("pct_of_users", fn.percent_exact(F.col("user_count"), whole, 2))


def rating_distribution(fact: DataFrame) -> DataFrame:
    counts = fact.groupBy("rating").agg(_rows())
    whole = F.sum("rating_count").over(Window.partitionBy())  # over the distinct ratings
    return counts.withColumn("pct_of_total", fn.percent_exact(F.col("rating_count"), whole, 2))


def yearly_summary(fact: DataFrame) -> DataFrame:
    years = fact.groupBy(F.year("interaction_timestamp").alias("year"))
    out = years.agg(
        F.count("*").alias("total_ratings"), _users(), _movies(), _avg(), F.count_if("is_late_arrival").alias("late_arrival_count")
    )
    return out.withColumn("late_arrival_pct", fn.percent_exact("late_arrival_count", "total_ratings", 3))


def release_decade(fact: DataFrame, movies: DataFrame) -> DataFrame:
    dated = fact.join(movies.select("movie_sk", "release_year"), "movie_sk").filter("release_year is not null")
    decade = F.concat((F.col("release_year") - F.col("release_year") % 10).cast("string"), F.lit("s"))
    return dated.groupBy(decade.alias("decade")).agg(
        F.countDistinct("movie_sk").alias("movie_count"), _avg(), F.count("*").alias("total_ratings"), _users()
    )


def top_genome_tags(scores: DataFrame, tags: DataFrame, n: int = 20) -> DataFrame:
    named = scores.join(tags.select("tag_sk", "tag"), "tag_sk").groupBy("tag")
    out = named.agg(fn.mean_exact("relevance", 3, 4).alias("avg_relevance"), F.countDistinct("movie_sk").alias("movie_count"))
    return out.orderBy(F.desc("avg_relevance"), "tag").limit(n)


def late_matrix(ratings: DataFrame) -> DataFrame:
    late = ratings.filter("is_late_arrival")
    return late.groupBy("_batch_year", "rating_year").agg(F.count("*").alias("late_rows"))


def event_year_late_distribution(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("rating_year", "is_late_arrival").agg(F.count("*").alias("rows"))


def rerated_pairs(ratings: DataFrame, n: int = 20) -> DataFrame:
    pairs = ratings.groupBy("user_id", "movie_id").agg(F.count("*").alias("versions")).filter("versions > 1")
    return pairs.orderBy(F.desc("versions"), "user_id", "movie_id").limit(n)


def pair_history(ratings: DataFrame, user: int, movie: int) -> DataFrame:
    mine = ratings.filter((F.col("user_id") == user) & (F.col("movie_id") == movie))
    return mine.orderBy("interaction_timestamp")


def pair_histories(ratings: DataFrame, pairs: DataFrame) -> DataFrame:
    """All versions of each of a few pairs, in order."""
    mine = ratings.join(pairs.select("user_id", "movie_id"), ["user_id", "movie_id"])
    return mine.orderBy("user_id", "movie_id", "interaction_timestamp")


def layer_latency(df: DataFrame, ingested: str, processed: str, batch: str) -> DataFrame:
    minutes = (F.unix_timestamp(processed) - F.unix_timestamp(ingested)) / 60
    return df.groupBy(batch).agg(F.avg(minutes).alias("avg_minutes"))


def coverage_fact(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count("*").alias("rows"), _movies(), _users(), F.min("rating_year").alias("first_year"), F.max("rating_year").alias("last_year"), _avg()
    )


def coverage_scores(scores: DataFrame) -> DataFrame:
    return scores.agg(
        F.countDistinct("movie_sk").alias("movies"),
        F.countDistinct("tag_sk").alias("tags"),
        F.min("relevance").alias("least"),
        F.max("relevance").alias("most"),
        fn.mean_exact("relevance", 3, 4).alias("mean"),
    )


def coverage_bridge(bridge: DataFrame) -> DataFrame:
    out = bridge.agg(F.countDistinct("movie_sk").alias("movies"), F.countDistinct("genre_sk").alias("genres"), F.count("*").alias("pairs"))
    return out.withColumn("genres_per_movie", fn.percent_exact(F.col("pairs"), F.col("movies") * 100, 2))


def coverage_calendar(dates: DataFrame) -> DataFrame:
    return dates.agg(
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.countDistinct("year").alias("years"),
        F.count_if("is_weekend").alias("weekend_days"),
        F.count_if(~F.col("is_weekend")).alias("week_days"),
    )


def coverage_genre_ids(genres: DataFrame) -> DataFrame:
    return genres.agg(F.min("genre_id").alias("least_id"), F.max("genre_id").alias("most_id"))


def silver_stats_movies(movies: DataFrame) -> DataFrame:
    return movies.agg(
        F.count_if(F.col("release_year").isNull()).alias("null_years"), F.count_if(F.size("genres") == 0).alias("empty_genres")
    )


def silver_stats_links(links: DataFrame) -> DataFrame:
    none = lambda c: F.count_if(F.col(c).isNull())
    return links.agg(none("imdb_id").alias("no_imdb"), none("tmdb_id").alias("no_tmdb"), F.count_if(~F.col("has_external_ids")).alias("neither"))


def silver_stats_tags(tags: DataFrame) -> DataFrame:
    size = F.length("tag")
    return tags.agg(F.min(size).alias("shortest"), F.max(size).alias("longest"), fn.mean_exact(size, 0, 2).alias("mean_length"))


def silver_stats_scores(scores: DataFrame) -> DataFrame:
    ok = scores.filter("_dq_status = 'PASS'")
    return ok.agg(F.min("relevance").alias("least"), F.max("relevance").alias("most"), fn.mean_exact("relevance", 3, 4).alias("mean"))


# Figures derived from the tables above.


def yoy_growth(yearly: DataFrame) -> DataFrame:
    """Percent change of yearly totals; the first year has none and goes."""
    before = F.lag("total_ratings").over(Window.orderBy("year"))  # one row per year
    change = (F.col("total_ratings") - F.col("before")).cast("double") * F.lit(100.0).cast("double") / F.col("before").cast("double")
    return yearly.withColumn("before", before).filter("before is not null").select("year", "total_ratings", change.alias("growth_pct"))


def monthly_range(monthly: DataFrame, first: int, last: int) -> DataFrame:
    label = F.concat_ws("-", F.col("year").cast("string"), F.lpad(F.col("month").cast("string"), 2, "0"))
    return monthly.filter(F.col("year").between(first, last)).withColumn("year_month", label)


def monthly_range_mean(monthly: DataFrame, first: int, last: int) -> DataFrame:
    chosen = monthly_range(monthly, first, last)
    mean = lambda c: (F.sum(c).cast("double") / F.count(c).cast("double")).alias(f"mean_{c}")
    ends = [F.min("year_month").alias("first_month"), F.max("year_month").alias("last_month")]
    return chosen.agg(*ends, mean("unique_users"), mean("unique_movies"))


def rating_vs_popularity(top_rated: DataFrame, popular: DataFrame, n: int = 100, labelled: int = 10) -> DataFrame:
    """One point per title of both lists; the first ``labelled`` have a label."""
    both = top_rated.unionByName(popular)
    first = F.row_number().over(Window.partitionBy("title").orderBy(F.desc("rating_count"), "movie_id"))
    once = both.withColumn("_r", first).filter("_r = 1").drop("_r")
    once = once.orderBy(F.desc("rating_count"), "movie_id").limit(n)
    rank = F.row_number().over(Window.orderBy(F.desc("rating_count"), "movie_id"))  # over at most n rows
    return once.withColumn("label", F.when(rank <= labelled, F.col("title")))


def top_n(ranking: DataFrame, n: int, *order: Column | str) -> DataFrame:
    return ranking.orderBy(*order).limit(n)


def top_genres_trend(trend: DataFrame, genres: DataFrame | None = None, n: int = 5) -> DataFrame:
    """The trend's rows of the genres with the most ratings, by a ranking or by the trend's own sums.

    Without a ranking the trend is computed once, and the fact not grouped again: a genre's rows, one per year, go with its sum.
    """
    if genres is None:
        rows = F.collect_list(F.struct(*trend.columns)).alias("_rows")
        years = trend.groupBy("genre_name").agg(F.sum("rating_count").alias("_all"), rows)
        return years.orderBy(F.desc("_all"), "genre_name").limit(n).select(F.inline("_rows"))
    largest = genres.orderBy(F.desc("rating_count"), "genre_name").limit(n)
    return trend.join(largest.select("genre_name"), "genre_name", "left_semi").select(trend.columns)


def genre_year_matrix(trend: DataFrame, years: list[int]) -> DataFrame:
    """Genres by year, 0 where a genre has no rating."""
    wide = trend.groupBy("genre_name").pivot("year", years).agg(F.sum("rating_count"))
    return wide.na.fill(0).select("genre_name", *[F.col(f"`{y}`").alias(f"y{y}") for y in years])


def cumulative_pct(distribution: DataFrame) -> DataFrame:
    """Running percent up to each rating value (a few rows)."""
    up_to = Window.orderBy("rating").rowsBetween(Window.unboundedPreceding, 0)
    part, whole = F.sum("rating_count").over(up_to), F.sum("rating_count").over(Window.partitionBy())
    return distribution.select("rating", "rating_count", fn.percent_exact(part, whole, 2).alias("cumulative_pct"))


def engagement_cards(activity: DataFrame, distribution: DataFrame) -> DataFrame:
    """One row: users, ratings, ratings per user, and the modal bucket and rating."""
    users = activity.agg(F.sum("user_count").alias("n"), F.max_by("activity_bucket", F.struct("user_count", "activity_bucket")).alias("b"))
    rows = distribution.agg(F.sum("rating_count").alias("m"), F.max_by("rating", F.struct("rating_count", "rating")).alias("r"))
    one = users.withColumn("k", F.lit(1)).join(rows.withColumn("k", F.lit(1)), "k")
    return one.select(
        F.col("n").alias("total_users"),
        F.col("m").alias("total_ratings"),
        fn.percent_exact(F.col("m"), F.col("n") * 100, 2).alias("ratings_per_user"),
        bucket_label("b").alias("modal_bucket"),
        F.col("r").alias("modal_rating"),
    )


def bucket_label(c: str | Column) -> Column:
    """'01 — 1-10' as '1-10'."""
    return F.regexp_replace(c, r"^\d+ — ", "")


def decade_cards(decades: DataFrame, since: int = 1920) -> DataFrame:
    late = decades.filter(F.regexp_replace("decade", "s$", "").cast("int") >= since)
    best = lambda c: F.max_by("decade", F.struct(c, "decade"))
    return late.agg(
        best("avg_rating").alias("best_rated"), best("total_ratings").alias("most_rated"), best("movie_count").alias("most_movies")
    )


def latest_year_delta(yearly: DataFrame, summary: DataFrame) -> DataFrame:
    last = yearly.agg(F.max_by(F.struct("year", "total_ratings", "avg_rating"), "year").alias("y"))
    one = last.withColumn("k", F.lit(1)).join(summary.select(F.lit(1).alias("k"), F.col("avg_rating").alias("all_time")), "k")
    cents = lambda c: F.round(F.col(c) * 100).cast("bigint")
    delta = (cents("y.avg_rating") - cents("all_time")).cast("double") / 100.0
    return one.select("y.year", "y.total_ratings", "y.avg_rating", delta.alias("delta"))
