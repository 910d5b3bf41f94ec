"""The test tables in the roles of a rated-items lakehouse.

``Roles`` builds each layer as a DataFrame; ``CTES`` says the same in DuckDB
SQL, so a query and its oracle share their inputs but no code. A few values
are broken on purpose, so that every quality rule has rows that fail it.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks, conform, keys, kpi, versioning
from ..session import work_dir
from ..streaming.ingest import EVENT_KEY, NATURAL_KEY, event_order, flagged_ratings

TS = "interaction_timestamp"


class Roles:
    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return df.withColumns({c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"})

    @cached_property
    def raw_ratings(self) -> DataFrame:
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        both = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        return both.selectExpr(
            "if(o_custkey % 41 = 7, 'n/a', cast(o_custkey as string)) as userId",
            "cast(l_partkey as string) as movieId",
            "case when l_partkey % 53 = 5 then '7.5' when l_partkey % 59 = 3 then null else cast(l_quantity / 10 as string) end as rating",
            "case when l_orderkey % 101 = 9 then 0 when l_orderkey % 103 = 11 then null else unix_timestamp(l_shipdate) end as timestamp",
            "o_orderdate as _ingestion_timestamp",
            "year(o_orderdate) as _batch_year",
        )

    @cached_property
    def raw_movies(self) -> DataFrame:
        return self.table("part").selectExpr(
            "cast(p_partkey as string) as movieId",
            """case p_partkey % 6 when 0 then concat(split_part(p_name, ' ', 2), ', The (', 1950 + p_size, ')')
               when 1 then concat(p_name, ' (', 1950 + p_size, ')  ') when 2 then p_name
               when 3 then concat(p_name, ' (', 9100 + p_size, ')') when 4 then concat(split_part(p_name, ' ', 1), ', Das')
               else if(p_partkey % 12 = 5, null, '  ') end as title""",
            """case p_partkey % 10 when 7 then '(no genres listed)' when 8 then '' when 9 then null
               else concat(lower(p_type), '|', p_brand, '| sci-fi ') end as genres""",
            "timestamp '2020-01-01' as _ingestion_timestamp",
        )

    @cached_property
    def raw_tags(self) -> DataFrame:
        return self.table("events").selectExpr(
            "cast(user_id as string) as userId",
            "if(event_id % 31 = 4, 'x', cast(event_id % 200 as string)) as movieId",
            r"""case event_id % 7 when 0 then concat(event_type, chr(9), ' h@ck!', props) when 1 then null when 2 then 'ab'
               when 3 then '  ' else concat(props, ' ', event_type) end as tag""",
            "if(event_id % 37 = 5, 0, unix_timestamp(ts)) as timestamp",
            "timestamp '2020-01-01' as _ingestion_timestamp",
            "cast(2023 + event_id % 2 as int) as _batch_year",
        )

    @cached_property
    def raw_links(self) -> DataFrame:
        return self.table("part").selectExpr(
            "cast(p_partkey as string) as movieId",
            "if(p_partkey % 3 = 0, null, lpad(cast(p_partkey as string), 7, '0')) as imdbId",
            "if(p_partkey % 5 = 0, null, p_size) as tmdbId",
            "timestamp '2020-01-01' as _ingestion_timestamp",
        )

    @cached_property
    def raw_genome_scores(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "cast(l_partkey as string) as movieId",
            "cast(l_suppkey as string) as tagId",
            "case when l_orderkey % 61 = 0 then '1.5' when l_orderkey % 67 = 1 then null else cast(l_discount * 10 + 0.0D as string) end as relevance",
            "l_shipdate as _ingestion_timestamp",
        )

    @cached_property
    def raw_genome_tags(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "cast(s_suppkey as string) as tagId",
            "case when s_suppkey % 9 = 4 then null when s_suppkey % 9 = 5 then ' ' else concat('  ', lower(s_name), chr(10), ' top') end as tag",
            "timestamp '2020-01-01' as _ingestion_timestamp",
        )

    @cached_property
    def ratings(self) -> DataFrame:
        return flagged_ratings(self.raw_ratings)

    @cached_property
    def movies(self) -> DataFrame:
        return checks.dq_flag(conform.conform_movies(self.raw_movies), checks.rules_movies())

    @cached_property
    def silver_movies(self) -> DataFrame:
        """``movies`` as a stored table: titles and genres are parsed once, however many tables are made of them.

        Rows are dealt out first, as a file of few row groups is read by few tasks.
        """
        raw, path = self.raw_movies.repartition("movieId"), f"{work_dir(self.spark)}/movies-{uuid.uuid4().hex}"
        checks.dq_flag(conform.conform_movies(raw), checks.rules_movies()).write.parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def tags(self) -> DataFrame:
        return checks.dq_flag(conform.conform_tags(self.raw_tags), checks.rules_tags())

    @cached_property
    def links(self) -> DataFrame:
        return checks.dq_flag(conform.conform_links(self.raw_links), checks.rules_links())

    @cached_property
    def genome_scores(self) -> DataFrame:
        order = ["relevance desc", "_ingestion_timestamp desc"]
        rows = versioning.dedup_latest(conform.conform_genome_scores(self.raw_genome_scores), ["movie_id", "tag_id"], order)
        return checks.dq_flag(rows, checks.rules_genome_scores())

    @cached_property
    def genome_tags(self) -> DataFrame:
        return checks.dq_flag(conform.conform_genome_tags(self.raw_genome_tags), checks.rules_genome_tags())

    @cached_property
    def versions(self) -> DataFrame:
        return versioning.scd2_bootstrap(self.ratings, EVENT_KEY, NATURAL_KEY, TS, event_order())

    @cached_property
    def dim_movies(self) -> DataFrame:
        return keys.dim_movies(self.silver_movies)

    @cached_property
    def dim_genome_tags(self) -> DataFrame:
        return keys.dim_genome_tags(self.genome_tags)

    @cached_property
    def genre_members(self) -> DataFrame:
        return keys.explode_members(checks.passing(self.silver_movies), "movie_id", "genres", "genre_name")

    @cached_property
    def dim_genres(self) -> DataFrame:
        return keys.dim_genres_incremental(None, self.genre_members)

    @cached_property
    def bridge(self) -> DataFrame:
        return keys.bridge_movies_genres(self.silver_movies, self.dim_movies, self.dim_genres)

    @cached_property
    def dim_date(self) -> DataFrame:
        return keys.dim_date(self.table("lineitem"), "l_shipdate")

    @cached_property
    def fact(self) -> DataFrame:
        return keys.fact_ratings(self.versions, self.dim_movies, self.dim_date)

    @cached_property
    def fact_by_id(self) -> DataFrame:
        """``fact`` with the movies' ids beside their surrogate keys, which go where nothing reads them."""
        return keys.fact_ratings(self.versions, self.dim_movies, self.dim_date, also=["movie_id"])

    @cached_property
    def bridge_by_id(self) -> DataFrame:
        return keys.bridge_movies_genres(self.silver_movies, self.dim_movies, self.dim_genres, by_id=True)

    @cached_property
    def fact_scores(self) -> DataFrame:
        return keys.fact_genome_scores(self.genome_scores, self.dim_movies, self.dim_genome_tags)

    # KPI tables that others are derived from.

    @cached_property
    def monthly(self) -> DataFrame:
        return kpi.rating_trends_monthly(self.fact, self.dim_date)

    @cached_property
    def genre_kpi(self) -> DataFrame:
        return kpi.genre_performance(self.fact, self.bridge, self.dim_genres)

    @cached_property
    def genre_trend(self) -> DataFrame:
        return kpi.genre_trends_yearly(self.fact_by_id, self.dim_date, self.bridge_by_id, self.dim_genres, "movie_id")

    @cached_property
    def yearly(self) -> DataFrame:
        return kpi.yearly_summary(self.fact)

    @cached_property
    def top_rated(self) -> DataFrame:
        return kpi.top_rated_movies(self.fact, self.dim_movies, least=20)

    @cached_property
    def popular(self) -> DataFrame:
        return kpi.most_popular_movies(self.fact, self.dim_movies)


def _proper(x: str) -> str:
    """initcap in DuckDB."""
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: concat(upper(w[1:1]), w[2:])), ' ')"


_ARTICLE = r",\s*(The|A|An|Le|La|Les|Das|Der|Die|El|Il|Los|Las)\s*$"
_NO_YEAR = r"trim(regexp_replace(trim(title), '\s*\(\d{4}\)\s*$', ''))"
_MEAN = "CAST((20 * sum(CAST(round(rating * 10) AS BIGINT)) + count(rating)) // (2 * count(rating)) AS DOUBLE) / 100"
_MEAN_REL = "CAST((20000 * sum(CAST(round(relevance * 1000) AS BIGINT)) + 1000 * count(relevance)) // (2000 * count(relevance)) AS DOUBLE) / 10000"


def pct(part: str, whole: str, places: int) -> str:
    return f"CAST((CAST({part} AS BIGINT) * {200 * 10**places} + ({whole})) // (2 * ({whole})) AS DOUBLE) / {10**places}"


def _flags(source: str, rules: list[tuple[str, str]]) -> str:
    each = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in rules)
    return (
        f"SELECT *, CASE WHEN failed = '' THEN 'PASS' ELSE 'QUARANTINE' END AS status FROM "
        f"(SELECT *, array_to_string(list_filter([{each}], lambda x: x IS NOT NULL), '|') AS failed FROM {source})"
    )


_DAY = "CAST(strftime({0}, '%Y%m%d') AS INTEGER)"
_FLOOR = "TIMESTAMP '1995-01-01'"
CTES = {
    "r_raw": """SELECT CASE WHEN o_custkey % 41 = 7 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS userId, CAST(l_partkey AS VARCHAR) AS movieId,
        CASE WHEN l_partkey % 53 = 5 THEN '7.5' WHEN l_partkey % 59 = 3 THEN NULL ELSE CAST(l_quantity / 10 AS VARCHAR) END AS rating,
        CASE WHEN l_orderkey % 101 = 9 THEN 0 WHEN l_orderkey % 103 = 11 THEN NULL ELSE CAST(epoch(l_shipdate) AS BIGINT) END AS ts,
        o_orderdate AS ingested, CAST(year(o_orderdate) AS INTEGER) AS batch
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "r_typed": """SELECT TRY_CAST(userId AS INTEGER) AS user_id, TRY_CAST(movieId AS INTEGER) AS movie_id, round(TRY_CAST(rating AS DOUBLE), 1) AS rating,
        make_timestamp(ts * 1000000) AS moment, ingested, batch FROM r_raw""",
    "r_conf": f"SELECT *, {_DAY.format('moment')} AS date_key, year(moment) <> batch AS late, CAST(year(moment) AS INTEGER) AS rating_year FROM r_typed",
    "r": _flags("r_conf", [
        ("NULL_USER_ID", "user_id IS NULL"), ("NULL_MOVIE_ID", "movie_id IS NULL"), ("NULL_RATING", "rating IS NULL"),
        ("NULL_TIMESTAMP", "moment IS NULL"), ("INVALID_TIMESTAMP_FLOOR", f"moment < {_FLOOR}"),
        ("INVALID_RATING_RANGE", "NOT rating BETWEEN 0 AND 5"), ("DATE_KEY_MISMATCH", f"date_key <> {_DAY.format('moment')}")]),
    "m_raw": """SELECT CAST(p_partkey AS VARCHAR) AS movieId,
        CASE p_partkey % 6 WHEN 0 THEN split_part(p_name, ' ', 2) || ', The (' || (1950 + p_size) || ')'
          WHEN 1 THEN p_name || ' (' || (1950 + p_size) || ')  ' WHEN 2 THEN p_name WHEN 3 THEN p_name || ' (' || (9100 + p_size) || ')'
          WHEN 4 THEN split_part(p_name, ' ', 1) || ', Das' ELSE CASE WHEN p_partkey % 12 = 5 THEN NULL ELSE '  ' END END AS title,
        CASE p_partkey % 10 WHEN 7 THEN '(no genres listed)' WHEN 8 THEN '' WHEN 9 THEN NULL
          ELSE lower(p_type) || '|' || p_brand || '| sci-fi ' END AS genres FROM part""",
    "m_conf": rf"""SELECT TRY_CAST(movieId AS INTEGER) AS movie_id,
        {_proper(rf"trim(CASE WHEN regexp_matches({_NO_YEAR}, '{_ARTICLE}') THEN regexp_extract({_NO_YEAR}, '{_ARTICLE}', 1) || ' ' || regexp_replace({_NO_YEAR}, '{_ARTICLE}', '') ELSE {_NO_YEAR} END)")} AS title,
        CASE WHEN TRY_CAST(regexp_extract(trim(title), '\((\d{{4}})\)\s*$', 1) AS INTEGER) BETWEEN 1800 AND 2199
          THEN TRY_CAST(regexp_extract(trim(title), '\((\d{{4}})\)\s*$', 1) AS INTEGER) END AS release_year,
        CASE WHEN genres IS NULL OR trim(genres) = '' OR contains(lower(genres), 'no genres listed') THEN CAST([] AS VARCHAR[])
          ELSE list_transform(string_split(genres, '|'), lambda g: {_proper('trim(g)')}) END AS genres FROM m_raw""",
    "m": _flags("m_conf", [
        ("NULL_MOVIE_ID", "movie_id IS NULL"), ("NULL_TITLE", "title IS NULL OR trim(title) = ''"),
        ("INVALID_RELEASE_YEAR", "release_year IS NOT NULL AND NOT release_year BETWEEN 1800 AND 2199")]),
    "t_raw": """SELECT CAST(user_id AS VARCHAR) AS userId, CASE WHEN event_id % 31 = 4 THEN 'x' ELSE CAST(event_id % 200 AS VARCHAR) END AS movieId,
        CASE event_id % 7 WHEN 0 THEN event_type || chr(9) || ' h@ck!' || props WHEN 1 THEN NULL WHEN 2 THEN 'ab' WHEN 3 THEN '  '
          ELSE props || ' ' || event_type END AS tag,
        CASE WHEN event_id % 37 = 5 THEN 0 ELSE CAST(floor(epoch(ts)) AS BIGINT) END AS ts, CAST(2023 + event_id % 2 AS INTEGER) AS batch FROM events""",
    "t_conf": rf"""SELECT *, {_DAY.format('moment')} AS date_key FROM (SELECT TRY_CAST(userId AS INTEGER) AS user_id, TRY_CAST(movieId AS INTEGER) AS movie_id,
        {_proper(r"trim(regexp_replace(regexp_replace(tag, '[^a-zA-Z0-9\s\-]', '', 'g'), '\s+', ' ', 'g'))")} AS tag,
        make_timestamp(ts * 1000000) AS moment, batch FROM t_raw)""",
    "t": _flags("t_conf", [
        ("NULL_USER_ID", "user_id IS NULL"), ("NULL_MOVIE_ID", "movie_id IS NULL"), ("NULL_TAG", "tag IS NULL"), ("EMPTY_TAG", "trim(tag) = ''"),
        ("NULL_TIMESTAMP", "moment IS NULL"), ("INVALID_TIMESTAMP_FLOOR", f"moment < {_FLOOR}"), ("SHORT_TAG", "length(tag) < 3"),
        ("DATE_KEY_MISMATCH", f"date_key <> {_DAY.format('moment')}")]),
    "l_conf": """SELECT CAST(p_partkey AS INTEGER) AS movie_id, CASE WHEN p_partkey % 3 <> 0 THEN 'tt' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') END AS imdb_id,
        CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_size AS VARCHAR) END AS tmdb_id, p_partkey % 3 <> 0 OR p_partkey % 5 <> 0 AS has_external_ids FROM part""",
    "l": _flags("l_conf", [("NULL_MOVIE_ID", "movie_id IS NULL"), ("NO_EXTERNAL_IDS", "NOT has_external_ids")]),
    "g_raw": """SELECT CAST(l_partkey AS INTEGER) AS movie_id, CAST(l_suppkey AS INTEGER) AS tag_id, round(CASE WHEN l_orderkey % 61 = 0 THEN 1.5::DOUBLE
        WHEN l_orderkey % 67 = 1 THEN NULL ELSE l_discount * 10 + 0.0 END, 3) AS relevance, l_shipdate AS ingested FROM lineitem""",
    "g_conf": """SELECT movie_id, tag_id, relevance FROM g_raw
        QUALIFY row_number() OVER (PARTITION BY movie_id, tag_id ORDER BY relevance DESC NULLS LAST, ingested DESC NULLS LAST) = 1""",
    "g": _flags("g_conf", [
        ("NULL_MOVIE_ID", "movie_id IS NULL"), ("NULL_TAG_ID", "tag_id IS NULL"), ("NULL_RELEVANCE", "relevance IS NULL"),
        ("INVALID_RELEVANCE_RANGE", "NOT relevance BETWEEN 0 AND 1")]),
    "gt_conf": rf"""SELECT CAST(s_suppkey AS INTEGER) AS tag_id, {_proper(r"trim(regexp_replace(tag, '\s+', ' ', 'g'))")} AS tag FROM
        (SELECT s_suppkey, CASE WHEN s_suppkey % 9 = 4 THEN NULL WHEN s_suppkey % 9 = 5 THEN ' ' ELSE '  ' || lower(s_name) || chr(10) || ' top' END AS tag FROM supplier)""",
    "gt": _flags("gt_conf", [("NULL_TAG_ID", "tag_id IS NULL"), ("NULL_TAG", "tag IS NULL"), ("EMPTY_TAG", "trim(tag) = ''")]),
    "v_once": """SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY user_id, movie_id, moment
        ORDER BY rating DESC NULLS LAST, batch DESC NULLS LAST, ingested DESC NULLS LAST) = 1""",
    "v": """SELECT * EXCLUDE (n, nx), n = 1 AS is_current, moment AS start_at, CASE WHEN n > 1 THEN nx END AS end_at FROM (SELECT *,
        row_number() OVER (PARTITION BY user_id, movie_id ORDER BY moment DESC NULLS LAST) AS n,
        lead(moment) OVER (PARTITION BY user_id, movie_id ORDER BY moment ASC NULLS FIRST) AS nx FROM v_once)""",
    "dim_m": "SELECT sha256(CAST(movie_id AS VARCHAR)) AS movie_sk, movie_id, title, release_year FROM m WHERE status = 'PASS'",
    "dim_gt": "SELECT sha256(CAST(tag_id AS VARCHAR)) AS tag_sk, tag_id, tag FROM gt WHERE status = 'PASS'",
    "members": "SELECT * FROM (SELECT movie_id, unnest(genres) AS genre_name FROM m WHERE status = 'PASS') WHERE trim(genre_name) <> ''",
    "dim_g": """SELECT sha256(genre_name) AS genre_sk, CAST(row_number() OVER (ORDER BY genre_name) AS INTEGER) AS genre_id, genre_name
        FROM (SELECT min(genre_name) AS genre_name FROM members GROUP BY lower(genre_name))""",
    "bridge": """SELECT DISTINCT movie_sk, genre_sk FROM members JOIN dim_m USING (movie_id) JOIN dim_g ON lower(members.genre_name) = lower(dim_g.genre_name)""",
    "dim_d": f"""SELECT {_DAY.format('d')} AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
        CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name, CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
        strftime(d, '%A') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend, CAST(weekofyear(d) AS INTEGER) AS week_of_year
        FROM (SELECT CAST(unnest(generate_series(min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d FROM lineitem)""",
    "f": """SELECT movie_sk, user_id, movie_id, rating, moment, date_key, rating_year, late, batch, ingested FROM v JOIN dim_m USING (movie_id)
        JOIN dim_d USING (date_key) WHERE status = 'PASS' AND is_current""",
    "fg": "SELECT movie_sk, tag_sk, relevance FROM g JOIN dim_m USING (movie_id) JOIN dim_gt USING (tag_id) WHERE g.status = 'PASS'",
    "k_month": f"""SELECT year, month, month_name, {_MEAN} AS avg_rating, count(*) AS rating_count, count(DISTINCT user_id) AS unique_users,
        count(DISTINCT movie_sk) AS unique_movies FROM f JOIN dim_d USING (date_key) GROUP BY ALL""",
    "k_genre": f"""SELECT genre_name, {_MEAN} AS avg_rating, count(*) AS rating_count, count(DISTINCT movie_sk) AS unique_movies,
        count(DISTINCT user_id) AS unique_users FROM f JOIN bridge USING (movie_sk) JOIN dim_g USING (genre_sk) GROUP BY ALL""",
    "k_stats": f"SELECT movie_sk, {_MEAN} AS avg_rating, count(*) AS rating_count FROM f GROUP BY movie_sk",
    "k_rated": """SELECT movie_id, title, release_year, avg_rating, rating_count FROM k_stats JOIN dim_m USING (movie_sk) WHERE rating_count >= 20
        ORDER BY avg_rating DESC, rating_count DESC, movie_id LIMIT 30""",
    "k_popular": """SELECT movie_id, title, release_year, avg_rating, rating_count FROM k_stats JOIN dim_m USING (movie_sk)
        ORDER BY rating_count DESC, movie_id LIMIT 30""",
    "k_trend": f"""SELECT year, genre_name, {_MEAN} AS avg_rating, count(*) AS rating_count FROM f JOIN dim_d USING (date_key)
        JOIN bridge USING (movie_sk) JOIN dim_g USING (genre_sk) GROUP BY ALL""",
    "k_activity": f"""SELECT activity_bucket, user_count, {pct('user_count', 'sum(user_count) OVER ()', 2)} AS pct_of_users FROM (
        SELECT CASE WHEN n <= 10 THEN '01 — 1-10' WHEN n <= 50 THEN '02 — 11-50' WHEN n <= 200 THEN '03 — 51-200' WHEN n <= 500 THEN '04 — 201-500'
          WHEN n <= 1000 THEN '05 — 501-1000' ELSE '06 — 1000+' END AS activity_bucket, count(*) AS user_count
        FROM (SELECT user_id, count(*) AS n FROM f GROUP BY user_id) GROUP BY 1)""",
    "k_dist": f"SELECT rating, n AS rating_count, {pct('n', 'sum(n) OVER ()', 2)} AS pct_of_total FROM (SELECT rating, count(*) AS n FROM f GROUP BY rating)",
    "k_year": f"""SELECT *, {pct('late_arrival_count', 'total_ratings', 3)} AS late_arrival_pct FROM (SELECT CAST(year(moment) AS INTEGER) AS year,
        count(*) AS total_ratings, count(DISTINCT user_id) AS unique_users, count(DISTINCT movie_sk) AS unique_movies, {_MEAN} AS avg_rating,
        count(*) FILTER (late) AS late_arrival_count FROM f GROUP BY 1)""",
    "k_decade": f"""SELECT CAST(release_year // 10 * 10 AS VARCHAR) || 's' AS decade, count(DISTINCT movie_sk) AS movie_count, {_MEAN} AS avg_rating,
        count(*) AS total_ratings, count(DISTINCT user_id) AS unique_users FROM f JOIN dim_m USING (movie_sk) WHERE release_year IS NOT NULL GROUP BY 1""",
    "k_all": f"""SELECT count(*) AS total_ratings, count(DISTINCT user_id) AS unique_users, count(DISTINCT movie_sk) AS unique_movies, {_MEAN} AS avg_rating FROM f""",
}


def sql(body: str) -> str:
    """``body`` over the layers it needs."""
    needed: list[str] = []
    for name in reversed(CTES):
        text = " ".join([body, *(CTES[n] for n in needed)])
        if any(w == name for w in _words(text)):
            needed.append(name)
    return (f"WITH {', '.join(f'{n} AS ({CTES[n]})' for n in reversed(needed))} " if needed else "") + body


def _words(text: str) -> list[str]:
    return "".join(c if c.isalnum() or c == "_" else " " for c in text).split()
