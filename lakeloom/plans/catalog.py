"""One query per operator, each with the SQL it must equal where SQL can say it.

Times are shown as text and arrays joined by a bar, so that both engines
render them alike. Writers and streams work in the shared folder and return
what they read back; clocks are left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import checks, conform, incremental, keys, kpi, versioning
from ..session import work_dir
from ..sources import clustering, loads
from ..sources import tables as src
from ..streaming.ingest import EVENT_KEY, NATURAL_KEY, event_order, flagged_ratings, stream_ingest_incremental
from .roles import _MEAN, TS, Roles, pct, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: The same queries as functions of the tables in their roles.
BUILDS: dict[str, Callable[[Roles], DataFrame]] = {}


def shown(df: DataFrame) -> DataFrame:
    """Times as text, arrays joined."""
    how = {
        "timestamp": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss"),
        "date": lambda c: F.date_format(c, "yyyy-MM-dd"),
        "array<string>": lambda c: F.array_join(c, "|"),
    }
    return df.select(*[how[t](F.col(c)).alias(c) if t in how else F.col(c) for c, t in df.dtypes])


def query(oracle: str | None = None, name: str | None = None):
    def add(build: Callable[[Roles], DataFrame]):
        key = name or build.__name__
        BUILDS[key] = build
        QUERIES[key] = lambda spark, folder: shown(build(Roles(spark, folder)))
        if oracle:
            ORACLES[key] = sql(oracle)
        return build

    return add


def _work(r: Roles, name: str) -> str:
    return f"{work_dir(r.spark)}/{name}-{uuid.uuid4().hex}"


_AT = "strftime(moment, '%Y-%m-%d %H:%M:%S')"
_TABLE = "SELECT user_id, movie_id, rating, rating_year, batch AS _batch_year FROM r"
_HISTORY = f"""SELECT user_id, movie_id, rating, {_AT} AS interaction_timestamp, is_current, strftime(start_at, '%Y-%m-%d %H:%M:%S') AS effective_start_date,
    strftime(end_at, '%Y-%m-%d %H:%M:%S') AS effective_end_date"""
_VERSION = ["user_id", "movie_id", "rating", TS, "is_current", "effective_start_date", "effective_end_date"]

# Scans and incremental state.


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def scan_table(r):
    return src.scan_table(r.spark, f"{r.folder}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@query("SELECT user_id, movie_id, rating FROM r WHERE batch = 1999")
def scan_partition_slice(r):
    return src.scan_partition_slice(r.ratings, "_batch_year", 1999).select("user_id", "movie_id", "rating")


@query("SELECT DISTINCT batch FROM r WHERE batch <= 1998")
def processed_batches(r):
    return src.processed_batches(r.ratings.filter("_batch_year <= 1998"), "_batch_year")


@query("SELECT DISTINCT batch FROM r")
def available_batches(r):
    return src.available_batches(r.ratings, "_batch_year")


@query("SELECT DISTINCT batch FROM r WHERE batch > 1998")
def pending_batches(r):
    return src.pending_batches(src.available_batches(r.ratings, "_batch_year"), src.processed_batches(r.ratings.filter("_batch_year <= 1998"), "_batch_year"))


@query("SELECT DISTINCT batch FROM r WHERE batch <= 1998")
def skipped_batches(r):
    return src.skipped_batches(src.available_batches(r.ratings, "_batch_year"), src.processed_batches(r.ratings.filter("_batch_year <= 1998"), "_batch_year"))


@query("SELECT DISTINCT batch FROM r")
def partition_batches(r):
    path, name = _work(r, "partitions"), f"lakeloom_{uuid.uuid4().hex}"
    src.write_overwrite(_ratings_table(r), path, ["_batch_year"])
    src.register_table(r.spark, name, path)
    return src.partition_batches(r.spark, name, "_batch_year")


@query("""SELECT 'c_custkey' AS "column", count(*) AS rows, count(*) - count(c_custkey) AS nulls, count(DISTINCT c_custkey) AS "distinct",
    CAST(min(c_custkey) AS VARCHAR) AS least, CAST(max(c_custkey) AS VARCHAR) AS greatest FROM customer
    UNION ALL SELECT 'c_mktsegment', count(*), count(*) - count(c_mktsegment), count(DISTINCT c_mktsegment), min(c_mktsegment), max(c_mktsegment) FROM customer""")
def table_profile(r):
    return src.table_profile(r.table("customer").select("c_custkey", "c_mktsegment"))


_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS "distinct",
    CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS greatest FROM lineitem"""
    for c in ("l_returnflag", "l_linestatus", "l_linenumber")
)


@query(_PROFILE)
def table_profile_sketched(r):
    """The columns have few values, of which the sketch of each of seven batches holds all."""
    lines = r.table("lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", F.year("l_shipdate").alias("batch"))
    united = src.unite_sketches(src.profile_sketches(lines, "batch"))
    return src.sketched_profile(united).drop("lower", "median", "upper")


def _broken_lines(r: Roles) -> DataFrame:
    """Lines of raw ratings: too short, too long, with a bad number, or right."""
    return r.table("orders").selectExpr(
        """case o_orderkey % 6 when 0 then concat(o_custkey, ',', o_orderkey) when 1 then concat_ws(',', o_custkey, o_orderkey, '3.5', '915148800', 'more')
           when 2 then concat_ws(',', 'n/a', o_orderkey, 'x', '915148800') when 3 then concat_ws(',', o_custkey, '', '3.5', '915148800')
           else concat_ws(',', o_custkey, o_orderkey, '4.5', '915148800') end as value"""
    )


_LINES = """(SELECT CASE o_orderkey % 6 WHEN 0 THEN o_custkey || ',' || o_orderkey WHEN 1 THEN o_custkey || ',' || o_orderkey || ',3.5,915148800,more'
    WHEN 2 THEN 'n/a,' || o_orderkey || ',x,915148800' ELSE NULL END AS raw, o_orderkey, o_custkey FROM orders)"""


@query(f"""SELECT CAST(CASE WHEN o_orderkey % 6 = 2 THEN NULL ELSE o_custkey END AS INTEGER) AS "userId", CAST(CASE WHEN o_orderkey % 6 = 3 THEN NULL ELSE o_orderkey END AS INTEGER) AS "movieId",
    CASE WHEN o_orderkey % 6 IN (0, 2) THEN NULL WHEN o_orderkey % 6 IN (1, 3) THEN 3.5::DOUBLE ELSE 4.5::DOUBLE END AS rating,
    CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 915148800::BIGINT END AS "timestamp", raw AS _raw_line,
    CASE o_orderkey % 6 WHEN 0 THEN 'FEW_FIELDS' WHEN 1 THEN 'MANY_FIELDS' WHEN 2 THEN 'BAD_VALUE:userId,rating' END AS _reject_reason FROM {_LINES}""")
def scan_csv_checked(r):
    path = _work(r, "lines")
    _broken_lines(r).write.text(path)
    return src.scan_csv_checked(r.spark, path, "ratings", header=False)


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) + 10 AS number FROM orders")
def number_rows(r):
    return keys.number_rows(r.table("orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], "number", 10).drop("o_totalprice")


def _file():
    """The file's name without the number among its year's files."""
    return F.regexp_replace(F.regexp_extract("_input_file_name", "[^/]*$", 0), r"\.\d+\.csv$", ".csv").alias("file")


def _csv_folder(r: Roles) -> str:
    """The raw ratings as CSV files ``ratings_<year>.<number>.csv``, written in one job."""
    folder = _work(r, "csv")
    rows = r.raw_ratings.selectExpr(
        "try_cast(userId as int) userId", "try_cast(movieId as int) movieId", "try_cast(rating as double) rating", "timestamp", "_batch_year"
    )
    rows.hint("rebalance", "_batch_year").write.partitionBy("_batch_year").option("header", True).csv(f"{folder}/parts")
    path = r.spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(r.spark._jsc.hadoopConfiguration())
    for year in fs.globStatus(path(f"{folder}/parts/_batch_year=*")):  # file names only
        for k, part in enumerate(fs.globStatus(path(year.getPath(), "part-*.csv"))):
            fs.rename(part.getPath(), path(f"{folder}/ratings_{year.getPath().getName().split('=')[1]}.{k}.csv"))
    return folder


@query('SELECT TRY_CAST(userId AS INTEGER) AS "userId", TRY_CAST(movieId AS INTEGER) AS "movieId", TRY_CAST(rating AS DOUBLE) AS rating, ts AS "timestamp" FROM r_raw')
def scan_csv_typed(r):
    return src.scan_csv_typed(r.spark, f"{_csv_folder(r)}/ratings_*.csv", "ratings")


@query("SELECT DISTINCT batch FROM r")
def discover_batches(r):
    return src.discover_batches(r.spark, _csv_folder(r), "ratings")


@query("SELECT p_partkey, 'part.parquet' AS file, 'run-1' AS _job_run_id, 'jobs/load' AS _notebook_path, 'files' AS _source_system FROM part")
def lineage_static(r):
    rows = conform.lineage_static(r.spark.read.parquet(f"{r.folder}/part.parquet"), "run-1", "jobs/load", "files")
    return rows.select("p_partkey", _file(), "_job_run_id", "_notebook_path", "_source_system")


@query(f"""SELECT TRY_CAST(userId AS INTEGER) AS "userId", TRY_CAST(movieId AS INTEGER) AS "movieId", 'ratings_' || batch || '.csv' AS file, batch AS _batch_year,
    'ratings_' || batch AS _batch_id, 'run-1' AS _job_run_id, 'jobs/load' AS _notebook_path, 'files' AS _source_system FROM r_raw""")
def lineage_incremental(r):
    scan = src.scan_csv_typed(r.spark, f"{_csv_folder(r)}/ratings_*.csv", "ratings")
    rows = conform.lineage_incremental(scan, "ratings", "run-1", "jobs/load", "files")
    return rows.select("userId", "movieId", _file(), "_batch_year", "_batch_id", "_job_run_id", "_notebook_path", "_source_system")


@query("""SELECT movie_id, title, '2020-01-01 00:00:00' AS _bronze_ingestion_timestamp, 'run-1' AS _job_run_id, 'jobs/movies' AS _notebook_path,
    'files' AS _source_system FROM m""")
def lineage_silver_static(r):
    return conform.lineage_silver_static(r.movies, "run-1", "jobs/movies", "files").select(
        "movie_id", "title", "_bronze_ingestion_timestamp", "_job_run_id", "_notebook_path", "_source_system"
    )


@query("""SELECT user_id, movie_id, strftime(ingested, '%Y-%m-%d %H:%M:%S') AS _bronze_ingestion_timestamp, batch AS _batch_year, 'run-1' AS _job_run_id,
    'jobs/ratings' AS _notebook_path, 'files' AS _source_system FROM r""")
def lineage_silver_incremental(r):
    rows = conform.lineage_silver_incremental(r.ratings, "run-1", "jobs/ratings", "files", F.col("_batch_year"))
    return rows.select("user_id", "movie_id", "_bronze_ingestion_timestamp", "_batch_year", "_job_run_id", "_notebook_path", "_source_system")


@query("""SELECT *, 'silver.movies' AS _source_table, 'run-1' AS _job_run_id, 'jobs/dim' AS _notebook_path, '1.0' AS _model_version, 0 AS _source_silver_version
    FROM dim_m""")
def lineage_gold(r):
    return conform.lineage_gold(r.dim_movies, "silver.movies", "run-1", "jobs/dim", "1.0", 0).drop("_aggregation_timestamp")


def _ratings_table(r: Roles) -> DataFrame:
    return r.ratings.select("user_id", "movie_id", "rating", "rating_year", "_batch_year")


@query(_TABLE)
def write_overwrite(r):
    path = _work(r, "overwrite")
    src.write_overwrite(_ratings_table(r), path, ["_batch_year"])
    src.write_overwrite(_ratings_table(r), path, ["_batch_year"])
    return r.spark.read.parquet(path).select(_ratings_table(r).columns)


@query(f"{_TABLE} WHERE batch <> 1999 OR rating > 2")
def write_replace_partition(r):
    path, rows = _work(r, "replace"), _ratings_table(r)
    src.write_overwrite(rows, path, ["_batch_year"])
    src.write_replace_partition(rows.filter("_batch_year = 1999 and rating > 2"), path, "_batch_year", 1999)
    return r.spark.read.parquet(path).select(_ratings_table(r).columns)


@query(f"{_TABLE} WHERE rating_year IS NULL OR rating_year NOT IN (1998, 1999) OR rating > 2")
def write_replace_touched_partitions(r):
    path, rows = _work(r, "touched"), _ratings_table(r)
    src.write_overwrite(rows, path, ["rating_year"])
    src.write_replace_touched_partitions(rows.filter("rating_year in (1998, 1999) and rating > 2"), path, "rating_year")
    return r.spark.read.parquet(path).select(_ratings_table(r).columns)


@query(f"{_TABLE} UNION ALL {_TABLE}")
def write_append(r):
    path = _work(r, "append")
    for _ in range(2):
        src.write_append(_ratings_table(r), path)
    return r.spark.read.parquet(path).select(_ratings_table(r).columns)


@query("SELECT * FROM k_dist")
def write_parquet_kpi(r):
    folder = _work(r, "kpi")
    src.write_parquet_kpi(kpi.rating_distribution(r.fact), folder, "rating_distribution")
    return r.spark.read.parquet(f"{folder}/rating_distribution.parquet")


@query("SELECT count(*) AS rows, CAST(count(*) AS INTEGER) AS committed FROM r")
def committed_row_count(r):
    rows = _ratings_table(r)
    n = src.write_overwrite(rows, _work(r, "counted"))
    return rows.agg(F.count("*").alias("rows")).withColumn("committed", F.lit(n))


@query("SELECT user_id, movie_id, CAST(NULL AS DOUBLE) AS rating, rating_year, batch AS _batch_year, 1 AS extra FROM r")
def schema_guard(r):
    rows = _ratings_table(r)
    return src.schema_guard(rows.drop("rating").withColumn("extra", F.lit(1)), rows.schema, "null")


@query(_TABLE)
def register_table(r):
    path, name = _work(r, "registered"), f"lakeloom_{uuid.uuid4().hex}"
    src.write_overwrite(_ratings_table(r), path, ["_batch_year"])
    src.register_table(r.spark, name, path, {"layer": "silver"})
    return r.spark.table(name).select(_ratings_table(r).columns)


def _two_snapshots(r: Roles) -> str:
    root, orders = _work(r, "snapshots"), r.table("orders")
    src.snapshot_write(orders.filter("o_orderkey % 10 <> 0"), root)
    src.snapshot_write(orders, root)
    return root


@query("SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate) FROM orders WHERE o_orderkey % 10 <> 0")
def snapshot_read_as_of(r):
    return src.snapshot_read_as_of(r.spark, _two_snapshots(r), 0)


@query("SELECT CAST(count(*) + count(*) FILTER (o_orderkey % 10 <> 0) AS BIGINT) AS rows, 1 AS version FROM orders")
def current_version(r):
    root = _two_snapshots(r)
    found = r.spark.read.parquet(f"{root}/versions").agg(F.sum("rows").alias("rows"))
    return found.withColumn("version", F.lit(src.current_version(r.spark, root)))


@query(_TABLE)
def rewrite_clustered(r):
    path = _work(r, "clustered")
    clustering.rewrite_clustered(_ratings_table(r), path, ["movie_id", "user_id"], 16)
    return r.spark.read.parquet(path).select(_ratings_table(r).columns)


@query("SELECT count(*) AS rows, CAST(min(movie_id) AS INTEGER) AS least_movie_id, CAST(max(user_id) AS INTEGER) AS greatest_user_id FROM r")
def clustered_file_ranges(r):
    path = _work(r, "clustered")
    clustering.rewrite_clustered(_ratings_table(r), path, ["movie_id", "user_id"], 16)
    ranges = clustering.file_ranges(r.spark.read.parquet(path), ["movie_id", "user_id"])
    return ranges.agg(F.sum("rows").alias("rows"), F.min("least_movie_id").alias("least_movie_id"), F.max("greatest_user_id").alias("greatest_user_id"))


@query(f"{_HISTORY}, 0 AS version FROM v")
def stream_ingest_incremental_files(r):
    folder, root, mark = _csv_folder(r), _work(r, "stream"), _work(r, "stream-checkpoint")
    version = stream_ingest_incremental(r.spark, folder, root, mark)
    again = stream_ingest_incremental(r.spark, folder, root, mark)  # nothing new
    return src.snapshot_read_as_of(r.spark, root, again).select(*_VERSION, F.lit(version).alias("version"))


for _all in (QUERIES, ORACLES, BUILDS):
    _all["stream_ingest_incremental"] = _all.pop("stream_ingest_incremental_files")

# Conform transforms and flags.


@query(f"""SELECT user_id, movie_id, rating, {_AT} AS interaction_timestamp, date_key, late AS is_late_arrival, rating_year, true AS is_current,
    {_AT} AS effective_start_date, CAST(NULL AS VARCHAR) AS effective_end_date, strftime(ingested, '%Y-%m-%d %H:%M:%S') AS _ingestion_timestamp,
    batch AS _batch_year FROM r""")
def conform_ratings(r):
    return conform.conform_ratings(r.raw_ratings)


@query("SELECT movie_id, title, release_year, array_to_string(genres, '|') AS genres FROM m")
def conform_movies(r):
    return conform.conform_movies(r.raw_movies).drop("_ingestion_timestamp")


@query(f"SELECT user_id, movie_id, tag, {_AT} AS tag_timestamp, date_key FROM t")
def conform_tags(r):
    return conform.conform_tags(r.raw_tags).drop("_ingestion_timestamp")


@query("SELECT movie_id, imdb_id, tmdb_id, has_external_ids FROM l")
def conform_links(r):
    return conform.conform_links(r.raw_links).drop("_ingestion_timestamp")


@query("SELECT movie_id, tag_id, relevance FROM g_raw")
def conform_genome_scores(r):
    return conform.conform_genome_scores(r.raw_genome_scores).drop("_ingestion_timestamp")


@query("SELECT tag_id, tag FROM gt")
def conform_genome_tags(r):
    return conform.conform_genome_tags(r.raw_genome_tags).drop("_ingestion_timestamp")


@query(f"SELECT user_id, movie_id, rating, {_AT} AS interaction_timestamp, failed AS _dq_failed_rules, status AS _dq_status FROM r")
def dq_flag(r):
    return r.ratings.select("user_id", "movie_id", "rating", TS, "_dq_failed_rules", "_dq_status")


for _name, _cte, _role, _key in (
    ("ratings", "r", "ratings", "movie_id"),
    ("tags", "t", "tags", "movie_id"),
    ("movies", "m", "movies", "movie_id"),
    ("links", "l", "links", "movie_id"),
    ("genome_scores", "g", "genome_scores", "movie_id"),
    ("genome_tags", "gt", "genome_tags", "tag_id"),
):
    query(f"SELECT {_key}, failed AS _dq_failed_rules, status AS _dq_status FROM {_cte}", f"dq_rules_{_name}")(
        lambda r, role=_role, key=_key: getattr(r, role).select(key, "_dq_failed_rules", "_dq_status")
    )


@query("SELECT user_id, movie_id, rating FROM r WHERE status = 'PASS'")
def filter_pass(r):
    return checks.filter_pass(r.ratings)[0].select("user_id", "movie_id", "rating")


@query("SELECT user_id, movie_id, rating FROM v WHERE is_current")
def filter_current(r):
    return checks.filter_current(r.versions).select("user_id", "movie_id", "rating")


@query("SELECT user_id, movie_id, batch AS _batch_year FROM r WHERE batch IN (1997, 2000)")
def filter_batches(r):
    return checks.filter_batches(r.ratings, [1997, 2000]).select("user_id", "movie_id", "_batch_year")


@query("""SELECT batch AS _batch_year, count(*) AS total, count(*) FILTER (status = 'QUARANTINE') AS quarantined,
    count(*) FILTER (late) AS late FROM r GROUP BY batch""")
def dq_batch_metrics(r):
    return checks.dq_batch_metrics(r.ratings, "_batch_year", "is_late_arrival")


@query(f"SELECT failed AS failed_rules, n AS rows, {pct('n', 'sum(n) OVER ()', 2)} AS pct FROM (SELECT replace(failed, '|', ',') AS failed, count(*) AS n FROM r GROUP BY 1)")
def dq_rule_breakdown(r):
    return checks.dq_rule_breakdown(r.ratings)


@query("SELECT 'pk_unique:user_id,movie_id' AS \"check\", count(*) AS violations FROM (SELECT 1 FROM r GROUP BY user_id, movie_id HAVING count(*) > 1)")
def check_pk_unique(r):
    return checks.check_pk_unique(r.ratings, ["user_id", "movie_id"])


_NULLS = " UNION ALL ".join(f"SELECT 'not_null:{c}' AS \"check\", count(*) FILTER ({c} IS NULL) AS violations FROM r" for c in ("user_id", "movie_id", "rating"))


@query(_NULLS)
def check_not_null(r):
    return checks.check_not_null(r.ratings, ["user_id", "movie_id", "rating"])


@query(_NULLS)
def check_constraints(r):
    return checks.check_constraints(r.ratings, {"ratings": ["user_id", "movie_id", "rating"], "movies": ["movie_id"]}, "ratings")


@query("""SELECT unnest(['lineage:_source_table', 'lineage:_job_run_id', 'lineage:_notebook_path', 'lineage:_model_version',
    'lineage:_aggregation_timestamp', 'lineage:_source_silver_version']) AS "check",
    unnest([count(*) FILTER (movie_id % 7 = 0), 0, 0, 0, 0, 0]) AS violations FROM dim_m""")
def check_lineage_contract(r):
    rows = conform.lineage_gold(r.dim_movies, "silver.movies", "run-1", "jobs/dim", "1.0", 3)
    return checks.check_lineage_contract(rows.withColumn("_source_table", F.when(F.col("movie_id") % 7 != 0, F.col("_source_table"))))


@query("""SELECT 'fk:doc_id' AS "check", count(DISTINCT doc_id) AS violations FROM labels
    WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = labels.doc_id AND d.doc_id % 11 <> 0)""")
def check_foreign_keys(r):
    return checks.check_foreign_keys(r.table("labels"), [("doc_id", r.table("documents").filter("doc_id % 11 <> 0"), "doc_id")])


@query("SELECT count(*) AS actual, CAST(count(*) AS INTEGER) AS expected, true AS ok FROM r")
def check_row_count(r):
    path = _work(r, "counted")
    written = src.write_overwrite(_ratings_table(r), path)
    return checks.check_row_count(r.spark.read.parquet(path), written)


@query("""SELECT strftime(b, '%Y-%m-%d') AS before, strftime(d, '%Y-%m-%d') AS after FROM (SELECT full_date AS d, lag(full_date) OVER (ORDER BY full_date) AS b
    FROM dim_d WHERE day NOT IN (13, 14, 29)) WHERE d - b > 1""")
def check_date_continuity(r):
    return checks.check_date_continuity(r.dim_date.filter("day not in (13, 14, 29)").select("full_date"), "full_date")


@query("""SELECT unnest(['pk_unique:title', 'not_null:movie_id', 'not_null:release_year', 'lineage:_source_table', 'lineage:_job_run_id',
    'lineage:_notebook_path', 'lineage:_model_version', 'lineage:_aggregation_timestamp', 'lineage:_source_silver_version', 'fk:movie_id']) AS "check",
    unnest([(SELECT count(*) FROM (SELECT title FROM dim_m GROUP BY title HAVING count(*) > 1)), count(*) FILTER (movie_id IS NULL),
    count(*) FILTER (release_year IS NULL), 0, count(*) FILTER (movie_id % 11 = 2), 0, count(*) FILTER (movie_id % 13 = 3), 0, count(*),
    count(*) FILTER (movie_id NOT IN (SELECT movie_id FROM l WHERE status = 'PASS'))]) AS violations FROM dim_m""")
def validate_table(r):
    links = [("movie_id", checks.passing(r.links), "movie_id")]
    rows = conform.lineage_gold(r.dim_movies, "silver.movies", "run-1", "jobs/dim", "1.0", None)
    rows = rows.withColumn("_job_run_id", F.when(F.col("movie_id") % 11 != 2, F.col("_job_run_id")).otherwise(" "))
    rows = rows.withColumn("_model_version", F.when(F.col("movie_id") % 13 != 3, F.col("_model_version")))
    return checks.validate_table(rows, ["title"], ["movie_id", "release_year"], links, fail=False)


@query(f"""SELECT *, CAST(sum(CASE WHEN event_year <> batch_year THEN rows ELSE 0 END) OVER (PARTITION BY batch_year) AS BIGINT) AS cross_rows,
    {pct('sum(CASE WHEN event_year <> batch_year THEN rows ELSE 0 END) OVER (PARTITION BY batch_year)', 'sum(rows) OVER (PARTITION BY batch_year)', 2)} AS cross_pct
    FROM (SELECT batch AS batch_year, rating_year AS event_year, count(*) AS rows FROM r GROUP BY ALL)""")
def detect_cross_batch(r):
    return checks.detect_cross_batch(r.raw_ratings, "_batch_year", "timestamp")


@query("SELECT count(*) AS orphans FROM r WHERE status = 'PASS' AND movie_id NOT IN (SELECT movie_id FROM dim_m)")
def orphan_report(r):
    return checks.orphan_report(checks.passing(r.ratings), r.dim_movies, "movie_id")


# Keys, joins, dimensions, facts.


@query("SELECT movie_id, tag_id, sha256(concat_ws('|', movie_id, tag_id)) AS score_sk FROM g")
def surrogate_key(r):
    return keys.surrogate_key(r.genome_scores, "score_sk", "movie_id", "tag_id").select("movie_id", "tag_id", "score_sk")


_LOOKUP = "SELECT user_id, movie_id, movie_sk FROM r JOIN dim_m USING (movie_id) WHERE r.status = 'PASS'"


@query(_LOOKUP)
def join_lookup_inner(r):
    return keys.join_lookup_inner(checks.passing(r.ratings), r.dim_movies, "movie_id").select("user_id", "movie_id", "movie_sk")


@query(_LOOKUP)
def join_lookup_broadcast(r):
    return keys.join_lookup_broadcast(checks.passing(r.ratings), r.dim_movies, "movie_id").select("user_id", "movie_id", "movie_sk")


@query("SELECT year, genre_name, count(*) AS rows FROM f JOIN dim_d USING (date_key) JOIN bridge USING (movie_sk) JOIN dim_g USING (genre_sk) GROUP BY ALL")
def join_star_chain(r):
    chain = keys.join_star_chain(r.fact, (r.dim_date, "date_key"), (r.bridge, "movie_sk"), (r.dim_genres, "genre_sk"))
    return chain.groupBy("year", "genre_name").agg(F.count("*").alias("rows"))


@query("SELECT DISTINCT genre_name FROM members WHERE lower(genre_name) NOT IN (SELECT lower(genre_name) FROM members WHERE movie_id % 50 = 0)")
def join_anti_new_members(r):
    known = r.genre_members.filter("movie_id % 50 = 0").select("genre_name").distinct()
    return keys.join_anti_new_members(r.genre_members.select("genre_name").distinct(), known, "genre_name")


@query("SELECT user_id, movie_id FROM r WHERE status = 'PASS' AND movie_id NOT IN (SELECT movie_id FROM dim_m)")
def join_anti_orphans(r):
    return keys.join_anti_orphans(checks.passing(r.ratings), r.dim_movies, "movie_id").select("user_id", "movie_id")


@query("SELECT user_id, movie_id, rating FROM r WHERE user_id IN (SELECT user_id FROM r WHERE batch = 2000)")
def join_semi_affected_keys(r):
    touched = checks.filter_batches(r.ratings, [2000])
    return keys.join_semi_affected_keys(r.ratings, touched, ["user_id"]).select("user_id", "movie_id", "rating")


@query("SELECT movie_id, genre_name FROM members")
def explode_members(r):
    return r.genre_members


@query("SELECT * FROM dim_m")
def dim_movies(r):
    return r.dim_movies


@query("SELECT * FROM dim_gt")
def dim_genome_tags(r):
    return r.dim_genome_tags


@query("SELECT movie_sk, movie_id, imdb_id, tmdb_id FROM l JOIN dim_m USING (movie_id) WHERE l.status = 'PASS'")
def dim_external_links(r):
    return keys.dim_external_links(r.links, r.dim_movies)


_OLD_GENRES = "SELECT min(genre_name) AS genre_name FROM members WHERE movie_id % 20 = 0 GROUP BY lower(genre_name)"


@query(f"""SELECT sha256(genre_name) AS genre_sk, CAST(genre_id AS INTEGER) AS genre_id, genre_name FROM (
    SELECT genre_name, row_number() OVER (ORDER BY genre_name) AS genre_id FROM ({_OLD_GENRES})
    UNION ALL SELECT genre_name, (SELECT count(*) FROM ({_OLD_GENRES})) + row_number() OVER (ORDER BY genre_name) FROM dim_g
    WHERE lower(genre_name) NOT IN (SELECT lower(genre_name) FROM ({_OLD_GENRES})))""")
def dim_genres_incremental(r):
    old = keys.dim_genres_incremental(None, r.genre_members.filter("movie_id % 20 = 0"))
    return keys.dim_genres_incremental(old, r.genre_members)


@query("SELECT * REPLACE (strftime(full_date, '%Y-%m-%d') AS full_date) FROM dim_d")
def dim_date(r):
    return r.dim_date


@query("SELECT movie_sk, genre_sk FROM bridge")
def bridge_movies_genres(r):
    return r.bridge


@query(f"""SELECT movie_sk, user_id, rating, {_AT} AS interaction_timestamp, date_key, rating_year, late AS is_late_arrival, batch AS _batch_year,
    strftime(ingested, '%Y-%m-%d %H:%M:%S') AS _processing_timestamp FROM f WHERE batch IN (1998, 1999)""")
def fact_ratings(r):
    stamped = r.versions.withColumn("_processing_timestamp", F.col("_ingestion_timestamp"))
    return keys.fact_ratings(stamped, r.dim_movies, r.dim_date, [1998, 1999])


@query("SELECT movie_sk, tag_sk, relevance FROM fg")
def fact_genome_scores(r):
    return r.fact_scores


# Versions, merges, change detection.


@query("SELECT movie_id, tag_id, relevance FROM g")
def dedup_latest(r):
    return r.genome_scores.select("movie_id", "tag_id", "relevance")


@query(f"{_HISTORY} FROM v")
def scd2_bootstrap(r):
    return r.versions.select(*_VERSION)


def _scd2_inputs(r: Roles) -> tuple[DataFrame, DataFrame]:
    """A history, and a batch with new events, other ratings for known ones, and keys and times that are NULL."""
    old = versioning.scd2_bootstrap(r.ratings.filter("_batch_year <= 1999"), EVENT_KEY, NATURAL_KEY, TS, event_order())
    new = r.ratings.filter("_batch_year = 1998 and rating is not null or _batch_year = 2000")
    return old, new.withColumn("rating", 5 - F.col("rating"))


_ORDER = "rating DESC NULLS LAST, batch DESC NULLS LAST, ingested DESC NULLS LAST"


def _timeline(events: str) -> str:
    """SQL: one row per event of a relation with ``fresh``, with its place in the natural key's timeline."""
    once = f"SELECT * FROM {events} QUALIFY row_number() OVER (PARTITION BY user_id, movie_id, moment ORDER BY fresh DESC, {_ORDER}) = 1"
    return f"""SELECT * EXCLUDE (n, nx), n = 1 AS is_current, moment AS start_at, CASE WHEN n > 1 THEN nx END AS end_at FROM (SELECT *,
        row_number() OVER (PARTITION BY user_id, movie_id ORDER BY moment DESC NULLS LAST) AS n,
        lead(moment) OVER (PARTITION BY user_id, movie_id ORDER BY moment ASC NULLS FIRST) AS nx FROM ({once}))"""


_APPLIED = f"""(WITH old AS (SELECT *, 0 AS fresh FROM r WHERE batch <= 1999),
    new AS (SELECT * REPLACE (5 - rating AS rating), 1 AS fresh FROM r WHERE batch = 1998 AND rating IS NOT NULL OR batch = 2000),
    kept AS ({_timeline('old')}), hit AS (SELECT DISTINCT user_id, movie_id FROM new WHERE user_id IS NOT NULL AND movie_id IS NOT NULL),
    events AS (SELECT * EXCLUDE (is_current, start_at, end_at) FROM kept SEMI JOIN hit USING (user_id, movie_id) UNION ALL SELECT * FROM new)
    {_timeline('events')} UNION ALL SELECT * FROM kept ANTI JOIN hit USING (user_id, movie_id))"""


@query(f"{_HISTORY} FROM {_APPLIED}")
def scd2_apply(r):
    old, new = _scd2_inputs(r)
    return versioning.scd2_apply(old, new, EVENT_KEY, NATURAL_KEY, TS, event_order()).select(*_VERSION)


@query("""SELECT count(*) FILTER (c > 1) AS several_current, count(*) FILTER (c = 0) AS none_current, CAST(sum(e) AS BIGINT) AS current_with_end,
    CAST(sum(o) AS BIGINT) AS history_without_end FROM (SELECT count(*) FILTER (cur) AS c, count(*) FILTER (cur AND end_at IS NOT NULL) AS e,
    count(*) FILTER (NOT cur AND end_at IS NULL) AS o FROM (SELECT *, CASE WHEN movie_id % 5 = 0 THEN true WHEN movie_id % 7 = 1 THEN false
    ELSE is_current END AS cur FROM v) GROUP BY user_id, movie_id)""")
def scd2_check(r):
    broken = F.when(F.col("movie_id") % 5 == 0, True).when(F.col("movie_id") % 7 == 1, False).otherwise(F.col("is_current"))
    return versioning.scd2_check(r.versions.withColumn("is_current", broken), NATURAL_KEY)


@query("SELECT user_id, movie_id, rating FROM v WHERE start_at <= TIMESTAMP '1999-06-30' AND (end_at IS NULL OR end_at > TIMESTAMP '1999-06-30')")
def scd2_as_of(r):
    return versioning.scd2_as_of(r.versions, "1999-06-30").select("user_id", "movie_id", "rating")


def _merge_inputs(r: Roles) -> tuple[DataFrame, DataFrame]:
    orders = r.table("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    dearer = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return orders.filter("o_orderkey % 3 <> 0"), dearer.filter("o_orderkey % 2 = 0")


@query("""SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 2 <> 0""")
def merge_upsert(r):
    target, source = _merge_inputs(r)
    return versioning.merge_upsert(target, source, ["o_orderkey"], ["o_totalprice desc", "o_custkey"])


@query("""SELECT count(*) FILTER (o_orderkey % 3 = 0) AS inserted, count(*) FILTER (o_orderkey % 3 <> 0) AS updated, count(*) AS dropped
    FROM orders WHERE o_orderkey % 2 = 0""")
def merge_counts(r):
    target, source = _merge_inputs(r)
    return versioning.merge_counts(target, source.unionAll(source), ["o_orderkey"])


@query("""WITH old AS (SELECT DISTINCT lower(p_type) AS p_type FROM part WHERE p_size < 5) SELECT p_type FROM old
    UNION ALL SELECT DISTINCT p_type FROM part WHERE lower(p_type) NOT IN (SELECT p_type FROM old)""")
def merge_insert_only(r):
    part = r.table("part")
    old = part.filter("p_size < 5").select(F.lower("p_type").alias("p_type")).distinct()
    return versioning.merge_insert_only(old, part.select("p_type").distinct(), ["p_type"], fold_case=True)


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '1-%')")
def merge_delete_keys(r):
    orders = r.table("orders").select("o_orderkey", "o_orderpriority")
    return versioning.merge_delete_keys(orders, orders.filter("o_orderpriority like '1-%'"), ["o_orderkey"])


def _feed(r: Roles) -> DataFrame:
    orders = r.table("orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    new = orders.filter("o_orderkey % 7 <> 0")
    new = new.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 5 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return versioning.change_feed(orders.filter("o_orderkey % 10 <> 0"), new, ["o_orderkey"])


_FEED = """SELECT o_orderkey, CASE WHEN kind IN ('insert', 'update_postimage') THEN np ELSE o_totalprice END AS o_totalprice, o_orderdate, kind FROM (
    SELECT *, unnest(CASE WHEN o_orderkey % 10 = 0 AND o_orderkey % 7 <> 0 THEN ['insert'] WHEN o_orderkey % 10 <> 0 AND o_orderkey % 7 = 0 THEN ['delete']
      WHEN o_orderkey % 10 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 5 = 0 THEN ['update_preimage', 'update_postimage'] ELSE [] END) AS kind
    FROM (SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS np FROM orders))"""


@query(f"SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, kind AS _change_type FROM ({_FEED})")
def change_feed(r):
    return _feed(r)


@query(f"SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS batch FROM ({_FEED})")
def impacted_batches(r):
    return versioning.impacted_batches(_feed(r), F.year("o_orderdate"))


@query(f"SELECT DISTINCT batch FROM r WHERE batch IN (SELECT year(o_orderdate) FROM ({_FEED}) WHERE o_orderkey < 50)")
def select_batches_to_process(r):
    impacted = versioning.impacted_batches(_feed(r).filter("o_orderkey < 50"), F.year("o_orderdate"))
    return versioning.select_batches_to_process(src.available_batches(r.ratings, "_batch_year"), impacted, baseline=1)


def _audit(r: Roles) -> DataFrame:
    """An audit with one row per batch year, failed ones among them."""
    return r.ratings.groupBy("_batch_year").agg(F.count("*").alias("n")).selectExpr(
        "'run-1' run_id", "'gold.fact' target_table", "'silver.ratings' source_table", "_batch_year batch", "0 start_version",
        "cast(_batch_year % 3 as int) end_version", "'1.0' model_version", "if(_batch_year % 4 = 0, 'FAILED', 'SUCCESS') status", "n rows_written",
    )


_AUDIT = "SELECT batch, count(*) AS n, batch % 3 AS end_version, CASE WHEN batch % 4 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status FROM r GROUP BY batch"


@query(f"SELECT batch, status, n AS rows_written FROM ({_AUDIT}) UNION ALL SELECT 2030, 'SUCCESS', 5")
def audit_append(r):
    row = ("run-2", "gold.fact", "silver.ratings", 2030, 0, 9, "1.0", "SUCCESS", 5)
    return versioning.audit_append(_audit(r), [row]).select("batch", "status", "rows_written")


@query(f"SELECT batch FROM ({_AUDIT}) WHERE status = 'SUCCESS' AND end_version = 1")
def audit_processed(r):
    return versioning.audit_processed(_audit(r), "gold.fact", "silver.ratings", 1, "1.0")


@query(f"SELECT CAST(max(end_version) AS INTEGER) AS latest_version FROM ({_AUDIT}) WHERE status = 'SUCCESS'")
def audit_latest_version(r):
    return versioning.audit_latest_version(_audit(r), "gold.fact", "silver.ratings")


@query(f"""SELECT user_id, movie_id, {_AT} AS interaction_timestamp, f.rating, v.status AS _dq_status, 'ratings_' || r_raw.batch || '.csv' AS file
    FROM f JOIN v USING (user_id, movie_id, moment) JOIN r_raw ON TRY_CAST(userId AS INTEGER) = f.user_id AND TRY_CAST(movieId AS INTEGER) = f.movie_id
    AND make_timestamp(ts * 1000000) = moment""")
def lineage_trace(r):
    scan = src.scan_csv_typed(r.spark, f"{_csv_folder(r)}/ratings_*.csv", "ratings")
    raw = conform.lineage_incremental(scan, "ratings", "run-1", "jobs/load", "files")
    root = _work(r, "silver")
    history = versioning.scd2_bootstrap(flagged_ratings(raw), EVENT_KEY, NATURAL_KEY, TS, event_order())  # an event once
    version = src.snapshot_write(history, root)
    silver = src.snapshot_read_as_of(r.spark, root, version).select("user_id", "movie_id", TS, "_dq_status")
    bronze = raw.withColumn("_at", fn.from_epoch("timestamp"))
    gold = r.fact.join(r.dim_movies, "movie_sk").select("user_id", "movie_id", TS, "rating")
    traced = versioning.lineage_trace(gold, silver, bronze, ["user_id", "movie_id", TS], ["userId", "movieId", "_at"])
    return traced.select("user_id", "movie_id", TS, "rating", "_dq_status", _file())


# Incremental loads and aggregates.


@query(f"""SELECT movie_sk, user_id, rating, {_AT} AS interaction_timestamp, date_key, rating_year, late AS is_late_arrival, batch AS _batch_year
    FROM {_APPLIED} JOIN dim_m USING (movie_id) JOIN dim_d USING (date_key) WHERE status = 'PASS' AND is_current""")
def fact_incremental_load(r):
    old, new = _scd2_inputs(r)
    root = _work(r, "silver")
    src.snapshot_write(old, root, keys=NATURAL_KEY)
    build = lambda rows, batches: keys.fact_ratings(rows, r.dim_movies, r.dim_date, batches)
    load = loads.SliceLoad(
        root, _work(r, "fact"), _work(r, "audit"), build, NATURAL_KEY, "gold.fact", "silver.ratings", "1.0", "_dq_status = 'PASS' and is_current"
    )
    load.run(r.spark, "run-1")
    target = src.snapshot_read_as_of(r.spark, root, 0)
    src.snapshot_write(versioning.scd2_apply(target, new, EVENT_KEY, NATURAL_KEY, TS, event_order()), root, keys=NATURAL_KEY)
    load.run(r.spark, "run-2")
    load.run(r.spark, "run-3")  # nothing new
    fact = r.spark.read.parquet(load.path)
    return fact.select("movie_sk", "user_id", "rating", TS, "date_key", "rating_year", "is_late_arrival", "_batch_year")


def _fact_versions(r: Roles) -> tuple[DataFrame, DataFrame]:
    """A fact table and its next version, with rows that came, went and changed.

    Both are made of one stored table, which has what the KPIs read. Its movies
    are told by their id, which has a surrogate key and back: 4 bytes for 64.
    """
    rows = keys.fact_ratings(r.versions, r.dim_movies, r.dim_date, also=["movie_id"])
    root = _work(r, "fact")
    version = src.snapshot_write(rows.select("movie_id", "user_id", "rating", "date_key", "_batch_year"), root)
    fact = src.snapshot_read_as_of(r.spark, root, version)
    old = fact.filter("_batch_year <= 1999").withColumn("rating", F.when(F.col("user_id") % 5 == 0, 5 - F.col("rating")).otherwise(F.col("rating")))
    return old, fact.filter("user_id % 7 <> 0")


def _followed(r: Roles, state) -> DataFrame:
    """The figures of a state that was built from the old fact and took the feed to the new one."""
    old, new = _fact_versions(r)
    kept, root = _work(r, "feed"), _work(r, "state")
    src.snapshot_write(versioning.change_feed(old, new, ["movie_id", "user_id"]), kept)
    feed = src.snapshot_read_as_of(r.spark, kept, 0)
    incremental.store_state(r.spark, root, state(old, None), "first")
    return incremental.kpi_figures(incremental.store_state(r.spark, root, state(feed, incremental.sign_of_change()), "feed"))


_KPI = f"{_MEAN} AS avg_rating, count(*) AS rating_count, count(DISTINCT user_id) AS unique_users, count(DISTINCT movie_sk) AS unique_movies"


@query(f"SELECT year, month, month_name, {_KPI} FROM f JOIN dim_d USING (date_key) WHERE user_id % 7 <> 0 GROUP BY ALL")
def kpi_rating_trends_monthly_incremental(r):
    return _followed(r, lambda rows, sign: incremental.monthly_state(rows, r.dim_date, sign, "movie_id"))


@query(f"SELECT genre_name, {_KPI} FROM f JOIN bridge USING (movie_sk) JOIN dim_g USING (genre_sk) WHERE user_id % 7 <> 0 GROUP BY ALL")
def kpi_genre_performance_incremental(r):
    bridge = r.bridge.join(r.dim_movies.select("movie_sk", "movie_id"), "movie_sk").select("movie_id", "genre_sk")
    return _followed(r, lambda rows, sign: incremental.genre_state(rows, bridge, r.dim_genres, sign, "movie_id"))


# KPIs and coverage.

for _name, _cte, _build in (
    ("kpi_all_time_summary", "k_all", lambda r: kpi.all_time_summary(r.fact)),
    ("kpi_rating_trends_monthly", "k_month", lambda r: r.monthly),
    ("kpi_genre_performance", "k_genre", lambda r: r.genre_kpi),
    ("kpi_movie_stats", "k_stats", lambda r: kpi.movie_stats(r.fact)),
    ("kpi_top_rated_movies", "k_rated", lambda r: r.top_rated),
    ("kpi_most_popular_movies", "k_popular", lambda r: r.popular),
    ("kpi_genre_trends_yearly", "k_trend", lambda r: r.genre_trend),
    ("kpi_user_activity_distribution", "k_activity", lambda r: kpi.user_activity_distribution(r.fact)),
    ("kpi_rating_distribution", "k_dist", lambda r: kpi.rating_distribution(r.fact)),
    ("kpi_yearly_summary", "k_year", lambda r: r.yearly),
    ("kpi_release_decade", "k_decade", lambda r: kpi.release_decade(r.fact, r.dim_movies)),
):
    query(f"SELECT * FROM {_cte}", _name)(_build)


@query("""SELECT tag, CAST((20000 * s + 1000 * n) // (2000 * n) AS DOUBLE) / 10000 AS avg_relevance, movie_count FROM (SELECT tag,
    sum(CAST(round(relevance * 1000) AS BIGINT)) AS s, count(*) AS n, count(DISTINCT movie_sk) AS movie_count FROM fg JOIN dim_gt USING (tag_sk) GROUP BY tag)
    ORDER BY avg_relevance DESC, tag LIMIT 20""")
def kpi_top_genome_tags(r):
    return kpi.top_genome_tags(r.fact_scores, r.dim_genome_tags)


@query("SELECT batch AS _batch_year, rating_year, count(*) AS late_rows FROM r WHERE late GROUP BY ALL")
def kpi_late_matrix(r):
    return kpi.late_matrix(r.ratings)


@query("SELECT rating_year, late AS is_late_arrival, count(*) AS rows FROM r GROUP BY ALL")
def kpi_event_year_late_distribution(r):
    return kpi.event_year_late_distribution(r.ratings)


@query("SELECT user_id, movie_id, count(*) AS versions FROM v WHERE status = 'PASS' GROUP BY ALL HAVING count(*) > 1 ORDER BY versions DESC, user_id, movie_id LIMIT 20")
def kpi_rerated_pairs(r):
    return kpi.rerated_pairs(checks.passing(r.versions))


@query(f"""SELECT user_id, movie_id, rating, {_AT} AS interaction_timestamp, is_current FROM v JOIN (SELECT user_id, movie_id FROM v
    WHERE user_id IS NOT NULL GROUP BY ALL HAVING count(*) > 1 ORDER BY count(*) DESC, user_id, movie_id LIMIT 5) USING (user_id, movie_id)""")
def kpi_pair_history(r):
    most = kpi.rerated_pairs(r.versions.filter("user_id is not null"), 5)
    return kpi.pair_histories(r.versions, most).select("user_id", "movie_id", "rating", TS, "is_current")


@query("SELECT batch AS _batch_year, round(avg((epoch(moment) - epoch(ingested)) / 60), 6) AS avg_minutes FROM r WHERE status = 'PASS' GROUP BY batch")
def kpi_layer_latency(r):
    latency = kpi.layer_latency(checks.passing(r.ratings), "_ingestion_timestamp", TS, "_batch_year")
    return latency.withColumn("avg_minutes", F.round("avg_minutes", 6))


@query("""SELECT count(*) AS rows, count(DISTINCT movie_sk) AS unique_movies, count(DISTINCT user_id) AS unique_users, min(rating_year) AS first_year,
    max(rating_year) AS last_year, (SELECT avg_rating FROM k_all) AS avg_rating FROM f""")
def coverage_fact(r):
    return kpi.coverage_fact(r.fact)


_MEAN_REL = "CAST((20000 * sum(CAST(round(relevance * 1000) AS BIGINT)) + 1000 * count(relevance)) // (2000 * count(relevance)) AS DOUBLE) / 10000"


@query(f"SELECT count(DISTINCT movie_sk) AS movies, count(DISTINCT tag_sk) AS tags, min(relevance) AS least, max(relevance) AS most, {_MEAN_REL} AS mean FROM fg")
def coverage_scores(r):
    return kpi.coverage_scores(r.fact_scores)


@query(f"SELECT *, {pct('pairs', 'movies * 100', 2)} AS genres_per_movie FROM (SELECT count(DISTINCT movie_sk) AS movies, count(DISTINCT genre_sk) AS genres, count(*) AS pairs FROM bridge)")
def coverage_bridge(r):
    return kpi.coverage_bridge(r.bridge)


@query("""SELECT min(year) AS first_year, max(year) AS last_year, count(DISTINCT year) AS years, count(*) FILTER (is_weekend) AS weekend_days,
    count(*) FILTER (NOT is_weekend) AS week_days FROM dim_d""")
def coverage_calendar(r):
    return kpi.coverage_calendar(r.dim_date)


@query("SELECT min(genre_id) AS least_id, max(genre_id) AS most_id FROM dim_g")
def coverage_genre_ids(r):
    return kpi.coverage_genre_ids(r.dim_genres)


@query("SELECT count(*) FILTER (release_year IS NULL) AS null_years, count(*) FILTER (len(genres) = 0) AS empty_genres FROM m")
def silver_stats_movies(r):
    return kpi.silver_stats_movies(r.movies)


@query("SELECT count(*) FILTER (imdb_id IS NULL) AS no_imdb, count(*) FILTER (tmdb_id IS NULL) AS no_tmdb, count(*) FILTER (NOT has_external_ids) AS neither FROM l")
def silver_stats_links(r):
    return kpi.silver_stats_links(r.links)


@query("""SELECT CAST(min(length(tag)) AS INTEGER) AS shortest, CAST(max(length(tag)) AS INTEGER) AS longest,
    CAST((200 * sum(length(tag)) + count(tag)) // (2 * count(tag)) AS DOUBLE) / 100 AS mean_length FROM t""")
def silver_stats_tags(r):
    return kpi.silver_stats_tags(r.tags)


@query(f"SELECT min(relevance) AS least, max(relevance) AS most, {_MEAN_REL} AS mean FROM g WHERE status = 'PASS'")
def silver_stats_scores(r):
    return kpi.silver_stats_scores(r.genome_scores)


@query("""SELECT year, total_ratings, CAST(total_ratings - b AS DOUBLE) * 100 / CAST(b AS DOUBLE) AS growth_pct
    FROM (SELECT *, lag(total_ratings) OVER (ORDER BY year) AS b FROM k_year) WHERE b IS NOT NULL""")
def kpi_yoy_growth(r):
    return kpi.yoy_growth(r.yearly)


@query("""SELECT min(ym) AS first_month, max(ym) AS last_month, CAST(sum(unique_users) AS DOUBLE) / count(*) AS mean_unique_users,
    CAST(sum(unique_movies) AS DOUBLE) / count(*) AS mean_unique_movies FROM (SELECT *, year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS ym FROM k_month)
    WHERE year BETWEEN 1996 AND 1999""")
def kpi_monthly_range_mean(r):
    return kpi.monthly_range_mean(r.monthly, 1996, 1999)


@query("""SELECT * EXCLUDE (k), CASE WHEN k <= 10 THEN title END AS label FROM (SELECT *, row_number() OVER (ORDER BY rating_count DESC, movie_id) AS k FROM (
    SELECT DISTINCT ON (title) * FROM (SELECT * FROM k_rated UNION ALL SELECT * FROM k_popular) ORDER BY title, rating_count DESC, movie_id)) WHERE k <= 100""")
def kpi_rating_vs_popularity(r):
    return kpi.rating_vs_popularity(r.top_rated, r.popular)


@query("SELECT * FROM k_popular ORDER BY rating_count DESC, movie_id LIMIT 10")
def kpi_top_n(r):
    return kpi.top_n(r.popular, 10, F.desc("rating_count"), "movie_id")


@query("SELECT * FROM k_trend WHERE genre_name IN (SELECT genre_name FROM k_genre ORDER BY rating_count DESC, genre_name LIMIT 5)")
def kpi_top_genres_trend(r):
    return kpi.top_genres_trend(r.genre_trend)  # the fact has no row without a date, so its years add up to all


_YEARS = list(range(1995, 2002))


@query("SELECT genre_name, " + ", ".join(f"CAST(coalesce(sum(rating_count) FILTER (year = {y}), 0) AS BIGINT) AS y{y}" for y in _YEARS) + " FROM k_trend GROUP BY genre_name")
def kpi_genre_year_matrix(r):
    return kpi.genre_year_matrix(r.genre_trend, _YEARS)


@query(f"SELECT rating, rating_count, {pct('sum(rating_count) OVER (ORDER BY rating ROWS UNBOUNDED PRECEDING)', 'sum(rating_count) OVER ()', 2)} AS cumulative_pct FROM k_dist")
def kpi_cumulative_pct(r):
    return kpi.cumulative_pct(kpi.rating_distribution(r.fact))


@query(f"""SELECT CAST(n AS BIGINT) AS total_users, CAST(m AS BIGINT) AS total_ratings, {pct('m', 'CAST(n * 100 AS BIGINT)', 2)} AS ratings_per_user,
    regexp_replace(b, '^\\d+ — ', '') AS modal_bucket, x AS modal_rating FROM (SELECT sum(user_count) AS n,
    arg_max(activity_bucket, (user_count, activity_bucket)) AS b FROM k_activity), (SELECT sum(rating_count) AS m, arg_max(rating, (rating_count, rating)) AS x FROM k_dist)""")
def kpi_engagement_cards(r):
    return kpi.engagement_cards(kpi.user_activity_distribution(r.fact), kpi.rating_distribution(r.fact))


@query("""SELECT arg_max(decade, (avg_rating, decade)) AS best_rated, arg_max(decade, (total_ratings, decade)) AS most_rated,
    arg_max(decade, (movie_count, decade)) AS most_movies FROM k_decade WHERE CAST(decade[:-2] AS INTEGER) >= 1960""")
def kpi_decade_cards(r):
    return kpi.decade_cards(kpi.release_decade(r.fact, r.dim_movies), since=1960)


@query("""SELECT year, total_ratings, avg_rating, CAST(CAST(round(avg_rating * 100) AS BIGINT) - (SELECT CAST(round(avg_rating * 100) AS BIGINT) FROM k_all) AS DOUBLE) / 100 AS delta
    FROM k_year ORDER BY year DESC LIMIT 1""")
def kpi_latest_year_delta(r):
    return kpi.latest_year_delta(r.yearly, kpi.all_time_summary(r.fact))


@query("SELECT regexp_replace(activity_bucket, '^\\d+ — ', '') AS label, user_count FROM k_activity")
def kpi_bucket_label(r):
    return kpi.user_activity_distribution(r.fact).select(kpi.bucket_label("activity_bucket").alias("label"), "user_count")
