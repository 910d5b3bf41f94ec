"""Scans, sinks and incremental state over Parquet and CSV.

Writers return the rows they committed, observed on the write job itself.
Snapshots are directories ``v=<n>`` beside a ``versions`` table; a version
exists once its row is there, so a failed write leaves none behind. One
writer at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete, exists

#: The schemas of the raw files, by table.
CSV_SCHEMAS = {
    "ratings": "userId int, movieId int, rating double, timestamp bigint",
    "tags": "userId int, movieId int, tag string, timestamp bigint",
    "movies": "movieId int, title string, genres string",
    "links": "movieId int, imdbId string, tmdbId int",
    "genome-scores": "movieId int, tagId int, relevance double",
    "genome-tags": "tagId int, tag string",
}


def scan_csv_typed(spark: SparkSession, path: str, table: str, schemas: Mapping[str, str] = CSV_SCHEMAS) -> DataFrame:
    """CSV with a header, by the declared schema of ``table``; never inferred."""
    if table not in schemas:
        raise ValueError(f"no schema is declared for {table!r}")
    return spark.read.schema(schemas[table]).option("header", True).option("mode", "PERMISSIVE").csv(path)


#: Codec of stored versions and slices: keys in hexadecimal take half of what they take in Spark's default, which has no entropy coding.
_CODEC = "zstd"

#: Columns of ``scan_csv_checked`` beside the typed ones.
RAW, REASON = "_raw_line", "_reject_reason"


def scan_csv_checked(
    spark: SparkSession, path: str, table: str, schemas: Mapping[str, str] = CSV_SCHEMAS, header: bool = True
) -> DataFrame:
    """``scan_csv_typed`` that loses nothing: two more columns for lines that do not fit.

    ``_reject_reason`` is NULL where every field has its type; otherwise
    ``FEW_FIELDS``, ``MANY_FIELDS`` or ``BAD_VALUE:`` and the columns, comma
    joined, and ``_raw_line`` is the line as it stands in the file. Fields
    that could be read are typed all the same; an empty field is NULL and no
    fault. ``accepted`` and ``quarantine`` part the rows.
    """
    if table not in schemas:
        raise ValueError(f"no schema is declared for {table!r}")
    typed = T._parse_datatype_string(schemas[table])
    names = typed.fieldNames()
    reader = spark.read.schema(T.StructType(typed.fields + [T.StructField(RAW, T.StringType())])).option("header", header)
    # Unread columns would not be looked at, so a line's fault would depend on what is selected.
    rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW).option("columnPruning", False).csv(path)
    absent = "\u0001"  # so that an empty field can be told from a missing one
    wide = ", ".join(f"f{k} string" for k in range(len(names) + 1))
    fields = F.from_csv(F.col(RAW), wide, {"nullValue": absent, "emptyValue": ""})
    at = [fields[f"f{k}"] for k in range(len(names) + 1)]
    bad = F.array_compact(F.array(*[F.when((F.trim(f) != "") & F.col(n).isNull(), F.lit(n)) for n, f in zip(names, at)]))
    reason = F.when(at[len(names)].isNotNull(), "MANY_FIELDS").when(at[len(names) - 1].isNull(), "FEW_FIELDS")
    reason = reason.otherwise(F.concat(F.lit("BAD_VALUE:"), F.array_join(bad, ",")))
    return rows.withColumn(REASON, F.when(F.col(RAW).isNotNull(), reason)).select(*names, RAW, REASON)


def accepted(checked: DataFrame) -> DataFrame:
    """The rows of ``scan_csv_checked`` that fit, with the typed columns only."""
    return checked.filter(F.col(REASON).isNull()).drop(RAW, REASON)


def quarantine(checked: DataFrame) -> DataFrame:
    """The lines that do not fit: (_raw_line, _reject_reason)."""
    return checked.filter(F.col(REASON).isNotNull()).select(RAW, REASON)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A registered table, or a Parquet path (any name with a slash)."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def scan_partition_slice(df: DataFrame, column: str, value: object) -> DataFrame:
    """One batch; on a partition column the scan prunes to it."""
    return df.filter(F.col(column) == value)


def discover_batches(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Batch years of the files ``<table>_<YYYY>.csv``; raises if there is none.

    A year may have several files, ``<table>_<YYYY>.<number>.csv``. Only the listing is read, not the files' contents.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"{table}_*.csv").load(folder).select("path")
    year = F.regexp_extract("path", rf"/{table}_(\d{{4}})(?:\.\d+)?\.csv$", 1).try_cast("int")
    found = files.select(year.alias("batch")).filter("batch is not null").distinct()
    if found.isEmpty():
        raise FileNotFoundError(f"no files {table}_<year>.csv in {folder}")
    return found


def processed_batches(df: DataFrame | None, column: str, spark: SparkSession | None = None) -> DataFrame:
    """Batches that a target holds; a target that does not exist has none."""
    if df is None:
        if spark is None:
            raise ValueError("an absent target needs a session")
        return spark.createDataFrame([], "batch int")
    return df.select(F.col(column).cast("int").alias("batch")).filter("batch is not null").distinct()


def partition_batches(spark: SparkSession, table: str, column: str) -> DataFrame:
    """The same from a catalog table's partition list, without a scan."""
    value = F.regexp_extract("partition", rf"(?:^|/){column}=(\d+)(?:/|$)", 1).try_cast("int")
    return spark.sql(f"SHOW PARTITIONS {table}").select(value.alias("batch")).filter("batch is not null").distinct()


def available_batches(df: DataFrame, column: str) -> DataFrame:
    """Batches of a source, which must have some."""
    found = processed_batches(df, column)
    if found.isEmpty():
        raise ValueError("the source has no batches")
    return found


def pending_batches(available: DataFrame, processed: DataFrame) -> DataFrame:
    return available.join(processed, "batch", "left_anti")


def skipped_batches(available: DataFrame, processed: DataFrame) -> DataFrame:
    return available.join(processed, "batch", "left_semi")


def schema_guard(df: DataFrame, target: T.StructType, on_missing: str = "error") -> DataFrame:
    """``df`` in the target's column order, new columns last.

    New columns are accepted and a changed type is refused; a column that is
    gone is refused too, or filled with NULL by ``on_missing='null'``.
    """
    have = {f.name: f.dataType for f in df.schema}
    out: list[Column] = []
    for f in target:
        if f.name not in have:
            if on_missing != "null":
                raise TypeError(f"column {f.name} is missing")
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] != f.dataType:
            raise TypeError(f"column {f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}")
        else:
            out.append(F.col(f.name))
    known = set(target.fieldNames())
    return df.select(*out, *[c for c in df.columns if c not in known])


def schema_at(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema of the Parquet data at a path; None where there is none."""
    try:
        return spark.read.parquet(path).schema if exists(spark, path) else None
    except AnalysisException:  # a folder without data
        return None


def _guarded(df: DataFrame, path: str) -> DataFrame:
    there = schema_at(df.sparkSession, path)
    return df if there is None else schema_guard(df, there)


def committed_row_count(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run ``write`` on ``df`` and count its rows in the same job."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def write_overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    df = _guarded(df, path)
    static = lambda d: d.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)
    return committed_row_count(df, static)


def _replace_partitions(df: DataFrame, path: str, column: str) -> int:
    dynamic = lambda d: d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    return committed_row_count(df, dynamic)


def write_replace_partition(df: DataFrame, path: str, column: str, value: int) -> int:
    """Replace one partition; a row of another one fails the job."""
    same = F.when(F.col(column).eqNullSafe(F.lit(value)), F.col(column)).otherwise(
        F.raise_error(F.concat(F.lit(f"a row is not of {column}={value}: "), F.coalesce(F.col(column).cast("string"), F.lit("NULL"))))
    )
    return _replace_partitions(_guarded(df, path).withColumn(column, same.cast(df.schema[column].dataType)), path, column)


def write_replace_touched_partitions(df: DataFrame, path: str, column: str) -> int:
    """Replace every partition that ``df`` has rows of, in one job.

    Rows without a partition value are not written; no rows write nothing.
    """
    return _replace_partitions(_guarded(df, path).filter(F.col(column).isNotNull()), path, column)


def replace_slices(df: DataFrame, path: str, column: str, values: Sequence[int]) -> dict[int, int]:
    """Replace the partitions of ``values``, in one job; returns the rows of each.

    A value without rows loses its partition; a row of another value fails the
    job. Other partitions keep their files.
    """
    known = F.when(F.col(column).isin(*values), F.col(column)) if values else F.lit(None)
    told = F.concat(F.lit(f"a row's {column} is none of those to replace: "), F.coalesce(F.col(column).cast("string"), F.lit("NULL")))
    checked = F.coalesce(known, F.raise_error(told)).cast(df.schema[column].dataType)
    rows, seen = _guarded(df, path).withColumn(column, checked), Observation()
    counted = rows.observe(seen, *[F.count_if(F.col(column) == v).alias(f"n{v}") for v in values], F.count("*").alias("n"))
    counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", _CODEC).partitionBy(column).parquet(path)
    found = {v: seen.get[f"n{v}"] for v in values}
    for v in (v for v, n in found.items() if not n):
        delete(df.sparkSession, f"{path}/{column}={v}")
    return found


def write_append(df: DataFrame, path: str) -> int:
    return committed_row_count(_guarded(df, path), lambda d: d.write.mode("append").parquet(path))


def write_parquet_kpi(df: DataFrame, folder: str, name: str) -> int:
    return committed_row_count(df, lambda d: d.write.mode("overwrite").parquet(f"{folder}/{name}.parquet"))


def register_table(spark: SparkSession, name: str, path: str, properties: Mapping[str, str] | None = None) -> None:
    """Idempotent registration of a Parquet location, partitions included."""
    there = spark.catalog.tableExists(name)
    if not there:
        spark.catalog.createTable(name, path=path, source="parquet")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    if properties:
        quoted = ", ".join("'{}'='{}'".format(*(x.replace("'", r"\'") for x in kv)) for kv in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({quoted})")


def current_version(spark: SparkSession, root: str) -> int | None:
    if schema_at(spark, f"{root}/versions") is None:
        return None
    return spark.read.parquet(f"{root}/versions").agg(F.max("version")).first()[0]


#: Parts that the keys of a table kept by key are hashed into, where nothing else is said.
BUCKETS = 64
#: Bytes that a part should hold, about, and most parts.
BUCKET_BYTES, MOST_BUCKETS = 1 << 30, 100_000
#: Bytes of a row as text that take one byte in the files, about.
_PACKED = 4
#: Bytes of a value as text, about, by type; other types are measured. A name with its marks comes to each.
_TEXT_BYTES = {T.BooleanType: 5, T.ByteType: 3, T.ShortType: 5, T.IntegerType: 8, T.LongType: 10, T.FloatType: 6, T.DoubleType: 6, T.DateType: 12, T.TimestampType: 26}


def bucket_of(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def buckets_for(df: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """How many parts rows need that are to be kept by key, by their size as text; at least ``BUCKETS``.

    Only texts and nested values are measured, the others count by their type,
    nulls like the rest: a table of numbers and times is only counted, so
    that none of its columns are read or computed.
    """
    fixed, measured = 0, []
    for f in df.schema:
        c, kind = F.col(f"`{f.name}`"), type(f.dataType)
        fixed += len(f.name) + 4 + _TEXT_BYTES.get(kind, 0)
        if kind in (T.StringType, T.BinaryType):
            measured.append(F.octet_length(c))
        elif kind not in _TEXT_BYTES:
            measured.append(F.octet_length(F.to_json(F.struct(c))))
    sums = [F.coalesce(F.sum(m.cast("long")), F.lit(0)) for m in measured]
    size = df.agg(reduce(Column.__add__, sums, F.count(F.lit(1)) * fixed)).first()[0]
    return max(BUCKETS, min(MOST_BUCKETS, -(-size // (_PACKED * bucket_bytes))))


def bucket_count(spark: SparkSession, root: str, version: int) -> int:
    """The number of key buckets of a version that is kept by key."""
    return _marks(spark, root, version)[-1].of


def snapshot_write(df: DataFrame, root: str, note: str = "", keys: Sequence[str] = (), buckets: int | None = None, sums: Sequence[str] = (), finish: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Write the next version; returns its number. ``note`` is kept with it.

    With ``keys`` the rows must be all of the key buckets that they fall in.
    Only these are written; the version has the other buckets as the last one
    has them, in the same files. A root is kept by key from its first version
    on, or never. ``buckets`` is how many there are, by default as many as
    before; another number asks for all rows of the table. With ``sums`` rows
    of one key are added up in these columns, in the shuffle by bucket; there
    should be few of each. ``finish`` adds columns row by row, after the
    shuffle by bucket, so that they are not sent through it.
    """
    spark = df.sparkSession
    last = current_version(spark, root)
    version, of = 0 if last is None else last + 1, buckets or BUCKETS
    if last is not None:
        mark = _marks(spark, root, last)[-1]
        if bool(keys) != bool(mark.buckets):
            raise ValueError(f"the versions of {root} are {'not ' if keys else ''}kept by key")
        of = buckets or mark.of
    path, by = f"{root}/v={version}", ["_bucket"] if keys else []
    rows = df.withColumn("_bucket", bucket_of(keys, of)) if keys else df
    if sums:
        rows = rows.repartition("_bucket").groupBy(*keys, "_bucket").agg(*[F.sum(c).alias(c) for c in sums])
    elif keys:
        rows = rows.hint("rebalance", "_bucket")
    rows = finish(rows) if finish else rows
    written = committed_row_count(rows, lambda d: d.write.mode("overwrite").option("compression", _CODEC).partitionBy(*by).parquet(path))
    found = None
    if keys and not written:  # a folder without rows, for the schema
        rows.drop("_bucket").limit(0).write.mode("overwrite").parquet(f"{path}/_bucket=-1")
        found = [-1]
    elif keys:
        found = sorted(r[0] for r in spark.read.parquet(path).select("_bucket").distinct().collect())  # no more than there are buckets
    mark = spark.createDataFrame([(version, written, note, found, of)], "version int, rows bigint, note string, buckets array<int>, of int")
    mark.coalesce(1).write.mode("append").parquet(f"{root}/versions")
    return version


def _marks(spark: SparkSession, root: str, version: int) -> list:
    """The versions up to one, in order; one row each."""
    known = spark.read.option("mergeSchema", True).parquet(f"{root}/versions").filter(F.col("version") <= version)
    of = F.coalesce(F.col("of"), F.lit(BUCKETS)) if "of" in known.columns else F.lit(BUCKETS)
    found = sorted(known.select("version", "buckets", of.alias("of")).collect(), key=lambda m: m.version)
    if not found or found[-1].version != version:
        raise ValueError(f"{root} has no version {version}")
    return found


def snapshot_read_as_of(spark: SparkSession, root: str, version: int, buckets: Sequence[int] | None = None) -> DataFrame:
    """A version's rows; of a table kept by key, those of some buckets if named."""
    marks = _marks(spark, root, version)
    if not marks[-1].buckets:
        return spark.read.parquet(f"{root}/v={version}")
    since = max((m.version for m, after in zip(marks, marks[1:]) if m.of != after.of), default=-1)  # then all rows were dealt anew
    newest = {b: f"{root}/v={m.version}/_bucket={b}" for m in marks if m.version > since for b in m.buckets}
    paths = [path for b, path in sorted(newest.items()) if buckets is None or b in buckets]
    return spark.read.parquet(*paths) if paths else spark.read.parquet(next(iter(newest.values()))).limit(0)


def table_profile(df: DataFrame) -> DataFrame:
    """Per column: rows, nulls, distinct values, least and greatest as text.

    Exact, so every row goes through the shuffle once a column; for large
    tables and for tables that come in batches see ``profile_sketches``.
    """
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count("*").alias("rows"),
                F.count_if(F.col(c).isNull()).alias("nulls"),
                F.countDistinct(c).alias("distinct"),
                F.min(c).cast("string").alias("least"),
                F.max(c).cast("string").alias("greatest"),
            ).alias(f"c{k}")
            for k, c in enumerate(df.columns)
        ]
    )
    return stats.select(F.explode(F.array(*stats.columns)).alias("s")).select("s.*")


#: Fixed value: log2 of the registers of a distinct-count sketch. Its error is about 1.04 / sqrt(2**12), 1.6 %.
SKETCH_BITS = 12
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def profile_sketches(df: DataFrame, by: str | None = None) -> DataFrame:
    """What profiles can be united from: one row, or one per value of ``by``, with a struct per column.

    Each has rows, nulls, least, greatest, a sketch of the distinct values
    and, for numbers, one of the quantiles. One pass in which every task sends
    a row per batch, whatever the number of columns.
    """
    columns = [f for f in df.schema if f.name != by]
    return df.groupBy(*([by] if by else [])).agg(*[_sketch(f).alias(f.name) for f in columns])


def _sketch(f: T.StructField) -> Column:
    c = F.col(f"`{f.name}`")
    whole = isinstance(f.dataType, (T.IntegerType, T.LongType, T.StringType, T.BinaryType))
    parts = [
        F.count("*").alias("rows"),
        F.count_if(c.isNull()).alias("nulls"),
        F.min(c).alias("least"),
        F.max(c).alias("greatest"),
        F.hll_sketch_agg(c if whole else c.cast("string"), F.lit(SKETCH_BITS)).alias("values"),
    ]
    if isinstance(f.dataType, _NUMBERS):
        parts.append(F.kll_sketch_agg_double(c.cast("double")).alias("quantiles"))
    return F.struct(*parts)


def unite_sketches(sketches: DataFrame, by: str | None = None) -> DataFrame:
    """The sketches of several batches as those of all of them, over any number of tables united before."""
    out = []
    for f in sketches.schema:
        if f.name == by or not isinstance(f.dataType, T.StructType):
            continue
        part = lambda name, f=f: F.col(f"`{f.name}`.{name}")
        united = [
            F.sum(part("rows")).alias("rows"),
            F.sum(part("nulls")).alias("nulls"),
            F.min(part("least")).alias("least"),
            F.max(part("greatest")).alias("greatest"),
            F.hll_union_agg(part("values")).alias("values"),
        ]
        if "quantiles" in f.dataType.fieldNames():
            united.append(F.kll_merge_agg_double(part("quantiles")).alias("quantiles"))
        out.append(F.struct(*united).alias(f.name))
    return sketches.groupBy(*([by] if by else [])).agg(*out)


def sketched_profile(sketches: DataFrame, by: str | None = None) -> DataFrame:
    """``table_profile`` from sketches: distinct values within about 2 %, and the quartiles of numbers; per batch if ``by``."""
    columns = []
    for f in sketches.schema:
        if f.name == by or not isinstance(f.dataType, T.StructType):
            continue
        part = lambda name, f=f: F.col(f"`{f.name}`.{name}")
        known = part("rows") > part("nulls")
        quartile = F.lit(None).cast("double")
        at = lambda q, f=f: F.when(known, F.kll_sketch_get_quantile_double(part("quantiles"), F.lit(q)))
        quartiles = [at(q) if "quantiles" in f.dataType.fieldNames() else quartile for q in (0.25, 0.5, 0.75)]
        columns.append(F.struct(
            F.lit(f.name).alias("column"), part("rows").alias("rows"), part("nulls").alias("nulls"),
            F.hll_sketch_estimate(part("values")).alias("distinct"),
            part("least").cast("string").alias("least"), part("greatest").cast("string").alias("greatest"),
            *[q.alias(name) for q, name in zip(quartiles, ("lower", "median", "upper"))],
        ))
    return sketches.select(*([by] if by else []), F.explode(F.array(*columns)).alias("s")).select(*([by] if by else []), "s.*")


def changed_buckets(spark: SparkSession, root: str, old: int, new: int) -> list[int] | None:
    """The key buckets that versions after ``old`` up to ``new`` wrote.

    None stands for all rows: where the table is not kept by key, or its
    number of buckets changed.
    """
    marks = [m for m in _marks(spark, root, new) if m.version >= old]
    if not marks[-1].buckets or len({m.of for m in marks}) > 1:
        return None
    return sorted({b for m in marks if m.version > old for b in m.buckets})


def analyze_table(spark: SparkSession, name: str) -> None:
    """Optimizer statistics of a registered table and all its columns."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
