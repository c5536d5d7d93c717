"""Reading and inspecting date-partitioned tables."""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.calendar import parse_suffix
from tallybook.schemas import GRAIN_FORMATS, GRAIN_LENGTHS

PARTITION = "partition_date"


def with_partition(
    schema: T.StructType, grain: str | None = "day", col: str = PARTITION
) -> T.StructType:
    if grain is None or col in schema.names:
        return schema
    kind = T.DateType() if grain in ("day", "month") else T.TimestampNTZType()
    return T.StructType([*schema.fields, T.StructField(col, kind)])


def at_grain(value, grain: str | None):
    """A date, time or column cut to the start of its day, month or hour; None stays None."""
    if value is None or grain is None:
        return value
    if isinstance(value, Column):
        if grain == "month":
            return F.trunc(value, "MM")
        return value.cast("date") if grain == "day" else F.date_trunc("HOUR", value).cast("timestamp_ntz")
    if grain in ("day", "month"):
        day = value.date() if isinstance(value, datetime) else value
        return day.replace(day=1) if grain == "month" else day
    return value.replace(minute=0, second=0, microsecond=0)


def scan(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    grain: str | None = "day",
    partition: date | datetime | None = None,
    col: str = PARTITION,
) -> DataFrame:
    """All partitions of a table, or one; one partition is pruned at listing time."""
    partition = at_grain(partition, grain)
    df = spark.read.schema(with_partition(schema, grain, col)).parquet(root)
    return df if partition is None else df.where(F.col(col) == F.lit(partition))


def shards(
    spark: SparkSession,
    root: str,
    name: str,
    grain: str = "day",
    start: str | None = None,
    end: str | None = None,
) -> list[str]:
    """Folders ``name_SUFFIX`` with a suffix in ``[start, end)``, in order, from one listing.

    Suffixes of one grain sort as their dates do.
    """
    digits = r"\d{8}T\d{2}" if grain == "hour_t" else rf"\d{{{GRAIN_LENGTHS[grain]}}}"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    found = [re.fullmatch(f"{re.escape(name)}_({digits})", s.getPath().getName()) for s in listed]
    kept = [m for m in found if m and (not start or m[1] >= start) and (not end or m[1] < end)]
    return [f"{root}/{m[0]}" for m in sorted(kept, key=lambda m: m[1])]


def scan_sharded(
    spark: SparkSession,
    root: str,
    name: str,
    schema: T.StructType,
    grain: str = "day",
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Folders ``name_YYYYMMDD`` read as one table, the suffix as ``partition_date``.

    Only folders with a suffix in ``[start, end)`` are read.
    """
    folders = shards(spark, root, name, grain, start, end)
    if not folders:
        return spark.createDataFrame([], with_partition(schema, grain))
    digits = r"\d{8}T\d{2}" if grain == "hour_t" else rf"\d{{{GRAIN_LENGTHS[grain]}}}"
    suffix = F.regexp_extract(F.col("_metadata.file_path"), rf"/{re.escape(name)}_({digits})/", 1)
    df = spark.read.schema(schema).parquet(*folders)
    return df.select("*", parse_suffix(suffix, grain).alias(PARTITION))


def partitions(df: DataFrame, col: str = PARTITION) -> DataFrame:
    """Partitions present, in order."""
    return df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col)


def newest(df: DataFrame, n: int = 1, col: str = PARTITION) -> DataFrame:
    """The ``n`` newest partitions as (col, age); fails when fewer exist."""
    days = df.where(F.col(col).isNotNull()).select(col).distinct()
    top = days.orderBy(F.desc(col)).limit(n)
    found = F.sort_array(F.collect_list(col), asc=False)
    short = F.lit(f"fewer than {n} partitions in the table")
    checked = F.when(F.size(found) >= n, found).otherwise(F.raise_error(short))
    return top.agg(checked.alias("found")).select(F.posexplode("found").alias("age", col))


def latest(df: DataFrame, n: int = 1, col: str = PARTITION) -> DataFrame:
    """Rows of the ``n`` newest partitions, with ``age`` 0 for the newest.

    The partition list holds ``n`` rows, so it is broadcast, and on a partitioned
    table it prunes the scan at run time.
    """
    return df.join(F.broadcast(newest(df, n, col)), col)


def latest_partition(df: DataFrame, col: str = PARTITION) -> DataFrame:
    """Rows of the newest partition (a scalar subquery, pruned at run time)."""
    return df.where(F.col(col) == df.agg(F.max(col)).scalar())


def _bound(value: str | date | datetime, grain: str) -> Column:
    if isinstance(value, str):
        digits = value.replace("-", "")
        if len(digits) != GRAIN_LENGTHS[grain]:
            raise ValueError(f"bound {value!r} does not match {GRAIN_FORMATS[grain]}")
        return parse_suffix(F.lit(digits), grain)
    return F.lit(value)


def in_range(
    df: DataFrame,
    start: str | date | None = None,
    end: str | date | None = None,
    grain: str = "day",
    col: str = PARTITION,
) -> DataFrame:
    """Partitions in ``[start, end)``; either side may be open, not both."""
    if grain not in GRAIN_FORMATS:
        raise ValueError(f"grain must be one of {sorted(GRAIN_FORMATS)}, not {grain!r}")
    if start is None and end is None:
        raise ValueError("a start or an end is needed")
    lower = None if start is None else _bound(start, grain)
    upper = None if end is None else _bound(end, grain)
    if lower is not None and upper is not None:
        if type(start) is type(end) and not _text(start) < _text(end):
            raise ValueError("start must be before end")
    if lower is not None:
        df = df.where(F.col(col) >= lower)
    if upper is not None:
        df = df.where(F.col(col) < upper)
    return df


def _text(value: str | date | datetime) -> str:
    return value.replace("-", "") if isinstance(value, str) else value.isoformat()


def dependency_report(required: DataFrame, actual: DataFrame, col: str = PARTITION) -> DataFrame:
    """One row per required partition: is it there, and does it have rows?

    ``actual`` is either the table itself or a listing with a ``row_count`` column,
    where a partition may exist with no rows.
    """
    rows = F.sum("row_count") if "row_count" in actual.columns else F.count(F.lit(1))
    have = actual.groupBy(col).agg(rows.alias("row_count"))
    return required.select(col).distinct().join(have, col, "left").select(
        col,
        F.col("row_count").isNotNull().alias("exists"),
        (F.coalesce("row_count", F.lit(0)) > 0).alias("has_rows"),
    )


def retention_candidates(
    df: DataFrame, as_of: date | Column, keep_days: int = 30, col: str = PARTITION
) -> DataFrame:
    """Partitions outside the last ``keep_days`` days, the day of ``as_of`` included."""
    today = as_of if isinstance(as_of, Column) else F.lit(as_of)
    first_kept = F.date_sub(today, keep_days - 1)
    return partitions(df.where(F.col(col) < first_kept), col)


def window_filter(
    df: DataFrame, col: str, as_of: date | Column, first_days_ago: int, last_days_ago: int
) -> DataFrame:
    """Rows dated between ``first_days_ago`` and ``last_days_ago`` days before ``as_of``."""
    today = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return df.where(
        F.col(col).between(F.date_sub(today, first_days_ago), F.date_sub(today, last_days_ago))
    )


def since_year_start(df: DataFrame, col: str, as_of: date | Column, years: int = 2) -> DataFrame:
    """Rows from 1 January of the year ``years`` before ``as_of`` on."""
    today = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return df.where(F.col(col) >= F.trunc(F.add_months(today, -12 * years), "YEAR"))


def stored_files(spark: SparkSession, root: str) -> DataFrame:
    """``file, size, modified`` of a stored table, from a listing; no content is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return listed.option("pathGlobFilter", "*.parquet").load(root).select(
        F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )


def table_stats(
    rows: DataFrame, files: DataFrame, dataset_id: str, table_id: str | Column, by: str | None = None
) -> DataFrame:
    """Row count, bytes and file times of a table, or of each of its partitions.

    Rows are counted without reading a column, ``by`` aside; bytes and times come from
    ``stored_files``. ``table_id`` may use the partition column ``by``.
    """
    table = table_id if isinstance(table_id, Column) else F.lit(table_id)
    keys = [by] if by else []
    if by:
        found = F.regexp_extract("file", f"/{by}=([^/]+)/", 1)
        files = files.withColumn(by, F.url_decode(found).cast(rows.schema[by].dataType))
    sizes = files.groupBy(*keys).agg(
        F.unix_millis(F.min("modified")).alias("creation_time"),
        F.unix_millis(F.max("modified")).alias("last_modified_time"),
        F.sum("size").alias("size_bytes"),
    )
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    both = sizes.unionByName(counts, allowMissingColumns=True).groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in ("creation_time", "last_modified_time", "row_count", "size_bytes")]
    )
    return both.select(
        F.lit(dataset_id).alias("dataset_id"),
        table.alias("table_id"),
        "creation_time",
        "last_modified_time",
        F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
        "size_bytes",
    )
