"""A1-A17: partitioned tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.calendar import (
    offset_of,
    partition_id,
    partition_offset,
    split_suffix,
)
from tallybook.functions.numbers import money_sum
from tallybook.operators.shape import conform, union_all
from tallybook.schemas import struct
from tallybook.session import new_scratch_table
from tallybook.sources import partitions as P
from tallybook.sources.tables import list_partitions as list_partitions_of
from tallybook.sources.tables import sql, write
from workload.registry import query
from workload.tables import case, daily, table, with_

EVENT = struct(("event_id user_id", "bigint"), ("event_type", "string"), ("value", "double"))
_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def stored_daily(spark: SparkSession, sf_dir: str) -> str:
    """All events written as a table with one partition per day."""
    root = new_scratch_table(spark, "events")
    write(daily(spark, sf_dir), root, EVENT)
    return root


@query(
    "a1_wildcard_scan",
    with_(
        "daily",
        """
SELECT partition_date, COUNT(*) AS row_count,
       CAST(SUM(CAST(CAST(value AS VARCHAR) AS DECIMAL(38,10))) AS DOUBLE) AS total_value
FROM daily GROUP BY partition_date""",
    ),
)
def wildcard_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = P.scan(spark, stored_daily(spark, sf_dir), EVENT)
    return stored.groupBy("partition_date").agg(
        F.count(F.lit(1)).alias("row_count"), money_sum(F.col("value")).alias("total_value")
    )


@query(
    "a2_partition_scan",
    with_(
        "daily",
        """
SELECT event_id, user_id, event_type, value, partition_date FROM daily
WHERE partition_date = DATE '2024-01-15'""",
    ),
)
def partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.scan(spark, stored_daily(spark, sf_dir), EVENT, partition=date(2024, 1, 15))


@query("a3_list_hours", "SELECT DISTINCT date_trunc('hour', ts) AS partition_date FROM events")
def list_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folders of a table that is stored by hour."""
    root = new_scratch_table(spark, "hours")
    write(daily(spark, sf_dir).withColumn("partition_date", F.col("ts")), root, EVENT, grain="hour")
    return list_partitions_of(spark, root, grain="hour")


@query(
    "a10_rerun_empty",
    with_(
        "daily",
        """
SELECT partition_date, COUNT(*) AS row_count FROM daily
WHERE partition_date <> DATE '2024-01-15' GROUP BY partition_date""",
    ),
)
def rerun_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day that is loaded again without rows has none; the others are whole."""
    root, day = stored_daily(spark, sf_dir), date(2024, 1, 15)
    write(daily(spark, sf_dir).where("false"), root, EVENT, "TRUNCATE", day)
    return P.scan(spark, root, EVENT).groupBy("partition_date").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "a10_failed_load",
    with_(
        "daily",
        """
SELECT partition_date, COUNT(*) AS row_count, SUM(event_id) AS id_sum,
       SUM(event_id) FILTER (event_type = 'click') AS click_sum
FROM daily WHERE partition_date <> DATE '2024-01-15' OR event_type = 'click' GROUP BY partition_date""",
    ),
)
def failed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day is replaced by its clicks; loads of two other days fail while they write."""
    root, rows = stored_daily(spark, sf_dir), daily(spark, sf_dir)
    day = date(2024, 1, 15)
    write(rows.where((F.col("partition_date") == F.lit(day)) & (F.col("event_type") == "click")), root, EVENT, "TRUNCATE", day)
    fails = F.when(F.col("event_id") >= 0, F.raise_error("broken row").cast("bigint"))
    for other in (date(2024, 1, 16), date(2024, 1, 17)):
        try:
            write(rows.withColumn("event_id", fails), root, EVENT, "TRUNCATE", other)
        except Exception as e:  # the error comes from a task, in whatever class wraps it
            if "broken row" not in str(e):
                raise
        else:
            raise AssertionError("the load should have failed")
    clicks = F.sum(F.when(F.col("event_type") == "click", F.col("event_id"))).alias("click_sum")
    measures = [F.count(F.lit(1)).alias("row_count"), F.sum("event_id").alias("id_sum"), clicks]
    return P.scan(spark, root, EVENT).groupBy("partition_date").agg(*measures)


@query("a3_list_partitions", with_("daily", "SELECT DISTINCT partition_date FROM daily ORDER BY 1"))
def list_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.partitions(daily(spark, sf_dir))


@query(
    "a4_latest_partition",
    with_(
        "daily",
        """
SELECT event_id, user_id, value, partition_date FROM daily
WHERE partition_date = (SELECT max(partition_date) FROM daily)""",
    ),
)
def latest_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily(spark, sf_dir).select("event_id", "user_id", "value", "partition_date")
    return P.latest_partition(rows)


@query(
    "a5_latest_two",
    with_(
        "daily",
        """
, newest AS (SELECT partition_date, row_number() OVER (ORDER BY partition_date DESC) - 1 AS age
             FROM (SELECT DISTINCT partition_date FROM daily) ORDER BY partition_date DESC LIMIT 2)
SELECT event_id, user_id, value, partition_date, CAST(age AS INTEGER) AS age
FROM daily JOIN newest USING (partition_date)""",
    ),
)
def latest_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily(spark, sf_dir).select("event_id", "user_id", "value", "partition_date")
    return P.latest(rows, 2)


@query(
    "a6_partition_range",
    with_(
        "daily",
        """
SELECT event_id, user_id, value, partition_date FROM daily
WHERE partition_date >= DATE '2024-01-10' AND partition_date < DATE '2024-01-20'""",
    ),
)
def partition_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily(spark, sf_dir).select("event_id", "user_id", "value", "partition_date")
    return P.in_range(rows, "2024-01-10", "2024-01-20")


@query(
    "a7_partition_offset",
    """
SELECT event_id,
  strftime(ts - INTERVAL 1 DAY, '%Y%m%d') AS day_m1, strftime(ts, '%Y%m%d') AS day_0,
  strftime(ts + INTERVAL 1 DAY, '%Y%m%d') AS day_p1,
  strftime(ts - INTERVAL 1 MONTH, '%Y%m') AS month_m1, strftime(ts, '%Y%m') AS month_0,
  strftime(ts + INTERVAL 1 MONTH, '%Y%m') AS month_p1,
  strftime(ts - INTERVAL 1 HOUR, '%Y%m%d%H') AS hour_m1, strftime(ts, '%Y%m%d%H') AS hour_0,
  strftime(ts + INTERVAL 1 HOUR, '%Y%m%dT%H') AS hour_t_p1,
  CAST(floor((epoch_us(date_trunc('day', ts)) - epoch_us(TIMESTAMP '2024-01-15 12:00:00')) / 86400000000.0) AS INTEGER) AS days_off,
  CAST(floor((epoch_us(date_trunc('hour', ts)) - epoch_us(TIMESTAMP '2024-01-15 12:30:00')) / 3600000000.0) AS INTEGER) AS hours_off,
  CAST(datesub('month', TIMESTAMP '2024-03-15 12:00:00', date_trunc('month', ts)) AS INTEGER) AS months_off
FROM events""",
)
def offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")

    def off(n: int, grain: str):
        return partition_offset(ts, F.lit(n), grain)

    def now(text: str):
        return F.lit(text).cast("timestamp_ntz")

    return table(spark, sf_dir, "events").select(
        "event_id",
        off(-1, "day").alias("day_m1"),
        off(0, "day").alias("day_0"),
        off(1, "day").alias("day_p1"),
        off(-1, "month").alias("month_m1"),
        off(0, "month").alias("month_0"),
        off(1, "month").alias("month_p1"),
        off(-1, "hour").alias("hour_m1"),
        off(0, "hour").alias("hour_0"),
        off(1, "hour_t").alias("hour_t_p1"),
        offset_of(F.to_date(ts), now("2024-01-15 12:00:00"), "day").alias("days_off"),
        offset_of(F.date_trunc("HOUR", ts), now("2024-01-15 12:30:00"), "hour").alias("hours_off"),
        offset_of(F.trunc(ts, "MM"), now("2024-03-15 12:00:00"), "month").alias("months_off"),
    )


@query(
    "a7_partition_ids",
    """
SELECT event_id, event_type || CASE event_type
    WHEN 'view' THEN strftime(ts - INTERVAL 1 DAY, '_%Y%m%d') WHEN 'click' THEN strftime(ts - INTERVAL 1 MONTH, '_%Y%m')
    WHEN 'signup' THEN strftime(ts - INTERVAL 1 HOUR, '_%Y%m%d%H') WHEN 'purchase' THEN strftime(ts - INTERVAL 1 HOUR, '_%Y%m%dT%H')
    ELSE '' END AS table_id
FROM events""",
)
def partition_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table names that spell their grain, moved to the partition before each event."""
    kind = F.col("event_type")
    grain = case(
        kind,
        {"view": "_YYYYMMDD", "click": "_YYYYMM", "signup": "_YYYYMMDDHH", "purchase": "_YYYYMMDDTHH"},
        default="",
    )
    made = partition_id(F.concat(kind, grain), F.col("ts"), F.lit(-1))
    return table(spark, sf_dir, "events").select("event_id", made.alias("table_id"))


@query(
    "a8_suffix_parse",
    """
WITH ids AS (
  SELECT event_id, event_type || CASE event_type WHEN 'view' THEN strftime(ts, '_%Y%m%d')
    WHEN 'click' THEN strftime(ts, '_%Y%m') WHEN 'signup' THEN strftime(ts, '_%Y%m%d%H')
    WHEN 'purchase' THEN strftime(ts, '_%Y%m%dT%H') ELSE '' END AS table_id
  FROM events)
SELECT event_id, table_id,
  CASE WHEN event_type = 'error' THEN table_id ELSE event_type || '_' END AS prefix,
  CASE event_type WHEN 'view' THEN 'day' WHEN 'click' THEN 'month' WHEN 'signup' THEN 'hour'
       WHEN 'purchase' THEN 'hour_t' END AS grain,
  CASE WHEN event_type <> 'error' THEN substr(table_id, length(event_type) + 2) END AS suffix
FROM ids JOIN events USING (event_id)""",
)
def suffix_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, ts = F.col("event_type"), F.col("ts")
    suffix = (
        F.when(kind == "view", F.date_format(ts, "_yyyyMMdd"))
        .when(kind == "click", F.date_format(ts, "_yyyyMM"))
        .when(kind == "signup", F.date_format(ts, "_yyyyMMddHH"))
        .when(kind == "purchase", F.date_format(ts, "_yyyyMMdd'T'HH"))
        .otherwise("")
    )
    ids = table(spark, sf_dir, "events").select("event_id", F.concat(kind, suffix).alias("table_id"))
    return ids.withColumn("p", split_suffix(F.col("table_id"))).select("event_id", "table_id", "p.*")


@query(
    "a9_dependency_report",
    with_(
        "daily",
        """
SELECT r.partition_date, d.n IS NOT NULL AS "exists", COALESCE(d.n, 0) > 0 AS has_rows
FROM (VALUES (DATE '2024-01-10'), (DATE '2024-01-20'), (DATE '2024-01-30'),
             (DATE '2024-02-10'), (DATE '2024-03-10')) r(partition_date)
LEFT JOIN (SELECT partition_date, COUNT(*) AS n FROM daily GROUP BY 1) d USING (partition_date)""",
    ),
)
def dependency_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = ["2024-01-10", "2024-01-20", "2024-01-30", "2024-02-10", "2024-03-10"]
    wanted = F.explode(F.array(*[F.lit(d).cast("date") for d in days]))
    required = spark.range(1).select(wanted.alias("partition_date"))
    return P.dependency_report(required, daily(spark, sf_dir))


@query(
    "a12_conform",
    """
SELECT CAST(c_custkey AS VARCHAR) AS item_id, c_name AS account_name,
       TRY_CAST('2024-01-' || lpad(CAST(c_custkey % 35 AS VARCHAR), 2, '0') AS DATE) AS opened,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance,
       CAST(NULL AS VARCHAR) AS note, CAST(NULL AS BIGINT) AS score
FROM customer""",
)
def conform_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = struct(
        ("item_id account_name", "string"),
        ("opened", "date"),
        ("balance", T.DecimalType(18, 2)),
        ("note", "string"),
        ("score", "bigint"),
    )
    day = F.concat(F.lit("2024-01-"), F.lpad((F.col("c_custkey") % 35).cast("string"), 2, "0"))
    raw = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("item_id"),
        F.col("c_name").alias("account_name"),
        day.alias("opened"),
        F.col("c_acctbal").alias("balance"),
        "c_mktsegment",
    )
    return conform(raw, schema).withColumn("balance", F.col("balance").cast("double"))


@query(
    "a15_retention_candidates",
    with_(
        "daily",
        """
SELECT DISTINCT partition_date FROM daily
WHERE partition_date < (SELECT max(partition_date) FROM daily) - 9""",
    ),
)
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily(spark, sf_dir)
    newest = rows.agg(F.max("partition_date")).scalar()
    return P.retention_candidates(rows, newest, keep_days=10)


@query(
    "a16_table_stats",
    "\nUNION ALL\n".join(f"SELECT 'warehouse' AS dataset_id, '{t}' AS table_id, COUNT(*) AS row_count FROM {t}" for t in _TABLES),
)
def table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table; bytes and times, which SQL can't see, are tested apart."""
    files = [(t, P.stored_files(spark, f"{sf_dir}/{t}.parquet")) for t in _TABLES]
    stats = [P.table_stats(table(spark, sf_dir, t), f, "warehouse", t) for t, f in files]
    return union_all(*stats).select("dataset_id", "table_id", "row_count")


@query(
    "a17_param_sql",
    """
SELECT o_orderpriority, COUNT(*) AS row_count,
       CAST(SUM(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38,10))) AS DOUBLE) AS total_price
FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderpriority""",
)
def param_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("param_orders")
    text = """
        SELECT o_orderpriority, count(*) AS row_count,
               CAST(sum(CAST(o_totalprice AS DECIMAL(38,10))) AS DOUBLE) AS total_price
        FROM IDENTIFIER(:t) WHERE o_totalprice > :min_price GROUP BY o_orderpriority"""
    return sql(spark, text, {"t": "param_orders", "min_price": 100000})
