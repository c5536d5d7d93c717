"""D: profiles, comparisons, reconciliations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.numbers import money_sum
from tallybook.operators.profile import (
    compare,
    duplicate_count,
    is_empty,
    missing_categories,
    null_checks,
    null_profile,
    null_profile_by_partition,
    ordered_list,
    reconcile,
)
from workload.registry import query
from workload.tables import budget, cte, daily, spend, table, tx, with_

# events with gaps: an error has no type, a small value and an odd user are unknown
cte(
    "gaps",
    """
SELECT event_id, partition_date, NULLIF(event_type, 'error') AS event_type,
       CASE WHEN value >= 1 THEN value END AS value,
       CASE WHEN user_id % 7 <> 3 THEN user_id END AS user_id,
       CASE WHEN event_type = 'view' THEN [] WHEN event_type = 'click' THEN NULL ELSE [event_type] END AS tags
FROM daily
""",
    "daily",
)


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    none = F.array().cast("array<string>")
    return daily(spark, sf_dir).select(
        "event_id",
        "partition_date",
        F.nullif(kind, F.lit("error")).alias("event_type"),
        F.when(F.col("value") >= 1, F.col("value")).alias("value"),
        F.when(F.col("user_id") % 7 != 3, F.col("user_id")).alias("user_id"),
        F.when(kind == "view", none).when(kind == "click", F.lit(None)).otherwise(F.array(kind)).alias("tags"),
    )


_CHECKS = {"null_events": "event_id", "null_types": "event_type", "null_values": "value", "null_users": "user_id"}
_CHECKS_SQL = ", ".join(f"COUNT(*) FILTER ({c} IS NULL) AS {n}" for n, c in _CHECKS.items())


@query("d1_null_profile", with_("gaps", f"SELECT {_CHECKS_SQL}, COUNT(*) AS total_rows FROM gaps"))
def nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_profile(gaps(spark, sf_dir), null_checks(_CHECKS), total="total_rows")


@query(
    "d2_conditional_nulls",
    with_(
        "gaps",
        """
SELECT partition_date,
  COUNT(*) FILTER (event_type = 'view' AND value IS NULL) AS null_view_values,
  COUNT(*) FILTER (event_type NOT IN ('view', 'click') AND user_id IS NULL) AS null_other_users,
  COUNT(*) FILTER (event_type IS NOT NULL AND (tags IS NULL OR len(tags) = 0)) AS null_tags
FROM gaps GROUP BY partition_date""",
    ),
)
def conditional_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    checks = {
        "null_view_values": (kind == "view") & F.col("value").isNull(),
        "null_other_users": ~kind.isin("view", "click") & F.col("user_id").isNull(),
        "null_tags": kind.isNotNull() & is_empty(F.col("tags")),
    }
    return null_profile(gaps(spark, sf_dir), checks, by=["partition_date"])


@query(
    "d3_distinct_counts",
    """
SELECT COUNT(DISTINCT o_custkey) AS customers, COUNT(DISTINCT o_orderpriority) AS priorities,
       COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS days FROM orders""",
)
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").agg(
        F.count_distinct("o_custkey").alias("customers"),
        F.count_distinct("o_orderpriority").alias("priorities"),
        F.count_distinct(F.to_date("o_orderdate")).alias("days"),
    )


@query(
    "d4_conditional_sum",
    with_(
        "tx",
        """
SELECT category_raw, CAST(SUM(CASE WHEN status = 'O' THEN CAST(CAST(amount AS VARCHAR) AS DECIMAL(38,10)) ELSE 0 END) AS DOUBLE) AS open_amount,
       CAST(SUM(CAST(CAST(CASE WHEN status = 'F' THEN amount * -1 ELSE amount END AS VARCHAR) AS DECIMAL(38,10))) AS DOUBLE) AS flipped_amount
FROM tx GROUP BY category_raw""",
    ),
)
def conditional_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount, status = F.col("amount"), F.col("status")
    return tx(spark, sf_dir).groupBy("category_raw").agg(
        money_sum(F.when(status == "O", amount).otherwise(0.0)).alias("open_amount"),
        money_sum(F.when(status == "F", amount * -1).otherwise(amount)).alias("flipped_amount"),
    )


# a seventh of a price has more places than cents
@query(
    "d4_fine_sum",
    """
SELECT o_orderpriority, CAST(SUM(CAST(CAST(o_totalprice / 7 AS VARCHAR) AS DECIMAL(38,10))) AS DOUBLE) AS sevenths,
       CAST(SUM(CAST(CAST(o_totalprice / 70000 AS VARCHAR) AS DECIMAL(38,10))) AS DOUBLE) AS small_parts
FROM orders GROUP BY o_orderpriority""",
)
def fine_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        money_sum(price / 7).alias("sevenths"), money_sum(price / 70000).alias("small_parts")
    )


@query(
    "d8_partition_null_rollup",
    with_(
        "gaps",
        """
, per AS (SELECT partition_date, COUNT(*) FILTER (value > 300) AS null_large FROM gaps GROUP BY 1)
SELECT string_agg(CAST(partition_date AS VARCHAR), '; ' ORDER BY partition_date) FILTER (null_large > 0) AS partitions_null,
       CAST(SUM(null_large) AS BIGINT) AS null_large
FROM per""",
    ),
)
def partition_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_profile_by_partition(gaps(spark, sf_dir), {"null_large": F.col("value") > 300})


@query(
    "d9_string_agg",
    """
SELECT c_mktsegment, string_agg(DISTINCT n, '; ' ORDER BY n) AS nations,
       string_agg(DISTINCT none, '; ') AS nothing
FROM (SELECT c_mktsegment, CASE WHEN n_name <> 'NATION_3' THEN n_name END AS n, CAST(NULL AS VARCHAR) AS none
      FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)
GROUP BY c_mktsegment""",
)
def string_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct names per segment first, so a list is never longer than the dictionary."""
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    pairs = table(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey").distinct()
    named = pairs.join(nations, "c_nationkey", "left").withColumns(
        {"n": F.when(F.col("n_name") != "NATION_3", F.col("n_name")), "none": F.lit(None).cast("string")}
    )
    return named.groupBy("c_mktsegment").agg(
        ordered_list("n").alias("nations"), ordered_list("none").alias("nothing")
    )


@query(
    "d11_duplicate_keys",
    """
SELECT COUNT(*) AS duplicates FROM (
  SELECT l_partkey, CAST(l_shipdate AS DATE) FROM lineitem WHERE l_quantity > 1
  GROUP BY ALL HAVING COUNT(*) > 1)""",
)
def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    return duplicate_count(rows, ["l_partkey", "day"], F.col("l_quantity") > 1)


@query(
    "d12_missing_categories",
    with_(
        "spend budget",
        """
, gone AS (
  SELECT DISTINCT s.category_raw || ' - ' || s.subcategory_raw AS label FROM spend s
  LEFT JOIN budget b ON s.category_raw = b.category_raw AND s.subcategory_raw = b.subcategory_raw
  WHERE b.category_raw IS NULL AND s.subcategory_raw NOT IN ('FURNITURE'))
SELECT string_agg(label, '; ' ORDER BY label) AS missing_categories, COUNT(*) AS missing_categories_count
FROM gone""",
    ),
)
def missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_categories(spend(spark, sf_dir), budget(spark, sf_dir), ["FURNITURE"])


@query("d13_distinct", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority").distinct()


@query(
    "d14_partition_compare",
    with_(
        "gaps",
        """
, a AS (SELECT COUNT(*) AS r, COUNT(DISTINCT user_id) AS u, COUNT(DISTINCT event_type) AS t, COUNT(*) FILTER (value IS NULL) AS nv,
         CAST(SUM(CAST(CAST(value AS VARCHAR) AS DECIMAL(38,10))) AS DOUBLE) AS v FROM gaps WHERE partition_date = DATE '2024-01-30'),
  b AS (SELECT COUNT(*) AS r, COUNT(DISTINCT user_id) AS u, COUNT(DISTINCT event_type) AS t,
         CAST(SUM(CAST(CAST(value AS VARCHAR) AS DECIMAL(38,10))) AS DOUBLE) AS v FROM gaps WHERE partition_date = DATE '2024-01-29')
SELECT DATE '2024-01-30' AS partition_0d, DATE '2024-01-29' AS partition_1d, a.nv AS null_values,
  a.r AS total_rows_0d, b.r AS total_rows_1d, a.r - b.r AS total_rows_diff,
  a.u AS total_users_0d, b.u AS total_users_1d, a.u - b.u AS total_users_diff,
  a.t AS total_types_0d, b.t AS total_types_1d, a.t - b.t AS total_types_diff,
  round(a.v, 2) AS total_value_0d, round(b.v, 2) AS total_value_1d,
  round((a.v - b.v) / NULLIF(abs(b.v), 0) * 100, 2) AS total_value_pct_chg,
  round(abs((a.v - b.v) / NULLIF(abs(b.v), 0) * 100), 2) AS total_value_pct_chg_abs
FROM a, b""",
    ),
)
def partition_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare(
        gaps(spark, sf_dir),
        "partition_date",
        date(2024, 1, 30),
        date(2024, 1, 29),
        counts={"rows": F.count(F.lit(1))},
        distinct={"users": "user_id", "types": "event_type"},
        sums={"value": money_sum(F.col("value"))},
        nulls=null_checks({"null_values": "value"}),
    )


@query(
    "d15_reconcile",
    """
WITH o AS (SELECT SUM(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38,10))) AS v FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-05-04'),
  l AS (SELECT SUM(CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(38,10))) AS v FROM lineitem WHERE CAST(l_shipdate AS DATE) = DATE '1998-05-04')
SELECT round(CAST(o.v AS DOUBLE), 2) AS total_price_0d, round(CAST(l.v AS DOUBLE), 2) AS total_price_source,
       round(CAST(o.v AS DOUBLE) - CAST(l.v AS DOUBLE), 2) AS total_price_diff
FROM o, l""",
)
def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.lit("1998-05-04").cast("date")
    orders = table(spark, sf_dir, "orders").where(F.to_date("o_orderdate") == day)
    lines = table(spark, sf_dir, "lineitem").where(F.to_date("l_shipdate") == day)
    return reconcile(
        orders.select(F.col("o_totalprice").alias("amount")),
        lines.select(F.col("l_extendedprice").alias("amount")),
        "price",
    )
