"""C, E, F, G and I: joins, dedup, order, unions, the change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators.budgeting import (
    actuals,
    balance_rows,
    budget_totals,
    budget_vs_actual,
    categorize,
    with_balance,
)
from tallybook.operators.dedup import apply_tombstones, current_view, latest_by
from tallybook.operators.joins import enrich, existing_keys, merge_cursors, missing_keys
from tallybook.operators.profile import compare
from tallybook.plans.mart import metric_union
from tallybook.plans.status import daily_status, latest_shards
from workload.mart import mart_rows
from workload.registry import query
from workload.tables import budget, cte, daily, removed, spend, table, tx, with_


@query(
    "c1_left_enrich",
    with_(
        "tx",
        """
SELECT t.transaction_id, t.account_id, t.amount, c.c_name AS account_name, c.c_mktsegment AS account_type
FROM (SELECT transaction_id, amount, CASE WHEN status <> 'P' THEN account_id END AS account_id FROM tx) t
LEFT JOIN customer c ON t.account_id = c.c_custkey""",
    ),
)
def left_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tx(spark, sf_dir).select(
        "transaction_id", "amount", F.when(F.col("status") != "P", F.col("account_id")).alias("account_id")
    )
    accounts = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey account_id", "c_name account_name", "c_mktsegment account_type"
    )
    return enrich(rows, accounts, ["account_id"])


@query(
    "c2_tombstone_filter",
    with_(
        "tx removed",
        """
SELECT DISTINCT t.transaction_id, t.account_id, t.transaction_date, t.amount
FROM tx t LEFT JOIN removed r USING (transaction_id, account_id)
WHERE CASE WHEN r.transaction_id IS NOT NULL THEN r.date_removed < t.transaction_date ELSE TRUE END""",
    ),
)
def tombstone_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tx(spark, sf_dir).select("transaction_id", "account_id", "transaction_date", "amount")
    return apply_tombstones(rows, removed(spark, sf_dir), ["transaction_id", "account_id"], "transaction_date")


@query(
    "c3_category_month_join",
    with_(
        "categorized",
        "SELECT transaction_id, transaction_month, category_updated, subcategory_updated, category, subcategory, detail_category FROM categorized",
    ),
)
def category_month_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categorize(spend(spark, sf_dir), budget(spark, sf_dir)).select(
        "transaction_id", "transaction_month", "category_updated", "subcategory_updated", "category",
        "subcategory", "detail_category",
    )


def all_actuals(spark: SparkSession, sf_dir: str, b: DataFrame) -> DataFrame:
    return actuals(categorize(spend(spark, sf_dir), b))


def budget_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = budget(spark, sf_dir)
    return budget_vs_actual(budget_totals(b), all_actuals(spark, sf_dir, b))


@query("c4_budget_vs_actual", with_("lines", "SELECT * FROM lines"))
def c4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget_lines(spark, sf_dir)


@query(
    "c5_left_anti",
    """
SELECT c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)""",
)
def left_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = table(spark, sf_dir, "orders").where("o_totalprice > 300000").selectExpr("o_custkey c_custkey")
    return missing_keys(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), large, ["c_custkey"])


def _newest_two(spark: SparkSession, sf_dir: str):
    rows = daily(spark, sf_dir)
    newest = rows.agg(F.max("partition_date")).scalar()
    older = rows.where(F.col("partition_date") < newest).agg(F.max("partition_date")).scalar()
    return rows, newest, older


@query(
    "c6_cross_compare",
    with_(
        "daily",
        """
, d AS (SELECT max(partition_date) AS d0,
               (SELECT max(partition_date) FROM daily WHERE partition_date < (SELECT max(partition_date) FROM daily)) AS d1
        FROM daily),
n AS (SELECT COUNT(*) AS r, COUNT(DISTINCT user_id) AS u FROM daily, d WHERE partition_date = d0),
o AS (SELECT COUNT(*) AS r, COUNT(DISTINCT user_id) AS u FROM daily, d WHERE partition_date = d1)
SELECT d0 AS partition_0d, d1 AS partition_1d, n.r AS total_rows_0d, o.r AS total_rows_1d,
       n.r - o.r AS total_rows_diff, n.u AS total_users_0d, o.u AS total_users_1d, n.u - o.u AS total_users_diff
FROM d CROSS JOIN n CROSS JOIN o""",
    ),
)
def cross_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, d0, d1 = _newest_two(spark, sf_dir)
    counts = {"rows": F.count(F.lit(1))}
    return compare(rows, "partition_date", d0, d1, counts, {"users": "user_id"})


@query("c7_existing_keys", "SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return existing_keys(docs, table(spark, sf_dir, "labels"), ["doc_id"])


@query(
    "c7_existing_any_key",
    """
SELECT c_custkey, c_name FROM customer
WHERE c_name IN (SELECT c_name FROM customer WHERE c_mktsegment = 'BUILDING')
   OR c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""",
)
def existing_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two alternative keys, each NULL in part of the other side."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    known = customers.where("c_mktsegment = 'BUILDING'").selectExpr("CAST(NULL AS BIGINT) c_custkey", "c_name")
    buyers = table(spark, sf_dir, "orders").where("o_totalprice > 400000").selectExpr("o_custkey c_custkey", "CAST(NULL AS STRING) c_name")
    return existing_keys(customers.drop("c_mktsegment"), known.unionByName(buyers), ["c_name", "c_custkey"])


@query(
    "c8_lookup",
    """
SELECT c_custkey, n_name, r_name FROM customer
LEFT JOIN nation ON n_nationkey = c_nationkey + 4 LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_nationkey") + 4).alias("nation"))
    nations = table(spark, sf_dir, "nation").selectExpr("n_nationkey nation", "n_name", "n_regionkey region")
    regions = table(spark, sf_dir, "region").selectExpr("r_regionkey region", "r_name")
    return enrich(enrich(customers, nations, ["nation"]), regions, ["region"]).select("c_custkey", "n_name", "r_name")


# ------------------------------------------------------------------ latest per key


@query(
    "e1_latest_per_key",
    """
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) = 1""",
)
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("order_date"), "o_totalprice"
    )
    return latest_by(rows, ["o_custkey"], [F.desc_nulls_last("order_date"), F.asc("o_orderkey")])


_LINE = "l_orderkey l_suppkey l_linenumber l_quantity l_discount l_tax l_returnflag l_linestatus".split()


@query(
    "e2_dedup_two_order",
    f"""
SELECT l_partkey, CAST(l_shipdate AS DATE) AS ship_date, l_extendedprice, {', '.join(_LINE)} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey, CAST(l_shipdate AS DATE)
  ORDER BY l_extendedprice DESC NULLS LAST, {', '.join(_LINE)}) = 1""",
)
def dedup_two_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.to_date("l_shipdate").alias("ship_date"), "l_extendedprice", *_LINE
    )
    order = [F.desc_nulls_last("l_extendedprice"), *[F.asc_nulls_last(c) for c in _LINE]]
    return latest_by(rows, ["l_partkey", "ship_date"], order)


@query(
    "e3_latest_version",
    """
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id
  ORDER BY COALESCE(CASE WHEN event_type <> 'view' THEN ts END, date_trunc('day', ts)) DESC NULLS LAST, event_id DESC) = 1""",
)
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest version per user; a view carries only its day."""
    exact = F.when(F.col("event_type") != "view", F.col("ts"))
    moment = F.coalesce(exact, F.to_date("ts").cast("timestamp_ntz"))
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", moment.alias("moment"))
    return latest_by(rows, ["user_id"], [F.desc_nulls_last("moment"), F.desc("event_id")]).drop("moment")


cte(
    "shards",
    """
SELECT 'ledger' AS dataset_id, event_type || '_' || strftime(ts, '%Y%m%d') AS table_id,
       epoch_ms(date_trunc('hour', min(ts))) AS creation_time, epoch_ms(date_trunc('hour', max(ts))) AS last_modified_time,
       COUNT(*) AS row_count, CAST(SUM(event_id) AS BIGINT) * 10 AS size_bytes
FROM events GROUP BY event_type, strftime(ts, '%Y%m%d')
UNION ALL
SELECT 'budget_values', 'budget_' || strftime(o_orderdate, '%Y%m'),
       epoch_ms(min(o_orderdate)), epoch_ms(max(o_orderdate)), COUNT(*), CAST(SUM(o_orderkey) AS BIGINT)
FROM orders GROUP BY strftime(o_orderdate, '%Y%m')
UNION ALL
SELECT 'ledger', 'temp_cursors', epoch_ms(date_trunc('day', min(ts))), epoch_ms(date_trunc('day', max(ts))),
       COUNT(DISTINCT user_id), CAST(COUNT(*) AS BIGINT) FROM events
""",
)


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table statistics: a daily shard per event type, a monthly one per order month."""
    events, orders = table(spark, sf_dir, "events"), table(spark, sf_dir, "orders")
    utc = "timestamp_ntz'1970-01-01'"

    def millis(expr: str):
        return F.expr(f"timestampdiff(MILLISECOND, {utc}, {expr})")

    def stats(df: DataFrame, dataset: str, table_id, unit: str, ts: str, rows, size) -> DataFrame:
        return df.groupBy(table_id.alias("table_id")).agg(
            millis(f"date_trunc('{unit}', min({ts}))").alias("creation_time"),
            millis(f"date_trunc('{unit}', max({ts}))").alias("last_modified_time"),
            rows.alias("row_count"),
            size.cast("bigint").alias("size_bytes"),
        ).select(F.lit(dataset).alias("dataset_id"), "*")

    count = F.count(F.lit(1))
    per_day = F.concat_ws("_", "event_type", F.date_format("ts", "yyyyMMdd"))
    per_month = F.concat(F.lit("budget_"), F.date_format("o_orderdate", "yyyyMM"))
    return (
        stats(events, "ledger", per_day, "HOUR", "ts", count, F.sum("event_id") * 10)
        .unionByName(stats(orders, "budget_values", per_month, "DAY", "o_orderdate", count, F.sum("o_orderkey")))
        .unionByName(
            stats(events, "ledger", F.lit("temp_cursors"), "DAY", "ts", F.count_distinct("user_id"), count)
        )
    )


cte(
    "newest_shards",
    r"""
SELECT * EXCLUDE (family) FROM (
  SELECT *, CASE WHEN table_id ~ '.*[0-9]{8}' THEN left(table_id, -8) END AS family FROM shards WHERE dataset_id = 'ledger'
  UNION ALL
  SELECT *, CASE WHEN table_id ~ '.*[0-9]{6}' THEN left(table_id, -6) END FROM shards WHERE dataset_id <> 'ledger')
QUALIFY table_id = max(table_id) OVER (PARTITION BY dataset_id = 'ledger', family)
""",
    "shards",
)


@query("e4_latest_shard", with_("newest_shards", "SELECT * FROM newest_shards"))
def latest_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_shards(shards(spark, sf_dir))


_SUFFIX_SQL = """CASE WHEN table_id IN ('temp_cursors') THEN NULL
  WHEN dataset_id = 'ledger' THEN right(table_id, 8) ELSE right(table_id, 6) END"""


@query(
    "f1_status_order",
    with_("shards", f"SELECT {_SUFFIX_SQL} AS partition_date, table_id, row_count FROM shards ORDER BY 1 DESC NULLS LAST, 2"),
)
def status_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, daily_set = F.col("table_id"), F.col("dataset_id") == "ledger"
    suffix = F.when(t != "temp_cursors", F.when(daily_set, F.substring(t, -8, 8)).otherwise(F.substring(t, -6, 6)))
    rows = shards(spark, sf_dir).select(suffix.alias("partition_date"), "table_id", "row_count")
    return rows.orderBy(F.desc_nulls_last("partition_date"), F.asc_nulls_first("table_id"))


def status_sql(size: str) -> str:
    return with_(
        "newest_shards",
        f"""
SELECT {_SUFFIX_SQL} AS partition_date, table_id,
       strftime(make_timestamp(creation_time * 1000), '%Y-%m-%d %H:%M:%S') AS creation_time,
       strftime(make_timestamp(last_modified_time * 1000), '%Y-%m-%d %H:%M:%S') AS last_modified_time,
       row_count, {size} AS table_size
FROM newest_shards ORDER BY 1 DESC NULLS LAST, 2""",
    )


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_status(shards(spark, sf_dir))


# ------------------------------------------------------------------ unions and feed


@query("d5_actual_by_category", with_("actual", "SELECT * FROM actual"))
def actual_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_actuals(spark, sf_dir, budget(spark, sf_dir))


@query("d6_budget_by_category", with_("budget_total", "SELECT * FROM budget_total"))
def budget_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget_totals(budget(spark, sf_dir))


@query("d7_balance_rows", with_("balance", "SELECT * FROM balance"))
def d7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance_rows(budget_lines(spark, sf_dir))


@query("g1_with_balance", with_("lines balance", "SELECT * FROM lines UNION ALL SELECT * FROM balance"))
def g1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_balance(budget_lines(spark, sf_dir))


cte(
    "four_shapes",
    "\nUNION ALL\n".join(
        [
            mart_rows(
                "lines", "TRANSACTIONS_AGG", partition_date="DATE '2001-08-01'",
                **{n: n for n in "transaction_date transaction_month budget_amount transactions_count actual_amount category subcategory detail_category".split()},
            ),
            mart_rows(
                "tx", "TRANSACTIONS", partition_date="transaction_date", transaction_date="transaction_date",
                transaction_month="transaction_month", transaction_id="transaction_id", account_id="account_id",
                actual_amount="amount * -1", category_raw="category_raw",
            ),
            mart_rows(
                "customer", "ACCOUNTS", account_id="c_custkey", account_name="c_name",
                account_type="c_mktsegment", actual_amount="c_acctbal",
            ),
            mart_rows(
                "lineitem", "INVESTMENTS", partition_date="l_shipdate", transaction_id="l_partkey",
                account_id="l_suppkey", actual_amount="l_extendedprice", quantity="l_quantity",
            ),
        ]
    ),
    "lines",
    "tx",
)


@query("g2_metric_union", with_("four_shapes", "SELECT * FROM four_shapes"))
def four_way_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = budget_lines(spark, sf_dir).withColumn("partition_date", F.lit("2001-08-01").cast("date"))
    details = tx(spark, sf_dir).withColumns(
        {"partition_date": F.col("transaction_date"), "actual_amount": F.col("amount") * -1}
    )
    accounts = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey account_id", "c_name account_name", "c_mktsegment account_type", "c_acctbal actual_amount"
    )
    held = table(spark, sf_dir, "lineitem").selectExpr(
        "l_shipdate partition_date", "l_partkey transaction_id", "l_suppkey account_id",
        "l_extendedprice actual_amount", "l_quantity quantity",
    )
    return metric_union(
        {"TRANSACTIONS_AGG": lines, "TRANSACTIONS": details, "ACCOUNTS": accounts, "INVESTMENTS": held}
    )


@query(
    "g3_cursor_merge",
    with_(
        "daily",
        """
, n AS (SELECT user_id, max(event_id) AS next_cursor FROM daily WHERE partition_date = (SELECT max(partition_date) FROM daily) GROUP BY 1),
p AS (SELECT user_id, max(event_id) AS next_cursor FROM daily WHERE partition_date < (SELECT max(partition_date) FROM daily) GROUP BY 1)
SELECT 'item-' || user_id AS item_id, 'c' || next_cursor AS next_cursor FROM n
UNION ALL
SELECT 'item-' || p.user_id, 'c' || p.next_cursor FROM p LEFT JOIN n USING (user_id) WHERE n.user_id IS NULL""",
    ),
)
def cursor_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily(spark, sf_dir)
    day = F.col("partition_date")
    newest = rows.agg(F.max("partition_date")).scalar()

    def last(df: DataFrame) -> DataFrame:
        return df.groupBy("user_id").agg(F.max("event_id").alias("c")).select(
            F.concat(F.lit("item-"), "user_id").alias("item_id"), F.concat(F.lit("c"), "c").alias("next_cursor")
        )

    return merge_cursors(last(rows.where(day == newest)), last(rows.where(day < newest)))


@query(
    "i2_current_view",
    with_(
        "daily",
        """
, gone AS (SELECT user_id, min(partition_date) AS first_removed FROM daily WHERE event_type = 'error' AND value > 30 GROUP BY 1)
SELECT v.user_id, v.event_id, CASE v.event_type WHEN 'click' THEN 'MODIFIED' ELSE 'ADDED' END AS status, v.value
FROM daily v LEFT JOIN gone g USING (user_id)
WHERE v.event_type <> 'error' AND (g.user_id IS NULL OR g.first_removed < v.partition_date)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1""",
    ),
)
def feed_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily(spark, sf_dir)
    kind = F.col("event_type")
    status = F.when(kind == "click", "MODIFIED").otherwise("ADDED").alias("status")
    versions = rows.where(kind != "error").select("user_id", "event_id", "ts", "partition_date", status, "value")
    gone = rows.where((kind == "error") & (F.col("value") > 30)).selectExpr("user_id", "partition_date date_removed")
    order = [F.desc_nulls_last("ts"), F.desc("event_id")]
    live = current_view(versions, gone, "user_id", ("user_id",), "partition_date", order)
    return live.select("user_id", "event_id", "status", "value")


@query(
    "i2_same_day_versions",
    """
SELECT 'tx-' || o_custkey AS transaction_id, arg_max(o_totalprice, o_orderkey) AS amount,
       max(o_orderkey) AS feed_page
FROM orders GROUP BY o_custkey""",
)
def same_day_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modifications of one day without a clock time: the one that came last in the feed counts."""
    day, none = F.lit("2001-08-01").cast("date"), F.lit(None)
    item, account = F.lit("item").alias("item_id"), F.lit("account").alias("account_id")
    name = F.concat(F.lit("tx-"), "o_custkey").alias("transaction_id")
    versions = table(spark, sf_dir, "orders").select(
        item, account, name, day.alias("partition_date"), F.lit("MODIFIED").alias("status"),
        day.alias("transaction_date"), none.cast("timestamp_ntz").alias("transaction_datetime"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderkey").alias("feed_page"),
        F.lit(0).cast("bigint").alias("feed_place"),
    )
    none_removed = versions.where("false").selectExpr("item_id", "account_id", "transaction_id", "partition_date date_removed")
    return current_view(versions, none_removed).select("transaction_id", "amount", "feed_page")
