"""K: the whole pipelines."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators.shape import union_all
from tallybook.plans.mart import build_mart, stored_positions, write_mart
from tallybook.plans.pipelines import Ledger, accounts_snapshot, load_transactions, run_status
from tallybook.plans.quality import alerts, long_report, quality_report
from tallybook.schemas import MART, TABLES
from tallybook.session import new_scratch_table, stage
from tallybook.sources.partitions import scan
from tallybook.streaming import feed
import workload.mart  # noqa: F401  (defines the mart's CTEs)
from workload.columns import size_sql
from workload.ingest import (
    account_pages,
    flat_accounts,
    institutions,
    supplier_balances,
    sync_pages,
)
from workload.ledger_rules import RULES, UNMAPPED
from workload.registry import query
from workload.relations import status, status_sql
from workload.tables import (
    AS_OF,
    CTES,
    DAY_BEFORE,
    cte,
    l_accounts,
    l_budget,
    l_cursors,
    l_holdings,
    l_removed,
    l_trades,
    l_transactions,
    ledger,
    with_,
)


@query(
    "k1_accounts_snapshot",
    with_(
        "page_accounts valued",
        """
SELECT *, 'background' AS update_type, '2025-03-04 05:06:07' AS consent FROM page_accounts
UNION ALL BY NAME
SELECT item_id, account_name, 'investment' AS account_type, 'cryptocurrency' AS account_subtype,
       'CRYPTO' AS account_source, current_balance, 'USD' AS currency_code, 0 AS n_products, 0 AS n_billed
FROM valued""",
    ),
)
def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    balances, rates = supplier_balances(spark, sf_dir)
    pages = account_pages(spark, sf_dir)
    return flat_accounts(accounts_snapshot(pages, institutions(spark, sf_dir), balances, rates))


cte(
    "numbered_pages",
    """
SELECT 'item-' || (o_custkey % 40) AS item_id, 'cursor-' || o_orderkey AS next_cursor, o_orderkey, o_orderstatus,
       row_number() OVER (PARTITION BY o_custkey % 40 ORDER BY o_orderkey) AS page
FROM orders""",
)


@query(
    "k3_missing_pages",
    with_(
        "numbered_pages",
        """
, lost AS (SELECT item_id FROM numbered_pages GROUP BY item_id HAVING max(page) > 5 AND right(item_id, 1) = '3')
SELECT 'transactions' AS kind, 'tx-' || o_orderkey AS id, CAST(NULL AS VARCHAR) AS detail FROM numbered_pages
WHERE o_orderstatus <> 'P' AND item_id NOT IN (FROM lost)
UNION ALL
SELECT 'tombstones', 'tx-' || o_orderkey, NULL FROM numbered_pages WHERE o_orderstatus = 'P' AND item_id NOT IN (FROM lost)
UNION ALL
SELECT 'cursors', item_id, CASE WHEN item_id IN (FROM lost) THEN 'old' ELSE arg_max(next_cursor, page) END
FROM numbered_pages GROUP BY item_id
UNION ALL
SELECT 'missing', item_id, '4-5' FROM lost""",
    ),
)
def feed_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's load where pages 4 and 5 of some items are lost and others landed twice."""
    store = Ledger(spark, new_scratch_table(spark, "ledger"))
    day, before = date(2001, 8, 1), date(2001, 7, 31)
    pages = stage(sync_pages(spark, sf_dir), "pages")
    lost = F.endswith("item_id", F.lit("3")) & F.col("page").isin(4, 5)
    items = pages.select("item_id").distinct()
    store.load("cursors", items.withColumn("next_cursor", F.lit("old")), partition=before)
    load_transactions(store, pages.where(~lost).unionAll(pages.where("page % 50 = 1")), day)
    none = F.lit(None).cast("string").alias("detail")
    span = F.concat_ws("-", "first_page", "last_page").alias("detail")
    return union_all(
        store.read("transactions", day).select(F.lit("transactions").alias("kind"), F.col("transaction_id").alias("id"), none),
        store.read("removed_transactions", day).select(F.lit("tombstones").alias("kind"), F.col("transaction_id").alias("id"), none),
        store.read("cursors", day).select(F.lit("cursors").alias("kind"), F.col("item_id").alias("id"), F.col("next_cursor").alias("detail")),
        store.read("missing_pages", day).select(F.lit("missing").alias("kind"), F.col("item_id").alias("id"), span),
    )


@query(
    "i2_compacted_view",
    with_(
        "numbered_pages",
        """
, v AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, CASE o_orderstatus WHEN 'F' THEN 'MODIFIED' ELSE 'ADDED' END AS status,
         o_totalprice AS amount, o_orderkey % 4 AS batch, page
  FROM orders JOIN (SELECT o_orderkey, page FROM numbered_pages) USING (o_orderkey) WHERE o_orderstatus <> 'P'),
gone AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE) + 3) AS first FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT 'tx-' || o_custkey AS transaction_id, day AS transaction_date, status, amount
FROM v LEFT JOIN gone USING (o_custkey) WHERE first IS NULL OR first < day
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY day DESC, status DESC, batch DESC, page DESC) = 1""",
    ),
)
def compacted_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages arrive in four batches, out of order; two bases are made and the older batches deleted."""
    dst = new_scratch_table(spark, "feed")
    landed_on = F.date_add(F.to_date("o_orderdate"), 3)
    pages = stage(sync_pages(spark, sf_dir, "o_custkey", partition_date=landed_on, batch=F.col("o_orderkey") % 4), "pages")
    for batch in range(4):
        feed.apply_batch(pages.where(F.col("batch") == batch).drop("batch"), batch, dst)
        if batch in (1, 2):
            feed.compact(spark, dst)
    feed.clean(spark, dst, keep=1)
    return feed.current(spark, dst).select("transaction_id", "transaction_date", "status", "amount")


@query("k5_metric_mart", with_("mart", "SELECT * FROM mart"))
def metric_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_mart(ledger(spark, sf_dir), date.fromisoformat(AS_OF), RULES)


def stored_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marts of two days, stored as two partitions; both take the positions from one store."""
    root, tables = new_scratch_table(spark, "mart"), ledger(spark, sf_dir)
    held = stored_positions(tables, RULES)
    for day in (AS_OF, DAY_BEFORE):
        write_mart(tables, date.fromisoformat(day), root, rules=RULES, held=held)
    return scan(spark, root, MART, col="built_on")


def reports(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = {
        "accounts": l_accounts(spark, sf_dir),
        "holdings": l_holdings(spark, sf_dir),
        "trades": l_trades(spark, sf_dir),
        "budget": l_budget(spark, sf_dir),
        "tombstones": l_removed(spark, sf_dir),
        "transactions": l_transactions(spark, sf_dir),
        "cursors": l_cursors(spark, sf_dir),
        "mart": stored_marts(spark, sf_dir),
    }
    return quality_report(tables, unmapped=UNMAPPED)


# ------------------------------------------------------------- reports as SQL

def _count_if(test: str, name: str) -> str:
    return f"COUNT(*) FILTER ({test}) AS {name}"


def _nulls(table: str, kinds: dict[str, str] | None = None, names: dict[str, str] | None = None) -> str:
    """Counts of missing values of the columns that a table requires.

    ``kinds`` has the SQL of each kind of row, ``names`` what a column is called in the flat
    tables, or how its absence is told there.
    """
    kinds, names, asked = kinds or {}, names or {}, {}
    for kind, columns in TABLES[table].required.items():
        for column in columns.split():
            asked.setdefault(column, []).append(kind)
    out = []
    for column, wanted in asked.items():
        flat = names.get(column, column.rsplit(".", 1)[-1] if column.startswith("balance") else column)
        test = flat if " " in flat else f"{flat} IS NULL"
        rows = "" if "" in wanted else "(" + " OR ".join(kinds[k] for k in wanted) + ") AND "
        out.append(_count_if(f"{rows}{test}", "null_" + column.replace(".", "_")))
    return ", ".join(out)


def _sum(x: str) -> str:
    return f"CAST(SUM(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,10))) AS DOUBLE)"


def _counts(n: str) -> str:
    return f"a.{n} AS total_{n}_0d, b.{n} AS total_{n}_1d, a.{n} - b.{n} AS total_{n}_diff"


def _change(n: str) -> str:
    pct = f"(a.{n} - b.{n}) / NULLIF(abs(b.{n}), 0) * 100"
    return (
        f"round(a.{n}, 2) AS total_{n}_0d, round(b.{n}, 2) AS total_{n}_1d, "
        f"round({pct}, 2) AS total_{n}_pct_chg, round(abs({pct}), 2) AS total_{n}_pct_chg_abs"
    )


def two_days(source: str, nulls: str, counts: dict[str, str], sums: dict[str, str], col: str = "partition_date") -> str:
    measures = ", ".join(f"{x} AS {n}" for n, x in (counts | sums).items())
    null_names = [p.rsplit(" AS ", 1)[1] for p in nulls.split(", COUNT")] if nulls else []
    picked = "".join(f"a.{n}, " for n in null_names)
    head = f"{nulls}, " if nulls else ""
    out = ", ".join([*map(_counts, counts), *map(_change, sums)])
    return f"""
SELECT d.d0 AS partition_0d, d.d1 AS partition_1d, {picked}{out}
FROM (SELECT max({col}) AS d0, (SELECT max({col}) FROM {source} WHERE {col} < (SELECT max({col}) FROM {source})) AS d1 FROM {source}) d,
     (SELECT {head}{measures} FROM {source} WHERE {col} = (SELECT max({col}) FROM {source})) a,
     (SELECT {measures} FROM {source} WHERE {col} = (SELECT max({col}) FROM {source} WHERE {col} < (SELECT max({col}) FROM {source}))) b"""


def one_day(source: str, nulls: str, total: bool = True) -> str:
    rows = ", COUNT(*) AS total_rows" if total else ""
    newest = f"(SELECT max(partition_date) FROM {source})"
    return f"SELECT {newest} AS partition_0d, {nulls}{rows} FROM {source} WHERE partition_date = {newest}"


cte(
    "r_accounts",
    two_days(
        "l_accounts",
        _nulls(
            "financial_accounts",
            {"bank": "account_source = 'BANK'"},
            {"balance.current": "current_balance", "products": "NOT has_products", "billed_products": "NOT has_billed"},
        ),
        {"items": "COUNT(DISTINCT item_id)", "accounts": "COUNT(*)"},
        {"account_value": _sum("current_balance")},
    ),
    "l_accounts",
)
_SECURITY = {
    "security.security_id": "security_id", "security.currency_code": "security_currency",
    "security.is_cash_equivalent": "is_cash_equivalent", "security.name": "security_name",
    "security.type": "security_type",
}
cte(
    "r_holdings",
    two_days(
        "l_holdings",
        _nulls("investment_holdings", names=_SECURITY),
        {"items": "COUNT(DISTINCT item_id)", "accounts": "COUNT(DISTINCT account_id)"},
        {"investment_value": _sum("institution_value")},
    ),
    "l_holdings",
)
# columns that trades always have here are left out of the flat table
_FULL = "investment_date investment_name quantity amount price investment_subtype currency_code"
cte(
    "r_trades",
    one_day(
        "l_trades",
        _nulls(
            "investment_transactions",
            names={n: "1 = 0" for n in _FULL.split()} | {"investment_transaction_id": "trade_id"},
        ),
    ),
    "l_trades",
)
_BUDGET_NAMES = ("category_raw", "subcategory_raw", "category", "subcategory")
cte(
    "r_budget",
    f"""
SELECT * FROM ({two_days("l_budget", "", {n: f"COUNT(DISTINCT {n})" for n in _BUDGET_NAMES} | {"rows": "COUNT(*)"}, {"budget_amount": _sum("budget_amount")})}),
  (SELECT {", ".join(_count_if(f"{n} IS NULL", f"null_{n}") for n in _BUDGET_NAMES)},
     string_agg(DISTINCT CASE WHEN {" OR ".join(f"{n} IS NULL" for n in _BUDGET_NAMES)} THEN CAST(partition_date AS VARCHAR) END, '; ') AS partitions_null
   FROM l_budget)""",
    "l_budget",
)
cte("r_tombstones", one_day("l_removed", _nulls("removed_transactions")), "l_removed")
cte("r_cursors", one_day("l_cursors", _nulls("cursors")), "l_cursors")
_CATEGORY = {
    "category_info.primary": "category_raw", "category_info.detailed": "subcategory_raw",
    "category_info.confidence_level": "confidence_level", "merchant.name": "name_raw",
}
cte(
    "r_transactions",
    f"""
SELECT * FROM ({one_day("l_transactions", _nulls("transactions", names=_CATEGORY), False)}),
  (SELECT string_agg(x, '; ' ORDER BY x) AS missing_categories, COUNT(DISTINCT x) AS missing_categories_count
   FROM (SELECT DISTINCT t.category_raw || ' - ' || t.subcategory_raw AS x
         FROM l_transactions t LEFT JOIN l_budget b USING (category_raw, subcategory_raw)
         WHERE b.category IS NULL AND t.partition_date = (SELECT max(partition_date) FROM l_transactions)
           AND t.subcategory_raw NOT IN ({', '.join(map(repr, UNMAPPED))})))""",
    "l_transactions",
    "l_budget",
)


def _rename(sql: str, names: list[str], suffix: str) -> str:
    return re.sub(r"\b(" + "|".join(sorted(names, key=len, reverse=True)) + r")\b", rf"\1{suffix}", sql)


# the mart of the day before: same CTEs under other names
_DATED = ["clock", "m_versions", "m_labelled", "m_tx", "m_actual", "m_lines", "m_agg", "mart"]
for _name in _DATED:
    _needs, _sql = CTES[_name]
    _old = _sql.replace(AS_OF, DAY_BEFORE) if _name == "clock" else _rename(_sql, _DATED, "_1d")
    cte(f"{_name}_1d", _old, *[f"{n}_1d" if n in _DATED else n for n in _needs])
cte(
    "marts",
    "SELECT *, (SELECT as_of FROM clock) AS built_on FROM mart UNION ALL SELECT *, (SELECT as_of FROM clock_1d) FROM mart_1d",
    "mart",
    "mart_1d",
    "clock",
    "clock_1d",
)
_MART_NULLS = _nulls(
    "metric_mart",
    {k: f"metric_category = '{k}'" for k in ("ACCOUNTS", "INVESTMENTS", "TRANSACTIONS", "TRANSACTIONS_AGG")}
    | {"LINE": "metric_category = 'TRANSACTIONS_AGG' AND category <> 'Balance'"},
)
_ACCOUNT_AMOUNT = "CASE WHEN metric_category = 'ACCOUNTS' THEN actual_amount ELSE 0 END"
cte(
    "r_mart",
    f"""
SELECT * FROM ({two_days("marts", _MART_NULLS, {
        "metric_categories": "COUNT(DISTINCT metric_category)", "items": "COUNT(DISTINCT item_id)",
        "accounts": "COUNT(DISTINCT account_id)"},
        {"account_summed_value": _sum(_ACCOUNT_AMOUNT), "actual_amount": _sum("actual_amount")}, "built_on")}),
  (SELECT COUNT(*) AS null_repeated_transaction_ids FROM (
     SELECT 1 FROM mart WHERE transaction_date IS NOT NULL AND transaction_id IS NOT NULL
     GROUP BY transaction_date || ' - ' || transaction_id HAVING COUNT(*) > 1)),
  (SELECT COUNT(*) AS null_repeated_account_ids FROM (
     SELECT 1 FROM mart WHERE transaction_date IS NOT NULL AND item_id IS NOT NULL AND metric_category = 'ACCOUNTS'
     GROUP BY transaction_date || ' - ' || item_id || CASE WHEN account_id IS NULL THEN '' ELSE ' - ' || account_id END
     HAVING COUNT(*) > 1)),
  (SELECT round(x, 2) AS total_account_value_0d, round(y, 2) AS total_account_value_fin_accts,
          round(x - y, 2) AS total_account_value_diff
   FROM (SELECT {_sum("actual_amount")} AS x FROM mart, clock WHERE metric_category = 'ACCOUNTS' AND partition_date = clock.as_of),
        (SELECT {_sum("CASE WHEN account_type = 'credit' THEN -current_balance ELSE current_balance END")} AS y
         FROM l_accounts WHERE partition_date = (SELECT max(partition_date) FROM l_accounts)))""",
    "marts",
    "mart",
    "clock",
    "l_accounts",
)

_REPORTS = ("accounts", "holdings", "trades", "budget", "tombstones", "transactions", "cursors", "mart")
_TWO_DAY = ("accounts", "holdings", "budget", "mart")
_DETAIL = {"budget": "partitions_null", "transactions": "missing_categories"}


def _long(name: str) -> str:
    day = "partition_1d" if name in _TWO_DAY else "CAST(NULL AS DATE)"
    detail = _DETAIL.get(name, "CAST(NULL AS VARCHAR)")
    drop = [c for c in ("partition_0d", "partition_1d", _DETAIL.get(name)) if c and (c != "partition_1d" or name in _TWO_DAY)]
    return f"""
SELECT '{name}' AS "check", _0 AS partition_0d, _1 AS partition_1d, _d AS detail, metric, value
FROM (SELECT partition_0d AS _0, {day} AS _1, {detail} AS _d,
             CAST(COLUMNS(* EXCLUDE ({', '.join(drop)})) AS DOUBLE) FROM r_{name})
UNPIVOT INCLUDE NULLS (value FOR metric IN (COLUMNS(* EXCLUDE (_0, _1, _d))))"""


cte("long_reports", "\nUNION ALL\n".join(_long(n) for n in _REPORTS), *[f"r_{n}" for n in _REPORTS])


@query("k6_quality_report", with_("long_reports", "SELECT * FROM long_reports"))
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long_report(reports(spark, sf_dir))


# (check, rule, metrics of the alert, value compared, fires, threshold)
_NULL = "starts_with(metric, 'null_')"
_RULES = [
    *[(c, "null", _NULL, f"SUM(value) FILTER ({_NULL})", "<> 0", 0) for c in _REPORTS],
    *[
        (c, "diff", f"starts_with(metric, 'total_') AND NOT ({skip})",
         f"SUM(abs(value)) FILTER (contains(metric, 'diff') AND NOT ({skip}))", "<> 0", 0)
        for c, skip in {
            "accounts": "contains(metric, 'account_value')",
            "holdings": "contains(metric, 'investment_value')",
            "budget": "contains(metric, 'budget_amount')",
            "mart": "contains(metric, 'account_summed_value') OR contains(metric, 'actual_amount')",
        }.items()
    ],
    *[
        (c, "pct", f"starts_with(metric, 'total_') AND contains(metric, '{m}')",
         f"SUM(value) FILTER (metric = 'total_{m}_pct_chg_abs')", "> 10", 10)
        for c, m in (("accounts", "account_value"), ("holdings", "investment_value"),
                     ("mart", "account_summed_value"), ("mart", "actual_amount"))
    ],
    *[(c, "empty", "metric = 'total_rows'", "SUM(value) FILTER (metric = 'total_rows')", "= 0", 0)
      for c in ("trades", "cursors", "tombstones")],
    ("transactions", "missing", "metric = 'missing_categories_count'",
     "SUM(value) FILTER (metric = 'missing_categories_count')", "> 0", 0),
]
_ALERTS = "\nUNION ALL\n".join(
    f"""
SELECT l."check", '{rule}' AS rule, partition_0d, partition_1d, detail, t.total,
       CAST({threshold} AS DOUBLE) AS threshold, metric, value
FROM long_reports l JOIN (SELECT {total} AS total FROM long_reports WHERE "check" = '{check}') t ON t.total {fires}
WHERE l."check" = '{check}' AND {metrics}"""
    for check, rule, metrics, total, fires, threshold in _RULES
)


@query("k7_alerts", with_("long_reports", _ALERTS))
def raised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts(reports(spark, sf_dir))


@query(
    "k8_ledger_status",
    with_(
        "l_removed l_budget",
        """
SELECT * FROM (
  SELECT strftime(partition_date, '%Y%m%d') AS partition_date, 'removed_transactions_' || strftime(partition_date, '%Y%m%d') AS table_id,
         COUNT(*) AS row_count FROM l_removed WHERE partition_date = (SELECT max(partition_date) FROM l_removed) GROUP BY 1, 2
  UNION ALL
  SELECT strftime(partition_date, '%Y%m'), 'budget_values_' || strftime(partition_date, '%Y%m'), COUNT(*)
  FROM l_budget WHERE partition_date = (SELECT max(partition_date) FROM l_budget) GROUP BY 1, 2
  UNION ALL
  SELECT NULL, 'temp_cursors', COUNT(DISTINCT user_id) FROM events)""",
    ),
)
def ledger_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest partition of each table of a stored ledger, from its files."""
    store = Ledger(spark, new_scratch_table(spark, "ledger"))
    store.load("removed_transactions", l_removed(spark, sf_dir))
    store.load("budget_values", l_budget(spark, sf_dir))
    store.load("temp_cursors", l_cursors(spark, sf_dir).select("item_id").distinct())
    status_rows = run_status(store, ["removed_transactions", "budget_values", "temp_cursors"])
    return status_rows.select("partition_date", "table_id", "row_count")


@query("k8_daily_status", status_sql(size_sql("size_bytes")))
def daily_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status(spark, sf_dir)
