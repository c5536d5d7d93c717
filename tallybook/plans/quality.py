"""Data-quality checks over the ledger's tables, and the alerts they raise.

A check is a one-row report.  ``quality_report`` returns all of them; ``long_report``
turns them into rows; ``alerts`` keeps the rows that break a rule.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.numbers import money_sum
from tallybook.operators.budgeting import BALANCE
from tallybook.operators.profile import (
    compare,
    duplicate_count,
    is_empty,
    missing_categories,
    null_profile,
    null_profile_by_partition,
    one_row,
    reconcile,
)
from tallybook.operators.shape import union_all
from tallybook.plans.mart import ACCOUNTS, INVESTMENTS, TRANSACTIONS, TRANSACTIONS_AGG
from tallybook.schemas import TABLES
from tallybook.sources.pages import BANK_SOURCE
from tallybook.sources.partitions import PARTITION

Day = date | Column


def _on(df: DataFrame, day: Day) -> DataFrame:
    return df.where(F.col(PARTITION) == _lit(day))


def _lit(day: Day) -> Column:
    return day if isinstance(day, Column) else F.lit(day)


def _rows() -> Column:
    return F.count(F.lit(1))


def required_nulls(name: str, kinds: dict[str, Column] | None = None) -> dict[str, Column]:
    """Tests for the columns that a table requires, named after them.

    An empty array counts as missing; a column that several kinds of rows require is tested once.
    """
    table, asked = TABLES[name], {}
    for kind, columns in table.required.items():
        for column in columns.split():
            asked.setdefault(column, []).append(kind)
    tests = {}
    for column, wanted in asked.items():
        top = table.schema[column] if column in table.schema.names else None
        array = top is not None and isinstance(top.dataType, T.ArrayType)
        missing = is_empty(F.col(column)) if array else F.col(column).isNull()
        if "" not in wanted:
            missing = reduce(or_, [kinds[k] for k in wanted]) & missing
        tests["null_" + column.replace(".", "_")] = missing
    return tests


def _single(df: DataFrame, day: Day, name: str, total: str | None) -> DataFrame:
    report = null_profile(_on(df, day), required_nulls(name), total=total)
    return report.select(_lit(day).alias("partition_0d"), "*")


def account_check(df: DataFrame, d0: Day, d1: Day) -> DataFrame:
    return compare(
        df,
        PARTITION,
        d0,
        d1,
        counts={"accounts": _rows()},
        distinct={"items": "item_id"},
        sums={"account_value": money_sum(F.col("balance.current"))},
        nulls=required_nulls("financial_accounts", {"bank": F.col("account_source") == BANK_SOURCE}),
    )


def holding_check(df: DataFrame, d0: Day, d1: Day) -> DataFrame:
    return compare(
        df,
        PARTITION,
        d0,
        d1,
        distinct={"items": "item_id", "accounts": "account_id"},
        sums={"investment_value": money_sum(F.col("institution_value"))},
        nulls=required_nulls("investment_holdings"),
    )


def trade_check(df: DataFrame, d0: Day) -> DataFrame:
    return _single(df, d0, "investment_transactions", "total_rows")


def budget_check(df: DataFrame, d0: Day, d1: Day) -> DataFrame:
    names = TABLES["budget_values"].required[""].split()
    change = compare(
        df,
        PARTITION,
        d0,
        d1,
        counts={"rows": _rows()},
        distinct={n: n for n in names},
        sums={"budget_amount": money_sum(F.col("budget_amount"))},
    )
    return one_row(change, null_profile_by_partition(df, required_nulls("budget_values"), PARTITION))


def cursor_check(df: DataFrame, d0: Day) -> DataFrame:
    return _single(df, d0, "cursors", "total_rows")


def tombstone_check(df: DataFrame, d0: Day) -> DataFrame:
    return _single(df, d0, "removed_transactions", "total_rows")


def transaction_check(
    df: DataFrame, budget: DataFrame, d0: Day, unmapped: list[str] | None = None
) -> DataFrame:
    """``unmapped`` lists raw subcategories that the budget isn't expected to map."""
    pairs = _on(df, d0).select(
        F.col("category_info.primary").alias("category_raw"),
        F.col("category_info.detailed").alias("subcategory_raw"),
    )
    return one_row(_single(df, d0, "transactions", None), missing_categories(pairs, budget, unmapped))


def mart_check(mart: DataFrame, accounts: DataFrame, d0: Day, d1: Day, acct_day: Day) -> DataFrame:
    """``mart`` carries the day it was built as ``built_on``: its rows have dates of their own."""
    kind, amount = F.col("metric_category"), F.col("actual_amount")
    kinds = {k: kind == k for k in (ACCOUNTS, INVESTMENTS, TRANSACTIONS, TRANSACTIONS_AGG)}
    kinds["LINE"] = kinds[TRANSACTIONS_AGG] & (F.col("category") != BALANCE)
    change = compare(
        mart,
        "built_on",
        d0,
        d1,
        distinct={"metric_categories": "metric_category", "items": "item_id", "accounts": "account_id"},
        sums={
            "account_summed_value": money_sum(F.when(kind == ACCOUNTS, amount).otherwise(0.0)),
            "actual_amount": money_sum(amount),
        },
        nulls=required_nulls("metric_mart", kinds),
    )
    new = mart.where(F.col("built_on") == _lit(d0))
    dated = F.col("transaction_date").isNotNull()
    per_date = duplicate_count(
        new, ["transaction_date", "transaction_id"], dated & F.col("transaction_id").isNotNull(),
        "null_repeated_transaction_ids",
    )
    per_account = duplicate_count(
        new, ["transaction_date", "item_id", "account_id"],
        dated & F.col("item_id").isNotNull() & (kind == ACCOUNTS), "null_repeated_account_ids",
    )
    current = F.col("balance.current")
    flipped = F.when(F.col("account_type") == "credit", current * -1).otherwise(current)
    totals = reconcile(
        new.where((kind == ACCOUNTS) & (F.col(PARTITION) == _lit(d0))).select(amount.alias("amount")),
        _on(accounts, acct_day).select(flipped.alias("amount")),
        "account_value",
    ).withColumnRenamed("total_account_value_source", "total_account_value_fin_accts")
    report = one_row(change, per_date, per_account, totals)
    return report.withColumn("partition_fin_accts", _lit(acct_day))


@dataclass(frozen=True)
class Check:
    """Which alert rules apply to a report."""

    null: bool = True
    diff_excluded: tuple[str, ...] | None = None
    pct: tuple[str, ...] = ()
    empty: bool = False
    missing: bool = False


CHECKS = {
    "accounts": Check(diff_excluded=("account_value",), pct=("account_value",)),
    "holdings": Check(diff_excluded=("investment_value",), pct=("investment_value",)),
    "trades": Check(empty=True),
    "budget": Check(diff_excluded=("budget_amount",)),
    "tombstones": Check(empty=True),
    "transactions": Check(missing=True),
    "cursors": Check(empty=True),
    "mart": Check(
        diff_excluded=("account_summed_value", "actual_amount"),
        pct=("account_summed_value", "actual_amount"),
    ),
}


def stored_days(tables: dict[str, DataFrame]) -> dict[str, tuple[date, ...]]:
    """Partitions of each table, the newest first, from one job over all of them.

    A table has one row per partition here, and reports get their days as literals.
    """
    found = union_all(
        *[
            df.select(F.lit(name).alias("name"), F.col("built_on" if name == "mart" else PARTITION).alias("day"))
            .where("day IS NOT NULL")
            .distinct()
            for name, df in tables.items()
        ]
    )
    days: dict[str, list[date]] = {name: [] for name in tables}
    for row in found.collect():
        days[row["name"]].append(row["day"])
    return {name: tuple(sorted(found, reverse=True)) for name, found in days.items()}


def quality_report(
    tables: dict[str, DataFrame],
    days: dict[str, tuple[Day, ...]] | None = None,
    unmapped: list[str] | None = None,
) -> dict[str, DataFrame]:
    """One-row reports per check, for the tables that are given.

    ``days`` fixes the partitions of all checks, the newest first; without it one job finds them.
    """
    days = stored_days(tables) if days is None else days
    out: dict[str, DataFrame] = {}

    def pick(name: str, n: int) -> tuple[Day, ...]:
        if len(days[name]) < n:
            raise ValueError(f"fewer than {n} partitions for the check of {name}")
        return days[name][:n]

    if "accounts" in tables:
        out["accounts"] = account_check(tables["accounts"], *pick("accounts", 2))
    if "holdings" in tables:
        out["holdings"] = holding_check(tables["holdings"], *pick("holdings", 2))
    if "trades" in tables:
        out["trades"] = trade_check(tables["trades"], *pick("trades", 1))
    if "budget" in tables:
        out["budget"] = budget_check(tables["budget"], *pick("budget", 2))
    if "tombstones" in tables:
        out["tombstones"] = tombstone_check(tables["tombstones"], *pick("tombstones", 1))
    if "transactions" in tables:
        out["transactions"] = transaction_check(
            tables["transactions"], tables["budget"], *pick("transactions", 1), unmapped
        )
    if "cursors" in tables:
        out["cursors"] = cursor_check(tables["cursors"], *pick("cursors", 1))
    if "mart" in tables:
        out["mart"] = mart_check(
            tables["mart"], tables["accounts"], *pick("mart", 2), *pick("accounts", 1)
        )
    return out


# columns of a report that are no metric
_DAYS = ("partition_0d", "partition_1d")
_TEXT = ("partitions_null", "missing_categories")
_OTHER = (*_DAYS, *_TEXT, "partition_fin_accts")


def _head(name: str, report: DataFrame) -> list[str]:
    """The check's name, its partitions and its text, as SQL."""
    have = report.columns
    days = [f"CAST({d if d in have else 'NULL'} AS DATE) AS {d}" for d in _DAYS]
    text = next((t for t in _TEXT if t in have), "CAST(NULL AS STRING)")
    return [f"'{name}' AS check", *days, f"{text} AS detail"]


def long_report(reports: dict[str, DataFrame]) -> DataFrame:
    """(check, partition_0d, partition_1d, detail, metric, value): a row per metric."""
    rows = []
    for name, report in reports.items():
        metrics = [c for c in report.columns if c not in _OTHER]
        typed = report.selectExpr(
            *_head(name, report), *[f"CAST({m} AS DOUBLE) AS {m}" for m in metrics]
        )
        rows.append(typed.unpivot(["check", *_DAYS, "detail"], metrics, "metric", "value"))
    return union_all(*rows)


def _alert_rules(
    spec: Check, columns: list[str], zero: float, pct: float, signed: bool
) -> list[tuple[str, str, float, list[str], dict[str, str]]]:
    """(rule, comparison, threshold, metrics shown, SQL of each metric's share of the total)."""
    totals = [c for c in columns if c.startswith("total_")]
    rules = []
    if spec.null:
        shown = [c for c in columns if c.startswith("null_")]
        rules.append(("null", "<>", zero, shown, {c: c for c in shown}))
    if spec.diff_excluded is not None:
        shown = [c for c in totals if not any(x in c for x in spec.diff_excluded)]
        diffs = [c for c in shown if "diff" in c]
        rules.append(("diff", "<>", zero, shown, {c: c if signed else f"abs({c})" for c in diffs}))
    for metric in spec.pct:
        shown = [c for c in totals if metric in c]
        change = f"total_{metric}_pct_chg_abs"
        rules.append((f"pct {metric}", ">", pct, shown, {change: change}))
    if spec.empty:
        rules.append(("empty", "=", zero, ["total_rows"], {"total_rows": "total_rows"}))
    if spec.missing:
        count = "missing_categories_count"
        rules.append(("missing", ">", zero, [count], {count: count}))
    return rules


def alerts(
    reports: dict[str, DataFrame],
    zero: float = 0,
    pct: float = 10,
    signed: bool = False,
    checks: dict[str, Check] | None = None,
) -> DataFrame:
    """Rows of the reports that raise an alert.

    null     the null counts of a check do not add up to ``zero``
    diff     the count differences do not (absolute ones; ``signed`` lets them cancel)
    pct      a value changed by more than ``pct`` percent
    empty    the partition has no rows
    missing  the budget lacks categories in use

    An alert carries the metrics that make it up and the compared value in ``total``; a
    NULL metric adds nothing.  Each report is computed once: its row is turned into one
    row per rule and metric, and the totals are added up over those.
    """
    checks = checks or CHECKS
    rows = []
    for name, report in reports.items():
        cells = []
        for rule, op, threshold, shown, shares in _alert_rules(
            checks[name], report.columns, zero, pct, signed
        ):
            for m in shown:
                share = f"CAST({shares[m]} AS DOUBLE)" if m in shares else "CAST(NULL AS DOUBLE)"
                cells.append(
                    f"struct('{rule}' AS rule, '{op}' AS op, CAST({threshold} AS DOUBLE) AS threshold, "
                    f"'{m}' AS metric, CAST({m} AS DOUBLE) AS value, {share} AS share)"
                )
        rows.append(report.selectExpr(*_head(name, report), f"inline(array({', '.join(cells)}))"))
    cells = union_all(*rows)
    total = F.sum("share").over(Window.partitionBy("check", "rule"))
    # an empty sum compares as zero, except for a change that could not be computed
    seen = F.when(F.col("rule").startswith("pct"), total).otherwise(F.coalesce(total, F.lit(0.0)))
    op, threshold = F.col("op"), F.col("threshold")
    fires = (
        F.when(op == "<>", F.col("total") != threshold)
        .when(op == ">", F.col("total") > threshold)
        .otherwise(F.col("total") == threshold)
    )
    return (
        cells.withColumn("total", seen)
        .where(fires)
        .select(
            "check",
            F.split_part("rule", F.lit(" "), F.lit(1)).alias("rule"),
            *_DAYS,
            "detail",
            "total",
            "threshold",
            "metric",
            "value",
        )
    )
