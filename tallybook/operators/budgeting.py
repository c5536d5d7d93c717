"""Budget against actual spending."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.numbers import money_sum

# Categories left out of the comparison, and the roll-up row's name.
UNBUDGETED = ["Transfer", "Exclude"]
BALANCE = "Balance"
KEYS = ["transaction_month", "category", "subcategory"]


def categorize(tx: DataFrame, budget: DataFrame) -> DataFrame:
    """Look up the budget category of each transaction for its month.

    ``tx`` carries category_updated, subcategory_updated and transaction_month.
    """
    lookup = budget.select(
        F.col("category_raw").alias("category_updated"),
        F.col("subcategory_raw").alias("subcategory_updated"),
        "transaction_month",
        "category",
        "subcategory",
        "detail_category",
    )
    return tx.join(
        lookup, ["category_updated", "subcategory_updated", "transaction_month"], "left"
    )


def actuals(tx: DataFrame, unique: bool = False) -> DataFrame:
    """Spending by category and month.  ``unique`` says that no transaction id occurs twice, so
    that rows can be counted on the map side and ids needn't be shuffled."""
    ids = F.count("transaction_id") if unique else F.count_distinct("transaction_id")
    return tx.groupBy(*KEYS, "detail_category").agg(
        money_sum(F.col("actual_amount")).alias("actual_amount"), ids.alias("transactions_count")
    )


def budget_totals(budget: DataFrame) -> DataFrame:
    return budget.groupBy(
        "transaction_month", "transaction_date", "category", "subcategory", "detail_category"
    ).agg(money_sum(F.col("budget_amount")).alias("budget_amount"))


def budget_vs_actual(
    budget: DataFrame, actual: DataFrame, unbudgeted: list[str] | None = None
) -> DataFrame:
    """Every budget line with what was spent on it, zero where nothing was.

    Only the detail level may be NULL on both sides of a match.
    """
    names = UNBUDGETED if unbudgeted is None else unbudgeted
    b = budget.where(~F.col("category").isin(names)).alias("b")
    a = actual.alias("a")
    match: Column = F.col("b.detail_category").eqNullSafe(F.col("a.detail_category"))
    for k in KEYS:
        match = match & (F.col(f"b.{k}") == F.col(f"a.{k}"))
    return b.join(a, match, "left").select(
        "b.transaction_date",
        "b.transaction_month",
        "b.category",
        "b.subcategory",
        "b.detail_category",
        "b.budget_amount",
        F.coalesce("a.actual_amount", F.lit(0.0)).alias("actual_amount"),
        F.coalesce("a.transactions_count", F.lit(0)).cast("bigint").alias("transactions_count"),
    )


def balance_rows(lines: DataFrame) -> DataFrame:
    """One roll-up row per month over all budget lines."""
    none = F.lit(None).cast("string")
    return lines.groupBy("transaction_date", "transaction_month").agg(
        money_sum(F.col("budget_amount")).alias("budget_amount"),
        money_sum(F.col("actual_amount")).alias("actual_amount"),
    ).select(
        "transaction_date",
        "transaction_month",
        F.lit(BALANCE).alias("category"),
        none.alias("subcategory"),
        none.alias("detail_category"),
        "budget_amount",
        "actual_amount",
        F.lit(0).cast("bigint").alias("transactions_count"),
    )


def with_balance(lines: DataFrame) -> DataFrame:
    return lines.unionByName(balance_rows(lines))
