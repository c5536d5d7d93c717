"""The metric mart: one wide table over transactions, budgets, balances and positions."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook import session
from tallybook.functions.text import category_path, first_of, title_case
from tallybook.operators.budgeting import (
    actuals,
    budget_totals,
    budget_vs_actual,
    categorize,
    with_balance,
)
from tallybook.operators.dedup import apply_tombstones, latest_by, version_order
from tallybook.operators.joins import enrich
from tallybook.operators.rules import CASE_RULES, Rule, apply_rules, resolve_name, with_rules
from tallybook.operators.shape import conform, union_all
from tallybook.schemas import MART, TABLES
from tallybook.sources.partitions import PARTITION, scan, since_year_start
from tallybook.sources.publish import publishing
from tallybook.sources.tables import partition_folder

# Metric classes and the category that is left out.
TRANSACTIONS_AGG = "TRANSACTIONS_AGG"
TRANSACTIONS = "TRANSACTIONS"
ACCOUNTS = "ACCOUNTS"
INVESTMENTS = "INVESTMENTS"
EXCLUDED = "EXCLUDE_CATEGORY"

TX_KEY = ["item_id", "account_id", "transaction_id"]


@dataclass(frozen=True)
class MartRules:
    """What is particular to one ledger: labels, categories, merchant names.  None by default."""

    account_name: list[Rule] = field(default_factory=list)
    account_subname: list[Rule] = field(default_factory=list)
    category: list[Rule] = field(default_factory=list)
    subcategory: list[Rule] = field(default_factory=list)
    merchant: list[Rule] = field(default_factory=list)
    recode: list[Rule] = field(default_factory=list)

    @classmethod
    def load(cls, path: str | Path) -> MartRules:
        return cls(**json.loads(Path(path).read_text(encoding="utf-8")))


def account_balances(accounts: DataFrame, rules: MartRules) -> DataFrame:
    """Labelled balances, one row per account and day.

    One select, so every rule sees the stored columns and not a label made here.
    """
    current = F.col("balance.current")
    titles = {"subtype_title": title_case(F.col("account_subtype"))}
    institution = F.col("institution_name")
    return accounts.select(
        PARTITION,
        "item_id",
        "account_id",
        "institution_name",
        apply_rules(rules.account_name, institution).alias("account_name"),
        apply_rules(rules.account_subname, institution, titles).alias("account_subname"),
        title_case(F.col("account_type")).alias("account_type"),
        F.col(PARTITION).alias("transaction_date"),
        F.when(F.col("account_type") == "credit", current * -1).otherwise(current).alias("actual_amount"),
        F.col("balance.currency_code").alias("currency_code"),
    )


def account_labels(balances: DataFrame) -> DataFrame:
    """The newest labels per account."""
    texts = ("account_name", "account_subname", "account_type", "institution_name")
    order = [F.col("transaction_date").desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in texts]]
    return latest_by(balances, ["item_id", "account_id"], order).select(
        "item_id", "account_id", "institution_name", "account_name", "account_subname", "account_type"
    )


def positions(
    holdings: DataFrame, keys: tuple[str, ...] = ("security_id", PARTITION)
) -> DataFrame:
    """One holding per key.  The default keys keep one per security and day over all
    accounts, and one for all holdings without a security id."""
    rows = holdings.select(
        PARTITION,
        "item_id",
        "account_id",
        F.col("security.security_id").alias("security_id"),
        "cost_basis",
        "institution_value",
        "quantity",
        "institution_price",
        "institution_price_date",
        "currency_code",
        F.col("security.type").alias("security_type"),
        F.coalesce("security.ticker_symbol", "security.name").alias("ticker_symbol"),
        F.col("security.name").alias("security_name"),
    )
    order = [
        F.col("institution_price_date").desc_nulls_last(),
        F.col("institution_value").desc_nulls_last(),
        *[
            F.col(c).asc_nulls_first()
            for c in (
                "account_id", "item_id", "quantity", "institution_price", "security_name", "security_type",
                "ticker_symbol", "currency_code", "cost_basis",
            )
        ],
    ]
    return latest_by(rows, list(keys), order)


def live_transactions(
    transactions: DataFrame, removed: DataFrame, as_of: date | Column
) -> DataFrame:
    """Settled, unremoved transactions of the last years, the newest version of each.

    Date and pending filters reach the scan; only the columns below are read.
    """
    counterparty = first_of(F.col("counterparties"))
    recent = since_year_start(transactions, "transaction_date", as_of).where(~F.col("is_pending"))
    rows = recent.select(
        PARTITION,
        *TX_KEY,
        "status",
        "transaction_date",
        "transaction_datetime",
        "amount",
        "currency_code",
        "feed_page",
        "feed_place",
        F.col("category_info.primary").alias("category_raw"),
        F.col("category_info.detailed").alias("subcategory_raw"),
        "payment_channel",
        F.col("merchant.merchant_name").alias("merchant_name_raw"),
        F.col("merchant.name").alias("name_raw"),
        counterparty["name"].alias("counterparty_name_raw"),
        counterparty["type"].alias("merchant_type"),
    )
    # one placement by transaction serves the tombstones and the choice of a version
    placed = rows.repartition("transaction_id")
    live = apply_tombstones(placed, removed.repartition("transaction_id"), TX_KEY, "transaction_date")
    return latest_by(live, ["transaction_id"], version_order())


def label_transactions(tx: DataFrame, labels: DataFrame, rules: MartRules) -> DataFrame:
    """Account labels, category rules and merchant names on live transactions."""
    joined = enrich(tx, labels, ["item_id", "account_id"])
    merchant = resolve_name(
        F.col("merchant_name_raw"),
        F.array("counterparty_name_raw"),
        rules.merchant,
        F.col("name_raw"),
    )
    made = [merchant.alias("merchant_name")]
    for name, own, raw in (
        ("category_updated", rules.category, F.col("category_raw")),
        ("subcategory_updated", rules.subcategory, F.col("subcategory_raw")),
    ):
        if len(own) > CASE_RULES:
            joined = with_rules(joined, own, raw, name)
            made.append(F.col(name))
        else:
            made.append(apply_rules(own, raw).alias(name))
    # one generated row per transaction: a filter on the outcome then stays above the
    # rules, where a projection would run them once more inside the filter
    ruled = F.struct(*made)
    return joined.select(
        PARTITION,
        *TX_KEY,
        "transaction_date",
        F.trunc("transaction_date", "MM").alias("transaction_month"),
        F.when(F.col("amount") > 0, "DEBIT").otherwise("CREDIT").alias("transaction_type"),
        (F.col("amount") * -1).alias("actual_amount"),
        "currency_code",
        "category_raw",
        "subcategory_raw",
        F.inline(F.array(ruled)),
        "payment_channel",
        "merchant_name_raw",
        "counterparty_name_raw",
        "name_raw",
        "merchant_type",
        "account_name",
        "account_subname",
        "account_type",
    )


def categorized_transactions(
    labelled: DataFrame, budget: DataFrame, rules: MartRules
) -> DataFrame:
    """Budget categories for labelled transactions; excluded and NULL categories go."""
    kept = labelled.where(F.col("category_updated") != EXCLUDED)
    out = categorize(kept, budget)
    return out.withColumn("subcategory", apply_rules(rules.recode, F.col("subcategory")))


def budget_months(budget: DataFrame) -> DataFrame:
    """Monthly budget partitions with the dates the mart reports them under."""
    month = F.trunc(PARTITION, "MM")
    return budget.select(
        month.alias("transaction_month"),
        F.col(PARTITION).alias("transaction_date"),
        "category_raw",
        "subcategory_raw",
        "category",
        "subcategory",
        "detail_category",
        "budget_amount",
    )


def metric_union(parts: dict[str, DataFrame], schema: T.StructType = MART) -> DataFrame:
    """Frames of different shapes as one table, tagged with their metric class.

    A column a class does not have is NULL of the schema's type.
    """
    return union_all(
        *[conform(df.withColumn("metric_category", F.lit(name)), schema) for name, df in parts.items()]
    )


def with_paths(df: DataFrame) -> DataFrame:
    top, sub, detail = F.col("category"), F.col("subcategory"), F.col("detail_category")
    return df.withColumns(
        {"final_category": category_path(top, sub), "full_category": category_path(top, sub, detail)}
    )


def aggregate_lines(tx: DataFrame, budget: DataFrame) -> DataFrame:
    """Budget lines with their actuals, and the monthly balance rows."""
    # the mart has made transaction ids unique: they are counted as they are
    return with_paths(with_balance(budget_vs_actual(budget_totals(budget), actuals(tx, unique=True))))


def held_positions(holdings: DataFrame, labels: DataFrame) -> DataFrame:
    """Positions with the newest labels of their account."""
    return enrich(positions(holdings), labels.drop("institution_name"), ["item_id", "account_id"])


def stored_labels(tables: dict[str, DataFrame], rules: MartRules) -> DataFrame:
    """Labels of the accounts that hold something, stored.

    They are few beside all accounts, and known to be before the join is planned: wide positions
    needn't cross a shuffle to meet them where they are small enough to be broadcast.
    """
    on = ["item_id", "account_id"]
    labels = account_labels(account_balances(tables["financial_accounts"], rules))
    holders = tables["investment_holdings"].select(*on).distinct()
    return session.stage(labels.join(holders, on, "left_semi"), "labels")


def stored_positions(tables: dict[str, DataFrame], rules: MartRules | None = None) -> DataFrame:
    """``held_positions``, stored: they are the same in the marts of all days of these tables."""
    held = held_positions(tables["investment_holdings"], stored_labels(tables, rules or MartRules()))
    return session.stage(held, "positions")


def mart_parts(
    tables: dict[str, DataFrame],
    as_of: date | Column,
    rules: MartRules,
    stage: Callable[[DataFrame], DataFrame] | None = None,
    held: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """``held`` gives positions that ``held_positions`` has made already."""
    today = as_of if isinstance(as_of, Column) else F.lit(as_of)
    balances = account_balances(tables["financial_accounts"], rules)
    labels = account_labels(balances)
    budget = budget_months(tables["budget_values"])
    live = live_transactions(tables["transactions"], tables["removed_transactions"], today)
    tx = categorized_transactions(label_transactions(live, labels, rules), budget, rules)
    if stage is not None:
        tx = stage(tx)
    held = held_positions(tables["investment_holdings"], labels) if held is None else held
    return {
        TRANSACTIONS_AGG: aggregate_lines(tx, budget).withColumn(PARTITION, today),
        TRANSACTIONS: with_paths(tx),
        ACCOUNTS: balances.withColumn("transaction_month", F.trunc("transaction_date", "MM")),
        INVESTMENTS: held.select(
            "*",
            F.col("security_id").alias("transaction_id"),
            F.col(PARTITION).alias("transaction_date"),
            F.trunc(PARTITION, "MM").alias("transaction_month"),
            F.col("institution_value").alias("actual_amount"),
        ),
    }


def build_mart(
    tables: dict[str, DataFrame],
    as_of: date | Column,
    rules: MartRules | None = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The 36-column mart at ``as_of``.

    ``tables`` holds financial_accounts, investment_holdings, transactions,
    removed_transactions and budget_values, each with ``partition_date``.  Detail and
    aggregate rows share the categorised transactions; ``stage`` may write them once
    (``session.stage``) so their shuffles and rules do not run twice.
    """
    return metric_union(mart_parts(tables, as_of, rules or MartRules(), stage))


def write_mart(
    tables: dict[str, DataFrame],
    as_of: date,
    root: str,
    day: date | None = None,
    rules: MartRules | None = None,
    held: DataFrame | None = None,
) -> DataFrame:
    """Store the mart of ``as_of`` as partition ``day`` and return the stored rows.

    ``held`` gives positions that are stored already (``stored_positions``), for marts of several days.

    Detail rows are written first, and the aggregate rows read them back (five columns of them),
    so the transaction pipeline runs once.  Both are built out of sight; the partition changes in
    one step, and a run that fails at any point leaves the old one.
    """
    rules = rules or MartRules()
    if held is None:
        held = held_positions(tables["investment_holdings"], stored_labels(tables, rules))
    parts = mart_parts(tables, as_of, rules, held=held)
    del parts[TRANSACTIONS_AGG]
    table = TABLES["metric_mart"]
    day, col, spark = day or as_of, table.partition_col, parts[ACCOUNTS].sparkSession
    with publishing(spark, f"{root}/{partition_folder(day, col)}") as path:
        conform(metric_union(parts), MART).write.option("compression", "zstd").parquet(path)
        stored = spark.read.schema(MART).parquet(path)
        lines = aggregate_lines(
            stored.where(F.col("metric_category") == TRANSACTIONS), budget_months(tables["budget_values"])
        )
        aggregate = lines.withColumn(PARTITION, F.lit(as_of))
        conform(metric_union({TRANSACTIONS_AGG: aggregate}), MART).write.mode("append").option("compression", "zstd").parquet(path)
    return scan(spark, root, MART, partition=day, col=col)
