"""The daily jobs: each reads landed pages or tables and loads one partition."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators.joins import initial_cursors, last_cursors, merge_cursors
from tallybook.operators.shape import conform, union_all
from tallybook.plans.mart import MartRules, write_mart
from tallybook.plans.quality import quality_report
from tallybook.plans.status import DAILY_DATASETS, daily_status
from tallybook.schemas import ACCOUNTS, GRAIN_FORMATS, TABLES
from tallybook.session import stage
from tallybook.sources import pages as landed
from tallybook.sources.balances import value_balances
from tallybook.sources.budget import budget_for
from tallybook.sources.partitions import (
    PARTITION,
    newest,
    retention_candidates,
    scan,
    stored_files,
    table_stats,
    window_filter,
)
from tallybook.sources.tables import (
    drop_partitions,
    list_partitions,
    partition_days,
    table_exists,
    write,
)


@dataclass(frozen=True)
class Ledger:
    """Where the tables of one ledger are stored."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, partition: date | None = None) -> DataFrame:
        t = TABLES[name]
        return scan(self.spark, self.path(name), t.schema, t.grain, partition, t.partition_col)

    def exists(self, name: str) -> bool:
        return table_exists(self.spark, self.path(name))

    def days(self, name: str) -> list[date]:
        """Partitions of a table, oldest first; none if it isn't there."""
        t = TABLES[name]
        return partition_days(self.spark, self.path(name), t.partition_col, t.grain) if self.exists(name) else []

    def load(
        self, name: str, df: DataFrame, disposition: str = "TRUNCATE", partition: date | None = None
    ) -> None:
        t = TABLES[name]
        write(df, self.path(name), t.schema, disposition, partition, t.grain, t.partition_col)


def accounts_snapshot(
    pages: DataFrame,
    institutions: DataFrame | None,
    balances: DataFrame | None = None,
    rates: DataFrame | None = None,
) -> DataFrame:
    """Bank accounts and valued token balances as one table."""
    tokens = None if balances is None else value_balances(balances, rates)
    return conform(union_all(landed.normalize_accounts(pages, institutions), tokens), ACCOUNTS)


def load_budget(ledger: Ledger, budget: DataFrame, month: date) -> None:
    """The budget of a month; any of its days names it."""
    ledger.load("budget_values", budget_for(budget, month), "TRUNCATE", month)


def load_transactions(ledger: Ledger, pages: DataFrame, day: date, first: int | None = 1) -> DataFrame:
    """Apply sync pages: versions, tombstones, and the cursor of every item.

    Returns the ranges of pages that are missing, also stored as ``missing_pages``. An item with one
    is held back as a whole: none of its pages is applied and it keeps the cursor that it had, or
    an empty one, so that the next poll gives the missing page again; the others load. A page that
    landed twice counts once; ``first`` is the number of an item's first page. A late page is
    applied by a rerun over all pages of the day: a rerun replaces the partition, also by nothing.
    Items whose pages hold only removals get their new cursor too. The landed text is parsed once;
    the tables read its columns.
    """
    pages = stage(landed.once(pages, ["item_id"], "page"), "sync-pages")
    ledger.load("missing_pages", landed.missing_pages(pages, first=first), "TRUNCATE", day)
    late = ledger.read("missing_pages", day)
    previous = initial_cursors(pages.select("item_id").distinct())
    earlier = [d for d in ledger.days("cursors") if d < day]
    if earlier:
        previous = merge_cursors(ledger.read("cursors", earlier[-1]).drop(PARTITION), previous)
    whole = landed.hold_back(pages, late)
    ledger.load("transactions", landed.normalize_transactions(whole), "TRUNCATE", day)
    ledger.load("removed_transactions", landed.normalize_tombstones(whole, day), "TRUNCATE", day)
    ledger.load("temp_cursors", last_cursors(whole))
    merged = stage(merge_cursors(ledger.read("temp_cursors"), previous), "cursors")
    ledger.load("cursors", merged, "TRUNCATE", day)
    return late.drop(PARTITION)


def load_investments(
    ledger: Ledger,
    holdings: DataFrame,
    trades: DataFrame,
    day: date,
    items: DataFrame | None = None,
    products: tuple[str, ...] = ("investments",),
    window: tuple[int, int] | None = None,
    required: dict[str, date] | None = None,
) -> DataFrame:
    """Positions and trades of a day.

    Returns the items whose pages hold fewer trades than they announce, also stored as
    ``incomplete_trades``; none of their trades is loaded. A page that landed twice counts once.
    ``required`` names partitions without which the job fails.  With ``items`` only pages of items
    that have one of the products count; ``window`` keeps trades dated that many days before
    ``day``, first and last.
    """
    if required:
        late = missing_dependencies(ledger, required).collect()  # a row a table
        if late:
            raise ValueError(f"not there or empty: {', '.join(sorted(r['table'] for r in late))}")
    if items is not None:
        wanted = landed.with_product(items, list(products)).select("item_id").distinct()
        holdings, trades = (
            p.join(wanted, p["item"]["item_id"] == wanted["item_id"], "left_semi") for p in (holdings, trades)
        )
    trades = stage(landed.trade_pages_once(trades), "trade-pages")
    ledger.load("incomplete_trades", landed.incomplete_trades(trades), "TRUNCATE", day)
    late = ledger.read("incomplete_trades", day)
    whole = landed.hold_back(trades, late, trades["item"]["item_id"])
    bought = landed.normalize_trades(whole, repeated=False)
    if window is not None:
        bought = window_filter(bought, "investment_date", day, *window)
    ledger.load("investment_holdings", landed.normalize_holdings(holdings), "TRUNCATE", day)
    ledger.load("investment_transactions", bought, "TRUNCATE", day)
    return late.drop(PARTITION)


def missing_dependencies(ledger: Ledger, required: dict[str, date]) -> DataFrame:
    """Required partitions that are absent or empty, one row per table.

    A partition may be there and empty, and a table may not be there at all.
    """
    rows = []
    for name, day in required.items():
        there = day in ledger.days(name)
        rows.append((name, day, there, there and not ledger.read(name, day).isEmpty()))
    schema = f"table string, {PARTITION} date, exists boolean, has_rows boolean"
    return ledger.spark.createDataFrame(rows, schema).where(~F.col("has_rows"))


MART_INPUTS = (
    "financial_accounts",
    "investment_holdings",
    "transactions",
    "removed_transactions",
    "budget_values",
)


def load_mart(ledger: Ledger, day: date, as_of: date, rules: MartRules | None = None) -> DataFrame:
    """Build the mart partition ``day`` from the stored tables."""
    tables = {n: ledger.read(n) for n in MART_INPUTS}
    return write_mart(tables, as_of, ledger.path("metric_mart"), day, rules)


CHECK_INPUTS = {
    "accounts": "financial_accounts",
    "holdings": "investment_holdings",
    "trades": "investment_transactions",
    "budget": "budget_values",
    "tombstones": "removed_transactions",
    "transactions": "transactions",
    "cursors": "cursors",
    "mart": "metric_mart",
}


def run_checks(ledger: Ledger, unmapped: list[str] | None = None) -> dict[str, DataFrame]:
    """Reports on the newest partitions of all stored tables, the days read off the folders.

    A partition that was loaded without rows is there too, so its check sees it empty.
    """
    days = {check: tuple(reversed(ledger.days(n))) for check, n in CHECK_INPUTS.items()}
    tables = {check: ledger.read(n) for check, n in CHECK_INPUTS.items()}
    return quality_report(tables, days, unmapped)


def ledger_stats(ledger: Ledger, names: list[str] | None = None) -> DataFrame:
    """Statistics of every partition of the stored tables, as suffixed table ids."""
    reports = []
    for name in names or [n for n in TABLES if ledger.exists(n)]:
        t, files = TABLES[name], stored_files(ledger.spark, ledger.path(name))
        if t.grain is None:
            reports.append(table_stats(ledger.read(name), files, DAILY_DATASETS[0], name))
            continue
        suffix = F.date_format(t.partition_col, GRAIN_FORMATS[t.grain])
        dataset = DAILY_DATASETS[0] if t.grain == "day" else f"{DAILY_DATASETS[0]}_{t.grain}s"
        table = F.concat_ws("_", F.lit(name), suffix)
        reports.append(table_stats(ledger.read(name), files, dataset, table, t.partition_col))
    return union_all(*reports)


def run_status(ledger: Ledger, names: list[str] | None = None) -> DataFrame:
    """The newest partition of each stored table: rows, bytes and times."""
    return daily_status(ledger_stats(ledger, names))


def run_retention(ledger: Ledger, names: list[str], as_of: date, keep_days: int = 30) -> int:
    """Drop old partitions of each table; the listing opens no data file."""
    dropped = 0
    for name in names:
        t = TABLES[name]
        listed = list_partitions(ledger.spark, ledger.path(name), t.partition_col, t.grain)
        old = retention_candidates(listed, as_of, keep_days, t.partition_col)
        dropped += drop_partitions(ledger.spark, ledger.path(name), old, t.partition_col)
    return dropped


def drop_newest(ledger: Ledger, names: list[str]) -> int:
    """Drop the newest partition of each table, so that a day can be loaded afresh."""
    dropped = 0
    for name in names:
        t = TABLES[name]
        listed = list_partitions(ledger.spark, ledger.path(name), t.partition_col, t.grain)
        last = newest(listed, 1, t.partition_col)
        dropped += drop_partitions(ledger.spark, ledger.path(name), last, t.partition_col)
    return dropped
