from tallybook.sources.balances import value_balances
from tallybook.sources.budget import budget_for, read_budget
from tallybook.sources.pages import (
    attach_security,
    feed_complete,
    merge_pages,
    normalize_accounts,
    normalize_holdings,
    normalize_tombstones,
    normalize_trades,
    normalize_transactions,
    read_pages,
    with_product,
)
from tallybook.sources.partitions import (
    dependency_report,
    in_range,
    latest,
    latest_partition,
    newest,
    retention_candidates,
    scan,
    scan_sharded,
    since_year_start,
    stored_files,
    table_stats,
    window_filter,
)
from tallybook.sources.tables import (
    copy,
    create_as,
    create_empty,
    drop_partitions,
    drop_table,
    list_partitions,
    partition_days,
    register,
    sql,
    sql_file,
    write,
)

__all__ = [
    "attach_security",
    "budget_for",
    "copy",
    "create_as",
    "create_empty",
    "dependency_report",
    "drop_partitions",
    "drop_table",
    "feed_complete",
    "in_range",
    "latest",
    "latest_partition",
    "list_partitions",
    "merge_pages",
    "newest",
    "normalize_accounts",
    "normalize_holdings",
    "normalize_tombstones",
    "normalize_trades",
    "normalize_transactions",
    "partition_days",
    "read_budget",
    "read_pages",
    "register",
    "retention_candidates",
    "scan",
    "scan_sharded",
    "since_year_start",
    "sql",
    "sql_file",
    "stored_files",
    "table_stats",
    "value_balances",
    "window_filter",
    "with_product",
    "write",
]
