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
from tallybook.operators.profile import (
    compare,
    duplicate_count,
    missing_categories,
    null_profile,
    null_profile_by_partition,
    reconcile,
    unmapped_pairs,
)
from tallybook.operators.rules import apply_rules, load_rules, with_rules
from tallybook.operators.shape import conform, union_all

__all__ = [
    "actuals",
    "apply_rules",
    "apply_tombstones",
    "balance_rows",
    "budget_totals",
    "budget_vs_actual",
    "categorize",
    "compare",
    "conform",
    "current_view",
    "duplicate_count",
    "enrich",
    "existing_keys",
    "latest_by",
    "load_rules",
    "merge_cursors",
    "missing_categories",
    "missing_keys",
    "null_profile",
    "null_profile_by_partition",
    "reconcile",
    "union_all",
    "unmapped_pairs",
    "with_balance",
    "with_rules",
]
