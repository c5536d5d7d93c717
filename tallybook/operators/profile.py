"""Null, duplicate, drift and reconciliation profiles; each is a small DataFrame."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.numbers import money_sum, pct_change_sql, round2
from tallybook.operators.shape import union_all


def null_checks(columns: dict[str, str]) -> dict[str, Column]:
    """``{"null_items": "item_id"}`` as tests for NULL."""
    return {name: F.col(c).isNull() for name, c in columns.items()}


def is_empty(array: Column) -> Column:
    """An array that is NULL counts as empty."""
    return F.size(F.coalesce(array, F.array())) == 0


def null_profile(
    df: DataFrame, checks: dict[str, Column], by: list[str] | None = None, total: str | None = None
) -> DataFrame:
    """How many rows fail each check, in one pass; ``total`` names a row count."""
    counts = [F.count_if(test).alias(name) for name, test in checks.items()]
    if total:
        counts.append(F.count(F.lit(1)).alias(total))
    return df.groupBy(*by).agg(*counts) if by else df.agg(*counts)


def null_profile_by_partition(
    df: DataFrame, checks: dict[str, Column], col: str = "partition_date"
) -> DataFrame:
    """Totals over all partitions, and which partitions have any failure.

    The list holds at most one entry per partition.
    """
    per = null_profile(df, checks, by=[col])
    bad = sum((F.col(n) for n in checks), F.lit(0)) > 0
    flagged = per.withColumn("_bad", F.when(bad, F.col(col).cast("string")))
    return flagged.agg(
        ordered_list("_bad").alias("partitions_null"), *[F.sum(n).alias(n) for n in checks]
    )


def ordered_list(name: str) -> Column:
    """Non-NULL values of a column, sorted and joined; NULL when there are none."""
    return F.expr(f"listagg(`{name}`, '; ') WITHIN GROUP (ORDER BY `{name}`)")


def one_row(*reports: DataFrame) -> DataFrame:
    """One-row reports side by side, without a cross join."""
    columns = list(dict.fromkeys(c for r in reports for c in r.columns))
    return union_all(*reports).selectExpr(*[f"max(`{c}`) AS `{c}`" for c in columns])


def compare(
    df: DataFrame,
    part_col: str,
    d0: date | Column,
    d1: date | Column,
    counts: dict[str, Column] | None = None,
    distinct: dict[str, str] | None = None,
    sums: dict[str, Column] | None = None,
    nulls: dict[str, Column] | None = None,
) -> DataFrame:
    """Two partitions side by side, one row.

    Counts and distinct counts give ``total_x_0d``, ``_1d`` and ``_diff``; sums give
    rounded values and the change in percent; null checks are counted in the newer
    partition.  One scan reads both partitions and aggregates per partition.  Distinct
    counts take a second scan, of their own columns: in one aggregate they would copy every
    row, with all columns the checks need, once per distinct column.
    """
    counts, distinct, sums, nulls = counts or {}, distinct or {}, sums or {}, nulls or {}
    new, old = _lit(d0), _lit(d1)
    day = F.col(part_col)
    both = df.where((day == new) | (day == old))
    side = [(day == new).alias("_new"), (day == old).alias("_old")]

    def pick(name: str, flag: str) -> str:
        return f"max(CASE WHEN {flag} THEN `{name}` END)"

    def pair(names: Iterable[str], prefix: str, empty: str) -> list[str]:
        """Both sides of each metric; ``empty`` is what a side without rows gives."""
        return [
            f"coalesce({pick(prefix + n, flag)}, {empty}) AS `{prefix}{n}_{t}`"
            for n in names
            for flag, t in (("_new", 0), ("_old", 1))
        ]

    aggregates = [
        *[c.alias(f"c_{n}") for n, c in counts.items()],
        *[c.alias(f"s_{n}") for n, c in sums.items()],
        *[F.count_if(c).alias(n) for n, c in nulls.items()],
    ]
    reports = []
    if aggregates:
        reports.append(
            both.groupBy(*side)
            .agg(*aggregates)
            .selectExpr(
                *pair(counts, "c_", "0"),
                *pair(sums, "s_", "NULL"),
                *[f"coalesce({pick(n, '_new')}, 0) AS `{n}`" for n in nulls],
            )
        )
    if distinct:
        unique = [F.count_distinct(c).alias(f"c_{n}") for n, c in distinct.items()]
        reports.append(both.groupBy(*side).agg(*unique).selectExpr(*pair(distinct, "c_", "0")))
    one = reports[0] if len(reports) == 1 else one_row(*reports)
    out = [f"`{n}`" for n in nulls]
    for n in [*distinct, *counts]:
        a, b, total = f"`c_{n}_0`", f"`c_{n}_1`", f"total_{n}"
        out += [f"{a} AS {total}_0d", f"{b} AS {total}_1d", f"{a} - {b} AS {total}_diff"]
    for n in sums:
        a, b, total = f"`s_{n}_0`", f"`s_{n}_1`", f"total_{n}"
        change = pct_change_sql(a, b)
        out += [
            f"round({a}, 2) AS {total}_0d",
            f"round({b}, 2) AS {total}_1d",
            f"round({change}, 2) AS {total}_pct_chg",
            f"round(abs({change}), 2) AS {total}_pct_chg_abs",
        ]
    return one.selectExpr(*out).select(new.alias("partition_0d"), old.alias("partition_1d"), "*")


def _lit(value: date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def duplicate_count(
    df: DataFrame, keys: Iterable[str], where: Column | None = None, name: str = "duplicates"
) -> DataFrame:
    """How many keys occur more than once (one row).  NULLs in a key compare equal."""
    rows = df if where is None else df.where(where)
    return (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.count_if(F.col("_n") > 1).alias(name))
    )


def unmapped_pairs(
    tx: DataFrame, budget: DataFrame, ignored: list[str] | None = None
) -> DataFrame:
    """Raw category pairs in use that the budget does not map, one row each.

    Pairs are reduced to distinct ones on both sides before they meet.
    """
    pair = ["category_raw", "subcategory_raw"]
    used = tx if not ignored else tx.where(~F.col("subcategory_raw").isin(ignored))
    return used.select(*pair).distinct().join(budget.select(*pair).distinct(), pair, "left_anti")


def missing_categories(
    tx: DataFrame, budget: DataFrame, ignored: list[str] | None = None
) -> DataFrame:
    """The pairs of ``unmapped_pairs`` as an alert shows them: list and count, one row."""
    gone = unmapped_pairs(tx, budget, ignored)
    label = F.concat("category_raw", F.lit(" - "), "subcategory_raw")
    return gone.select(label.alias("_label")).agg(
        ordered_list("_label").alias("missing_categories"),
        F.count_distinct("_label").alias("missing_categories_count"),
    )


def reconcile(mart: DataFrame, source: DataFrame, name: str = "value") -> DataFrame:
    """Totals of two tables and their difference, one row.

    Both frames carry the column ``amount``.
    """
    none = F.lit(None).cast("double")
    both = mart.select(F.col("amount").alias("_m"), none.alias("_s")).unionByName(
        source.select(none.alias("_m"), F.col("amount").alias("_s"))
    )
    totals = both.agg(money_sum(F.col("_m")).alias("_m"), money_sum(F.col("_s")).alias("_s"))
    return totals.select(
        round2(F.col("_m")).alias(f"total_{name}_0d"),
        round2(F.col("_s")).alias(f"total_{name}_source"),
        round2(F.col("_m") - F.col("_s")).alias(f"total_{name}_diff"),
    )
