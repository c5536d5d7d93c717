"""The budget: a category map with monthly amounts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators.shape import conform
from tallybook.schemas import BUDGET_SOURCE, BUDGET_VALUES


def read_budget(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per line; ``backfill`` maps a month (first day) to an amount."""
    rows = spark.read.schema(BUDGET_SOURCE).json(path)
    months = F.transform_keys("backfill", lambda month, _: month.cast("date"))
    return rows.withColumn("backfill", months)


def budget_for(budget: DataFrame, month: date | Column) -> DataFrame:
    """Budget rows of one month; a backfill entry for it, even NULL, wins."""
    if "backfill" in budget.columns:
        m = month if isinstance(month, Column) else F.lit(month)
        entry = F.col("backfill")
        amount = F.when(F.map_contains_key(entry, m), F.try_element_at(entry, m)).otherwise(
            F.col("budget_amount")
        )
        budget = budget.withColumn("budget_amount", amount)
    return conform(budget, BUDGET_VALUES)
