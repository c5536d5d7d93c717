"""Lookups and key tests.

Keys that are only tested for presence are made distinct first: a key that fills a third
of the other side then crosses the shuffle once per task.  No side is force-broadcast here: dimensions of a ledger (accounts, securities) grow with
it.  Catalyst broadcasts a side whose size is under the session's threshold; otherwise
these are shuffled joins on unique right keys, where a hot left key is split at run time.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(df: DataFrame, dim: DataFrame, on: list[str], required: bool = False) -> DataFrame:
    """Left join to a dimension with unique keys; a NULL key finds nothing.

    ``required`` fails the job on a non-NULL key the dimension lacks.
    """
    if not required:
        return df.join(dim, on, "left")
    joined = df.join(dim.withColumn("_hit", F.lit(True)), on, "left")
    keyed = reduce(and_, [F.col(k).isNotNull() for k in on])
    message = F.concat_ws(" ", F.lit("no match for key"), *[F.col(k).cast("string") for k in on])
    lost = F.col("_hit").isNull() & keyed
    return joined.where(F.when(lost, F.raise_error(message).cast("boolean")).otherwise(True)).drop("_hit")


def missing_keys(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is absent from ``other``; a key with a NULL counts as absent."""
    return df.join(other.select(*on).distinct(), on, "left_anti").select(*df.columns)


def existing_keys(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that share at least one of the ``keys`` with ``other``; NULLs match nothing."""
    columns = df.columns
    if len(keys) == 1:
        return df.join(other.select(*keys).distinct(), keys, "left_semi").select(*columns)
    hits = []
    for k in keys:
        seen = other.where(F.col(k).isNotNull()).select(k).distinct()
        df = df.join(seen.withColumn(f"_hit_{k}", F.lit(True)), k, "left")
        hits.append(F.col(f"_hit_{k}").isNotNull())
    return df.where(reduce(or_, hits)).select(*columns)


def merge_cursors(refreshed: DataFrame, previous: DataFrame, key: str = "item_id") -> DataFrame:
    """Refreshed cursors, and the previous ones of items that got none."""
    return refreshed.unionByName(missing_keys(previous, refreshed, [key]))


def initial_cursors(items: DataFrame) -> DataFrame:
    """An empty cursor per item: the feed starts over."""
    return items.select("item_id", F.lit("").alias("next_cursor"))


def last_cursors(pages: DataFrame, order: str = "page") -> DataFrame:
    """The cursor of the last page per item."""
    return pages.groupBy("item_id").agg(F.max_by("next_cursor", order).alias("next_cursor"))
