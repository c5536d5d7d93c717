"""One row per key, tombstones, and the current state of a change feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value of the transaction status.
MODIFIED = "MODIFIED"


def latest_by(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """The first row per key in ``order``.  NULL keys form one group.

    Spark cuts each task's rows to one per key before the shuffle (a window group
    limit), so a key that holds most of the table still sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def apply_tombstones(
    df: DataFrame,
    removed: DataFrame,
    on: list[str],
    event_date: str,
    removed_date: str = "date_removed",
) -> DataFrame:
    """Rows without a tombstone, or dated after their earliest tombstone.

    A tombstone with no date removes the row.  Tombstones are reduced to one per key
    first, so several of them do not multiply rows.
    """
    first = removed.groupBy(*on).agg(F.min(removed_date).alias("_first"), F.lit(True).alias("_hit"))
    joined = df.join(first, on, "left")
    keep = F.col("_hit").isNull() | (F.col("_first") < F.col(event_date))
    return joined.where(keep).drop("_first", "_hit")


def version_order(batch: bool = False) -> list[Column]:
    """Newest version first; a modified version beats the one it replaces, and of versions of one
    moment the one that came later in the feed, by batch if there are any, page and place."""
    later = [*(["batch_id"] if batch else []), "feed_page", "feed_place"]
    return [
        F.coalesce(
            F.col("transaction_datetime"), F.col("transaction_date").cast("timestamp_ntz")
        ).desc_nulls_last(),
        F.col("partition_date").desc_nulls_last(),
        (F.col("status") == MODIFIED).desc_nulls_last(),
        *[F.col(c).desc_nulls_last() for c in later],
        F.col("amount").asc_nulls_first(),
    ]


def current_view(
    versions: DataFrame,
    tombstones: DataFrame,
    key: str = "transaction_id",
    on: tuple[str, ...] = ("item_id", "account_id", "transaction_id"),
    event_date: str = "transaction_date",
    order: list[Column] | None = None,
) -> DataFrame:
    """State of a change feed: live versions, the newest per key.

    Tombstones are tested per version, before the newest one is chosen.
    """
    live = apply_tombstones(versions, tombstones, list(on), event_date)
    return latest_by(live, [key], order or version_order())


def frontier(versions: DataFrame, on: list[str], event_date: str, order: list[Column]) -> DataFrame:
    """Versions that can still become the newest of their key, whatever tombstones come.

    An earlier tombstone brings back versions dated after it, so the newest one alone isn't enough.
    A version goes if a newer one of its key is dated the same or later: that one lives whenever
    this one does. A version without a date lives only without a tombstone. Frontiers may be taken
    of parts and of parts together. The newest per key and date are found first, which Spark cuts to
    one row a task before the shuffle, so a hot key leaves few rows to order.
    """
    best = latest_by(versions, [*on, event_date], order)
    newer = Window.partitionBy(*on).orderBy(*order)
    ranked = best.withColumns(
        {
            "_place": F.row_number().over(newer),
            "_newest": F.max(event_date).over(newer.rowsBetween(Window.unboundedPreceding, -1)),
        }
    )
    later = F.col(event_date).isNotNull() & F.coalesce(F.col(event_date) > F.col("_newest"), F.lit(True))
    return ranked.where((F.col("_place") == 1) | later).drop("_place", "_newest")


def first_tombstones(removed: DataFrame, on: list[str], removed_date: str = "date_removed") -> DataFrame:
    """One tombstone per key with its earliest date; several are worth as much as this one."""
    return removed.groupBy(*on).agg(F.min(removed_date).alias(removed_date))
