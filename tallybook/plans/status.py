"""Daily status: size and age of the newest partition of every table family."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.text import extract_or_null, format_size
from tallybook.operators.dedup import latest_by

# Defaults: datasets with daily suffixes (others are monthly), and the table without one.
DAILY_DATASETS = ("ledger",)
UNPARTITIONED = ("temp_cursors",)


def _clock(millis: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    moment = F.timestamp_add("SECOND", F.floor(millis / 1000), epoch)
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def family(daily: Column) -> Column:
    """Table id without its suffix; NULL for a table that has none."""
    table = F.col("table_id")
    return F.when(daily, extract_or_null(table, r"(.*)\d{8}$")).otherwise(
        extract_or_null(table, r"(.*)\d{6}$")
    )


def latest_shards(stats: DataFrame, daily_datasets: tuple[str, ...] = DAILY_DATASETS) -> DataFrame:
    daily = F.col("dataset_id").isin(list(daily_datasets))
    return latest_by(stats, [family(daily)], [F.col("table_id").desc_nulls_last()])


def daily_status(
    stats: DataFrame,
    daily_datasets: tuple[str, ...] = DAILY_DATASETS,
    unpartitioned: tuple[str, ...] = UNPARTITIONED,
) -> DataFrame:
    daily = F.col("dataset_id").isin(list(daily_datasets))
    table = F.col("table_id")
    suffix = F.when(table.isin(list(unpartitioned)), F.lit(None)).when(
        daily, F.substring(table, -8, 8)
    ).otherwise(F.substring(table, -6, 6))
    return (
        latest_shards(stats, daily_datasets)
        .select(
            suffix.alias("partition_date"),
            "table_id",
            _clock(F.col("creation_time")).alias("creation_time"),
            _clock(F.col("last_modified_time")).alias("last_modified_time"),
            "row_count",
            format_size(F.col("size_bytes")).alias("table_size"),
        )
        .orderBy(F.col("partition_date").desc_nulls_last(), F.col("table_id").asc_nulls_first())
    )
