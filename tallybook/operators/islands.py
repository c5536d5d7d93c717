"""Runs of consecutive numbers, and the numbers missing between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Numbers of a key that are placed together; a key with more is spread over several tasks.
BLOCK = 10_000


def islands(df: DataFrame, keys: list[str], number: str, block: int = BLOCK) -> DataFrame:
    """``keys, first, last``: the runs of consecutive numbers of each key.

    Repeated numbers count once and NULL ones not at all; NULL keys form one group. Runs are found
    in blocks of numbers first, by number minus rank, so a hot key is spread over tasks; what a
    key's blocks left over, a run each at least, is joined at their edges.
    """
    n = F.col(number)
    rows = df.where(n.isNotNull()).select(*keys, n.alias("_n"), F.expr(f"{number} div {block}").alias("_block"))
    in_block = Window.partitionBy(*keys, "_block").orderBy("_n")
    numbered = rows.distinct().withColumn("_run", F.col("_n") - F.row_number().over(in_block))
    parts = numbered.groupBy(*keys, "_block", "_run").agg(F.min("_n").alias("first"), F.max("_n").alias("last"))
    by_key = Window.partitionBy(*keys).orderBy("first")
    opens = F.coalesce(F.lag("last").over(by_key) < F.col("first") - 1, F.lit(True))
    joined = parts.withColumn("_opens", opens.cast("int")).withColumn("_run", F.sum("_opens").over(by_key))
    return joined.groupBy(*keys, "_run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_run")


def gaps(runs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, first, last``: what lies between the ``islands`` of each key."""
    following = F.lead("first").over(Window.partitionBy(*keys).orderBy("first"))
    ends = runs.select(*keys, (F.col("last") + 1).alias("_from"), (following - 1).alias("_to"))
    return ends.where(F.col("_to").isNotNull()).select(*keys, F.col("_from").alias("first"), F.col("_to").alias("last"))
