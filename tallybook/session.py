"""Session settings and scratch tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan here relies on.  Cluster sizing (shuffle partitions,
# executor memory, broadcast threshold) is left to whoever submits the job.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a hot account, item or transaction id is split across tasks at run time, even
    # where the join feeds an aggregate or window on the same key
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # sides placed by one of their join keys needn't be shuffled by all of them again
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, else one inside the warehouse.

    Both are folders that whoever starts the session names and every executor reaches.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch").rstrip("/")


def new_scratch_table(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/tallybook/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    For results that several branches of a plan need.  Unlike a cache the table
    survives lost executors, and every reader prunes columns and row groups.
    """
    spark = df.sparkSession
    path = new_scratch_table(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
