"""Writing tables: dispositions, typed conform, copies, query results, deletes."""

from __future__ import annotations

from datetime import date, datetime
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.operators.shape import conform
from tallybook.schemas import Table
from tallybook.sources.partitions import PARTITION, at_grain, scan, with_partition
from tallybook.sources.publish import publishing, repair_table

DISPOSITIONS = ("TRUNCATE", "APPEND", "EMPTY")
# Fixed value: the folder of rows without a partition.
NO_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def table_exists(spark: SparkSession, root: str) -> bool:
    path = _path(spark, root)
    return _fs(spark, path).exists(path)


def _path(spark: SparkSession, root: str):
    return spark._jvm.org.apache.hadoop.fs.Path(root)


def _fs(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def filesystem(spark: SparkSession, root: str) -> tuple:
    """The Hadoop file system of a folder, and its path there."""
    path = _path(spark, root)
    return _fs(spark, path), path


def partition_folder(value: date | datetime, col: str = PARTITION) -> str:
    """Name of a partition's folder, as Spark's writer spells it."""
    return f"{col}={quote(str(value), safe=' ')}"


def _check(disposition: str) -> None:
    if disposition not in DISPOSITIONS:
        raise ValueError(f"disposition must be one of {DISPOSITIONS}, not {disposition!r}")


def write(
    df: DataFrame,
    root: str,
    schema: T.StructType,
    disposition: str = "TRUNCATE",
    partition: date | datetime | None = None,
    grain: str | None = "day",
    col: str = PARTITION,
) -> None:
    """Load ``df`` into a table.

    With ``partition`` all rows go there: TRUNCATE replaces that partition, also by none, and
    leaves it standing.  Without it the frame's own partition column decides, and TRUNCATE
    replaces the partitions that occur in it and no others.  A value within a month or an hour
    stands for the whole of it.  EMPTY fails if a target partition holds rows.

    What a TRUNCATE replaces stands until the new content is written, then the folder changes at
    once; a load that fails leaves it as it was.  Without ``partition`` Spark's writer moves the
    partitions into place one by one when all are written.
    """
    _check(disposition)
    spark = df.sparkSession
    partition = at_grain(partition, grain)
    if partition is not None:
        df = df.withColumn(col, F.lit(partition))
    out = conform(df, with_partition(schema, grain, col))
    if grain is not None and partition is None:
        out = out.withColumn(col, at_grain(F.col(col), grain))
    if disposition == "EMPTY" and table_exists(spark, root):
        target = scan(spark, root, schema, grain, partition, col)
        if partition is None and grain is not None:
            target = target.join(out.select(col).distinct(), col, "left_semi")
        if not target.isEmpty():
            raise ValueError(f"{root} already holds rows")
    mode = "overwrite" if disposition == "TRUNCATE" else "append"
    if grain is None or partition is not None:
        out = out if grain is None else out.drop(col)
        target = root if grain is None else f"{root}/{partition_folder(partition, col)}"
        if disposition == "TRUNCATE":
            with publishing(spark, target) as path:
                out.write.parquet(path)
        else:
            out.write.mode(mode).parquet(target)
    else:
        # few files per partition, and a large day still spreads over many tasks
        out = out.hint("rebalance", F.col(col))
        writer = out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(col).parquet(root)


def create_empty(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    grain: str | None = "day",
    partition: date | datetime | None = None,
    disposition: str = "TRUNCATE",
    col: str = PARTITION,
) -> None:
    """A table, or one partition of it, with a schema and no rows.

    TRUNCATE empties what is there, APPEND keeps it, EMPTY fails if it holds rows.  Other
    partitions are never touched.
    """
    if (grain is None) != (partition is None):
        raise ValueError("a partitioned table needs the partition to create, another must not have one")
    none = spark.createDataFrame([], with_partition(schema, grain, col))
    write(none, root, schema, disposition, partition, grain, col)


def copy(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType,
    disposition: str = "TRUNCATE",
    grain: str | None = "day",
) -> None:
    write(scan(spark, source, schema, grain), target, schema, disposition, grain=grain)


def sql(spark: SparkSession, text: str, args: dict | None = None) -> DataFrame:
    """Run SQL with named parameters; a table name goes through ``IDENTIFIER(:name)``."""
    return spark.sql(text, args=args or {})


def sql_file(spark: SparkSession, path: str, args: dict | None = None) -> DataFrame:
    with open(path, encoding="utf-8") as f:
        return sql(spark, f.read(), args)


def create_as(
    spark: SparkSession,
    text: str,
    args: dict | None,
    root: str,
    table: Table,
    disposition: str = "TRUNCATE",
    partition: date | None = None,
) -> DataFrame:
    """Store a query's result as a table (or one partition), typed and commented."""
    out = sql(spark, text, args)
    write(out, root, table.schema, disposition, partition, table.grain, table.partition_col)
    return register(spark, root, table)


def register(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """Put a stored table into the session catalog with its comment.

    The entry is made under another name and takes the place of an older one at the end.
    """
    columns = with_partition(table.schema, table.grain, table.partition_col)
    spec = f"PARTITIONED BY ({table.partition_col})" if table.grain else ""
    body = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    new = f"{table.name}__new"

    def text(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    spark.sql(f"DROP TABLE IF EXISTS `{new}`")
    spark.sql(
        f"CREATE TABLE `{new}` ({body}) USING parquet {spec} LOCATION {text(root)} COMMENT {text(table.comment)}"
    )
    if table.grain:
        spark.sql(f"MSCK REPAIR TABLE `{new}`")
    spark.sql(f"DROP TABLE IF EXISTS `{table.name}`")
    spark.sql(f"ALTER TABLE `{new}` RENAME TO `{table.name}`")
    return spark.table(table.name)


def partition_days(
    spark: SparkSession, root: str, col: str = PARTITION, grain: str = "day"
) -> list[date] | list[datetime]:
    """Partitions of a stored table, oldest first, from one folder listing.

    No file is opened, and a value given back as a literal prunes a scan before it starts.
    Empty partitions are there too; rows without a partition are in none.  A load that died while
    it was put in place is finished first.
    """
    repair_table(spark, root)
    path = _path(spark, root)
    names = [s.getPath().getName() for s in _fs(spark, path).listStatus(path)]
    values = [unquote(n.split("=", 1)[1]) for n in names if n.startswith(f"{col}=")]
    kind = date if grain in ("day", "month") else datetime
    return sorted(kind.fromisoformat(v) for v in values if v != NO_PARTITION)


def list_partitions(
    spark: SparkSession, root: str, col: str = PARTITION, grain: str = "day"
) -> DataFrame:
    kind = "DATE" if grain in ("day", "month") else "TIMESTAMP_NTZ"
    days = [(d,) for d in partition_days(spark, root, col, grain)]
    return spark.createDataFrame(days, f"{col} {kind}").orderBy(col)


def drop_partitions(
    spark: SparkSession, root: str, candidates: DataFrame, col: str = PARTITION
) -> int:
    """Delete the folders of the given partitions; returns how many there were.

    Fails on a partition that isn't there.  The list has one row per partition of one table, so
    it is read on the driver.
    """
    dropped = 0
    for row in candidates.select(col).distinct().toLocalIterator():
        path = _path(spark, f"{root}/{partition_folder(row[0], col)}")
        if not _fs(spark, path).delete(path, True):
            raise FileNotFoundError(f"{root} has no partition {row[0]}")
        dropped += 1
    return dropped


def drop_table(spark: SparkSession, root: str) -> bool:
    """Delete a whole table family."""
    path = _path(spark, root)
    return bool(_fs(spark, path).delete(path, True))
