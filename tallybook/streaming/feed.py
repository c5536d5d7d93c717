"""The change feed as a Structured Streaming job.

Landed sync pages are the stream.  The checkpoint remembers which files were read, which
is what a cursor does for a polled feed.  Every micro-batch writes the folder of its batch
id, so a batch that is replayed after a failure overwrites itself.  Versions and tombstones
are only appended; ``current`` resolves them at read time, in any order of arrival.

``compact`` folds all finished batches into a base: the versions that can still count, one tombstone
per key, one cursor per item. A base has a folder named after its last batch and counts once its
marker file is there, which is made last; reading takes the newest base and the batches after it.
``clean`` deletes what no reader needs any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallybook.operators.dedup import current_view, first_tombstones, frontier, version_order
from tallybook.operators.shape import conform
from tallybook.schemas import SYNC_PAGE, TOMBSTONES, TRANSACTIONS, struct
from tallybook.sources.pages import normalize_tombstones, normalize_transactions
from tallybook.sources.tables import filesystem

BATCH = "batch_id"
BASES, UPTO = "bases", "upto"
#: Marks a finished base, and Spark's own mark of a finished write.
MARKER, SUCCESS = "_BASE", "_SUCCESS"
_ON = ("item_id", "account_id", "transaction_id")
#: Files of a micro-batch: a backlog is worked off in several, each of a size that can be persisted.
MAX_FILES = 10_000
_LANDED = T.StructType([*SYNC_PAGE.fields, T.StructField("partition_date", T.DateType())])
_VERSION = T.StructType([*TRANSACTIONS.fields, T.StructField("partition_date", T.DateType())])
_CURSOR = struct(("item_id", "string"), ("page", "bigint"), ("next_cursor", "string"))


def read_feed(spark: SparkSession, src: str, max_files: int = MAX_FILES) -> DataFrame:
    """Pages as a stream; ``partition_date`` is the landing day, in the page or its folder."""
    return spark.readStream.schema(_LANDED).option("maxFilesPerTrigger", max_files).json(src)


def apply_batch(pages: DataFrame, batch_id: int, dst: str) -> None:
    # the batch is parsed once for its three tables
    pages = pages.persist()
    try:
        versions = normalize_transactions(pages, keep=("partition_date",))
        removed = normalize_tombstones(pages, F.col("partition_date"))
        _put(versions, dst, "versions", batch_id)
        _put(removed, dst, "tombstones", batch_id)
        _put(conform(pages, _CURSOR), dst, "cursors", batch_id)
    finally:
        pages.unpersist()


def _put(df: DataFrame, dst: str, name: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{dst}/{name}/{BATCH}={batch_id}")


def start_feed(
    spark: SparkSession, src: str, dst: str, checkpoint: str, max_files: int = MAX_FILES
) -> StreamingQuery:
    """Read what has landed, then stop; run it again for what landed since."""
    return (
        read_feed(spark, src, max_files)
        .writeStream.foreachBatch(lambda df, batch_id: apply_batch(df, batch_id, dst))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _batches(spark: SparkSession, dst: str, name: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(full).parquet(f"{dst}/{name}")


def _folders(spark: SparkSession, path: str, prefix: str, marker: str) -> list[int]:
    """Numbers of the folders ``prefix=n`` below a path that hold the marker file, ascending."""
    fs, root = filesystem(spark, path)
    if not fs.exists(root):
        return []
    found = [s.getPath() for s in fs.listStatus(root)]
    done = [p.getName() for p in found if p.getName().startswith(f"{prefix}=") and fs.exists(p.suffix(f"/{marker}"))]
    return sorted(int(n.split("=", 1)[1]) for n in done)


def bases(spark: SparkSession, dst: str) -> list[int]:
    """Last batches of the finished bases, oldest first."""
    return _folders(spark, f"{dst}/{BASES}", UPTO, MARKER)


def _since(spark: SparkSession, dst: str, name: str, schema: T.StructType, upto: int | None) -> DataFrame:
    """A table as far as it counts: the base and the batches after it, or all batches."""
    rows = _batches(spark, dst, name, schema)
    if upto is None:
        return rows
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    base = spark.read.schema(full).parquet(f"{dst}/{BASES}/{UPTO}={upto}/{name}")
    return base.unionByName(rows.where(F.col(BATCH) > upto))


def _newest(spark: SparkSession, dst: str) -> int | None:
    done = bases(spark, dst)
    return done[-1] if done else None


def compact(spark: SparkSession, dst: str) -> int | None:
    """Fold the newest base and the finished batches after it into a new base; returns its last batch.

    A batch is finished when its cursors are, which are written last. A base that exists isn't made
    again; one that was left without its marker is.
    """
    finished = _folders(spark, f"{dst}/cursors", BATCH, SUCCESS)
    upto = _newest(spark, dst)
    if not finished or (upto is not None and finished[-1] <= upto):
        return upto
    last = finished[-1]

    def rows(name: str, schema: T.StructType) -> DataFrame:
        return _since(spark, dst, name, schema, upto).where(F.col(BATCH) <= last)

    versions = frontier(rows("versions", _VERSION), list(_ON), "transaction_date", version_order(batch=True))
    removed = first_tombstones(rows("tombstones", TOMBSTONES), list(_ON)).withColumn(BATCH, F.lit(last).cast("long"))
    last_seen = F.max(F.struct(BATCH, "page", "next_cursor")).alias("s")
    cursors_ = rows("cursors", _CURSOR).groupBy("item_id").agg(last_seen).select("item_id", "s.*")
    path = f"{dst}/{BASES}/{UPTO}={last}"
    for name, df in (("versions", versions), ("tombstones", removed), ("cursors", cursors_)):
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    fs, folder = filesystem(spark, path)
    fs.create(folder.suffix(f"/{MARKER}"), True).close()
    return last


def clean(spark: SparkSession, dst: str, keep: int = 2) -> int:
    """Delete all but the newest ``keep`` bases, and the batches that the oldest of these holds.

    Readers that began before the last ``keep - 1`` compactions may still hold what goes. Returns
    how many folders went.
    """
    kept = bases(spark, dst)[-keep:]
    if not kept:
        return 0
    gone = 0
    fs, root = filesystem(spark, f"{dst}/{BASES}")
    for path in [s.getPath() for s in fs.listStatus(root)]:
        if int(path.getName().split("=", 1)[1]) < kept[0]:
            gone += fs.delete(path, True)
    for name in ("versions", "tombstones", "cursors"):
        fs, root = filesystem(spark, f"{dst}/{name}")
        for path in [s.getPath() for s in fs.listStatus(root)]:
            if path.getName().startswith(f"{BATCH}=") and int(path.getName().split("=", 1)[1]) <= kept[0]:
                gone += fs.delete(path, True)
    return gone


def current(spark: SparkSession, dst: str) -> DataFrame:
    """Live transactions after all batches so far."""
    upto = _newest(spark, dst)
    versions = _since(spark, dst, "versions", _VERSION, upto)
    removed = _since(spark, dst, "tombstones", TOMBSTONES, upto)
    return current_view(versions, removed.drop(BATCH), order=version_order(batch=True)).drop(BATCH)


def cursors(spark: SparkSession, dst: str) -> DataFrame:
    """The last cursor seen per item."""
    seen = _since(spark, dst, "cursors", _CURSOR, _newest(spark, dst))
    last = F.max(F.struct(BATCH, "page", "next_cursor")).alias("last")
    return seen.groupBy("item_id").agg(last).select("item_id", "last.next_cursor")
