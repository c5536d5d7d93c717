"""Token ids in binary blocks: frequency ranks in one to four bytes, lengths in control bytes.

A value takes one to four little-endian bytes in the data stream; its length is two bits of the
control stream, four values to a byte. Each document begins a control byte of its own, so any
document of a block can be decoded alone. Ids are replaced by their rank in the whole corpus, so
the frequent ones take one byte.

A file is a Parquet file of blocks ``(shard, block, first, n, docs, counts, control, data)``: Spark's
writer commits it as a whole and any store it reaches can hold it. Shards are ranges of doc_id; shard,
block and the order within a block give ascending doc_id. ``first`` counts the ids of the shard before
the block, ``n`` those of the block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.session import new_scratch_table

from .common import WORD_BATCH_BYTES, in_batches, stage
from .subwords import encoder

#: Ids of a shard and of a block, about.
SHARD_IDS = 4_000_000
BLOCK_IDS = 100_000


def pack_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    return tuple(column[0].as_py() for column in pack_documents(values, np.array([len(values)])))


def pack_documents(values: np.ndarray, counts: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Control and data bytes of documents that follow each other, ``counts`` values each."""
    values = np.ascontiguousarray(values, dtype="<u4")
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    at, slots = _slots(counts)
    codes = np.zeros(slots, dtype=np.uint8)
    codes[at] = extra
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    ends = np.cumsum(extra + 1, dtype=np.int64)
    starts = ends - extra - 1
    data = np.empty(ends[-1] if len(ends) else 0, dtype=np.uint8)
    data[starts] = values & 0xFF
    for k in range(1, 4):
        longer = np.flatnonzero(extra >= k)
        data[starts[longer] + k] = values[longer] >> np.uint32(8 * k) & 0xFF
    sizes = np.diff(np.append(0, ends)[np.append(0, np.cumsum(counts))])
    return _binaries(control, -(-counts // 4)), _binaries(data, sizes)


def _slots(counts: np.ndarray) -> tuple[np.ndarray, int]:
    """Place of each value among the lengths of the control bytes, and how many places there are."""
    counts = np.asarray(counts, dtype=np.int64)
    slots = -(-counts // 4) * 4
    ends = np.cumsum(slots)
    at = np.repeat(ends - slots - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    return at, int(slots.sum())


def _binaries(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column; its rows hold ``counts`` values of ``flat`` each."""
    ends = np.append(0, np.cumsum(counts, dtype=np.int64)) * flat.itemsize
    if ends[-1] >= 2**31:
        raise ValueError("rows of one batch hold 2 GB or more")
    offsets = pa.py_buffer(ends.astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, offsets, pa.py_buffer(np.ascontiguousarray(flat))])


#: Lengths of the four values that a control byte stands for.
LENGTHS = (1 + (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3)).astype(np.uint8)


def unpack_values(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """The values of documents that follow each other, ``counts`` values each."""
    at, _ = _slots(counts)
    lengths = LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[at]
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    data = np.frombuffer(data, dtype=np.uint8)
    values = data[starts].astype(np.uint32)
    for k in range(1, 4):
        longer = np.flatnonzero(lengths > k)
        values[longer] |= data[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def tokens(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """``doc_id, n, ids, used`` of whole texts, ids as little-endian bytes, the end id included.

    An id takes two bytes if that is enough for every id of the file and the end id, else four.
    Each task adds one row without a document: ``used`` holds the ids that occur in it and how often.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen, kind = encoder(path), np.zeros(0, dtype=np.int64), pa.int64()
        width, end = "<u2" if max(words.largest, end_id) < 2**16 else "<u4", np.array([end_id], dtype=np.uint32)
        for batch in batches:
            kind = batch.column(0).type
            ids = [x for text in words.encode(batch.column(1)) for x in (text, end)]
            n = np.array([len(x) + 1 for x in ids[::2]], dtype=np.int32)
            flat = np.concatenate([end[:0], *ids]).astype(width)
            for k in range(0, len(flat), 1_000_000):
                more = np.bincount(flat[k : k + 1_000_000], minlength=len(seen))
                more[: len(seen)] += seen
                seen = more
            columns = [batch.column(0), pa.array(n), _binaries(flat, n), pa.nulls(len(n), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        used = np.flatnonzero(seen)
        both = np.concatenate([used, seen[used]]).astype("<i8").tobytes()
        columns = [pa.nulls(1, kind), pa.array([0], pa.int32()), pa.nulls(1, pa.binary()), pa.array([both], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "n", "ids", "used"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, n int, ids binary, used binary")


def _ids(ids: pa.Array, n: np.ndarray) -> np.ndarray:
    """The ids of the rows of a batch, which hold ``n`` each, one after the other."""
    offsets = np.frombuffer(ids.buffers()[1], dtype=np.int32)[ids.offset :][: len(ids) + 1]
    flat = np.frombuffer(ids.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return np.frombuffer(flat.tobytes(), dtype="<u2" if len(flat) == 2 * n.sum(dtype=np.int64) else "<u4")


def frequencies(tokenised: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All ids that occur, the most frequent first, ties to the smaller id, and how often each does.

    At most as many as the vocabulary has.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for used in batch.column(0).to_pylist():
                ids, n = np.frombuffer(used, dtype="<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], names=["id", "n"])

    counts = tokenised.where("used IS NOT NULL").select("used").mapInArrow(split, "id long, n long")
    rows = counts.groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id").collect()
    return tuple(np.array([r[c] for r in rows], dtype=np.int64) for c in ("id", "n"))


def write_files(docs: DataFrame, path: str, end_id: int, out: str) -> np.ndarray:
    """Write the token files of ``docs(doc_id, text)`` below ``out``; returns the id of each rank.

    Null and empty texts are their end id alone. Rows of one doc_id stay together, ordered by
    their ids; a null doc_id comes first. Other columns are ignored. An empty table gives a folder
    of no blocks.
    """
    in_batches(docs.sparkSession, WORD_BATCH_BYTES)
    tokenised = stage(tokens(docs, path, end_id), "tokens")
    in_batches(docs.sparkSession)
    by_rank, used = frequencies(tokenised)
    tokenised = tokenised.where("ids IS NOT NULL").drop("used")
    rank = np.zeros(int(by_rank.max(initial=0)) + 1, dtype=np.uint32)
    rank[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    shards = int(used.sum() // SHARD_IDS) + 1
    share = [k / shards for k in range(1, shards)]
    bounds = sorted(set(tokenised.approxQuantile("doc_id", share, 1 / (8 * shards)))) if share else []

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_in = np.asarray(batch.column(0).fill_null(-(2**63)))
            shard = np.searchsorted(np.array(bounds, dtype=np.float64), docs_in, side="left")
            n = np.asarray(batch.column(1))
            both = pack_documents(rank[_ids(batch.column(2), n)], n)
            columns = [pa.array(shard, pa.int32()), batch.column(0), batch.column(1), *both]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "doc_id", "n", "control", "data"])

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "block", "first", "n", "docs", "counts", "control", "data"]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        kinds += [pa.binary(), pa.binary()]
        rows: list[tuple] = []
        shard, number, first, held = None, 0, 0, []

        def close() -> None:
            nonlocal held, number, first
            if held:
                ids, counts, control, data = zip(*held)
                n = sum(counts)
                rows.append((shard, number, first, n, list(ids), list(counts), b"".join(control), b"".join(data)))
                held, number, first = [], number + 1, first + n

        def batch_of() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)
            rows.clear()
            return batch

        for batch in batches:
            size = 0
            for own, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if own != shard or size >= BLOCK_IDS:
                    close()
                    size = 0
                    if own != shard:
                        shard, number, first = own, 0, 0
                held.append(row)
                size += row[1]
            close()
            if rows:
                yield batch_of()

    schema = "shard int, doc_id long, n int, control binary, data binary"
    ordered = (
        tokenised.select(F.col("doc_id").cast("long"), "n", "ids")
        .mapInArrow(encode, schema)
        .repartition(shards, "shard")
        .sortWithinPartitions("shard", "doc_id", "n", "control", "data")
    )
    blocks = "shard int, block int, first long, n long, docs array<long>, counts array<int>"
    blocks += ", control binary, data binary"
    ordered.mapInArrow(block, blocks).write.option("compression", "zstd").parquet(out)
    return by_rank


def read_files(spark: SparkSession, out: str, by_rank: np.ndarray) -> DataFrame:
    """Decode token files: ``doc_id, start, n_tokens, ids_crc32`` of each document.

    ``start`` counts the ids of all documents before it: what the shard holds before the block, and
    the sums of the shards before, of which there are few.
    """
    files = spark.read.parquet(out)
    shards = files.groupBy("shard").agg(F.sum("n").alias("n"))
    shards = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))
    placed = files.join(F.broadcast(shards), "shard").withColumn("start", F.col("base") + F.col("first"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, counts, control, data, start in zip(*(c.to_pylist() for c in batch.columns)):
                ids = by_rank[unpack_values(control, data, counts)].astype("<u4")
                ends = np.cumsum(counts)
                sums = [zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(ends, counts)]
                columns = [pa.array(docs, pa.int64()), pa.array(start + ends - counts), pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(sums, pa.int64())], names=names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    columns = ["docs", "counts", "control", "data", "start"]
    return placed.select(*columns).mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """Write token files to a scratch folder and read them back."""
    spark = docs.sparkSession
    out = new_scratch_table(spark, "token-files")
    return read_files(spark, out, write_files(docs, path, end_id, out))
