"""Best-fit packing of token sequences by exact complements.

Only lengths decide how pieces are packed, and there are at most ``width`` different ones. So the
plan is made over counts by length: a few thousand steps, each for any number of equal sequences.
Spark counts the pieces, numbers those of one length, and looks up each piece's place in the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_BATCH_BYTES, in_batches, stage
from .subwords import encoder

#: Pieces of one length are numbered in this many parts, so a hot length is no single task.
PARTS = 256


class _Gaps:
    """Which lengths are left, and which sums one, two or three of them make."""

    def __init__(self, counts: np.ndarray) -> None:
        self.left = counts.astype(np.int64).copy()
        self.left[0] = 0
        self.used = np.zeros(len(counts), dtype=np.int64)
        self.width = len(counts) - 1
        self.index()

    def index(self) -> None:
        """Which sums two lengths make; valid until a length runs out."""
        self.there = self.left > 0
        twice = np.convolve(self.there.astype(np.int32), self.there.astype(np.int32))
        self.pairs = twice[: self.width + 1] > 0
        self.valid = self.there.sum()

    def enough(self, lengths: tuple[int, ...]) -> bool:
        return all(self.left[x] >= lengths.count(x) for x in lengths)

    def exact(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three lengths that fill the gap, the largest first."""
        if self.there[gap]:
            return (gap,)
        if self.pairs[gap]:
            for a in np.flatnonzero(self.there[1:gap] & self.there[1:gap][::-1])[::-1] + 1:
                if a < gap - a:
                    break
                if self.enough((int(a), gap - int(a))):
                    return int(a), gap - int(a)
        for a in np.flatnonzero(self.there[1:gap] & self.pairs[1:gap][::-1])[::-1] + 1:
            rest = gap - int(a)
            firsts = np.flatnonzero(self.there[1:rest] & self.there[1:rest][::-1]) + 1
            for b in firsts[2 * firsts >= rest][::-1][:4]:
                if self.enough(three := (int(a), int(b), rest - int(b))):
                    return three
        return None

    def largest(self, gap: int) -> int:
        below = np.flatnonzero(self.there[: gap + 1])
        return int(below[-1]) if len(below) else 0

    def take(self, length: int, n: int) -> int:
        """Hand out ``n`` pieces of a length; returns the number of the first."""
        first = int(self.used[length])
        self.used[length] += n
        self.left[length] -= n
        return first


def plan(counts: np.ndarray) -> np.ndarray:
    """Rows ``(length, first, n, sequence, offset)``: pieces ``first`` to ``first + n - 1`` of that
    length go to ``n`` sequences from ``sequence`` on, each at ``offset``.

    ``counts[l]`` is how many pieces of length ``l`` there are. The longest piece left opens
    sequences; their gap goes to one, two or three lengths that fill it exactly, else to the
    longest that fits, and what then remains is a gap again.
    """
    gaps, rows, sequences = _Gaps(counts), [], 0
    width = gaps.width
    for length in range(width, 0, -1):
        while gaps.left[length]:
            n = max(1, int(gaps.left[length]) // (width // length))
            rows.append((length, gaps.take(length, n), n, sequences, 0))
            todo = [(width - length, n, sequences)]
            sequences += n
            while todo:
                gap, n, first = todo.pop()
                if gaps.valid != (gaps.left > 0).sum():
                    gaps.index()
                chosen = gaps.exact(gap) if gap else None
                if chosen is None:
                    fit = gaps.largest(gap)
                    if not fit:
                        continue
                    chosen = (fit,)
                m = min(n, *(int(gaps.left[x]) // chosen.count(x) for x in chosen))
                offset = width - gap
                for x in chosen:
                    rows.append((x, gaps.take(x, m), m, first, offset))
                    offset += x
                if width > offset:
                    todo.append((width - offset, m, first))
                if n > m:
                    todo.append((gap, n - m, first + m))
    return np.array(rows, dtype=np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, path: str, width: int, end_id: int) -> DataFrame:
    """Token pieces of whole texts: ``doc_id, piece, start, length, ids_crc32``.

    A document longer than ``width`` is cut so that all pieces but the first are full.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        for batch in batches:
            docs_at, numbers, starts, lengths, sums = [], [], [], [], []
            for k, ids in enumerate(words.encode(batch.column(1))):
                ids = np.append(ids, end_id).astype("<u4")
                first = (len(ids) - 1) % width + 1
                begin = 0
                for number, end in enumerate(range(first, len(ids) + 1, width)):
                    docs_at.append(k)
                    numbers.append(number)
                    starts.append(begin)
                    lengths.append(end - begin)
                    sums.append(zlib.crc32(ids[begin:end].tobytes()))
                    begin = end
            columns = [batch.column(0).take(pa.array(docs_at, pa.int64())), pa.array(numbers, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (starts, lengths, sums)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def pack(docs: DataFrame, path: str, width: int = 2048, end_id: int = 0) -> DataFrame:
    """Pack the token pieces of ``docs(doc_id, text)`` into sequences of at most ``width`` tokens.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. A null or empty text
    is its end id alone; repeated rows and ids are packed as often as they come; other columns are
    ignored; an empty table gives no rows. Equal pieces are told apart by their number only.
    """
    in_batches(docs.sparkSession, WORD_BATCH_BYTES)
    cut = stage(pieces(docs, path, width, end_id), "pieces")
    in_batches(docs.sparkSession)
    cut = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(PARTS)).cast("int"))
    counts = cut.groupBy("length", "part").count()
    upto = Window.partitionBy("length").orderBy("part")  # at most PARTS rows
    counts = counts.withColumn("base", F.sum("count").over(upto) - F.col("count"))
    counts = stage(counts, "lengths")
    total = np.zeros(width + 1, dtype=np.int64)
    for row in counts.groupBy("length").agg(F.sum("count").alias("n")).collect():  # <= width rows
        total[row["length"]] = row["n"]
    rows = plan(total)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    keys = (rows[:, 0] << 44) + rows[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (np.asarray(batch.column(k)) for k in (3, 5))
            at = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            columns = [*batch.columns[:5], pa.array(rows[at, 3] + rank - rows[at, 1]), pa.array(rows[at, 4])]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:5], "sequence_id", "offset"])

    own = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = cut.withColumn("number", F.row_number().over(own)).join(
        counts.select("length", "part", "base").hint("merge"), ["length", "part"]
    )
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ranked = ranked.select(*columns, (F.col("base") + F.col("number") - 1).alias("rank"))
    kind = cut.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(place, schema)
