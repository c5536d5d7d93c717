"""Helpers shared by the operators: joins on hot keys, linked groups, word hashes of batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.session import configure as configure_session
from tallybook.session import stage

__all__ = ["components", "configure", "lookup", "stage", "table", "text_chunks", "word_hashes"]

#: A lookup's small side is repeated this often, its large side dealt out as often.
SALTS = 4
#: Bytes of text that the numpy helpers work on at once; one longer text is taken alone.
CHUNK = 1 << 19
#: Bytes of rows that Spark hands to Python at once, so that a batch of long texts is as small as one
#: of short ones; what encodes words once a batch is given more of them.
BATCH_BYTES, WORD_BATCH_BYTES = "4m", "16m"


def configure(spark: SparkSession) -> SparkSession:
    return in_batches(configure_session(spark))


def in_batches(spark: SparkSession, size: str = BATCH_BYTES) -> SparkSession:
    """From here on plans hand rows to Python in batches of this size."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lookup(
    large: DataFrame, small: DataFrame, on: list[str], how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Join ``large`` with ``small``, which has one row a key, although keys of ``large`` may be hot.

    The salt comes from the row itself, so a recomputed task deals its rows out alike.
    """
    salted = large.withColumn("_salt", F.pmod(F.xxhash64(*large.columns), F.lit(salts)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def components(links: DataFrame) -> DataFrame:
    """Connected groups of ``links(a, b)``: ``(id, root)``, root the smallest id of the group.

    Each round moves every id to its smallest neighbour and contracts the links, which leaves
    at most half of the ids; ids without a link don't appear. Rounds are stored tables, so a
    lost executor repeats one round at most.
    """
    spark = links.sparkSession
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    edges = stage(links.where("a <> b").select(*ends).distinct(), "links")
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        nearest = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("b"))
        moved = stage(nearest.select("id", F.least("id", "b").alias("root")), "moved")
        rounds.append(moved)
        edges = lookup(edges, moved.toDF("a", "x"), ["a"], "inner")
        edges = lookup(edges, moved.toDF("b", "y"), ["b"], "inner")
        ends = [F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")]
        edges = stage(edges.where("x <> y").select(*ends).distinct(), "links")
    if not rounds:
        kind = links.schema["a"].dataType.simpleString()
        return spark.createDataFrame([], f"id {kind}, root {kind}")
    roots = rounds.pop()
    while rounds:
        upper = rounds.pop().toDF("id", "via")
        joined = lookup(upper, roots.toDF("via", "root"), ["via"])
        roots = stage(joined.select("id", F.coalesce("root", "via").alias("root")), "roots")
    return roots


# ---------------------------------------------------------------- words and their hashes

_SEED = np.random.default_rng(20240229)
_BYTE = _SEED.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_UNDO = pow(_BASE, -1, 2**64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_chunks(texts: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Parts of a string column: first row, all bytes, and where each row's bytes begin and end."""
    texts = texts.fill_null("").cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word (A-Z lower-cased, split at ASCII white space), its start and end byte,
    and where each row's words begin and end."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    before = np.concatenate(([False], inside[:-1])) & ~edge[:-1]
    after = np.concatenate((inside[1:], [False])) & ~edge[1:]
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    if len(data):
        powers = np.cumprod(np.full(len(data), _BASE, dtype=np.uint64))
        np.cumsum(_BYTE[data] * powers, out=sums[1:])
    undo = np.cumprod(np.full(len(data) + 1, _UNDO, dtype=np.uint64))
    hashes = mix((sums[ends] - sums[starts]) * undo[starts])
    return hashes, starts, ends, np.searchsorted(starts, bounds)


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words."""
    n = len(words) - width + 1
    total = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(width if n > 0 else 0):
        total = total * np.uint64(_BASE) + words[k : k + n]
    return mix(total)
