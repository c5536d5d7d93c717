"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut into halves, each half has a codebook, and pairs of centres form a grid of
cells. A vector is filed under its nearest centre of each half. To find its near-duplicates, cells
are visited by a multi-sequence walk over two sorted lists. They are sorted by how far the vector
is at least from any vector filed under a centre, so the walk can stop where the sum exceeds the
distance that the threshold allows: all links are found, not just a share. What shares a cell is
verified by cosine in double precision.

Equal vectors are one class. Classes of a cell meet in blocks of bounded size, whatever the cell
holds, and only links leave a block.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, lookup, stage
from .vectors import codebook, matrix, nearest, packed, usable

#: Vectors the codebooks are fitted on, about; all are indexed.
SAMPLE = 20_000
#: Vectors of a cell and label aimed at, centres of a half at most, and vectors of a block, about.
CELL, MOST_CENTRES, BLOCK = 64, 256, 256

Books = dict[int, tuple[np.ndarray, np.ndarray]]


def bounds_below(half: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each point, and for each centre the least squared distance between the
    point and anything filed there: that to the plane halfway between the two centres."""
    squared = nearest(half, centres)
    home = squared.argmin(axis=1)
    apart = np.sqrt(nearest(centres, centres))[home]
    ahead = squared - squared[np.arange(len(half)), home][:, None]
    plane = np.divide(ahead, 2 * apart, out=np.zeros_like(ahead), where=apart > 0)
    return home, np.maximum(plane, 0.0) ** 2


def walk(first: np.ndarray, second: np.ndarray, limit: float) -> Iterator[tuple[int, int]]:
    """Cells in the order of ``first[i] + second[j]``, up to ``limit``."""
    one, two = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = first[one].tolist(), second[two].tolist()
    heap = [(x[0] + y[0], 0, 0)]
    while heap and heap[0][0] <= limit:
        _, a, b = heapq.heappop(heap)
        yield int(one[a]), int(two[b])
        if b + 1 < len(y):
            heapq.heappush(heap, (x[a] + y[b + 1], a, b + 1))
        if b == 0 and a + 1 < len(x):
            heapq.heappush(heap, (x[a + 1] + y[0], a + 1, 0))


def fit_books(vectors: list[np.ndarray], centres: int) -> Books:
    """Codebooks of both halves for each length of vectors."""
    books: Books = {}
    for size in {len(v) for v in vectors}:
        units = np.array([v for v in vectors if len(v) == size])
        units /= np.linalg.norm(units, axis=1, keepdims=True)
        half = size // 2
        parts = (units[:, :half], units[:, half:])
        books[size] = tuple(codebook(p, centres) if p.shape[1] else np.zeros((1, 0)) for p in parts)
    return books


def _filed(classes: DataFrame, books: Books, limit: float) -> DataFrame:
    """``label, size, cell, class, vector, home``: each class under its home cell, and under the
    later cells that it has to visit."""

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column(1))
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                units = matrix(part.column(3))
                units = units / np.linalg.norm(units, axis=1, keepdims=True)
                half = int(size) // 2
                empty = np.zeros((1, half)), np.zeros((1, int(size) - half))
                books_of = books.get(int(size), empty)
                (a, first), (b, second) = (
                    bounds_below(h, book) for h, book in zip((units[:, :half], units[:, half:]), books_of)
                )
                width = len(books_of[1])
                homes, rows, cells = a * width + b, [], []
                for k, home in enumerate(homes):
                    visited = {i * width + j for i, j in walk(first[k], second[k], limit)} | {int(home)}
                    later = [c for c in visited if c >= home]
                    rows += [k] * len(later)
                    cells += later
                take = pa.array(rows, pa.int64())
                cell = np.array(cells, dtype=np.int64)
                columns = [part.column(0).take(take), part.column(1).take(take), pa.array(cell)]
                columns += [part.column(2).take(take), part.column(3).take(take), pa.array(cell == homes[rows])]
                yield pa.RecordBatch.from_arrays(columns, names=["label", "size", "cell", "class", "vector", "home"])

    schema = "label long, size int, cell long, class long, vector array<double>, home boolean"
    return classes.select("label", "size", "class", "vector").mapInArrow(file, schema)


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows of a cell in arrays of about BLOCK."""
    cell = ["label", "size", "cell"]
    counts = rows.groupBy(*cell).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = lookup(rows.select(*cell, "class", "vector"), counts, cell, "inner")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")))
    pair = F.collect_list(F.struct("class", "vector"))
    return dealt.groupBy(*cell, "block").agg(pair.alias("rows"))


def _links(classes: DataFrame, books: Books, threshold: float) -> DataFrame:
    """``a, b``: classes of one label whose cosine reaches the threshold, each pair once."""
    filed = stage(_filed(classes, books, 2 - 2 * threshold + 1e-9), "cells")
    filed_home = _blocks(filed.where("home")).withColumnRenamed("rows", "there")
    asking = _blocks(filed).withColumnRenamed("rows", "asks")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                there, asks = (batch.column(c)[k].values for c in (0, 1))
                ids, others = (np.asarray(x.field("class")) for x in (there, asks))
                x, y = (matrix(v.field("vector")) for v in (there, asks))
                x, y = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (x, y))
                i, j = np.nonzero(x @ y.T >= threshold)
                a, b = ids[i], others[j]
                keep = a != b  # two at home here are seen from either side
                columns = [pa.array(np.minimum(a, b)[keep]), pa.array(np.maximum(a, b)[keep])]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    met = filed_home.join(asking.drop("block"), ["label", "size", "cell"]).select("there", "asks")
    return met.mapInArrow(verify, "a long, b long").distinct()


def near_duplicates(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors(vec_id, embedding, label)``.

    Only vectors of one label and one length link. A null label, a vector that is null or zero, or
    one that holds null or a component that isn't finite links with nothing. Repeated rows and
    equal vectors link with each other like any others; rows of one vec_id are one node of a
    component. A null vec_id gets no component and isn't kept. Other columns are ignored.
    """
    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), packed("embedding").alias("vector"))
    able = F.col("label").isNotNull() & usable("vector")
    rows = rows.withColumn("class", F.when(able, F.xxhash64("label", "vector")))
    size = F.size(F.first("vector")).alias("size")
    classes = rows.where("class IS NOT NULL").groupBy("class").agg(
        F.first("label").alias("label"), size, F.first("vector").alias("vector"),
        F.count("*").alias("members"), F.min("vec_id").alias("first"),
    )
    classes = stage(classes, "vector-classes")
    counts = classes.groupBy("label").count().agg(F.sum("count"), F.count("*")).first()
    total, labels = counts[0] or 0, max(counts[1], 1)
    share = min(1.0, SAMPLE / max(total, 1))
    drawn = classes.where(F.pmod("class", F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select("vector").toArrow()
    centres = int(min(max(sqrt(total / labels / CELL), 2), MOST_CENTRES))
    books = fit_books([np.array(v.values, dtype=np.float64) for v in drawn.column(0)], centres)
    links = stage(_links(classes, books, threshold), "vector-links")

    info = classes.select("class", "members", "first")
    both = links.union(links.select("b", "a")).toDF("class", "other")
    others = info.select(F.col("class").alias("other"), F.col("members").alias("more"))
    degrees = lookup(both, others, ["other"], "inner").groupBy("class").agg(F.sum("more").alias("more"))
    info = info.join(degrees, "class", "left")
    info = info.select("class", "first", (F.col("members") - 1 + F.coalesce("more", F.lit(0))).alias("n"))
    info = stage(info, "vector-degrees")

    rows = rows.select("vec_id", "class")
    named = lookup(rows, info, ["class"])
    ends = lookup(links, info.select(F.col("class").alias("a"), F.col("first").alias("x")), ["a"], "inner")
    ends = lookup(ends, info.select(F.col("class").alias("b"), F.col("first").alias("y")), ["b"], "inner")
    nodes = ends.select("x", "y").union(named.select("first", "vec_id")).toDF("a", "b").dropna().distinct()
    roots = components(nodes).toDF("vec_id", "root")
    out = lookup(named, roots, ["vec_id"])
    component = F.coalesce("root", "vec_id").cast("long")
    return out.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
