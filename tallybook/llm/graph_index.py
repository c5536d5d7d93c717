"""Approximate nearest neighbours by inner product: a robust-pruned directed graph in each shard.

Vectors are dealt to shards of bounded size, whose vectors are about equally long. A shard's graph grows by batches: a greedy beam search
from the middle of the shard proposes neighbours for each new vector, pruning keeps a proposal only
if no kept neighbour is much closer to it, and edges are made both ways, pruned again where a
vector gets too many. A query walks the graph of every shard with a beam; the best of all shards
are ranked by the exact inner product.

Inner product becomes distance by one more component that gives all vectors of a shard the same
length. Queries have nothing there, so that component has to be small or they lie far from all that
the graph was built for: a shard holds one band of lengths, or several that are small together, where
the beam sees nearly every node. Equal vectors are one node, which lists as many of its ids as an answer can need.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .vectors import matrix, packed, usable

#: Vectors of a shard and queries of a block, about.
SHARD, QUERIES = 8192, 512
#: Tasks that the query blocks of a shard are dealt to, at most.
DEALS = 8
#: Edges of a node, width of the beam when building and searching, relaxation of the pruning.
EDGES, BUILD_BEAM, SEARCH_BEAM, RELAX = 32, 64, 160, 1.2
#: Longest to shortest vector of a band of lengths; up to how many vectors (a beam holds them all)
#: and over how many bands (lengths by a factor of 20) bands share a shard.
BAND, FEW, REACH = 1.05, SEARCH_BEAM, 60
#: Nodes without a way from the start that a node takes in a round.
SPARE = 4
#: Beam entries that are expanded at a time.
EXPAND = 4


def beam(edges: np.ndarray, points: np.ndarray, start: int, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy search of many queries at once: the nodes found, nearest first, and their distances
    (squared, without the query's own length); -1 where there are fewer."""
    squares = (points**2).sum(axis=1)
    m = len(queries)
    ids = np.full((m, width), -1, dtype=np.int64)
    far = np.full((m, width), np.inf, dtype=np.float32)
    done = np.zeros((m, width), dtype=bool)
    ids[:, 0] = start
    far[:, 0] = squares[start] - 2 * queries @ points[start]
    while True:
        waiting = np.where(done | (ids < 0), np.inf, far)
        rows = np.flatnonzero(np.isfinite(waiting).any(axis=1))
        if not len(rows):
            return ids, far
        pick = np.argpartition(waiting[rows], min(EXPAND, width) - 1, axis=1)[:, :EXPAND]
        good = np.isfinite(np.take_along_axis(waiting[rows], pick, axis=1))
        current = np.where(good, np.take_along_axis(ids[rows], pick, axis=1), -1)
        opened = done[rows]
        np.put_along_axis(opened, pick, np.take_along_axis(opened, pick, axis=1) | good, axis=1)
        found = np.where(current[:, :, None] >= 0, edges[current], -1).reshape(len(rows), -1)
        found.sort(axis=1)  # the same node may be met twice
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        found[(found[:, :, None] == ids[rows][:, None, :]).any(axis=2)] = -1
        distance = squares[found] - 2 * np.einsum("ad,ard->ar", queries[rows], points[found])
        distance[found < 0] = np.inf
        all_far = np.concatenate((far[rows], distance.astype(np.float32)), axis=1)
        best = np.argsort(all_far, axis=1, kind="stable")[:, :width]
        far[rows] = np.take_along_axis(all_far, best, axis=1)
        merged = np.take_along_axis(np.concatenate((ids[rows], found), axis=1), best, axis=1)
        ids[rows] = np.where(np.isfinite(far[rows]), merged, -1)
        fresh = np.zeros(found.shape, dtype=bool)
        done[rows] = np.take_along_axis(np.concatenate((opened, fresh), axis=1), best, axis=1)


def prune(points: np.ndarray, node: int, proposed: np.ndarray, relax: float = RELAX) -> np.ndarray:
    """Diverse near neighbours: a proposal goes if one kept before is ``relax`` times closer to it
    than the node is."""
    proposed = np.unique(proposed[(proposed >= 0) & (proposed != node)])
    own = points[proposed]
    away = ((own - points[node]) ** 2).sum(axis=1)
    order = np.argsort(away, kind="stable")
    proposed, own, away = proposed[order], own[order], away[order]
    norms = (own**2).sum(axis=1)
    between = norms[:, None] + norms[None, :] - 2 * own @ own.T
    closer = relax**2 * between <= away[None, :]
    alive, kept = np.ones(len(proposed), dtype=bool), []
    for k in range(len(proposed)):
        if alive[k]:
            kept.append(k)
            if len(kept) == EDGES:
                break
            alive &= ~closer[k]
    return proposed[kept]


def build(points: np.ndarray) -> tuple[np.ndarray, int]:
    """Edges of each point, -1 where there are fewer, and the point to start from."""
    n = len(points)
    start = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    edges = np.full((n, EDGES), -1, dtype=np.int32)
    order = np.random.default_rng(5).permutation(n)
    order = np.concatenate(([start], order[order != start]))
    done = 1
    while done < n:
        batch = order[done : done + min(max(done, 16), 256)]
        found, _ = beam(edges, points, start, points[batch], BUILD_BEAM)
        # those of a batch don't see each other in the graph: the nearest are proposed as well
        near = ((points[batch] ** 2).sum(axis=1)[None, :] - 2 * points[batch] @ points[batch].T).argsort(axis=1)[:, : EDGES // 2]
        back: dict[int, list[int]] = {}
        for k, node in enumerate(batch.tolist()):
            kept = prune(points, node, np.concatenate((found[k], batch[near[k]])))
            edges[node, : len(kept)] = kept
            edges[node, len(kept) :] = -1
            for other in kept.tolist():
                back.setdefault(other, []).append(node)
        for node, more in back.items():
            own = edges[node][edges[node] >= 0]
            both = np.unique(np.concatenate((own, more)))
            if len(both) > EDGES:
                both = prune(points, node, both)
            edges[node, : len(both)] = both
            edges[node, len(both) :] = -1
        done += len(batch)
    return _connected(edges, points, start), start


def _connected(edges: np.ndarray, points: np.ndarray, start: int) -> np.ndarray:
    """``edges`` and, in columns of their own, one to each node that pruning left without a way from
    the start: long vectors lie apart, and are what most queries look for."""
    while True:
        reached = np.zeros(len(points), dtype=bool)
        front = np.array([start])
        while len(front):
            reached[front] = True
            front = np.unique(edges[front])
            front = front[front >= 0]
            front = front[~reached[front]]
        lost = np.flatnonzero(~reached)
        if not len(lost):
            return edges
        found, _ = beam(edges, points, start, points[lost], BUILD_BEAM)
        links: dict[int, list[int]] = {}
        for node, near in zip(lost.tolist(), found):
            free = (x for x in near[near >= 0].tolist() if len(links.get(x, ())) < SPARE)
            if (holder := next(free, None)) is not None:
                links.setdefault(holder, []).append(node)
        more = np.full((len(points), max(map(len, links.values()))), -1, dtype=edges.dtype)
        for holder, nodes in links.items():
            more[holder, : len(nodes)] = nodes
        edges = np.concatenate((edges, more), axis=1)


def _banded(own: DataFrame) -> DataFrame:
    """``own(vec_id, vector)`` with the vector's number of components and its band of lengths."""
    largest = F.array_max(F.transform("vector", F.abs))
    squares = F.aggregate(F.transform("vector", lambda x: (x / F.col("_m")) ** 2), F.lit(0.0), lambda a, x: a + x)
    length = F.log("_m") + F.log(squares) / 2
    band = F.floor(length / float(np.log(BAND)) + 0.5).cast("int")  # lengths about 1 are one band
    return own.withColumn("_m", largest).select("vec_id", "vector", F.size("vector").alias("size"), band.alias("band"))


def _layout(points: DataFrame) -> tuple[list[tuple[int, int, int, int]], dict[int, tuple[int, int]]]:
    """Shards of each band, ``(size, band, first, number)``, and first and last shard of each size.

    The driver sees one count for each occurring size and band of lengths; the range of a double
    has 29,000 bands.
    """
    counts = points.groupBy("size", "band").count().collect()
    bands, sizes, free, held, opened = [], {}, 0, 0, (0, 0)
    for size, band, n in sorted((r["size"], -r["band"], r["count"]) for r in counts):
        if free and held + n <= FEW and opened[0] == size and band - opened[1] < REACH:
            held += n
            bands.append((size, -band, free - 1, 1))
        else:
            number = -(-n // SHARD)
            bands.append((size, -band, free, number))
            free, held, opened = free + number, n, (size, band)
        sizes[size] = (sizes[size][0] if size in sizes else bands[-1][2], free - 1)
    return bands, sizes


def _graphs(points: DataFrame, shards: int, k: int) -> DataFrame:
    """One row a shard of ``points(vec_id, vector, size, shard)``: its distinct vectors, the smallest
    ids of each, and its graph."""

    def make(group: pa.Table) -> pa.Table:
        ids = np.asarray(group.column("vec_id").combine_chunks())
        vectors = matrix(group.column("vector").combine_chunks())
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        nodes, member = np.unique(vectors, axis=0, return_inverse=True)
        lists = np.split(ids[np.argsort(member, kind="stable")], np.cumsum(np.bincount(member))[:-1])
        lists = [x[: k + 1] for x in lists]
        edges, start = build(_lifted(_scaled(nodes)))
        row = {
            "shard": [int(group.column("shard")[0].as_py())], "size": [vectors.shape[1]], "start": [start],
            "nodes": [nodes.tobytes()], "edges": [edges.tobytes()],
            "ids": [np.concatenate(lists)], "counts": [np.array([len(x) for x in lists], dtype=np.int32)],
        }
        return pa.table(row, schema=kind)

    kind = pa.schema([
        ("shard", pa.int32()), ("size", pa.int32()), ("start", pa.int32()), ("nodes", pa.binary()),
        ("edges", pa.binary()), ("ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())),
    ])
    schema = "shard int, size int, start int, nodes binary, edges binary, ids array<long>, counts array<int>"
    dealt = points.select("vec_id", "vector", "shard").repartition(3 * shards, "shard")
    return dealt.groupBy("shard").applyInArrow(make, schema)


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors by their largest component, so that lengths of any scale have squares."""
    return vectors / np.abs(vectors).max()


def _lifted(vectors: np.ndarray) -> np.ndarray:
    squares = (vectors**2).sum(axis=1)
    return np.column_stack((vectors, np.sqrt(np.maximum(squares.max() - squares, 0)))).astype(np.float32)


def search(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """The ``k`` nearest of each query among all other rows of ``vectors(vec_id, embedding)``:
    ``query_id, rank, vec_id, score``.

    Queries are the rows whose vec_id is divisible by ``every``. Vectors that are null, zero or
    hold null or a component that isn't finite take no part, nor does a null vec_id. Vectors of
    different lengths don't meet. Ties go to the smaller vec_id. Of rows that share a vec_id the
    smallest vector stands for all. Other columns are ignored; without candidates a query has no
    rows.
    """
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), packed("embedding").alias("vector"))
    own = own.where("vec_id IS NOT NULL").where(usable("vector"))
    own = own.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    banded = stage(_banded(own), "banded")
    bands, sizes = _layout(banded)
    spark = vectors.sparkSession
    shards = 1 + max((last for _, last in sizes.values()), default=0)
    bands = spark.createDataFrame(bands, "size int, band int, first int, number int")
    sizes = spark.createDataFrame([(size, *ends) for size, ends in sizes.items()], "size int, first int, last int")
    shard = (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("number"))).cast("int")
    points = banded.join(bands, ["size", "band"]).select("vec_id", "vector", "size", shard.alias("shard"))
    graphs = stage(_graphs(points, shards, k), "graphs")
    asked = banded.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-asked.count() // QUERIES))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)))
    asked = asked.groupBy("size", "block").agg(F.collect_list(F.struct("vec_id", "vector")).alias("asked"))
    asked = asked.join(sizes, "size").withColumn("shard", F.explode(F.sequence("first", "last")))
    # the blocks of a shard are dealt to several tasks, in a number of parts that stays as it is
    deals = min(blocks, DEALS)
    asked = asked.select("shard", F.pmod("block", F.lit(deals)).cast("int").alias("deal"), "asked")
    asked = asked.repartition(deals * shards, "shard", "deal")
    copies = graphs.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))))
    copies = copies.repartition(deals * shards, "shard", "deal")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                size, start, nodes, edges, ids, counts, queries = (c[row] for c in batch.columns)
                points = np.frombuffer(nodes.as_buffer(), dtype=np.float64).reshape(-1, size.as_py())
                graph = np.frombuffer(edges.as_buffer(), dtype=np.int32).reshape(len(points), -1)
                ids, counts = ids.values.to_numpy(), counts.values.to_numpy()
                asking, vectors = np.asarray(queries.values.field(0)), matrix(queries.values.field(1))
                ways = vectors / np.abs(vectors).max(axis=1)[:, None]
                lifted = np.column_stack((ways, np.zeros(len(ways)))).astype(np.float32)
                found, _ = beam(graph, _lifted(_scaled(points)), start.as_py(), lifted, SEARCH_BEAM)
                ends = np.cumsum(counts)
                out: list[tuple[np.ndarray, ...]] = []
                for q, near in enumerate(found):
                    near = near[near >= 0]
                    score = points[near] @ vectors[q]
                    who = np.concatenate([ids[ends[x] - counts[x] : ends[x]] for x in near])
                    score = np.repeat(score, counts[near])
                    score, who = score[who != asking[q]], who[who != asking[q]]
                    best = np.lexsort((who, -score))[:k]
                    out.append((np.full(len(best), asking[q]), who[best], score[best]))
                columns = [pa.array(np.concatenate(x)) for x in zip(*out)]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

    met = asked.join(copies, ["shard", "deal"]).select("size", "start", "nodes", "edges", "ids", "counts", "asked")
    found = met.mapInArrow(look, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
