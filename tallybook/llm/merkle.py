"""Merkle manifest of a table: roots, inclusion proofs, and proofs of altered rows.

Leaves of one language form a tree of runs of eight in the order of doc_id; the roots of these trees
form one more. Only every few levels are stored: an aligned subtree is one row that holds the nodes at
its bottom. The nodes between are made again whenever a subtree is climbed or descended, and discarded.

Up: each stored subtree yields its top, the tops are cut into subtrees again, until every tree is one
node. Down: a subtree meets the path of its top, regrows its interior and gives each of its nodes the
siblings of these levels, with the path of the top behind them.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup, stage

FANOUT = 8
#: Levels from one stored one to the next; a subtree has at most FANOUT ** LEVELS nodes at its bottom.
LEVELS = 2
BLOCK = FANOUT**LEVELS
#: Hex digits of a digest.
WIDE = 64

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(**changed: Column) -> Column:
    """Digest of a row: each field as its length in bytes, a colon and the value, ``-`` if null."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``idx``, their place in their tree from 0, and ``total``, its number of nodes.

    Rows are dealt out by range, so a tree may lie in any number of tasks; what goes before a
    task's share of a tree is summed over the shares.
    """
    placed = nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = stage(placed.withColumn("row", F.monotonically_increasing_id()), "ordered")
    placed = placed.withColumn("share", F.shiftright("row", 33))
    shares = placed.groupBy("tree", "share").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("tree").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select(
        "tree",
        "share",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(Window.partitionBy("tree")).alias("total"),
    )
    # stored, the shares lie by no key, and the join deals nodes out by share and not by tree alone
    numbered = placed.join(stage(shares, "shares"), ["tree", "share"])
    return numbered.withColumn("idx", F.col("row") + F.col("shift")).drop("row", "share", "shift")


def _blocks(nodes: DataFrame, name: str) -> DataFrame:
    """Aligned subtrees, one a row: ``tree, block, total, nodes``, the nodes in order."""
    rest = [c for c in nodes.columns if c not in ("tree", "idx", "total")]
    node = F.struct("idx", *rest).alias("node")
    block = F.expr(f"idx div {BLOCK}").alias("block")
    grouped = nodes.select("tree", block, "total", node).groupBy("tree", "block")
    return stage(grouped.agg(F.first("total").alias("total"), F.sort_array(F.collect_list("node")).alias("nodes")), name)


def _above(total: int) -> int:
    return -(-total // FANOUT)


def _regrow(nodes: list[str], total: int) -> list[list[str]]:
    """A subtree's levels from its stored nodes up; ``total`` nodes of the whole tree are on the first."""
    levels = [nodes]
    while len(levels) <= LEVELS and total > 1:
        below, total = levels[-1], _above(total)
        levels.append([_digest("".join(below[k : k + FANOUT])) for k in range(0, len(below), FANOUT)])
    return levels


def _paths(nodes: list[str], total: int) -> Iterator[tuple[list[int], list[str]]]:
    """For each stored node of a subtree its place in its run and the run's others, level by level."""
    runs = [
        ["".join(level[k : k + FANOUT]) for k in range(0, len(level), FANOUT)] for level in _regrow(nodes, total)[:-1]
    ]
    for k in range(len(nodes)):
        places, siblings = [], []
        for level in runs:
            k, place = divmod(k, FANOUT)
            places.append(place)
            siblings.append(level[k][: WIDE * place] + level[k][WIDE * (place + 1) :])
        yield places, siblings


def folded(node: str, places: list[int], siblings: list[str]) -> str:
    """The root that a node and its siblings lead to."""
    for place, others in zip(places, siblings):
        node = _digest(others[: WIDE * place] + node + others[WIDE * place :])
    return node


def _subtrees(column: pa.ListArray, names: list[str]) -> Iterator[tuple[list, ...]]:
    """Each row's values of the named fields of its nodes."""
    at = column.offsets.to_pylist()
    flat = column.flatten()
    fields = [flat.field(n).to_pylist() for n in names]
    for a, b in zip(at[:-1], at[1:]):
        yield tuple(f[a - at[0] : b - at[0]] for f in fields)


def _tops(blocks: DataFrame) -> DataFrame:
    """The top of each subtree as a node of the next stored level: ``tree, idx, total, digest``."""

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, tops = [], []
            for total, (nodes,) in zip(batch.column("total").to_pylist(), _subtrees(batch.column("nodes"), ["digest"])):
                levels = _regrow(nodes, total)
                tops.append(levels[-1][0])
                for _ in levels[1:]:
                    total = _above(total)
                totals.append(total)
            columns = [batch.column("tree"), batch.column("block"), pa.array(totals, pa.int64()), pa.array(tops, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["tree", "idx", "total", "digest"])

    return blocks.mapInArrow(climb, "tree string, idx long, total long, digest string")


def _grow(leaves: DataFrame, order: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """Stored levels of every tree, the lowest first, and the roots ``tree, digest``."""
    levels = [_blocks(_numbered(leaves, order), "subtrees")]
    tops = stage(_tops(levels[0]), "tops")
    while not tops.where("total > 1").isEmpty():
        levels.append(_blocks(tops, "subtrees"))
        tops = stage(_tops(levels[-1]), "tops")
    return levels, tops.select("tree", "digest")


def _met(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    return blocks.join(paths.withColumnRenamed("idx", "block"), ["tree", "block"])


_PATH = "places array<int>, siblings array<string>, subroot string, root string"


def _descend(blocks: DataFrame, paths: DataFrame, key: str) -> DataFrame:
    """Paths of the nodes of one stored level, from the paths of the tops of its subtrees.

    ``key`` is the field of a node that the result names it by.
    """
    kind = blocks.schema["nodes"].dataType.elementType[key].dataType

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["tree", key, "places", "siblings", "subroot", "root"]
        for batch in batches:
            rows: list[tuple] = []
            given = [batch.column(c).to_pylist() for c in ("tree", "total", "places", "siblings", "subroot", "root")]
            for (tree, total, places, siblings, *roots), (keys, nodes) in zip(
                zip(*given), _subtrees(batch.column("nodes"), [key, "digest"])
            ):
                for own, (p, s) in zip(keys, _paths(nodes, total)):
                    rows.append((tree, own, p + places, s + siblings, *roots))
            kinds = [pa.string(), pa.int64() if key == "idx" else pa.string(), pa.list_(pa.int32()), pa.list_(pa.string())]
            kinds += [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names
            )

    schema = f"tree string, {key} {kind.simpleString()}, {_PATH}"
    return _met(blocks, paths).mapInArrow(extract, schema)


def _proven(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """The result rows of all leaves, made where their subtree is descended."""
    kind = blocks.schema["nodes"].dataType.elementType["doc_id"].dataType.simpleString()

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        for batch in batches:
            ids = batch.column("nodes").flatten().field("doc_id")
            rows: list[tuple] = []
            given = [batch.column(c).to_pylist() for c in ("total", "places", "siblings", "subroot", "root")]
            for (total, places, siblings, subroot, root), (nodes, altered) in zip(
                zip(*given), _subtrees(batch.column("nodes"), ["digest", "altered"])
            ):
                for node, other, (p, s) in zip(nodes, altered, _paths(nodes, total)):
                    proof = s + siblings
                    found = folded(other or node, p + places, proof)
                    rows.append((node, subroot, root, _digest("".join(proof)), found, found == root))
            kinds = [pa.string()] * 5 + [pa.bool_()]
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([ids, *columns], names=names)

    schema = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _met(blocks, paths).mapInArrow(extract, schema)


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for each row of docs.

    Leaves digest ``doc_id, source, lang, n_chars, text``; other columns are ignored. Leaves of a lang
    ascend by doc_id, a null one first, rows of one doc_id by their digest, so equal rows share leaf
    and fold but each has a place. Langs ascend bytewise, null first; an empty lang is not a null one.
    ``folded_root`` is the root that a row leads to whose A-Z were lower-cased, where 3 divides the
    crc32 of its doc_id (a null doc_id isn't altered); ``verified`` says that it is the true one, as
    it is where nothing changed: null and empty texts, texts without A-Z. An empty table has no rows.
    """
    lower = F.translate("text", _UPPER, _LOWER)
    altered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, leaf(text=lower))
    # "=" before a lang keeps the order and leaves the empty name to null
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree")
    leaves = docs.select(tree, "doc_id", leaf().alias("digest"), altered.alias("altered"))
    # stored first, so the sample of the range partitioning doesn't read the texts again
    levels, subroots = _grow(stage(leaves, "leaves"), ["doc_id", "digest"])
    branches = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("branch"), "digest")
    upper, root = _grow(branches, ["branch"])

    none = [F.array().cast("array<int>").alias("places"), F.array().cast("array<string>").alias("siblings")]
    paths = root.select("tree", F.lit(0).cast("long").alias("idx"), *none, F.lit("").alias("subroot"), F.col("digest").alias("root"))
    for blocks in reversed(upper[1:]):
        paths = _descend(blocks, paths, "idx")
    paths = _descend(upper[0], paths, "branch").drop("tree", "subroot")
    named = subroots.select(F.col("tree").alias("branch"), F.col("digest").alias("subroot"))
    paths = lookup(paths, named, ["branch"], "inner").select(
        F.col("branch").alias("tree"), F.lit(0).cast("long").alias("idx"), "places", "siblings", "subroot", "root"
    )
    for blocks in reversed(levels[1:]):
        paths = _descend(blocks, paths, "idx")
    return _proven(levels[0], paths)


def _level_sql(prefix: str, levels: int) -> list[str]:
    """The levels ``{prefix}1 …`` above ``{prefix}0(tree, i, h, n)``; a tree of one node stays."""
    return [
        f"""{prefix}{k + 1} AS (
  SELECT tree, i // 8 AS i, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h,
         (any_value(n) + 7) // 8 AS n
  FROM {prefix}{k} GROUP BY tree, i // 8)"""
        for k in range(levels)
    ]


def _fold_sql(source: str, prefix: str, levels: int) -> tuple[list[str], str]:
    """Steps that carry ``source(…, tree, i, f, proof)`` through the levels of ``prefix``."""
    steps, last = [], source
    for k in range(levels):
        runs = f"(SELECT tree, i // 8 AS run, string_agg(h, '' ORDER BY i) AS all_h, any_value(n) AS n FROM {prefix}{k} GROUP BY ALL)"
        own = "64 * (s.i % 8)::INTEGER"
        steps.append(
            f"""{source}_{k} AS (
  SELECT s.* REPLACE (s.i // 8 AS i,
    CASE WHEN r.n = 1 THEN f ELSE sha256(substr(all_h, 1, {own}) || f || substr(all_h, {own} + 65)) END AS f,
    CASE WHEN r.n = 1 THEN proof ELSE proof || substr(all_h, 1, {own}) || substr(all_h, {own} + 65) END AS proof)
  FROM {last} s JOIN {runs} r ON s.tree = r.tree AND s.i // 8 = r.run)"""
        )
        last = f"{source}_{k}"
    return steps, last


def _sql() -> str:
    def digest(text: str) -> str:
        fields = [text if f == "text" else f"{f}::VARCHAR" for f in FIELDS]
        return f"sha256({' || '.join(f'''coalesce(octet_length(encode({f})) || ':' || {f}, '-')''' for f in fields)})"

    lower = f"translate(text, '{_UPPER}', '{_LOWER}')"
    # CRC-32 bit by bit; 3988292384 is its polynomial, reversed
    step = "list_reduce([xor(c, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda x, j: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)"
    digits = "[4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)"
    crc = f"xor(list_reduce({digits}, lambda c, b: {step}), 4294967295)"
    depth, wide = 8, 4
    fold, folded_ = _fold_sql("p", "t", depth)
    upper, done = _fold_sql("u", "r", wide)
    parts = [
        f"""d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {digest('text')} AS leaf,
         CASE WHEN {crc} % 3 = 0 THEN {digest(lower)} ELSE {digest('text')} END AS given
  FROM documents)""",
        """o AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         count(*) OVER (PARTITION BY tree) AS n
  FROM d)""",
        "t0 AS (SELECT tree, i, leaf AS h, n FROM o)",
        *_level_sql("t", depth),
        f"b AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM t{depth})",
        "r0 AS (SELECT '' AS tree, i, h, n FROM b)",
        *_level_sql("r", wide),
        "p AS (SELECT doc_id, leaf, tree, i, given AS f, '' AS proof FROM o)",
        *fold,
        f"""u AS (
  SELECT p.doc_id, p.leaf, '' AS tree, b.i, p.f, p.proof, b.h AS subroot FROM {folded_} p JOIN b ON p.tree = b.tree)""",
        *upper,
    ]
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT u.doc_id, u.leaf, u.subroot, x.h AS root, sha256(u.proof) AS proof_sha256, u.f AS folded_root, u.f = x.h AS verified
FROM {done} u CROSS JOIN r{wide} x"""
    )


SQL = _sql()
