"""Near-duplicate documents: banded MinHash, sequential Bayesian verification, exact check.

1. One pass makes each text's set of word shingles, its hash and its MinHash signature. Texts with
   equal sets form a class; only classes go on.
2. Classes that agree on a band of the signature are candidates. A class first meets two others of
   each of its buckets, which connects almost all that belongs together, whatever a bucket's size.
   Linked classes then are one group, and a bucket of a single group is done.
3. In the buckets that are left every class meets all of other groups, once: in the first band that
   the two share. A bucket is cut into blocks, its largest group by itself, and each cell compares
   one block with another, so neither a task nor a row grows with the bucket, and pairs are only
   written if they survive.
4. A pair's signatures are compared in batches. It is dropped once the posterior probability that
   its similarity reaches the threshold falls below the chosen miss probability; what survives is
   verified on the full shingle sets. Shingles that no other class holds can't be shared, so pairs
   that have too many of them are dropped before.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, lookup, mix, run_hashes, stage, text_chunks, word_hashes

WIDTH = 5  # words of a shingle
BANDS, ROWS = 40, 5
#: Similarity as a fraction: 100 * intersection >= 75 * union.
PERCENT = 75
#: Values compared at once, and the probability at which a pair is given up.
BATCH, MISS = 25, 1e-5
#: Further values that are made for classes of open buckets only, and how many are compared at once.
MORE, MORE_BATCH = 400, 50
#: Classes of a block, on average, and how many of them are compared with a block at once.
BLOCK, ROWS_AT_ONCE = 1024, 64
#: Parts of a bucket of which a class meets the head of one, in the first round.
SLOTS = 16

_SEEDS = np.random.default_rng(7).integers(0, 2**63, (2, BANDS * ROWS), dtype=np.uint64) | np.uint64(1)
_MORE_SEEDS = np.random.default_rng(8).integers(0, 2**63, (2, MORE), dtype=np.uint64) | np.uint64(1)


def shingles(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the word runs; a shorter text is one run, no words are none."""
    return np.unique(run_hashes(words, min(width, len(words)))) if len(words) else words


def _least_values(own: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each of the hash functions."""
    least = np.full(seeds.shape[1], 2**64 - 1, dtype=np.uint64)
    for k in range(0, len(own), 256):
        values = (own[k : k + 256, None] ^ seeds[0]) * seeds[1]
        np.minimum(least, values.min(axis=0), out=least)
    return least


def signature(own: np.ndarray) -> np.ndarray:
    """16 bits of each of the smallest values."""
    return (_least_values(own, _SEEDS) >> np.uint64(40)).astype(np.uint16)


def more_signature(own: np.ndarray) -> np.ndarray:
    """Eight bits of each of the further values; equal by chance counts as a match, so nothing is lost."""
    return (_least_values(own, _MORE_SEEDS) >> np.uint64(40)).astype(np.uint8)


def least_matches(compared: int, threshold: float, miss: float) -> int:
    """Fewest matches among ``compared`` values that keep a pair.

    With a uniform prior, P(similarity >= t | m of n match) = P(Binomial(n + 1, t) <= m).
    """
    n, at_most = compared + 1, 0.0
    for m in range(compared + 1):
        at_most += comb(n, m) * threshold**m * (1 - threshold) ** (n - m)
        if at_most >= miss:
            return m
    return compared


def _sets(docs: DataFrame, with_signature: bool) -> DataFrame:
    """``doc_id, mark, n, class, data`` by text; data is the signature or the shingles, mark a hash
    of the text, which with doc_id tells a row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, bounds in text_chunks(batch.column(2)):
                words, _, _, edges = word_hashes(data, bounds)
                n, kinds, out = [], [], []
                for a, b in zip(edges[:-1], edges[1:]):
                    own = shingles(words[a:b])
                    n.append(len(own))
                    kinds.append(int(mix(np.add.reduce(own, keepdims=True) + np.uint64(len(own)))[0].astype(np.int64)))
                    out.append((signature(own) if with_signature else own).tobytes())
                columns = [batch.column(k).slice(first, len(n)) for k in (0, 1)]
                columns += [pa.array(n, pa.int64()), pa.array(kinds, pa.int64()), pa.array(out, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "n", "class", "data"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    return rows.mapInArrow(make, f"doc_id {kind}, mark long, n long, class long, data binary")


def _bands(classes: DataFrame) -> DataFrame:
    """``bucket, band, class, doc, n``: one row for each band of each class."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype=np.uint16)
            values = values.reshape(-1, BANDS, ROWS).astype(np.uint64)
            keys = np.broadcast_to(order, values.shape[:2])
            for k in range(ROWS):
                keys = mix(keys + values[:, :, k])
            again = pa.array(np.repeat(np.arange(batch.num_rows), BANDS))
            bands = pa.array(np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows))
            columns = [pa.array(keys.reshape(-1).astype(np.int64)), bands, *(c.take(again) for c in batch.columns[:3])]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "band", "class", "doc", "n"])

    return classes.select("class", "doc", "n", "data").mapInArrow(
        cut, "bucket long, band int, class long, doc long, n long"
    )


def _steps(first: int, upto: int, batch: int) -> list[tuple[int, int]]:
    """After how many values a pair is looked at, and the matches that it needs then."""
    return [(k, least_matches(k, PERCENT / 100, MISS)) for k in range(first + batch, upto + 1, batch)]


def _longer(sets: DataFrame) -> DataFrame:
    """``class, more``: the further values of each set."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [more_signature(np.frombuffer(v.as_buffer(), dtype=np.uint64)).tobytes() for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["class", "more"])

    return sets.select("class", "data").mapInArrow(make, "class long, more binary")


def _with_data(pairs: DataFrame, held: DataFrame) -> DataFrame:
    # the held side is the large one: it is not repeated, a hot class is split by the join
    one = pairs.join(held.select(F.col("class").alias("a"), F.col("data").alias("x")), "a")
    two = one.join(held.select(F.col("class").alias("b"), F.col("data").alias("y")), "b")
    return two.select("a", "b", "x", "y")


def _pruned(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of classes that their signatures don't rule out."""
    steps = _steps(0, BANDS * ROWS, BATCH)

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype=np.uint16).reshape(batch.num_rows, -1) for k in (2, 3))
            alive, matches, done = np.arange(batch.num_rows), np.zeros(batch.num_rows, dtype=np.int64), 0
            for upto, least in steps:
                matches += (x[alive, done:upto] == y[alive, done:upto]).sum(axis=1)
                keep = matches >= least
                alive, matches, done = alive[keep], matches[keep], upto
            yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(alive)) for k in (0, 1)], names=["a", "b"])

    return _with_data(pairs, signatures).mapInArrow(prune, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of classes whose similarity reaches the threshold."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for p, q in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (p, q))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(keep, pa.bool_())) for k in (0, 1)], names=["a", "b"])

    return _with_data(pairs, sets).mapInArrow(exact, "a long, b long")


def _common(sets: DataFrame) -> DataFrame:
    """``class, alone``: how many of a class's shingles no other class holds; none if it has none."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.frombuffer(v.as_buffer(), dtype=np.int64) for v in batch.column(1)]
            at = pa.array(np.repeat(np.arange(len(values)), [len(v) for v in values]))
            flat = np.concatenate([np.zeros(0, np.int64), *values])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(flat)], names=["class", "shingle"])

    rows = sets.select("class", "data").mapInArrow(spread, "class long, shingle long")
    held = rows.groupBy("shingle").agg(F.count("*").alias("c"), F.min("class").alias("class")).where("c = 1")
    return held.groupBy("class").agg(F.count("*").alias("alone"))


def _possible(a: str, b: str) -> Column:
    """Whether sizes, all and without what a class holds alone, allow the threshold for a pair.

    Of at most m common shingles the similarity is m / (n + other n - m) at most.
    """
    n, other, m = F.col(f"{a}n"), F.col(f"{b}n"), F.least(f"{a}common", f"{b}common")
    sized = F.least(n, other) * 100 >= F.greatest(n, other) * PERCENT
    return sized & (m * (100 + PERCENT) >= (n + other) * PERCENT)


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _links(classes: DataFrame, docs: DataFrame) -> DataFrame | None:
    """Links ``(a, b)`` between classes: every group of similar classes is connected by them."""
    entries = _bands(classes)
    shared = entries.groupBy("bucket").agg(F.min(F.struct("doc", "class")).alias("p"), F.count("*").alias("c"))
    shared = stage(shared.where("c > 1").select("bucket", F.col("p.class").alias("pivot")), "shared")
    entries = stage(lookup(entries, shared, ["bucket"], "inner"), "buckets")
    if entries.isEmpty():
        return None
    involved = entries.select("class", "doc", "n").distinct()
    sets = _sets(docs.join(involved.select(F.col("doc").alias("doc_id")).distinct(), "doc_id", "left_semi"), False)
    sets = sets.join(involved.select("class"), "class", "left_semi").dropDuplicates(["class"])
    sets = stage(sets.select("class", "data"), "shingles")
    alone = involved.select("class", "n").join(_common(sets), "class", "left")
    common = (F.col("n") - F.coalesce("alone", F.lit(0))).alias("common")
    held = classes.select("class", "data").join(alone.select("class", "n", common), "class")
    held = stage(held, "held")  # n and common say at a glance which pairs are possible

    # first, a class meets the earliest of each of its buckets and one more, picked by hash among
    # a few: so few pairs connect almost all that belongs together, whatever a bucket's size
    slot = F.pmod(F.xxhash64("class", "bucket"), F.lit(SLOTS))
    some = entries.groupBy("bucket", slot.alias("slot")).agg(F.min("class").alias("other"))
    asked = F.pmod(F.xxhash64("bucket", "class", "n"), F.lit(SLOTS))
    near = entries.withColumn("slot", asked).join(some, ["bucket", "slot"])
    pairs = near.select("class", "other").union(entries.select("class", "pivot")).toDF("x", "y").where("x <> y")
    pairs = pairs.select(_ordered("x", "y")).distinct()
    for end in ("a", "b"):
        sizes = held.select(F.col("class").alias(end), F.col("n").alias(f"{end}_n"), F.col("common").alias(f"{end}_common"))
        pairs = lookup(pairs, sizes, [end], "inner")
    pairs = pairs.where(_possible("a_", "b_")).select("a", "b")
    links = stage(_verified(_pruned(pairs, held), sets), "links")

    groups = components(links).toDF("class", "root")
    named = lookup(entries.select("bucket", "band", "class"), groups, ["class"])
    named = named.withColumn("root", F.coalesce("root", "class"))
    survivors = stage(_cells(named, held, sets), "pairs")
    return links.union(_verified(survivors, sets))


def _cells(named: DataFrame, held: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of different groups that share a bucket and that signatures don't rule out.

    ``named(bucket, band, class, root)`` says which group a class is in. Pairs within the largest
    group of a bucket need no look, so it has blocks of its own that never meet each other. Here
    signatures are longer: many texts stay apart only just, and more values tell them from links.
    """
    sizes = named.groupBy("bucket", "root").agg(F.count("*").alias("c"))
    sizes = sizes.groupBy("bucket").agg(
        F.max_by("root", F.struct("c", "root")).alias("main"),
        F.max("c").alias("inside"),
        F.sum("c").alias("total"),
        F.count("*").alias("roots"),
    )
    blocks = [
        F.ceil(F.col("inside") / BLOCK).cast("int").alias("main_blocks"),
        F.ceil((F.col("total") - F.col("inside")) / BLOCK).cast("int").alias("other_blocks"),
    ]
    open_ = stage(sizes.where("roots > 1").select("bucket", "main", *blocks), "open")
    rows = stage(lookup(named, open_, ["bucket"], "inner"), "open")
    able = held.where(f"common * 100 >= n * {PERCENT}").join(rows.select("class").distinct(), "class", "left_semi")
    able = able.join(_longer(sets.join(able.select("class"), "class", "left_semi")), "class")
    rows = lookup(rows, able, ["class"], "inner")
    outside = F.col("root") != F.col("main")
    rows = rows.withColumn("outside", outside).withColumn(
        "block", F.pmod(F.xxhash64("class"), F.when(outside, F.col("other_blocks")).otherwise(F.col("main_blocks"))).cast("int")
    )

    def cell(of_main: Column, i: Column, j: Column, first: Column) -> Column:
        return F.struct(of_main.alias("of_main"), i.alias("i"), j.alias("j"), first.alias("first"))

    def upto(n: str, make) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(n) - 1), make)

    yes, no, own = F.lit(True), F.lit(False), F.col("block")
    with_main = upto("main_blocks", lambda i: cell(yes, i, own, no))
    with_others = upto("other_blocks", lambda j: cell(no, F.least(own, j), F.greatest(own, j), own <= j))
    from_main = upto("other_blocks", lambda j: cell(yes, own, j, yes))
    cells = F.when(F.col("outside"), F.concat(with_main, with_others)).otherwise(from_main)
    rows = rows.select("bucket", "band", "class", "root", "n", "common", "data", "more", F.explode(cells).alias("cell"))
    key = ["bucket", "of_main", "i", "j"]
    rows = rows.select("bucket", "cell.*", "band", "class", "root", "n", "common", "data", "more")
    sorted_ = rows.repartition(*key).sortWithinPartitions(*key, "first", "class")
    return sorted_.mapInArrow(_compare_cells(), "a long, b long").distinct()


def _compare_cells():
    length = BANDS * ROWS
    steps = _steps(0, length, BATCH) + _steps(length, length + MORE, MORE_BATCH)

    def compare(cell: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Surviving pairs of one cell: its first block against the rest, or one block in itself."""
        band, diagonal = cell["band"][0].as_py(), cell["i"][0].as_py() == cell["j"][0].as_py() and not cell["of_main"][0].as_py()
        ids, root, n, common = (cell[c].to_numpy() for c in ("class", "root", "n", "common"))
        data, more = (
            np.frombuffer(b"".join(cell[c].to_pylist()), dtype=kind).reshape(len(ids), -1)
            for c, kind in (("data", np.uint16), ("more", np.uint8))
        )
        first = np.asarray(cell["first"].combine_chunks()).astype(bool)
        left, right = (np.arange(len(ids)),) * 2 if diagonal else (np.flatnonzero(first), np.flatnonzero(~first))
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for k in range(0, len(left), ROWS_AT_ONCE):
            own = left[k : k + ROWS_AT_ONCE]
            size, other = n[own][:, None], n[right][None, :]
            most = np.minimum(common[own][:, None], common[right][None, :])
            fits = (np.minimum(size, other) * 100 >= np.maximum(size, other) * PERCENT) & (root[own][:, None] != root[right][None, :])
            fits &= most * (100 + PERCENT) >= (size + other) * PERCENT
            if diagonal:
                fits &= own[:, None] < right[None, :]
            p, q = np.nonzero(fits)
            p, q = own[p], right[q]
            matches, done = np.zeros(len(p), dtype=np.int64), 0
            for upto, least in steps:
                values, at = (data, slice(done, upto)) if upto <= length else (more, slice(done - length, upto - length))
                matches = matches + (values[p, at] == values[q, at]).sum(axis=1)
                keep = matches >= least
                p, q, matches, done = p[keep], q[keep], matches[keep], upto
            # a pair is met in each band that it shares; only the first one hands it on
            equal = (data[p, : band * ROWS] == data[q, : band * ROWS]).reshape(len(p), band, ROWS).all(axis=2).any(axis=1)
            out.append((p[~equal], q[~equal]))
        p, q = (np.concatenate([x[k] for x in out]) if out else np.zeros(0, np.int64) for k in (0, 1))
        return np.minimum(ids[p], ids[q]), np.maximum(ids[p], ids[q])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def given(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
            found = [compare(table.slice(a, b - a)) for a, b in zip(starts[:-1], starts[1:]) if b - a > 1]
            if found:
                columns = [pa.array(np.concatenate([x[k] for x in found])) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            table = pa.concat_tables(held).combine_chunks()
            keys = [table[c].combine_chunks().cast(pa.int64()).to_numpy(zero_copy_only=False) for c in ("bucket", "of_main", "i", "j")]
            changed = np.zeros(table.num_rows, dtype=bool)
            for key in keys:
                changed[1:] |= key[1:] != key[:-1]
            starts = np.concatenate(([0], np.flatnonzero(changed)))
            yield from given(table, starts)  # the last cell may go on in the next batch
            held = [table.slice(int(starts[-1]))]
        if held:
            table = held[0].combine_chunks()
            yield from given(table, np.array([0, table.num_rows]))

    return run


def _classed(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Rows ``doc_id, mark, n, class``, the classes with their smallest doc_id, and links of classes."""
    made = stage(_sets(docs, True), "signatures")
    linkable = made.where("n > 0 AND doc_id IS NOT NULL")
    classes = linkable.groupBy("class").agg(
        F.min("doc_id").cast("long").alias("doc"), F.first("n").alias("n"), F.first("data").alias("data")
    )
    classes = stage(classes, "classes")
    return made.drop("data"), classes.select("class", F.col("doc").alias("first")), _links(classes, docs)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Groups of ``docs(doc_id, text)`` whose shingle sets link: ``doc_id, n_shingles,
    component_id, kept``.

    One row for each row of ``docs``; other columns are ignored. Words are runs of characters
    other than ASCII white space, A-Z lower-cased. A null or wordless text has no shingles and
    links with nothing. Rows of one doc_id are one node, whichever of their texts links. A null
    doc_id links with nothing, its component is null and it isn't kept. Equal sets link always;
    ties can't occur, as the smallest doc_id names a group.
    """
    made, first, links = _classed(docs)
    linkable = made.where("n > 0 AND doc_id IS NOT NULL")
    members = lookup(linkable.select("doc_id", "class"), first, ["class"], "inner")
    nodes = members.where("doc_id <> first").select(F.col("first").alias("a"), F.col("doc_id").cast("long").alias("b"))
    if links is not None:
        ends = lookup(links, first.toDF("a", "x"), ["a"], "inner")
        ends = lookup(ends, first.toDF("b", "y"), ["b"], "inner")
        nodes = nodes.union(ends.select(F.col("x").alias("a"), F.col("y").alias("b")))
    roots = components(nodes).select(F.col("id").alias("doc_id"), F.col("root").alias("component_id"))
    out = lookup(made.select("doc_id", F.col("n").alias("n_shingles")), roots, ["doc_id"])
    component = F.coalesce("component_id", F.col("doc_id").cast("long"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(False))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, all its columns unchanged.

    Here a row counts by its text: of rows that share a doc_id only those with equal or linked texts
    fall together. The smallest doc_id of a group stays, of its texts the one with the smallest
    hash, of equal rows one. Rows without a doc_id or without words link with nothing and all stay.
    """
    made, _, links = _classed(docs)
    rows = made.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "mark", "class")
    if links is not None:
        rows = lookup(rows, components(links).toDF("class", "root"), ["class"])
        rows = rows.withColumn("group", F.coalesce("root", "class"))
    else:
        rows = rows.withColumn("group", F.col("class"))
    kept = rows.groupBy("group").agg(F.min(F.struct("doc_id", "mark")).alias("k"))
    kept = kept.select(F.col("k.doc_id").alias("_id"), F.col("k.mark").alias("_mark"))
    unlinked = made.where("n = 0 AND doc_id IS NOT NULL").select("doc_id", "mark").distinct().toDF("_id", "_mark")
    own = docs.select("doc_id", F.xxhash64("text").alias("_own"), F.struct("*").alias("row"))

    def of(which: DataFrame) -> DataFrame:
        return own.join(which, (F.col("doc_id") == F.col("_id")) & (F.col("_own") == F.col("_mark")), "left_semi")

    once = of(kept).groupBy("doc_id", "_own").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    both = once.select("row.*").union(of(unlinked).select("row.*"))
    return both.union(docs.where("doc_id IS NULL"))
