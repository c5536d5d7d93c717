"""How the vocabularies of sources differ within a language, as exact integers.

Each (lang, source) group and each lang gives every kept term a smoothed share in parts of a billion.
Pairs of groups are compared over all kept terms of their lang, so the work is a cube: groups by groups
by terms. It is cut along all three: a cell is one block of groups against another over one block of
terms. The slice (group block, term block) is sent to each cell that needs it, a cell sums what its terms
add to each of its pairs, and these parts are added along the terms. Blocks are cut by hash, and their
number grows with groups and terms, so no cell grows with the corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup, stage

#: Shares are parts of this, rounded down, plus one.
PARTS = 1_000_000_000
#: Documents of a lang that a kept term needs.
LEAST_DOCS = 3
#: Terms listed for a group.
TOP = 200
#: Groups and terms of a block, on average.
GROUPS, TERMS = 48, 2048
#: Distinct terms that a task holds before it hands its counts on, and bytes of text split at once.
HELD, CHUNK = 400_000, 4 << 20

# A-Z in lower case, other ASCII but letters a blank, bytes of other characters as they are
_FOLD = bytes(k + 32 if 65 <= k <= 90 else k if 97 <= k <= 122 or k > 127 else 32 for k in range(256))


def _parts(raw: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, of a long one part by part."""
    text, at = raw.translate(_FOLD), 0
    while at < len(text):
        end = text.find(b" ", at + CHUNK) if len(text) > at + CHUNK else -1
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of each term, and documents that hold it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses: dict[tuple, Counter] = {}
        holds: dict[tuple, Counter] = {}
        held = 0

        def given() -> Iterator[pa.RecordBatch]:
            for (lang, source), found in uses.items():
                if not found:
                    continue
                terms = list(found)
                docs = holds[lang, source]
                columns = [
                    pa.repeat(pa.scalar(lang), len(terms)),
                    pa.repeat(pa.scalar(source), len(terms)),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array([found[t] for t in terms], pa.int64()),
                    pa.array([docs[t] for t in terms], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for lang, source, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                group = lang, source
                found, docs = uses.setdefault(group, Counter()), holds.setdefault(group, Counter())
                before, own = len(found), set()
                for words in _parts(raw.as_py()):
                    found.update(words)
                    own.update(words)
                docs.update(own)
                held += len(found) - before
                if held >= HELD:
                    yield from given()
                    uses, holds, held = {}, {}, 0
        yield from given()

    counted = _named(docs).mapInArrow(count, "lang string, source string, term string, n long, docs long")
    sums = [F.sum(c).alias(c) for c in ("n", "docs")]
    return counted.groupBy("lang", "source", "term").agg(*sums)


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(PARTS * (n + 1) / (total + terms)), in decimals: counts may have any size."""
    up = (n + 1).cast("decimal(19,0)") * F.lit(PARTS).cast("decimal(10,0)")
    down = (total + terms).cast("decimal(19,0)")
    return F.lit(1).cast("long") + F.call_function("div", up, down)


def shares(counts: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """The same for a row of counts per group; exact while a group has less than 9e15 terms."""
    below = np.maximum(total + terms, 1)[:, None]
    rest, out = counts + 1, np.zeros_like(counts)
    for _ in range(3):  # a billion in three steps of a thousand
        rest = rest * 1000
        out = out * 1000 + rest // below
        rest = rest % below
    return out + 1


def _compared(cells: DataFrame) -> DataFrame:
    """``lang, source, item, value``: what the terms of each cell add to each of its pairs."""
    names = ["lang", "source", "item", "value"]

    def side(rows: pa.Table, block: int) -> tuple[list[str], np.ndarray]:
        own = rows.filter(pc.equal(rows["group_block"], block))
        heads = own.filter(pc.less(own["place"], 0))
        sources = heads["source"].to_pylist()
        body = own.filter(pc.greater_equal(own["place"], 0))
        counts = np.zeros((len(sources), heads["width"][0].as_py()), dtype=np.int64)
        at = pc.index_in(body["source"].combine_chunks(), heads["source"].combine_chunks())
        counts[np.asarray(at), body["place"].to_numpy()] = body["n"].to_numpy()
        return sources, shares(counts, heads["n"].to_numpy(), heads["terms"][0].as_py())

    def compare(rows: pa.Table) -> pa.Table:
        first, second = rows["first"][0].as_py(), rows["second"][0].as_py()
        ours, p = side(rows, first)
        theirs, q = (ours, p) if first == second else side(rows, second)
        there = np.zeros((len(ours), len(theirs)), dtype=np.int64)
        back = np.zeros_like(there)
        for k in range(len(ours)):
            square = (p[k] - q) ** 2
            there[k] = (square // q).sum(axis=1)
            if first != second:
                back[k] = (square // p[k]).sum(axis=1)
        a, b = np.repeat(ours, len(theirs)), np.tile(theirs, len(ours))
        if first == second:
            keep = ~np.eye(len(ours), dtype=bool).reshape(-1)
            source, item, value = a[keep], b[keep], there.reshape(-1)[keep]
        else:
            source, item = np.concatenate((a, b)), np.concatenate((b, a))
            value = np.concatenate((there.reshape(-1), back.reshape(-1)))
        lang = pa.repeat(pa.scalar(rows["lang"][0].as_py(), pa.string()), len(value))
        columns = [lang, pa.array(source.tolist(), pa.string()), pa.array(item.tolist(), pa.string()), pa.array(value)]
        return pa.table(columns, names=names)

    grouped = cells.groupBy("lang", "first", "second", "term_block")
    return grouped.applyInArrow(compare, "lang string, source string, item string, value long")


def divergence(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank`` over ``docs(text, lang, source)``.

    Nulls of the three columns are read as ''; other columns are ignored, repeated rows count each.
    Part ``pair`` lists the other sources of the lang, ``term`` the terms that a group uses more than
    its lang does, the TOP first of them. Ties rank by the bytes of the item. A group without terms
    is compared by what smoothing gives it; in a lang without kept terms every pair has value 0. A
    lang with one source has no pairs. An empty table has no rows.
    """
    counts = stage(term_counts(docs), "term-counts")
    groups = stage(_named(docs).groupBy("lang", "source").agg(F.count("*").alias("docs")), "groups")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("used"), F.sum("docs").alias("docs"))
    kept = stage(kept.where(F.col("docs") >= LEAST_DOCS).select("lang", "term", "used"), "kept")

    sizes = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("used").alias("lang_total"))
    langs = groups.groupBy("lang").agg(F.count("*").alias("groups")).join(sizes, "lang", "left")
    langs = stage(langs.na.fill(0, ["terms", "lang_total"]).select(
        "*",
        F.greatest(F.lit(1), F.ceil(F.col("groups") / GROUPS)).cast("int").alias("group_blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("terms") / TERMS)).cast("int").alias("term_blocks"),
    ), "langs")

    # terms get a place in their block, so slices of different groups line up
    term_block = F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int").alias("term_block")
    placed = lookup(kept, langs.select("lang", "terms", "lang_total", "term_blocks"), ["lang"], "inner")
    placed = placed.select("lang", "term", "used", "terms", "lang_total", term_block)
    in_block = Window.partitionBy("lang", "term_block")
    placed = placed.withColumn("place", F.row_number().over(in_block.orderBy("term")) - 1)
    entries = stage(counts.select("lang", "source", "term", "n").join(placed, ["lang", "term"]), "entries")
    widths = placed.groupBy("lang", "term_block").agg(F.count("*").cast("int").alias("width"))

    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.select("lang", "source").join(totals, ["lang", "source"], "left").na.fill(0, ["total"])
    return _pairs(groups, langs, entries, widths).unionByName(_terms(groups, entries))


def _pairs(groups: DataFrame, langs: DataFrame, entries: DataFrame, widths: DataFrame) -> DataFrame:
    group_block = F.pmod(F.xxhash64("source"), F.col("group_blocks")).cast("int").alias("group_block")
    placed = lookup(groups, langs.select("lang", "terms", "group_blocks", "term_blocks"), ["lang"], "inner")
    # every group heads its slice of every term block, also where it uses none of its terms
    all_blocks = F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("term_block")
    heads = placed.select("lang", "source", group_block, "group_blocks", F.col("total").alias("n"), "terms", all_blocks)
    heads = heads.join(widths, ["lang", "term_block"], "left").na.fill(0, ["width"])
    heads = heads.withColumn("place", F.lit(-1))
    body = lookup(entries.select("lang", "source", "term_block", "place", "n"), langs.select("lang", "group_blocks"), ["lang"], "inner")
    body = body.select("*", group_block)
    slices = heads.unionByName(body, allowMissingColumns=True)
    copies = slices.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1)))
    cells = copies.select(
        "lang",
        F.least("group_block", "other").alias("first"),
        F.greatest("group_block", "other").alias("second"),
        "term_block",
        "group_block",
        "source",
        "place",
        "n",
        "terms",
        "width",
    )
    summed = _compared(cells).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return _ranked(summed, "pair")


def _terms(groups: DataFrame, entries: DataFrame) -> DataFrame:
    rows = lookup(entries, groups, ["lang", "source"], "inner")
    p = _share(F.col("n"), F.col("total"), F.col("terms")).alias("p")
    q = _share(F.col("used"), F.col("lang_total"), F.col("terms")).alias("q")
    rows = rows.select("lang", "source", F.col("term").alias("item"), p, q).where("p > q")
    return _ranked(rows.withColumn("value", F.expr("(p - q) * (p - q) div q")), "term").where(F.col("rank") <= TOP)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
w AS (
  SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS used FROM w GROUP BY ALL HAVING count(DISTINCT id) >= {LEAST_DOCS}),
langs AS (SELECT lang, count(*) AS v, sum(used) AS total FROM kept GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
uses AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM uses GROUP BY ALL),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n,
         1 + {PARTS}::HUGEINT * (coalesce(u.n, 0) + 1) // (coalesce(t.total, 0) + l.v) AS p,
         1 + {PARTS}::HUGEINT * (k.used + 1) // (l.total + l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN uses u USING (lang, source, term) LEFT JOIN totals t USING (lang, source)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM grid WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM parts)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP}"""
