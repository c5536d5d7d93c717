"""Substring deduplication by sliding sentence spans.

A text is cut into sentences: after a word that ends in sentence or clause punctuation, at a line
break, and, as prose may run on without either, after the word with the smallest hash of each
window of words that has neither. So every window has a cut, which depends on the words of the
window alone, and a passage is cut alike wherever it stands but for its edges. A run is several
sentences in a row with enough words. A run that occurs more than once in the whole corpus keeps its
first occurrence, by doc_id and place; the sentences of all others go.

Of all runs the shortest that begins at each sentence and the shortest that ends with it are hashed.
These give the same as all runs do: where a longer one repeats, so do those within it, and each of
its sentences is in one of them, as the words from that sentence to the end of the run are either
enough for a run or too few, and then the shortest one that ends there reaches back beyond it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BASE, _UNDO, lookup, mix, stage, text_chunks, word_hashes

#: Sentences and words of a run, at least.
SENTENCES, WORDS = 2, 20
#: Words in a row of which one ends a sentence, at least.
WINDOW = 11
#: Closing quotes and brackets that may follow a stop.
CLOSERS = 4


def _codes(characters: str) -> np.ndarray:
    """The bytes of each character as one number, in order."""
    return np.array(sorted(int.from_bytes(c.encode()) for c in characters))


_STOPS = _codes(".!?,;:…。、！？，；：｡､।॥؟،؛۔።፣՝։‽")
_CLOSING = _codes("\"')]}>»«›‹”’“‘」』】》〉）］｝")


def _one_of(codes: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, codes), len(known) - 1)] == codes


def _stops(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a word ends in a stop, closing quotes and brackets aside."""
    found = np.zeros(len(ends), dtype=bool)
    at = np.arange(len(ends))
    ends = ends.copy()
    for _ in range(CLOSERS + 1):
        a, b, c = (data[np.maximum(ends[at] - k, 0)].astype(np.int64) for k in (1, 2, 3))
        size = np.where(a < 0x80, 1, np.where(b >= 0xC0, 2, 3))
        code = a + (b << 8) * (size > 1) + (c << 16) * (size > 2)
        found[at] = _one_of(code, _STOPS)
        closed = _one_of(code, _CLOSING) & (ends[at] - size > starts[at])
        ends[at] -= size
        at = at[closed]
    return found


def _least(words: np.ndarray, last: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Places of the smallest hash, of equal ones the last, of each window of a text without an end."""
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    ends = np.concatenate(([0], np.cumsum(last)))
    inside = np.zeros(len(words) + 1, dtype=np.int64)  # windows that reach into the next text are none
    for b in edges[1:-1]:
        inside[max(b - WINDOW + 1, 0) : b] = 1
    at = np.flatnonzero((ends[WINDOW:] == ends[:n]) & (inside[:n] == 0))
    best, least = at.copy(), words[at]
    for k in range(1, WINDOW):
        other = words[at + k]
        smaller = other <= least
        best[smaller], least = at[smaller] + k, np.minimum(other, least)
    return best


def sentence_runs(
    data: np.ndarray, bounds: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each text: where its sentences begin (byte), hash of each run, its first sentence and the
    one after it."""
    words, starts, ends, edges = word_hashes(data, bounds)
    last = np.zeros(len(words), dtype=bool)
    if len(words):
        line = np.concatenate(([0], np.cumsum(data == 10)))
        last = _stops(data, starts, ends)
        last[:-1] |= line[starts[1:]] > line[ends[:-1]]
        last[_least(words, last, edges)] = True
    powers = np.cumprod(np.full(len(words), _BASE, dtype=np.uint64))
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(words * powers, dtype=np.uint64)))
    undo = np.cumprod(np.full(len(words) + 1, _UNDO, dtype=np.uint64))
    for a, b, origin in zip(edges[:-1], edges[1:], bounds[:-1]):
        if a == b:
            yield tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
            continue
        heads = np.concatenate(([a], a + 1 + np.flatnonzero(last[a : b - 1])))
        cuts = np.concatenate((heads, [b]))
        upto = np.maximum(np.searchsorted(cuts, heads + WORDS), np.arange(len(heads)) + SENTENCES)
        upto = upto[upto < len(cuts)]
        # the shortest run that ends before each sentence, if it isn't the shortest from its first one
        ends = np.arange(SENTENCES, len(cuts))
        since = np.minimum(np.searchsorted(cuts, cuts[ends] - WORDS, side="right") - 1, ends - SENTENCES)
        ends, since = ends[since >= 0], since[since >= 0]
        other = upto[since] != ends
        since = np.concatenate((np.arange(len(upto)), since[other]))
        upto = np.concatenate((upto, ends[other]))
        run = mix((sums[cuts[upto]] - sums[cuts[since]]) * undo[cuts[since]])
        yield starts[heads] - origin, run.astype(np.int64), since, upto


def _keyed(docs: DataFrame) -> DataFrame:
    key = F.xxhash64("doc_id", "text").alias("key")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), key, "text")


def _runs(docs: DataFrame) -> DataFrame:
    """``run, key, span``: every run of every text, and where it lies: its first sentence, shifted by
    32 bits, and the one after it."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, bounds in text_chunks(batch.column(1)):
                found = [(run, (since << 32) + upto) for _, run, since, upto in sentence_runs(data, bounds)]
                rows = np.repeat(np.arange(first, first + len(found)), [len(run) for run, _ in found])
                run, span = (pa.array(np.concatenate(x)) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([run, batch.column(0).take(pa.array(rows)), span], names=["run", "key", "span"])

    return _keyed(docs).select("key", "text").mapInArrow(make, "run long, key long, span long")


def repeated(docs: DataFrame) -> DataFrame:
    """``key, hits``: for each text with repeats, where its non-first runs lie.

    Runs are counted by their hash alone; only those that occur again carry their place.
    """
    runs = _runs(docs)
    again = runs.groupBy("run").agg(F.count("*").alias("c")).where("c > 1").select("run")
    again = stage(lookup(runs, again, ["run"], "left_semi", salts=2), "again")
    ids = _keyed(docs).select("key", "doc_id").distinct()
    placed = lookup(again, ids, ["key"], "inner")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key", "span")
    firsts = placed.groupBy("run").agg(F.min(place).alias("p"))
    firsts = firsts.select("run", F.col("p.key").alias("k"), F.col("p.span").alias("s"))
    others = lookup(again, firsts, ["run"], "inner", salts=2)
    others = others.where("key <> k OR span <> s")
    return others.groupBy("key").agg(F.sort_array(F.collect_set("span")).alias("hits"))


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, key, text, n_sentences, n_removed`` for each row of ``docs(doc_id, text)``.

    A null text has no sentences and stays null; a text without repeats stays as it is, others lose
    whole sentences with the white space after them. Rows alike in doc_id and text count as one
    and are treated alike; a null doc_id counts as the last. Other columns are ignored.
    """
    hits = stage(repeated(docs), "repeats")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(3).to_pylist()
            for first, data, bounds in text_chunks(batch.column(2), 1 << 20):
                texts, counts, removed = [], [], []
                for k, (starts, *_) in enumerate(sentence_runs(data, bounds)):
                    gone = np.zeros(len(starts) + 1, dtype=np.int64)
                    at = np.array(marks[first + k] or [], dtype=np.int64)
                    np.add.at(gone, at >> 32, 1)
                    np.add.at(gone, at & 0xFFFFFFFF, -1)
                    gone = np.cumsum(gone)[:-1] > 0
                    own = data[bounds[k] : bounds[k + 1]].tobytes()
                    if gone.any():
                        cuts = [*starts.tolist(), len(own)]
                        kept = [own[a:b] for a, b, g in zip(cuts[:-1], cuts[1:], gone) if not g]
                        own = own[: cuts[0]] + b"".join(kept)
                        own = own.rstrip(b" \t\n\v\f\r") if gone[-1] else own
                    texts.append(own.decode())
                    counts.append(len(starts))
                    removed.append(int(gone.sum()))
                n = len(texts)
                text = pa.array(texts, pa.string())
                text = pa.array([None if v is None else t for v, t in zip(batch.column(2).slice(first, n).to_pylist(), texts)], pa.string())
                columns = [*(batch.column(c).slice(first, n) for c in (0, 1)), text]
                columns += [pa.array(x, pa.int64()) for x in (counts, removed)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "text", "n_sentences", "n_removed"])

    schema = "doc_id long, key long, text string, n_sentences long, n_removed long"
    return _keyed(docs).join(hits, "key", "left").select("doc_id", "key", "text", "hits").mapInArrow(cut, schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated spans cut from ``text``, and ``n_chars``, if there, set to what is left.

    All rows and columns stay; only changed texts and their counts differ.
    """
    changed = drop_repeats(docs).where("n_removed > 0").select("key", "text").dropDuplicates(["key"])
    return replace_texts(docs, changed)


def replace_texts(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """``docs`` with the texts of ``changed(key, text)``, keyed by hash of doc_id and text."""
    new = changed.select(F.col("key"), F.struct(F.col("text").alias("new")).alias("with"))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("doc_id", "text").alias("key"))
    both = rows.join(new, "key", "left")
    row = F.col("row").withField("text", F.col("with.new"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.char_length("with.new").cast(kind))
    return both.select(F.when(F.col("with").isNull(), F.col("row")).otherwise(row).alias("row")).select("row.*")
