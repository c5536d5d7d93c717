"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Runs of one to three letters (anything else counts as one blank) are hashed to features. Document
frequencies come from all documents that may be learned from. The regression is trained by
follow-the-regularised-leader with elastic-net penalties on a bounded sample of them, and a
temperature, fitted on a part of the sample that the training hasn't seen, calibrates its
probabilities. Prediction reads the whole text and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_chunks

FEATURES = 1 << 15
#: Documents of each language that the regression is fitted on, about; 1 in 5 of them calibrate.
SAMPLE_PER_LANGUAGE = 600
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
UNKNOWN = "und"
#: A language counts as recognised from this calibrated probability on, or, of many languages, from
#: so many times what chance gives.
LEAST_SCORE = 0.4
TIMES_CHANCE = 1.5


class NGrams:
    """Counts of hashed n-grams of each text of a part of a column."""

    def __init__(self) -> None:
        small = [chr(k).lower() for k in range(1 << 16)]
        letters = [ord(c) if len(c) == 1 and c.isalpha() else 0 for c in small]
        self.fold = np.array(letters, dtype=np.uint64)

    def counts(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """Features of each text and how often they occur; None if it has no letter."""
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        edges = heads[bounds]
        folded = self.fold[np.minimum(codes, (1 << 16) - 1)]
        for k in np.flatnonzero(codes >= 1 << 16):
            if chr(codes[k]).isalpha():
                folded[k] = codes[k]
        shift, factor = np.uint64(64 - 15), np.uint64(0x9E3779B97F4A7C15)
        rolling, grams = np.zeros_like(folded), []
        for n in range(3):
            rolling = rolling[: len(folded) - n] * np.uint64(0x1FFFFF0B) + folded[n:] + np.uint64(n + 1)
            grams.append(((rolling ^ (rolling >> np.uint64(29))) * factor >> shift).astype(np.int32))
        for a, b in zip(edges[:-1], edges[1:]):
            if not folded[a:b].any():
                yield None
                continue
            own = np.concatenate([g[a : max(a, b - n)] for n, g in enumerate(grams)])
            seen = np.bincount(own, minlength=FEATURES)
            features = np.flatnonzero(seen)
            yield features, seen[features]


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # feature x language
    idf: np.ndarray
    temperature: float = 1.0

    def vector(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[features]
        return x / max(np.sqrt(x @ x), 1e-12)

    def probabilities(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return softmax(self.vector(features, counts) @ self.weights[features] / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def train(model: Model, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
    """Follow the regularised leader, coordinate by coordinate."""
    z, n, w = np.zeros_like(model.weights), np.zeros_like(model.weights), model.weights
    for _ in range(EPOCHS):
        for language, features, counts in rows:
            x = model.vector(features, counts)
            own, squares = w[features], n[features]
            p = softmax(x @ own)
            p[language] -= 1
            g = np.outer(x, p)
            more = squares + g * g
            sigma = (np.sqrt(more) - np.sqrt(squares)) / ALPHA
            total = z[features] + g - sigma * own
            z[features], n[features] = total, more
            step = (BETA + np.sqrt(more)) / ALPHA + L2
            w[features] = np.where(np.abs(total) > L1, (np.sign(total) * L1 - total) / step, 0.0)


def calibrate(model: Model, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
    """The temperature with the least log loss, by golden section over its logarithm."""
    scores = [(k, model.vector(f, c) @ model.weights[f]) for k, f, c in rows]

    def loss(log_t: float) -> float:
        return -sum(np.log(max(softmax(s / np.exp(log_t))[k], 1e-300)) for k, s in scores)

    low, high, part = np.log(0.02), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(24 if scores else 0):
        a, b = high - part * (high - low), low + part * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    model.temperature = float(np.exp((low + high) / 2)) if scores else 1.0


def held_out() -> F.Column:
    """Whether a document is kept from learning."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _learnable(docs: DataFrame) -> DataFrame:
    own = docs.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").where(~held_out())
    return own.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all learnable documents each feature occurs, and how many there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, total, docs_seen = NGrams(), np.zeros(FEATURES, dtype=np.int64), 0
        for batch in batches:
            for _, data, bounds in text_chunks(batch.column(0)):
                for found in grams.counts(data, bounds):
                    if found is not None:
                        total[found[0]] += 1
                        docs_seen += 1
        at = np.flatnonzero(total)
        features = np.concatenate(([-1], at))
        yield pa.RecordBatch.from_arrays([pa.array(features), pa.array(np.concatenate(([docs_seen], total[at])))], names=["f", "n"])

    counts = docs.select("text").mapInArrow(count, "f long, n long").groupBy("f").agg(F.sum("n").alias("n"))
    found = {r["f"]: r["n"] for r in counts.collect()}  # FEATURES + 1 rows at most
    total = found.pop(-1, 0)
    frequencies = np.zeros(FEATURES)
    frequencies[list(found)] = list(found.values())
    return frequencies, total


def sample(docs: DataFrame, per_language: int) -> list[tuple]:
    """``(order, language, features, counts)`` of a bounded sample, about as many of each language."""
    spark = docs.sparkSession
    sizes = docs.groupBy("lang").count().collect()  # one row a language
    if not sizes:
        return []
    limits = [(r["lang"], min(1 << 30, int((1 << 30) * per_language / r["count"]))) for r in sizes]
    limits = F.broadcast(spark.createDataFrame(limits, "lang string, upto long"))
    order = F.xxhash64("doc_id", F.lit("sample"))
    drawn = docs.join(limits, "lang").where(F.pmod(order, F.lit(1 << 30)) < F.col("upto"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = NGrams()
        kinds = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        for batch in batches:
            orders, languages = (batch.column(k).to_pylist() for k in (0, 1))
            for first, data, bounds in text_chunks(batch.column(2)):
                rows = [
                    (orders[first + k], languages[first + k], *found)
                    for k, found in enumerate(grams.counts(data, bounds))
                    if found is not None
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=names)

    names = ["order", "lang", "features", "counts"]
    schema = "order long, lang string, features array<int>, counts array<int>"
    found = drawn.select(order.alias("order"), "lang", "text").mapInArrow(count, schema).toArrow()
    rows = zip(*(found.column(k).to_pylist() for k in (0, 1)), *(found.column(k) for k in (2, 3)))
    return sorted(((o, lang, f.values.to_numpy(), c.values.to_numpy()) for o, lang, f, c in rows), key=lambda r: (r[0], r[1], len(r[2]), r[2].tobytes(), r[3].tobytes()))


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Learn from the texts and languages of the documents that aren't held out."""
    own = _learnable(docs)
    frequencies, total = document_frequencies(own)
    rows = sample(own, per_language)
    languages = sorted({r[1] for r in rows})
    idf = np.log((1 + total) / (1 + frequencies)) + 1
    model = Model(languages, np.zeros((FEATURES, len(languages))), idf)
    known = [(languages.index(r[1]), r[2], r[3]) for r in rows]
    train(model, [r for k, r in enumerate(known) if k % 5])
    calibrate(model, [r for k, r in enumerate(known) if k % 5 == 0])
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, key, held_out, lang_pred, score`` for each row of ``docs(doc_id, text)``.

    A null text, a text without a letter, and any text if nothing could be learned is ``und`` with
    score 0. Ties go to the first language by name. Other columns play no part.
    """

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = NGrams()
        for batch in batches:
            for first, data, bounds in text_chunks(batch.column(3)):
                names, scores = [], []
                for found in grams.counts(data, bounds):
                    if found is None or not model.languages:
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    p = model.probabilities(*found)
                    names.append(model.languages[int(p.argmax())])
                    scores.append(float(p.max()))
                columns = [batch.column(k).slice(first, len(names)) for k in range(3)]
                columns += [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", F.xxhash64("doc_id", "text").alias("key"), held_out().alias("held_out"), "text"]
    schema = f"doc_id {kind}, key long, held_out boolean, lang_pred string, score double"
    return docs.select(*columns).mapInArrow(decide, schema)


def identify(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """Fit on ``docs(doc_id, text, lang)`` and predict each of its rows."""
    return predict(docs, fit(docs, per_language))


def recognised(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """``docs`` without the documents whose language isn't recognised, all columns unchanged.

    If nothing could be learned, only documents without a letter go.
    """
    model = fit(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    least = min(least_score, TIMES_CHANCE / len(model.languages))
    found = predict(docs, model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("doc_id", "text").alias("key"))
    return rows.join(found.select("key").distinct(), "key", "left_semi").select("row.*")
