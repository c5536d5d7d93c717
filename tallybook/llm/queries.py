"""The registered queries of this folder, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    divergence,
    graph_index,
    language,
    main_text,
    merkle,
    minhash,
    multi_index,
    packing,
    pieces,
    secrets,
    spans,
    token_counts,
    token_files,
)
from .common import configure, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir)

    QUERIES[build.__name__] = run
    return build


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document, null text as empty: counts by kind, digest of the base spans, all spans."""
    found = secrets.scan(table(spark, sf_dir, "documents"), repository="doc_id", owner="source")
    return found.drop("key", "live")


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without the passages that stand earlier in the corpus; a null text stays null."""
    return spans.drop_repeats(table(spark, sf_dir, "documents")).drop("key")


@query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document encoded into pieces and decoded again."""
    return pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, number and checksum of each document's ids, read back from the token files."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.round_trip(table(spark, sf_dir, "documents"), path, end_id=1)


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and score of each document; `und` for a null text or one without a letter."""
    return language.identify(table(spark, sf_dir, "documents")).drop("key")


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of each document, null text as empty, and their place in packed sequences."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path, width=2048, end_id=0)


@query
def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page; empty for a null or empty page."""
    return main_text.extract(table(spark, sf_dir, "pages"))


@query
def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of each document and the smallest id of its near-duplicates; none without words."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of each vector and the smallest id reachable; unusable vectors and null labels link with nothing."""
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


@query
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of each vector whose id is divisible by 20; unusable vectors take no part."""
    return graph_index.search(table(spark, sf_dir, "embeddings"), every=20, k=20)


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and the fold of the altered row for each document."""
    return merkle.manifest(table(spark, sf_dir, "documents"))


@query
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of each document, and whether it is over 512 tokens."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of a language differ from each other, and the terms that mark each."""
    return divergence.divergence(table(spark, sf_dir, "documents"))


ORACLES |= {"op11_merkle_manifest": merkle.SQL, "op13_source_divergence": divergence.SQL}
