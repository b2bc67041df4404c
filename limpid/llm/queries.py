"""The operators of this subpackage applied to whole tables, with SQL where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from limpid.llm import (
    alignment, bpe, embedding_dedup, minhash_dedup, neighbours, packing, quality, sharding,
    substring_dedup, suffix_dedup, token_counts, vector_codes, warc,
)
from limpid.sources import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


@_query
def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.duplicate_bytes(_table(spark, sf_dir, "documents"))


@_query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.duplicate_words(_table(spark, sf_dir, "documents"))


@_query
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


@_query
def op9_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encoding_digests(_table(spark, sf_dir, "documents"), vocabulary)


@_query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


@_query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(_table(spark, sf_dir, "documents"))


ORACLES["op1_sharding"] = sharding.oracle_sql()


@_query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(_table(spark, sf_dir, "pages"))


ORACLES["op3_warc"] = warc.ORACLE_SQL


@_query
def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


@_query
def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"))


@_query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(_table(spark, sf_dir, "documents"))


@_query
def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.token_alignment(_table(spark, sf_dir, "documents"), *paths)


@_query
def op12_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(_table(spark, sf_dir, "embeddings"))


ORACLES["op12_vector_code_compression"] = vector_codes.oracle_sql()


@_query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), vocabulary)
