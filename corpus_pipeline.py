"""A corpus made ready for training: four stages over ``documents``.

1. rows that the quality classifier rejects go;
2. of each group of near duplicates the document of the smallest id stays;
3. byte strings that an earlier document has too go from the texts;
4. what is left is packed into sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limpid.llm import minhash_dedup, packing, quality, suffix_dedup
from limpid.llm.layout import cut
from limpid.sources import read_table

# Held by tests/llm/test_pipeline.py.
NEAR_PERCENT = 85


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, read_table(spark, f"{sf_dir}/labels.parquet"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.without_near_duplicates(docs, percent=NEAR_PERCENT)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = suffix_dedup.without_duplicate_bytes(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("bigint"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_documents),
    ("minhash near-dedup", one_of_each_group),
    ("suffix-array dedup", without_repeated_passages),
    ("best-fit packing", packed_sequences),
]

# SQL has no classifier and no packing heuristic; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage is written and read again."""
    docs = read_table(spark, f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
