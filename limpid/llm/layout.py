"""How rows are spread: blocks of documents, copies of a text, tables in between."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.sources import scratch_folder, through_table

# Rows without an id come after all others.
NO_ID = 2**63 - 1


def cut(df: DataFrame, purpose: str) -> DataFrame:
    """Through a table in the cluster's shared folder: short lineage, nothing to lose."""
    return through_table(df, scratch_folder(df.sparkSession, purpose))


def known_id(col: str) -> Column:
    return F.coalesce(F.col(col).cast("bigint"), F.lit(NO_ID))


def row_mark(key: str, text: str) -> Column:
    """64 bits of id and text: tells rows of one id apart, alike in every task."""
    return F.xxhash64(known_id(key), F.coalesce(F.col(text), F.lit("")).cast("binary"))


def text_digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, mark, digest, n_bytes) of each row, written once."""
    raw = F.coalesce(F.col(text), F.lit(""))
    return cut(
        docs.select(
            known_id(key).alias("id"),
            row_mark(key, text).alias("mark"),
            F.unhex(F.md5(raw.cast("binary"))).alias("digest"),
            F.octet_length(raw).cast("bigint").alias("n_bytes"),
        ),
        "digests",
    )


def later_copies(digests: DataFrame) -> DataFrame:
    """(id, mark): rows whose text an earlier id has too.

    Only repeated texts stand on the right of the join; Spark splits a hot text.
    """
    firsts = (
        digests.groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    return digests.join(firsts, "digest").where("id > first").select("id", "mark")


def slices(total: int, each: int, least: int = 64) -> int:
    """Number of slices of about ``each``; grows with the data."""
    return int(max(least, -(-total // each)))
