"""Rows of vectors made ready: those that take part, and classes of equal ones."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limpid.llm.layout import cut, known_id

INFINITE = float("inf")


def takes_part(vector: Column) -> Column:
    """Not null, not zero, every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < INFINITE))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vector_rows(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, digest, v) of the rows that take part, written once."""
    rows = df.select(known_id(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = cut(rows.where(takes_part(F.col("v"))), "vectors")
    return rows.withColumn("digest", F.unhex(F.md5(F.col("v").cast("string").cast("binary"))))


def dimensions(classes: DataFrame) -> dict[int, int]:
    """Number of classes by dimension."""
    return {r["d"]: r["count"] for r in classes.groupBy(F.size("v").alias("d")).count().orderBy("d").collect()}


def classes_of(rows: DataFrame, members: int) -> DataFrame:
    """(node, rep, copies, ids, v): equal vectors once, with their smallest ids.

    At most ``members`` ids of a class are kept, which Spark prunes before the shuffle;
    ``copies`` counts all.
    """
    first = Window.partitionBy("digest").orderBy("id")
    ids = (
        rows.select("digest", "id", "v").withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= members)
        .groupBy("digest")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"), F.first("v").alias("v"))
    )
    counts = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("rep"))
    found = ids.join(counts, "digest").withColumn("node", F.monotonically_increasing_id())
    return cut(found, "vector-classes")


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of equally long lists as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def packed(rows: np.ndarray) -> bytes:
    """Rows as bytes: four bytes a number where that loses nothing, else eight."""
    small = rows.astype(np.float32)
    exact = bool((small.astype(np.float64) == rows).all())
    return (b"4" + small.tobytes()) if exact else (b"8" + rows.tobytes())


def unpacked(data: bytes, d: int) -> np.ndarray:
    kind = np.float32 if data[:1] == b"4" else np.float64
    return np.frombuffer(data, kind, offset=1).astype(np.float64).reshape(-1, d)


def scaled(rows: np.ndarray) -> np.ndarray:
    """Each row times a power of two, so that squares neither overflow nor vanish."""
    _, power = np.frexp(np.abs(rows).max(axis=1, initial=0))
    return np.ldexp(rows, -power[:, None])
