"""Whether a table stands written in an order, which no comparison of rows as a bag can tell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limpid.sources.roworder import ROW_ORDER


def order_breaks(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(rows, breaks): neighbours of a written table whose keys fall; NULL is the smallest.

    ``rows`` carries the row order of its scan. Neighbours inside a block of a file are
    compared there; of each block only its first and last key meet those of the blocks before
    it, one row a block. An empty table has no breaks.
    """
    file, block, row = ROW_ORDER
    keyed = rows.select(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias("_key"), *ROW_ORDER)
    within = Window.partitionBy(file, block).orderBy(row)
    inner = keyed.withColumn("_before", F.lag("_key").over(within))
    blocks = inner.groupBy(file, block).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("_before") > F.col("_key")).alias("breaks"),
        F.min_by("_key", row).alias("_first"),
        F.max_by("_key", row).alias("_last"),
    )
    along = Window.orderBy(file, block)
    borders = blocks.withColumn("_torn", F.lag("_last").over(along) > F.col("_first"))
    return borders.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("breaks") + F.coalesce(F.col("_torn").cast("int"), F.lit(0))), F.lit(0)).alias("breaks"),
    )
