"""Registration of queries and small helpers they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from limpid.sources import read_table, scratch_folder, through_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Time text of every audit row, so that results can be compared.
STAMP = "2024-01-01 00:00:00"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def through_scratch(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back."""
    return through_table(df, scratch_folder(df.sparkSession, purpose))


def cents(col: str | Column) -> Column:
    """Money as whole cents: integer sums do not depend on the order of rows."""
    return F.round((F.col(col) if isinstance(col, str) else col) * 100).cast("bigint")


def school_year(day: str) -> Column:
    year = F.year(day)
    return F.concat_ws("-", (year - 1).cast("string"), year.cast("string"))
