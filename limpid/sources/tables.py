"""Parquet tables and the quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table_if_any(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or ``None`` when there is nothing at ``path``."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def table_exists(spark: SparkSession, path: str) -> bool:
    return read_table_if_any(spark, path) is not None


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    gather: bool = True,
    keep_others: bool = False,
) -> int:
    """Replace the table at ``path``; returns the rows written.

    A partitioned table is gathered by its partition columns first, in slices that Spark
    sizes, so that each task writes few files and a large partition many; ``gather`` can
    be left out where rows stand together already. ``keep_others`` replaces only the
    partitions that ``df`` has rows of; the files of all others stay as they are.

    The counter sits on top of the plan, so it runs in the writing tasks, whose
    repeats are counted once; no second pass is needed.
    """
    placed = df.hint("rebalance", *partition_by) if partition_by and gather else df
    counted, seen = _counted(placed)
    writer = counted.write.mode("overwrite").partitionBy(*partition_by)
    if keep_others:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return seen.get["rows"]


def through_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write and read back: cuts the lineage. The known schema saves an inference job."""
    write_table(df, path, partition_by, gather=False)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BYTE_ORDER_MARK = "\ufeff"


def write_quarantine(
    df: DataFrame, root: str, entity: str, reason: str, fmt: str = "parquet"
) -> int:
    """Keep rejected or altered rows under ``root/entity/reason``.

    As CSV every part file has a heading, which begins with a byte-order mark.
    """
    path = f"{root}/{entity}/{reason}"
    if fmt == "parquet":
        return write_table(df, path)
    first, *others = df.columns
    marked = df.select(F.col(f"`{first}`").alias(f"{BYTE_ORDER_MARK}{first}"), *(f"`{c}`" for c in others))
    counted, seen = _counted(marked)
    counted.write.mode("overwrite").csv(path, header=True, escape='"')
    return seen.get["rows"]
