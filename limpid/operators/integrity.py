"""Foreign keys.

No join here carries a broadcast hint. Spark broadcasts a side whose size,
estimated or measured at run time, is under its threshold, and otherwise shuffles
with AQE splitting hot keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_by_reference(
    df: DataFrame, dim: DataFrame | None, key: str
) -> tuple[DataFrame, DataFrame | None]:
    """Split into (rows whose key is in ``dim``, orphans). A NULL key is an orphan.

    Without a reference table every row is kept and there are no orphans.
    """
    if dim is None or key not in df.columns:
        return df, None
    known = dim.select(key)
    return df.join(known, key, "left_semi"), df.join(known, key, "left_anti")


def split_marked(
    df: DataFrame, dim: DataFrame | None, key: str, cut: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame | None]:
    """As ``split_by_reference``, by one join: ``cut`` writes its marked rows for both parts."""
    if dim is None or key not in df.columns:
        return cut(df), None
    known = dim.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_known", F.lit(True))
    marked = cut(df.join(known, key, "left").select(*df.columns, "_known"))
    return marked.where("_known").drop("_known"), marked.where("_known is null").drop("_known")


def missing_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` absent from ``right`` (a set difference)."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")
