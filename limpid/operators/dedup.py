"""Duplicates on a key: which row stays, which rows go.

``dropDuplicates`` keeps an arbitrary row; here an explicit order decides. NULL
keys form one group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limpid.sources.roworder import ROW_ORDER


def _key_names(keys: Sequence[str]) -> dict[str, str]:
    """New names for the keys of a table derived from the one it is joined with."""
    return {k: f"_key_{i}" for i, k in enumerate(keys)}


def _same_key(keys: Sequence[str]) -> Column:
    names = _key_names(keys)
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(names[k])) for k in keys])


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = ROW_ORDER,
    priority: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split into (kept, removed): one row per key stays, lowest priority value first.

    ``order_by`` must tell any two rows of a key apart, as the row order columns
    of a scan do.

    Neither side gathers a key's rows in one task. *kept* is ``row_number() = 1``,
    for which Spark prunes to one row per key in every map task before the
    shuffle. *removed* joins the rows with the first position of each repeated
    key: that table holds keys and positions of repeated keys only and comes from
    partial aggregates; Spark broadcasts it when its size allows and otherwise
    runs a shuffle join whose hot keys AQE splits.
    """
    ranked = df if priority is None else df.withColumn("_rank", priority)
    order = [*([] if priority is None else ["_rank"]), *order_by]

    window = Window.partitionBy(*keys).orderBy(*order)
    kept = (
        ranked.withColumn("_nth", F.row_number().over(window))
        .where(F.col("_nth") == 1)
        .drop("_nth", "_rank")
    )

    repeated = (
        ranked.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"), F.min(F.struct(*order)).alias("_first"))
        .where(F.col("_rows") > 1)
        .select(*[F.col(k).alias(name) for k, name in _key_names(keys).items()], "_first")
    )
    later = F.struct(*order) > F.col("_first")
    removed = ranked.join(repeated, _same_key(keys) & later).select(*df.columns)
    return kept, removed


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once.

    Counting is partial before its shuffle; the rows then meet only the repeated
    keys in a semi join, where a hot key can be split (a window could not).
    """
    repeated = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > 1)
        .select(*[F.col(k).alias(name) for k, name in _key_names(keys).items()])
    )
    return df.join(repeated, _same_key(keys), "left_semi")


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row (n_rows, n_duplicates): rows beyond the first of each key."""
    groups = df.groupBy(*keys).count()
    return groups.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n_duplicates"),
    )
