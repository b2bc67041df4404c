"""Exact medians of groups of any size, on one path for every size.

1. Rows are counted per (group, value): a partial aggregate, so a value that fills a
   group shrinks to one row before it is shuffled.
2. These counts are range-partitioned by (group, value), which splits a large group
   over several slices, and written with the number of their slice: the cuts of a
   repeated sampling could differ, those of a table cannot.
3. Sums per (group, slice) tell in which slice the middle ranks of each group lie, one or
   two slices a group. Only there are counts added up to find the values of these ranks.

No step gathers a group: a slice is bounded, whatever group or value fills it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limpid.operators.rollup import median_sketches, sketch_medians
from limpid.sources.scratch import scratch_folder
from limpid.sources.tables import through_table


def _cut(df: DataFrame, purpose: str) -> DataFrame:
    return through_table(df, scratch_folder(df.sparkSession, purpose))


def value_counts(df: DataFrame, value: str, groups: list[str]) -> DataFrame:
    """(groups, value, _n) as a written table; NULL and NaN values and NULL groups left out."""
    number = F.col(value).cast("double")
    present = df.select(*groups, number.alias(value)).where(~F.isnan(value)).na.drop()
    return _cut(present.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n")), "value-counts")


def medians_of_counts(counts: DataFrame, value: str, groups: list[str], name: str) -> DataFrame:
    """(groups, name) from a written table of (groups, value, _n)."""
    spread = counts.repartitionByRange(*groups, value).withColumn("_slice", F.spark_partition_id())
    placed = _cut(spread, "value-slices")
    slices = placed.groupBy(*groups, "_slice").agg(F.sum("_n").alias("_in"))
    whole = Window.partitionBy(*groups)
    upto = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The middle ranks of a group, and the slices that hold them: one row a slice and group.
    middle = (
        slices.withColumns({"_total": F.sum("_in").over(whole), "_end": F.sum("_in").over(upto)})
        .withColumns(
            {
                "_start": F.col("_end") - F.col("_in"),
                "_low": F.expr("(_total + 1) div 2"),
                "_high": F.expr("_total div 2 + 1"),
            }
        )
        .where("_end >= _low and _start < _high")
        .select(*groups, "_slice", "_start", "_low", "_high")
    )
    within = (
        Window.partitionBy(*groups, "_slice").orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = placed.join(middle, [*groups, "_slice"]).withColumn(
        "_end", F.col("_start") + F.sum("_n").over(within)
    )
    found = ranked.where((F.col("_end") >= F.col("_low")) & (F.col("_end") - F.col("_n") < F.col("_high")))
    low, high = F.min(value), F.max(value)
    # Halves first: the sum of two large values could overflow.
    return found.groupBy(*groups).agg(F.when(low == high, low).otherwise(low / 2 + high / 2).alias(name))


def group_median(df: DataFrame, value: str, group: str, exact: bool = True) -> DataFrame:
    """(group, group_median): NULL and NaN values ignored, no row for a NULL group.

    With ``exact=False`` one pass over mergeable sketches; see ``rollup`` for the error.
    """
    if not exact:
        return sketch_medians(median_sketches(df, value, [group]), [group], "group_median")
    return medians_of_counts(value_counts(df, value, [group]), value, [group], "group_median")


def overall_median(df: DataFrame, value: str, exact: bool = True) -> DataFrame:
    """(overall_median): median of a whole column, one row, NULL without values."""
    if not exact:
        return sketch_medians(median_sketches(df, value, []), [], "overall_median")
    # Without groups the counts are one row a value already.
    counts = value_counts(df, value, []).withColumn("_all", F.lit(1))
    found = medians_of_counts(counts, value, ["_all"], "overall_median")
    return found.agg(F.first("overall_median").alias("overall_median"))


def overall_of_counts(counts: DataFrame, value: str) -> DataFrame:
    """(overall_median) from a table that has counts ``_n`` of each value, groups allowed."""
    whole = counts.groupBy(value).agg(F.sum("_n").alias("_n")).withColumn("_all", F.lit(1))
    whole = _cut(whole, "value-counts")
    found = medians_of_counts(whole, value, ["_all"], "overall_median")
    return found.agg(F.first("overall_median").alias("overall_median"))
