"""Distinct counts and medians that roll up: small states per group, merged to coarser ones.

Bitmaps are exact: each key has a number, a group one row of 4 KB per 32,768 numbers it
meets, and groups merge by OR, so no key is shuffled twice. Sketches have a stated error and
a bounded size. Both are plain binary columns: they can be written for each batch of rows and
merged over batches later.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limpid.sources.scratch import scratch_folder
from limpid.sources.tables import through_table

NUMBER = "_number"
# Numbers that one row of a bitmap covers; fixed by the engine's bitmap functions.
BITMAP = 32_768
# Of a median sketch, and the largest share of rows by which its rank is off (99 %).
SKETCH_K = 2048
RANK_ERROR = 0.002
# log2 of the registers of a distinct sketch, and its relative standard error.
REGISTERS = 14
DISTINCT_ERROR = 0.0065


def key_numbers(keys: DataFrame, key: str) -> DataFrame:
    """(key, number): whole numbers from 1 without gaps, in key order, NULL left out.

    Written twice: once in the slices of a range partitioning, which keep their numbers, and
    once with the final number. Only row counts per slice are added up.
    """
    distinct = keys.select(key).where(F.col(key).isNotNull()).distinct()
    sliced = distinct.repartitionByRange(key).withColumn("_slice", F.spark_partition_id())
    placed = through_table(sliced, scratch_folder(keys.sparkSession, "key-slices"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))  # one row a slice
    starts = counts.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_slice").orderBy(key)
    numbered = placed.join(F.broadcast(starts), "_slice").select(
        key, (F.col("_start") + F.row_number().over(within)).alias(NUMBER)
    )
    return through_table(numbered, scratch_folder(keys.sparkSession, "key-numbers"))


def distinct_bitmaps(df: DataFrame, numbers: DataFrame, key: str, groups: Sequence[str]) -> DataFrame:
    """(groups, bucket, bits): which numbers each group has; keys without a number are left out."""
    numbered = df.join(numbers, key)
    return (
        numbered.groupBy(*groups, F.bitmap_bucket_number(NUMBER).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias("bits"))
    )


def merged_bitmaps(bitmaps: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The same for coarser groups, or for several batches of the same groups."""
    return bitmaps.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_counts(bitmaps: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """(groups, name): exact distinct counts, the bitmaps of a group merged."""
    merged = merged_bitmaps(bitmaps, groups)
    return merged.groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).alias(name))


def distinct_sketches(df: DataFrame, key: str, groups: Sequence[str]) -> DataFrame:
    """(groups, sketch): at most 16 KB a group; counts are off by ``DISTINCT_ERROR`` (one sigma)."""
    return df.groupBy(*groups).agg(F.hll_sketch_agg(key, F.lit(REGISTERS)).alias("sketch"))


def sketch_counts(sketches: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    merged = sketches.groupBy(*groups).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*groups, F.hll_sketch_estimate("sketch").alias(name))


def median_sketches(df: DataFrame, value: str, groups: Sequence[str]) -> DataFrame:
    """(groups, sketch) of the values that are neither NULL nor NaN; NULL groups left out."""
    number = F.col(value).cast("double")
    present = df.select(*groups, number.alias(value)).where(~F.isnan(value)).na.drop()
    return present.groupBy(*groups).agg(F.kll_sketch_agg_double(value, F.lit(SKETCH_K)).alias("sketch"))


def sketch_medians(sketches: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """(groups, name): a value whose rank is off the middle by at most ``RANK_ERROR`` of the rows."""
    merged = sketches.groupBy(*groups).agg(F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch"))
    return merged.select(*groups, F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)).alias(name))
