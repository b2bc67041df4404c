"""Counts about columns, each in one pass over the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_row_per(measures: Mapping[str, Sequence[Column]], df: DataFrame, names: Sequence[str]):
    """Aggregate everything at once, then turn the single row into one row per label."""
    aggregates = [
        value.alias(f"_{i}_{j}")
        for i, values in enumerate(measures.values())
        for j, value in enumerate(values)
    ]
    width = len(names)
    rows = F.array(
        *[
            F.struct(
                F.lit(label).alias("label"),
                *[F.col(f"_{i}_{j}").alias(names[j]) for j in range(width)],
            )
            for i, label in enumerate(measures)
        ]
    )
    return df.agg(*aggregates).select(F.inline(rows))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, n_rows, n_null, null_rate); the rate of an empty table is 0."""
    measures = {
        c: [F.count(F.lit(1)), F.count_if(F.col(c).isNull())] for c in (columns or df.columns)
    }
    counted = one_row_per(measures, df, ["n_rows", "n_null"])
    rate = F.when(F.col("n_rows") > 0, F.col("n_null") / F.col("n_rows")).otherwise(F.lit(0.0))
    return counted.withColumn("null_rate", rate).withColumnRenamed("label", "column_name")


def distinct_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n_distinct): exact distinct counts of non-null values.

    Distinct aggregates shuffle by value after removing repeats in each map task,
    so a frequent value costs one row per task.
    """
    measures = {c: [F.count_distinct(F.col(c))] for c in columns}
    counted = one_row_per(measures, df, ["n_distinct"])
    return counted.withColumnRenamed("label", "column_name")
