"""Missing values: delete, impute or fill with zero, always with an audit.

Audit column names and reason texts are part of the output contract.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.functions.numbers import NUMBER, round_half_up, to_number
from limpid.functions.text import BUDGET_SENTINELS, nullify_tokens
from limpid.operators.median import medians_of_counts, overall_median, overall_of_counts, value_counts
from limpid.operators.rollup import SKETCH_K

THRESHOLD = 0.05


def run_stamp() -> str:
    """Time text of a run: taken once, so repeated tasks write the same rows."""
    return datetime.now().strftime("%Y-%m-%d %H:%M:%S")


def nan_to_null(df: DataFrame, col: str, drop: bool = False) -> DataFrame:
    """A NaN is a missing value like NULL (or its row goes); only floats have one."""
    if df.schema[col].dataType.typeName() not in ("float", "double"):
        return df
    if drop:
        return df.where(~F.isnan(col))
    return df.withColumn(col, F.when(~F.isnan(col), F.col(col)))


@dataclass(frozen=True)
class GapFacts:
    """What one aggregate tells of a column before its gaps are handled.

    The median is that of a sketch: exact for few rows, else off by ``rollup.RANK_ERROR``.
    """

    rows: int
    missing: int
    mean: float | None
    median: float | None

    @property
    def rate(self) -> float:
        return self.missing / self.rows if self.rows else 0.0


def column_facts(col: str) -> dict[str, Column]:
    """Aggregates of a column, NaN counted as missing; also for an observation."""
    number = F.col(col).cast("double")
    value = F.when(~F.isnan(number), number)
    sketch = F.kll_sketch_agg_double(value, F.lit(SKETCH_K))
    return {
        "rows": F.count(F.lit(1)),
        "missing": F.count_if(value.isNull()),
        "mean": F.avg(value),
        # An empty sketch has no quantile.
        "median": F.when(F.count(value) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(0.5))),
    }


def gap_facts(df: DataFrame, col: str) -> GapFacts:
    """Runs one aggregate job over one column."""
    found = df.agg(*[x.alias(name) for name, x in column_facts(col).items()]).first()
    return GapFacts(**found.asDict())


def missing_rate(df: DataFrame, col: str) -> float:
    """Share of NULL and NaN in ``col``; 0 for an empty table. Runs one aggregate job."""
    return gap_facts(df, col).rate


def delete_missing(
    df: DataFrame, col: str, run_ts: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split into (rows with a value, audit of the rows without)."""
    kept = nan_to_null(df.where(F.col(col).isNotNull()), col, drop=True)
    removed = nan_to_null(df, col).where(F.col(col).isNull()).withColumns(
        {
            "date_suppression": F.lit(run_ts or run_stamp()),
            "motif_suppression": F.lit(f"valeur_manquante_{col}"),
        }
    )
    return kept, removed


def impute_group_median(
    df: DataFrame, col: str, group: str, run_ts: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Fill NULL with the group's median, else with the overall one: (filled, audit).

    Group and overall medians come from one table of counts. Only the rows with a hole
    meet them; the others pass through with no shuffle. If the column holds no value at
    all, its NULLs stay. NaN counts as NULL.
    """
    df = nan_to_null(df, col)
    # Values of rows without a group count for the overall median, as a group of their own.
    keyed = df.select(F.struct(group).alias("_group"), col)
    counts = value_counts(keyed, col, ["_group"])
    named = counts.where(F.col("_group").getField(group).isNotNull())
    named = named.select(F.col("_group").getField(group).alias(group), col, "_n")
    by_group = medians_of_counts(named, col, [group], "group_median")
    overall = overall_of_counts(counts, col)
    values = df.withColumn(col, F.col(col).cast("double"))
    holes = (
        values.where(F.col(col).isNull())
        .join(by_group, group, "left")
        .withColumn("_overall", overall.scalar())
        .withColumn("_value", F.coalesce("group_median", "_overall"))
    )
    audit = holes.select(
        *df.columns,
        F.col("_value").alias("valeur_imputee"),
        F.col("_value").alias("mediane_etablissement"),
        F.col("_overall").alias("mediane_globale_fallback"),
        F.col("group_median").isNull().alias("etablissement_sans_median"),
        F.lit(run_ts or run_stamp()).alias("date_imputation"),
    )
    patched = holes.withColumn(col, F.col("_value")).select(*df.columns)
    return values.where(F.col(col).isNotNull()).unionByName(patched), audit


def handle_missing(
    df: DataFrame,
    col: str,
    group: str,
    threshold: float = THRESHOLD,
    strategy: str = "auto",
    run_ts: str | None = None,
    facts: GapFacts | None = None,
) -> tuple[DataFrame, DataFrame, str]:
    """(clean, audit, strategy used). ``auto`` deletes up to ``threshold`` included.

    The rate is one small aggregate job, unless its ``facts`` are known; only the chosen
    branch is then planned.
    """
    if strategy == "auto":
        rate = facts.rate if facts else missing_rate(df, col)
        strategy = "delete" if rate <= threshold else "impute"
    if strategy == "delete":
        return *delete_missing(df, col, run_ts), strategy
    if strategy == "impute":
        return *impute_group_median(df, col, group, run_ts), strategy
    raise ValueError(f"unknown strategy {strategy!r}")


def amount(col: Column, sentinels: Sequence[str] = BUDGET_SENTINELS) -> Column:
    """Amount in a budget cell, NULL when it is a sentinel or not a number.

    A sentinel that is no number anyway needs no test of its own.
    """
    numeric = [s for s in sentinels if re.match(NUMBER, s.strip())]
    return to_number(nullify_tokens(col, numeric, strip=True) if numeric else col)


def zero_fill(df: DataFrame, columns: Sequence[str], sentinels=BUDGET_SENTINELS) -> DataFrame:
    """Amounts as double, unknown ones 0, all columns in one projection."""
    return df.withColumns(
        {c: F.coalesce(amount(F.col(c), sentinels), F.lit(0.0)) for c in columns}
    )


def stats_before_after(before: DataFrame, after: DataFrame, col: str) -> DataFrame:
    """(stage, mean_value, median_value) of a column, to two decimals."""

    def stats(df: DataFrame, stage: str) -> DataFrame:
        middle = overall_median(df, col).scalar()
        return df.agg(F.avg(col).alias("mean_value")).select(
            F.lit(stage).alias("stage"),
            round_half_up(F.col("mean_value"), 2).alias("mean_value"),
            round_half_up(middle, 2).alias("median_value"),
        )

    return stats(before, "avant").unionByName(stats(after, "apres"))
