"""Column naming. Renames are metadata only, they never touch a row."""

from __future__ import annotations

from pyspark.sql import DataFrame

# The only accents folded in headings.
FOLDED_ACCENTS = {"è": "e", "é": "e"}


def fold_accents(name: str) -> str:
    return name.translate(str.maketrans(FOLDED_ACCENTS))


def snake(name: str, fold: bool = True) -> str:
    """Lower case, blanks to underscores, and ``è``/``é`` to ``e`` unless ``fold`` is off."""
    lowered = name.lower().replace(" ", "_")
    return fold_accents(lowered) if fold else lowered


def snake_columns(df: DataFrame, fold: bool = True) -> DataFrame:
    return df.toDF(*[snake(c, fold) for c in df.columns])


def columns_with(df: DataFrame, part: str) -> list[str]:
    """Names of the columns whose name contains ``part``."""
    return [c for c in df.columns if part in c]
