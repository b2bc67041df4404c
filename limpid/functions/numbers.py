"""Numbers from dirty text, and the two rounding rules in use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from limpid.functions.text import BLANKS, squish

# A cast alone is too lenient: Spark reads "12d" as 12 and "nan" as NaN.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
WHOLE = r"^([+-]?\d+)(\.0*)?$"
INFINITY = float("inf")


def to_number(col: Column, grouped: bool = False) -> Column:
    """Double, or NULL when the text is not a finite number.

    ``grouped`` also accepts blanks between digits (``1 245``, NBSP included).
    """
    text = col.cast("string")
    text = F.translate(text, BLANKS, "") if grouped else squish(text)
    # regexp_substr and nullif name their input once, so the text is cleaned once.
    number = F.regexp_substr(text, F.lit(NUMBER)).try_cast("double")
    return F.nullif(F.nullif(number, F.lit(INFINITY)), F.lit(-INFINITY))


def to_count(col: Column) -> Column:
    """Nearest whole number, halves to even, as nullable bigint."""
    return F.bround(col.cast("double")).try_cast("bigint")


def to_year(col: Column) -> Column:
    """Whole calendar year (``2023`` or ``2023.0``), or NULL."""
    digits = F.regexp_extract(squish(col.cast("string")), WHOLE, 1)
    return digits.try_cast("bigint")


def round_half_up(col: Column, digits: int) -> Column:
    """Decimal rounding on the binary value, halves away from zero.

    ``F.round`` goes through the shortest decimal text (1.005 gives 1.01); this
    follows the stored double (1.0), as analytical databases do.
    """
    scale = F.lit(float(10**digits))
    return F.signum(col) * F.floor(F.abs(col) * scale + F.lit(0.5)) / scale


def guarded_ratio(numerator: Column, denominator: Column, empty: float | None = None) -> Column:
    """``numerator / denominator`` as double; ``empty`` when nothing to divide by."""
    ratio = numerator.cast("double") / denominator.cast("double")
    return F.when(denominator > 0, ratio).otherwise(F.lit(empty).cast("double"))
