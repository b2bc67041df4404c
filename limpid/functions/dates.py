"""Dates from day-first text, ISO text and spreadsheet serial numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from limpid.functions.text import squish

# d and M take one or two digits; yyyy takes exactly four.
DAY_FIRST = "d/M/yyyy"
SERIAL = r"^\d{1,7}(\.\d+)?$"
YEAR = r"^(19|20)\d\d$"
# Day zero and last day of spreadsheet serial numbers.
SERIAL_ORIGIN = "1899-12-30"
SERIAL_LAST = 2958465


def from_serial(text: Column) -> Column:
    """The day of a spreadsheet serial number, NULL for other text and beyond its range."""
    return F.when(text.rlike(SERIAL), _serial_day(text))


def _serial_day(digits: Column) -> Column:
    days = digits.try_cast("double")
    return F.when(
        days.between(1, SERIAL_LAST), F.date_add(F.lit(SERIAL_ORIGIN).cast("date"), days.cast("int"))
    )


def cell_date(text: Column, kind: Column) -> Column:
    """The date of a workbook cell whose kind is known, or NULL.

    A number is a serial number, also 2020; text is a year, ISO or day first, and digits
    that are no year are no date.
    """
    plain = squish(text.cast("string"))
    number = kind.isin("number", "date") & plain.rlike(SERIAL)
    other = F.when(~plain.rlike(SERIAL) | plain.rlike(YEAR), to_date_coerce(plain))
    return F.when(number, from_serial(plain)).otherwise(other)


def to_date_coerce(col: Column, fmt: str | None = None) -> Column:
    """Date, or NULL when the text is not one.

    With ``fmt`` only that layout is taken. Without it, four digits from 1900 to 2099
    are a year, any other number is a spreadsheet serial, and other text must be ISO,
    time part allowed, or day first.
    """
    if fmt is not None:
        return _laid_out(col, fmt)
    text = squish(col.cast("string"))
    iso = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), text).try_cast("date")
    # Digits are no other kind of date, so each pattern is asked once.
    return (
        F.when(text.rlike(YEAR), F.try_to_date(text, "yyyy"))
        .when(text.rlike(SERIAL), _serial_day(text))
        .otherwise(F.coalesce(iso, _laid_out(text, DAY_FIRST)))
    )


def _laid_out(text: Column, fmt: str) -> Column:
    """The date of a text in that layout. A text without its ``/`` is not tried: each failure costs
    an exception in the parser."""
    tried = F.try_to_date(text, fmt)
    return F.when(F.contains(text, F.lit("/")), tried) if "/" in fmt else tried


def iso_text(col: Column) -> Column:
    return col.cast("date").cast("string")
