"""Delimited text scans: every column is read as text."""

from __future__ import annotations

import csv
import io
from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from limpid.functions.text import READER_NULLS, nullify_tokens
from limpid.sources.records import NEVER_CLOSED, read_records
from limpid.sources.roworder import ROW_ORDER, with_row_order

# Text of a line that does not fit the heading, in scans that ask for it.
UNREADABLE = "_unreadable"


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ",",
    encoding: str = "UTF-8",
    with_order: bool = True,
    null_tokens: Sequence[str] = READER_NULLS,
    multi_line: bool = False,
    unreadable: bool = False,
) -> DataFrame:
    """Scan text files with a heading line; a leading byte-order mark is ignored.

    No type is inferred, which would cost one more pass over the data. Each file
    must carry the same headings in the same order: a file that does not fails
    the job instead of landing in the wrong columns. ``multi_line`` allows line
    ends inside quoted cells.

    ``unreadable`` adds a column with the text of records that have more cells than the
    heading, hold a line end that was not asked for, or follow a quote that is never closed;
    it is NULL for all others. Shorter records are filled up with NULL.
    ``split_unreadable`` parts a written table of such a scan.

    With either, the files are read block by block into whole records (``records``), and
    those are written once; without both, Spark's own scan takes each line as a record.
    """
    paths = list(paths) if not isinstance(paths, str) else paths
    if multi_line or unreadable:
        scan, names = _whole_records(spark, paths, sep, encoding, multi_line)
        scan = scan if unreadable else scan.drop(UNREADABLE)
        ordered = scan if with_order else scan.drop(*ROW_ORDER)
    else:
        scan = spark.read.csv(
            paths, header=True, inferSchema=False, enforceSchema=False, sep=sep, escape='"', encoding=encoding
        )
        names = scan.columns
        ordered = with_row_order(scan) if with_order else scan
    if not null_tokens:
        return ordered
    return ordered.withColumns({c: nullify_tokens(F.col(f"`{c}`"), null_tokens) for c in names})


def _heading_names(text: str | None, sep: str) -> tuple[list[str], list[str]]:
    """(cells, names) of a heading; blank and repeated names get their place, as in Spark's scan."""
    cells = next(csv.reader(io.StringIO(text, newline=""), delimiter=sep)) if text else []
    seen = Counter(c.lower() for c in cells)
    names = [f"_c{i}" if not c else f"{c}{i}" if seen[c.lower()] > 1 else c for i, c in enumerate(cells)]
    return cells, names


def _whole_records(
    spark: SparkSession, paths: str | Sequence[str], sep: str, encoding: str, multi_line: bool
) -> tuple[DataFrame, list[str]]:
    headings, records = read_records(spark, paths, sep, encoding)
    first = headings.agg(F.min("record")).first()[0]
    heading, names = _heading_names(first, sep)
    layout = {"sep": sep, "escape": '"', "multiLine": "true"}
    schema = ", ".join(f"c{i} string" for i in range(len(names) + 1))
    same = [F.coalesce(F.col(f"_cells.c{i}"), F.lit("")) == cell for i, cell in enumerate([*heading, ""])]
    cut = headings.withColumn("_cells", F.from_csv("record", schema, layout))
    other = cut.where(~reduce(Column.__and__, same)).select("_src_file", "record").first()
    if other:
        raise ValueError(f"CSV header of {other[0]} is {other[1]!r}, not {first!r} as in another file")
    # One cell more than the heading tells records that are too long.
    parsed = records.withColumn("_cells", F.from_csv("record", schema, layout))
    broken = F.col(f"_cells.c{len(names)}").isNotNull() | (F.col("kind") == NEVER_CLOSED)
    if not multi_line:
        broken = broken | F.contains("record", F.lit("\n"))
    cells = [F.col(f"_cells.c{i}").alias(name) for i, name in enumerate(names)]
    return parsed.select(*cells, F.when(broken, F.col("record")).alias(UNREADABLE), *ROW_ORDER), names


def split_unreadable(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, text and place of those that do not) of a written scan.

    ``ligne`` is the first line of a record that does not fit, ``suite`` the lines after it.
    """
    places = [c for c in ROW_ORDER if c in rows.columns]
    record = F.col(UNREADABLE)
    first = F.substring_index(record, "\n", 1)
    rest = F.when(F.contains(record, F.lit("\n")), F.substring(record, F.length(first) + 2, F.length(record)))
    bad = rows.where(record.isNotNull()).select(first.alias("ligne"), rest.alias("suite"), *places)
    return rows.where(record.isNull()).drop(UNREADABLE), bad
