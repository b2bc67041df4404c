"""Records of delimited text whose quoted cells may hold line ends, read block by block.

A large file is cut into blocks anywhere, so a task cannot know whether its first line stands
inside a quoted cell. A first pass notes, for each block with a quote, where it would end if
it began outside and inside such a cell. Composed in file order these facts give the state at
every block border and the few records that lie across one. In a second pass each task turns
its lines into whole records; pieces of the records that lie across borders are put together
by Spark. A file is read in as many tasks as it has blocks, whatever its cells hold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from limpid.sources.roworder import with_row_order
from limpid.sources.scratch import scratch_folder
from limpid.sources.tables import through_table

FACTS = "_src_file string, _src_block bigint, outside boolean, inside boolean, closes boolean"
# A record, or a piece of one: ``seq`` orders the pieces of a record.
PIECES = "kind string, record string, _src_file string, _src_block bigint, _src_row bigint, seq bigint"
ROW, HEADING, PIECE, NEVER_CLOSED = "row", "heading", "piece", "open"

# Encodings in which a line end and a quote are one byte that nothing else contains.
BYTEWISE = {"UTF-8", "UTF8", "ISO-8859-1", "LATIN-1", "LATIN1", "US-ASCII"}

Batches = Iterator[pa.RecordBatch]


def _task(sep: str, spans: dict | None) -> Callable[[Batches], Batches]:
    """The body of both passes. Nested, so it travels to executors by value.

    ``spans`` maps a file to (first block, last block or None) of each record across a
    border; without it facts are made, with it pieces.
    """
    kinds = (ROW, HEADING, PIECE, NEVER_CLOSED)

    def after_quote(line, at):
        """The place behind the quote that closes a cell, -1 if none does."""
        while True:
            at = line.find('"', at) + 1
            if not at:
                return -1
            if not line.startswith('"', at):
                return at
            at += 1

    def ends_inside(line, inside):
        """Whether a line ends in a quoted cell. Only a cell's first sign opens it."""
        at = 0
        while True:
            if inside or line.startswith('"', at):
                at = after_quote(line, at if inside else at + 1)
                if at < 0:
                    return True
                inside = False
            at = line.find(sep, at)
            if at < 0:
                return False
            at += len(sep)

    def facts(batches):
        import pyarrow as pa

        place, outside, inside, closes = None, False, True, False
        found = []

        def batch_of(rows):
            columns = list(zip(*rows))
            names = ["_src_file", "_src_block", "outside", "inside", "closes"]
            types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("line", "_src_file", "_src_block"))
            for line, file, block in zip(*columns):
                if (file, block) != place:
                    if place:
                        found.append((*place, outside, inside, closes))
                    place, outside, inside, closes = (file, block), False, True, False
                outside, inside = ends_inside(line, outside), ends_inside(line, inside)
                closes = closes or not inside
        if place:
            found.append((*place, outside, inside, closes))
        if found:
            yield batch_of(found)

    def pieces(batches):
        import pyarrow as pa

        row, heading, piece, never = kinds
        place, first_seen, state = None, True, False
        owner, closed, last = None, True, True
        held, held_row, out = [], None, []

        def batch_of(rows):
            names = ["kind", "record", "_src_file", "_src_block", "_src_row", "seq"]
            types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names
            )

        def put(kind, lines, row_no, block):
            file, seq = place
            text = "\n".join(lines)
            if kind in (row, heading, never):
                text = text.removesuffix("\r")
                if not text.strip(" \t\r\n"):
                    return False
            out.append((kind, text, file, block, row_no, seq))
            return True

        def finish():
            """What is left at the end of a block lies across its border, or never closes."""
            if not held:
                return
            if last:
                put(piece, held, held_row, place[1] if owner is None else owner)
            else:
                for offset, line in enumerate(held):
                    put(never, [line], held_row + offset, place[1])

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("line", "_src_file", "_src_block", "_src_row"))
            for line, file, block, row_no in zip(*columns):
                if (file, block) != place:
                    if place:
                        finish()
                    place, first_seen, held, held_row = (file, block), block == 0, [], None
                    across = spans.get(file, ())
                    owner = next((a for a, b in across if a < block and (b is None or block <= b)), None)
                    state = owner is not None
                    # Whether the record open at this block's end is ever closed.
                    last = not any(a <= block and b is None for a, b in across)
                    if block == 0:
                        line = line.removeprefix("﻿")
                if not held:
                    held_row = row_no
                held.append(line)
                if '"' in line:
                    state = ends_inside(line, state)
                if state:
                    continue
                if owner is not None:
                    put(piece, held, held_row, owner)
                    owner = None
                elif put(heading if first_seen else row, held, held_row, block):
                    first_seen = False
                held = []
            if out:
                yield batch_of(out)
                out = []
        if place:
            finish()
        if out:
            yield batch_of(out)

    return facts if spans is None else pieces


def text_lines(spark: SparkSession, paths: str | Sequence[str], encoding: str) -> DataFrame:
    """(line, row order) of text files; only a line feed ends a line."""
    if encoding.upper() not in BYTEWISE:
        raise ValueError(f"{encoding}: line ends are looked for byte by byte")
    lines = with_row_order(spark.read.text(paths if isinstance(paths, str) else list(paths), lineSep="\n"))
    text: Column = F.make_valid_utf8("value")
    if encoding.upper() not in ("UTF-8", "UTF8"):
        text = F.decode(F.col("value").cast("binary"), encoding)
    return lines.withColumn("value", text).withColumnRenamed("value", "line")


def block_facts(lines: DataFrame, sep: str) -> DataFrame:
    """For each block with a quote: does it end inside a cell if it began outside or inside,
    and does a record end in it if it began inside."""
    quoted = lines.where(F.contains("line", F.lit('"'))).select("line", "_src_file", "_src_block")
    return quoted.mapInArrow(_task(sep, None), FACTS)


def records_across(facts: DataFrame) -> DataFrame:
    """(file, first, last): blocks of each record across a border; last is NULL if the file
    ends before the record does. At most one for each block."""
    so_far = Window.partitionBy("_src_file").orderBy("_src_block").rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy("_src_file").orderBy("_src_block").rowsBetween(1, Window.unboundedFollowing)
    in_order = Window.partitionBy("_src_file").orderBy("_src_block")
    # A block sets the state, keeps it, or turns it; what was set last counts, and the turns since.
    sets = F.col("outside") == F.col("inside")
    turns = F.sum((F.col("outside") & ~F.col("inside")).cast("int")).over(so_far)
    counted = facts.withColumn("turns", turns)
    base = F.last(F.when(sets, F.col("outside")), ignorenulls=True).over(so_far)
    since = F.col("turns") - F.coalesce(F.last(F.when(sets, F.col("turns")), ignorenulls=True).over(so_far), F.lit(0))
    after = F.coalesce(base, F.lit(False)).cast("int").bitwiseXOR((since % 2).cast("int")) == 1
    states = counted.withColumn("after", after)
    states = states.withColumn("before", F.coalesce(F.lag("after").over(in_order), F.lit(False)))
    ends = F.first(F.when(F.col("before") & F.col("closes"), F.col("_src_block")), ignorenulls=True).over(later)
    begins = F.col("after") & (~F.col("before") | F.col("closes"))
    return states.withColumn("last", ends).where(begins).select(
        F.col("_src_file").alias("file"), F.col("_src_block").alias("first"), "last"
    )


def read_records(
    spark: SparkSession, paths: str | Sequence[str], sep: str, encoding: str
) -> tuple[DataFrame, DataFrame]:
    """(headings, records) of text files, both as (kind, record, row order), written once.

    The quote is doubled inside quoted cells. Blank lines are skipped, a leading byte-order
    mark and a carriage return at a record's end are dropped. Lines from a quote that is
    never closed to the end of the file are records of kind ``NEVER_CLOSED``, one each. A
    record is put together in one task, so it must fit there.
    """
    lines = text_lines(spark, paths, encoding)
    spans: dict[str, list[tuple[int, int | None]]] = {}
    for r in records_across(block_facts(lines, sep)).toLocalIterator():
        spans.setdefault(r["file"], []).append((r["first"], r["last"]))
    made = lines.mapInArrow(_task(sep, spans), PIECES)
    made = through_table(made, scratch_folder(spark, "records"), ["kind"])
    order = ["_src_file", "_src_block", "_src_row"]
    parts = made.where(F.col("kind") == PIECE).groupBy("_src_file", "_src_block").agg(
        F.sort_array(F.collect_list(F.struct("seq", "_src_row", "record"))).alias("parts")
    )
    whole = F.array_join("parts.record", "\n")
    joined = parts.select(
        F.lit(ROW).alias("kind"), F.regexp_replace(whole, "\r$", "").alias("record"),
        "_src_file", "_src_block", F.col("parts")[0]["_src_row"].alias("_src_row"),
    )
    rows = made.where(F.col("kind").isin(ROW, NEVER_CLOSED)).select("kind", "record", *order)
    headings = made.where(F.col("kind") == HEADING).select("kind", "record", *order)
    return headings, rows.unionByName(joined)
