"""What each Parquet file of a table says about itself, read from its footer in tasks.

A reader takes the columns of a table from one file or from a declaration; a file that
differs fails the scan, or gives NULL, without being named. Here each file answers alone.
Footers are some kilobytes at the end of a file; no data page is read.

Files are listed by Spark and opened by Arrow, so the store must be one that Arrow knows
(local, HDFS, S3, GCS).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs, parquet
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import from_arrow_type

FOOTERS = (
    "file string, n_rows bigint, fault string, "
    "columns array<struct<name: string, kind: string, n_nulls: bigint>>"
)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path as Spark names it, and the path there."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}")


def spark_type(kind: pa.DataType) -> str:
    """Spark's name of the type it reads a column as; Arrow's where Spark has none."""
    if pa.types.is_dictionary(kind):
        kind = kind.value_type
    try:
        return from_arrow_type(kind, prefer_timestamp_ntz=True).simpleString()
    except PySparkException:
        return str(kind)


def _instants(schema: parquet.ParquetSchema) -> set[str]:
    """Columns with the 96-bit time stamps that Spark reads as instants, Arrow as local times."""
    leaves = (schema.column(i) for i in range(len(schema)))
    return {c.path.split(".")[0] for c in leaves if c.physical_type == "INT96"}


def _nulls(about: parquet.FileMetaData) -> dict[str, int | None]:
    """NULLs of each flat column, by the statistics; ``None`` if a row group has none."""
    found: dict[str, int | None] = {}
    for g in range(about.num_row_groups):
        group = about.row_group(g)
        for c in range(group.num_columns):
            column = group.column(c)
            facts = column.statistics
            told = facts is not None and facts.has_null_count
            before = found.get(column.path_in_schema, 0)
            known = told and before is not None
            found[column.path_in_schema] = before + facts.null_count if known else None
    return found


def footer(path: str) -> dict:
    """One row of ``FOOTERS``. A file that is not Parquet has a fault and no columns."""
    store, place = opened(path)
    try:
        with store.open_input_file(place) as source:
            file = parquet.ParquetFile(source)
            about, schema, instants = file.metadata, file.schema_arrow, _instants(file.schema)
    except pa.ArrowInvalid as error:
        return {"file": path, "n_rows": None, "fault": str(error), "columns": None}
    nulls = _nulls(about)
    empty = 0 if about.num_rows == 0 else None
    columns = []
    for f in schema:
        kind = spark_type(f.type)
        if f.name in instants:
            kind = kind.replace("timestamp_ntz", "timestamp")
        columns.append({"name": f.name, "kind": kind, "n_nulls": nulls.get(f.name, empty)})
    return {"file": path, "n_rows": about.num_rows, "fault": None, "columns": columns}


_ARROW = pa.schema(
    [
        ("file", pa.string()),
        ("n_rows", pa.int64()),
        ("fault", pa.string()),
        (
            "columns",
            pa.list_(
                pa.struct([("name", pa.string()), ("kind", pa.string()), ("n_nulls", pa.int64())])
            ),
        ),
    ]
)


def _footers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [footer(path) for path in batch.column("path").to_pylist()]
        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def file_footers(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(file, n_rows, fault, columns) of each file below ``path``, at any depth.

    ``pattern`` picks files by name (``*.parquet``); names that begin with ``_`` or ``.``
    are never files of a table, and Spark passes over files of no bytes in every scan.
    ``columns`` holds name, type and count of NULLs, which is
    NULL for nested columns and where the writer left no statistics. Columns that stand in
    folder names only are in no footer.

    Each file is opened once. The tasks are at most as many as those of a shuffle: a
    footer costs a few reads, so a task can take thousands.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return reader.load(path).select("path").coalesce(tasks).mapInArrow(_footers, FOOTERS)
