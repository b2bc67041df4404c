"""An explicit row order, for operators that keep the first of several rows.

Spark rows have no position. The three columns below restore the order "files by
name, rows as written". They must be added to the scan itself: an id taken after
a shuffle would change when a lost executor's work is repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW_ORDER = ("_src_file", "_src_block", "_src_row")


def with_row_order(scan: DataFrame) -> DataFrame:
    """Add the order columns to a file scan.

    The monotonic id follows the scan's partitions, which are packed by size, so
    it orders rows only inside one block of one file; the name and the block
    start come first.
    """
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias("_src_file"),
        F.col("_metadata.file_block_start").alias("_src_block"),
        F.monotonically_increasing_id().alias("_src_row"),
    )


def drop_row_order(df: DataFrame) -> DataFrame:
    return df.drop(*ROW_ORDER)
