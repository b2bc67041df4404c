"""Order of written tables against plain lists."""

from __future__ import annotations

import random

import pytest

from limpid.operators.ordering import order_breaks
from limpid.sources import read_table, with_row_order, write_table


def falls(values):
    small = lambda v: tuple((x is not None, x) if x is not None else (False, 0) for x in v)
    return sum(small(a) > small(b) for a, b in zip(values, values[1:]))


@pytest.mark.parametrize("files", [1, 4])
@pytest.mark.parametrize("sort", [True, False])
def test_breaks(spark, tmp_path, files, sort):
    rng = random.Random(files)
    data = [(rng.choice(["a", "b", None]), rng.choice([1, 2, 3, None]), i) for i in range(400)]
    path = f"{tmp_path}/t"
    df = spark.createDataFrame(data, "r string, y int, n int").repartition(files)
    if sort:
        df = df.repartitionByRange(files, "r", "y").sortWithinPartitions("r", "y")
    write_table(df, path)
    rows = with_row_order(read_table(spark, path))
    written = [(r["r"], r["y"]) for r in rows.orderBy("_src_file", "_src_block", "_src_row").collect()]
    found = order_breaks(rows, ["r", "y"]).first()
    assert (found["rows"], found["breaks"]) == (400, falls(written))
    assert (found["breaks"] == 0) == sort


def test_a_break_between_files_only(spark, tmp_path):
    for name, start in (("a", 10), ("b", 0), ("c", 20)):
        spark.range(start, start + 5).coalesce(1).write.parquet(f"{tmp_path}/p={name}")
    rows = with_row_order(read_table(spark, str(tmp_path)))
    assert tuple(order_breaks(rows, ["id"]).first()) == (15, 1)


def test_an_empty_table(spark, tmp_path):
    write_table(spark.range(0), f"{tmp_path}/t")
    rows = with_row_order(read_table(spark, f"{tmp_path}/t"))
    assert tuple(order_breaks(rows, ["id"]).first()) == (0, 0)
