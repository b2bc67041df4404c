"""Records across line ends and block borders, against a reader of whole files."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from limpid.sources import ROW_ORDER, drop_row_order, read_delimited, read_table, split_unreadable, write_table
from limpid.sources.records import block_facts, read_records, records_across, text_lines
from tests.conftest import rows


@pytest.fixture
def small_blocks(spark):
    """Files are cut into blocks of so many bytes."""

    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield cut
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def cells(rng):
    signs = ["a", "é", ",", ";", '"', "\n", "\r\n", " ", "word", "\n\n", '""', "\n" * 9]
    return "".join(rng.choices(signs, k=rng.randint(0, 8))) or "x"


def table(n, seed, width=3):
    rng = random.Random(seed)
    return [[f"k{i:05d}", *[cells(rng) for _ in range(width - 1)]] for i in range(n)]


def as_text(data, end="\n", quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end, quoting=quoting)
    writer.writerows([[f"c{i}" for i in range(len(data[0]))], *data])
    return out.getvalue()


@pytest.mark.parametrize("block", [90, 1 << 20])
@pytest.mark.parametrize(("end", "encoding"), [("\n", "utf-8-sig"), ("\r\n", "latin-1")])
def test_any_cut_gives_the_same_records(spark, tmp_path, small_blocks, block, end, encoding):
    data = table(60, block)
    for name, part in (("b", data[:40]), ("a", data[40:])):
        text = as_text(part, end, csv.QUOTE_ALL if name == "a" else csv.QUOTE_MINIMAL)
        (tmp_path / f"{name}.csv").write_bytes(text.encode(encoding))
    small_blocks(block)
    charset = "UTF-8" if encoding == "utf-8-sig" else "ISO-8859-1"
    found = read_delimited(spark, str(tmp_path), encoding=charset, multi_line=True, null_tokens=())
    assert found.columns == ["c0", "c1", "c2", *ROW_ORDER]
    ordered = [tuple(r)[:3] for r in found.orderBy(*ROW_ORDER).collect()]
    assert ordered == [tuple(r) for r in data[40:] + data[:40]]
    assert found.select(*ROW_ORDER).distinct().count() == 60


def test_equals_the_scan_of_whole_files(spark, tmp_path, small_blocks):
    """Also where quotes stand inside plain cells, which parity alone would misread."""
    text = 'x,y\n5" pipe,1\n"a\nb" tail,2\n q"uote,3\n"6"" wide",4\n"m\r\nn","o\np"\n,\n"",5\n'
    (tmp_path / "t.csv").write_bytes(text.encode())
    want = spark.read.csv(f"{tmp_path}/t.csv", header=True, escape='"', multiLine=True)
    for block in (11, 1000):
        small_blocks(block)
        found = read_delimited(spark, f"{tmp_path}/t.csv", multi_line=True, null_tokens=(), with_order=False)
        assert rows(found) == rows(want)


def test_a_large_file_uses_many_tasks(spark, tmp_path, small_blocks):
    data = [[f"k{i}", "one\ntwo", "three"] for i in range(5_000)]
    (tmp_path / "t.csv").write_text(as_text(data))
    small_blocks(4_096)
    lines = text_lines(spark, str(tmp_path), "UTF-8")
    assert lines.rdd.getNumPartitions() >= 20
    found = read_delimited(spark, str(tmp_path), multi_line=True)
    assert found.count() == 5_000 and found.where(F.col("c1") != "one\ntwo").count() == 0


def test_states_at_borders_by_hand(spark):
    facts = [
        ("f", 0, True, False, True),    # outside: ends open
        ("f", 10, False, True, False),  # inside: goes on
        ("f", 20, True, False, True),   # turns: closed
        ("f", 30, True, True, True),    # closes nothing, opens one
        ("f", 40, True, True, True),    # closes it, opens the next
        ("f", 50, True, True, False),   # never closed
        ("g", 0, False, False, True),
    ]
    df = spark.createDataFrame(facts, "_src_file string, _src_block bigint, outside boolean, inside boolean, closes boolean")
    assert rows(records_across(df)) == [("f", 0, 20), ("f", 30, 40), ("f", 40, None)]


@pytest.mark.parametrize("block", [20, 1 << 20])
def test_a_quote_that_never_closes_loses_no_line(spark, tmp_path, small_blocks, block):
    body = "".join(f"{i},two\n" for i in range(12))
    (tmp_path / "t.csv").write_text('x,y\n1,2\n"open,3\n' + body)
    (tmp_path / "u.csv").write_text("x,y\n7,8\n")
    small_blocks(block)
    scan = read_delimited(spark, str(tmp_path), multi_line=True, unreadable=True)
    write_table(scan, f"{tmp_path}/bronze/t")
    good, bad = split_unreadable(read_table(spark, f"{tmp_path}/bronze/t"))
    assert rows(drop_row_order(good)) == [("1", "2"), ("7", "8")]
    ordered = [r["ligne"] for r in bad.orderBy(*ROW_ORDER).collect()]
    assert ordered == ['"open,3', *[f"{i},two" for i in range(12)]]


@pytest.mark.parametrize("block", [6, 1 << 20])
def test_without_line_ends_asked_for_no_half_line_is_a_row(spark, tmp_path, small_blocks, block):
    text = 'x,y,z\n"one\ntwo",5,6\n1,2,3\n"a\nb\nc",8,9\n4,5,6,7\n'
    (tmp_path / "t.csv").write_text(text)
    small_blocks(block)
    scan = read_delimited(spark, f"{tmp_path}/t.csv", unreadable=True)
    write_table(scan, f"{tmp_path}/bronze")
    good, bad = split_unreadable(read_table(spark, f"{tmp_path}/bronze"))
    assert rows(drop_row_order(good)) == [("1", "2", "3")]
    assert rows(bad, "ligne", "suite") == [('"a', 'b\nc",8,9'), ('"one', 'two",5,6'), ("4,5,6,7", None)]


def test_headings(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\n"x\ny",,n,N\n1,2,3,4\n')
    found = read_delimited(spark, f"{tmp_path}/a.csv", multi_line=True, with_order=False)
    want = spark.read.csv(f"{tmp_path}/a.csv", header=True, multiLine=True)
    assert found.columns == want.columns and rows(found) == [("1", "2", "3", "4")]
    (tmp_path / "b.csv").write_text("n,m\n1,2\n")
    with pytest.raises(ValueError, match="CSV header"):
        read_delimited(spark, f"{tmp_path}/*.csv", multi_line=True)
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "e.csv").write_text("")
    assert read_delimited(spark, f"{tmp_path}/e", multi_line=True, with_order=False).columns == []
    with pytest.raises(ValueError, match="UTF-16"):
        read_delimited(spark, f"{tmp_path}/a.csv", encoding="UTF-16", multi_line=True)


def test_lines_without_quotes_never_reach_the_first_pass(spark, tmp_path):
    (tmp_path / "t.csv").write_text("x\n" + "plain\n" * 1000)
    lines = text_lines(spark, str(tmp_path), "UTF-8")
    assert block_facts(lines, ",").collect() == []
    assert read_records(spark, str(tmp_path), ",", "UTF-8")[1].count() == 1000
