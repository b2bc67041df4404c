from __future__ import annotations

import datetime
import io
import re
import subprocess
import sys
import zipfile
from xml.etree import ElementTree

import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from limpid.functions import snake_columns
from limpid.sources import (
    ROW_ORDER,
    decode_tabs,
    drop_row_order,
    read_delimited,
    read_table,
    read_table_if_any,
    read_workbook_files,
    read_workbook_tab,
    scratch_folder,
    split_unreadable,
    table_exists,
    typed_tab,
    with_row_order,
    write_quarantine,
    write_table,
)
from limpid.sources.workbook import _decoder
from tests.conftest import rows
from workload.xlsx import workbook_bytes


def test_latin1_headings_and_cells(spark, tmp_path):
    text = "Code établissement;Région\nETB-001; Kara\nETB-002;Lycée d'été\n"
    (tmp_path / "a.csv").write_bytes(text.encode("latin-1"))
    df = read_delimited(spark, str(tmp_path / "a.csv"), sep=";", encoding="ISO-8859-1")
    clean = drop_row_order(snake_columns(df))
    assert clean.columns == ["code_etablissement", "region"]
    assert rows(clean) == [("ETB-001", " Kara"), ("ETB-002", "Lycée d'été")]


def test_byte_order_mark_in_every_file(spark, tmp_path):
    for name, body in {"a": "x,y\n1,NA\n", "b": "x,y\n2,\n3, NA \n"}.items():
        (tmp_path / f"{name}.csv").write_bytes(body.encode("utf-8-sig"))
    df = drop_row_order(read_delimited(spark, f"{tmp_path}/*.csv"))
    assert df.columns == ["x", "y"] and {t for _, t in df.dtypes} == {"string"}
    assert rows(df) == [("1", None), ("2", None), ("3", " NA ")]


def test_quoted_cells_keep_separators_and_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n"1, 2","say ""hi"""\n')
    assert rows(drop_row_order(read_delimited(spark, str(tmp_path)))) == [("1, 2", 'say "hi"')]


def test_line_ends_inside_cells_on_request(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('x,y\n"one\ntwo",1\n'.encode("utf-8-sig"))
    df = read_delimited(spark, str(tmp_path), multi_line=True)
    assert rows(drop_row_order(df)) == [("one\ntwo", "1")]


def test_files_with_other_headings_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n1,2\n")
    with pytest.raises(Exception, match="CSV header"):
        read_delimited(spark, f"{tmp_path}/*.csv").collect()


def test_row_order_follows_names_not_sizes(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n" + "".join(f"a{i}\n" for i in range(3)))
    (tmp_path / "b.csv").write_text("x\n" + "".join(f"b{i}\n" for i in range(3000)))
    df = read_delimited(spark, f"{tmp_path}/*.csv")
    assert [r["x"] for r in df.orderBy(*ROW_ORDER).limit(5).collect()] == ["a0", "a1", "a2", "b0", "b1"]
    assert df.select(*ROW_ORDER).distinct().count() == 3003


def test_row_order_across_splits_of_one_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n" + "".join(f"{i:06d}\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = read_delimited(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 1
        ordered = [r["x"] for r in df.orderBy(*ROW_ORDER).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ordered == sorted(ordered) and len(ordered) == 20000


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, k string")
    path = f"{tmp_path}/t"
    assert not table_exists(spark, path) and read_table_if_any(spark, path) is None
    assert write_table(df, path, ["k"]) == 2
    assert write_table(df.where("n = 1"), path, ["k"]) == 1
    assert table_exists(spark, path)
    assert rows(read_table(spark, path)) == [(1, "a")]
    plan = read_table(spark, path).where("k = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(k" in plan


def test_empty_table_is_written_and_counted(spark, tmp_path):
    df = spark.createDataFrame([], "n int")
    assert write_table(df, f"{tmp_path}/t") == 0
    assert read_table(spark, f"{tmp_path}/t").columns == ["n"]


def test_quarantine_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, 'é "x"')], "n int, t string")
    assert write_quarantine(df, str(tmp_path), "e", "why") == 1
    assert rows(read_table(spark, f"{tmp_path}/e/why")) == [(1, 'é "x"')]
    assert write_quarantine(df, str(tmp_path), "e", "text", fmt="csv") == 1
    assert rows(drop_row_order(read_delimited(spark, f"{tmp_path}/e/text"))) == [("1", 'é "x"')]
    parts = [p for p in (tmp_path / "e" / "text").iterdir() if p.name.startswith("part-")]
    assert parts and all(p.read_bytes().startswith("\ufeff".encode()) for p in parts)


def test_lines_that_do_not_fit(spark, tmp_path):
    text = 'x,y,z\n1,2,3\n4,5,6,7\n8,9\n"one\ntwo",5,6\n"a,b","c ""d""",e\n'
    (tmp_path / "t.csv").write_text(text)

    def parts(**options):
        scan = read_delimited(spark, f"{tmp_path}/t.csv", unreadable=True, **options)
        write_table(scan, f"{tmp_path}/bronze")
        good, bad = split_unreadable(read_table(spark, f"{tmp_path}/bronze"))
        return rows(drop_row_order(good)), rows(bad, "ligne")

    good, bad = parts(multi_line=True)
    assert good == [("1", "2", "3"), ("8", "9", None), ("a,b", 'c "d"', "e"), ("one\ntwo", "5", "6")]
    assert [line.strip() for (line,) in bad] == ["4,5,6,7"]
    _, bad = parts()
    assert {line.strip() for (line,) in bad} == {"4,5,6,7", '"one'}


def test_parquet_scan_takes_an_order_too(spark, tmp_path):
    write_table(spark.range(5).toDF("n").coalesce(1), f"{tmp_path}/t")
    df = with_row_order(read_table(spark, f"{tmp_path}/t"))
    assert [r["n"] for r in df.orderBy(*ROW_ORDER).collect()] == list(range(5))


class Settings:
    """Stands for a session: the setting cannot be changed on a running one."""

    def __init__(self, **values):
        self.conf = self
        self.values = {k.replace("_", "."): v for k, v in values.items()}

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_scratch_folder_uses_the_shared_setting():
    cluster = Settings(spark_checkpoint_dir="hdfs://shared/dir/", spark_master="yarn")
    first, second = (scratch_folder(cluster, "x") for _ in range(2))
    assert first.startswith("hdfs://shared/dir/limpid-x-") and first != second


def test_a_cluster_without_the_setting_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(Settings(spark_master="yarn"), "x")
    assert scratch_folder(Settings(spark_master="local[2]"), "x")


TITULAIRES = (["Matricule", "Nom", "Date"], [["T1", "Zoé & co", 43895], ["T2", None, 43896.5]])
CONTRACTUELS = (["Nom", "Matricule", "Fin", "Nom"], [["B", "T3", "N/A", "again"]])


@pytest.fixture
def workbooks(tmp_path):
    book = {"Titulaires": TITULAIRES, "Contractuels": CONTRACTUELS, "Métadonnées": (["x"], [[1]])}
    (tmp_path / "p_1.xlsx").write_bytes(workbook_bytes(book))
    other = {"Titulaires": (["Nom", "Matricule", "Grade"], [["C", "T4", 2.5]])}
    (tmp_path / "p_2.xlsx").write_bytes(workbook_bytes(other))
    return f"{tmp_path}/p_*.xlsx"


def test_workbook_tab_by_name_joins_headings_of_all_files(spark, workbooks):
    df = read_workbook_tab(spark, workbooks, "Titulaires", with_order=False)
    assert set(df.columns) == {"Matricule", "Nom", "Date", "Grade"}
    assert rows(df, "Matricule", "Nom", "Date", "Grade") == [
        ("T1", "Zoé & co", "43895", None),
        ("T2", None, "43896.5", None),
        ("T4", "C", None, "2.5"),
    ]


def test_workbook_tab_by_position_and_repeated_headings(spark, workbooks):
    df = read_workbook_tab(spark, workbooks, 1, with_order=False)
    assert df.columns == ["Nom", "Matricule", "Fin", "Nom.1"]
    assert rows(df) == [("B", "T3", None, "again")]


def test_workbook_rows_are_ordered_by_file_and_row(spark, workbooks):
    df = read_workbook_tab(spark, workbooks, "Titulaires", ["Matricule"])
    assert [r["Matricule"] for r in df.orderBy(*ROW_ORDER).collect()] == ["T1", "T2", "T4"]


def test_wide_sheet_and_many_batches(spark, tmp_path):
    headings = [f"c{i}" for i in range(60)]
    data = [[i * j for j in range(60)] for i in range(5000)]
    (tmp_path / "w.xlsx").write_bytes(workbook_bytes({"s": (headings, data)}))
    df = read_workbook_tab(spark, f"{tmp_path}/w.xlsx", "s", with_order=False)
    assert df.columns == headings
    assert df.selectExpr("count(*)", "sum(cast(c59 as bigint))").first() == (5000, 59 * 4999 * 2500)


def book_with_styles(date1904):
    """One tab whose cells cover every kind; built by hand, since the writer knows two formats."""
    import io
    import zipfile

    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    formats = ["yyyy-mm-dd", '0.0 "days"', "[Red]0.00", "General", "hh:mm", "\\d0"]
    own = "".join(f"<numFmt numFmtId='{164 + i}' formatCode='{f}'/>" for i, f in enumerate(formats))
    xfs = "".join(f'<xf numFmtId="{n}"/>' for n in (0, 14, *range(164, 170)))
    cells = "".join(
        f'<row r="{n}"><c r="A{n}" t="inlineStr"><is><t>{name}</t></is></c>{cell}</row>'
        for n, (name, cell) in enumerate([
            ("Nom", '<c r="B1" t="inlineStr"><is><t>Jour</t></is></c><c r="C1" t="inlineStr"><is><t>Autre</t></is></c>'),
            ("built in", '<c r="B2" s="1"><v>43895</v></c>'), ("own", '<c r="B3" s="2"><v>43895.75</v></c>'),
            ("days", '<c r="B4" s="3"><v>2020</v></c>'), ("red", '<c r="B5" s="4"><v>43895</v></c>'),
            ("plain", '<c r="B6"><v>2020</v></c>'), ("year", '<c r="B7" t="inlineStr"><is><t>2020</t></is></c>'),
            ("digits", '<c r="B8" t="str"><v>43895</v></c>'), ("iso", '<c r="B9" t="str"><v>2020-03-05</v></c>'),
            ("first", '<c r="B10" t="str"><v>5/3/2020</v></c>'), ("none", '<c r="B11" t="str"><v>bientôt</v></c>'),
            ("true", '<c r="B12" t="b"><v>1</v></c>'), ("error", '<c r="B13" t="e"><v>#N/A</v></c>'),
            ("empty", ""), ("token", '<c r="B15" t="str"><v>N/A</v></c>'), ("other", '<c r="C16" s="1"><v>43895</v></c>'),
            ("escaped", '<c r="B17" s="7"><v>2020</v></c>'),
        ], start=1)
    )
    parts = {
        "workbook.xml": f'<workbook {main} xmlns:r="{rel}"><workbookPr date1904="{date1904}"/>'
        '<sheets><sheet name="T" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        f'<Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "styles.xml": f"<styleSheet {main}><numFmts>{own}</numFmts><cellXfs>{xfs}</cellXfs></styleSheet>",
        "worksheets/sheet1.xml": f"<worksheet {main}><sheetData>{cells}</sheetData></worksheet>",
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        for name, text in parts.items():
            book.writestr(f"xl/{name}", text)
    return out.getvalue()


@pytest.mark.parametrize(("date1904", "styled"), [("0", "2020-03-05"), ("1", "2024-03-06")])
def test_kinds_of_cells(spark, tmp_path, date1904, styled):
    (tmp_path / "k.xlsx").write_bytes(book_with_styles(date1904))
    files = read_workbook_files(spark, f"{tmp_path}/k.xlsx")
    decoded = decode_tabs(files, ["T"], ["Jour", "Nom", "Autre"])
    tab = typed_tab(decoded, 0, ["Nom", "Jour", "Autre"], dates=["Jour"], with_order=False)
    assert dict(tab.dtypes) == {"Nom": "string", "Jour": "date", "Jour_illisible": "string", "Autre": "string"}
    found = {r["Nom"]: (r["Jour"] and str(r["Jour"]), r["Jour_illisible"]) for r in tab.collect()}
    assert found == {
        "built in": (styled, None), "own": (styled, None), "red": ("2020-03-05", None),
        "days": ("1905-07-12", None), "plain": ("1905-07-12", None), "year": ("2020-01-01", None),
        "digits": (None, "43895"), "iso": ("2020-03-05", None), "first": ("2020-03-05", None),
        "none": (None, "bientôt"), "true": (None, "True"), "error": (None, None), "empty": (None, None),
        "token": (None, None), "other": (None, None), "escaped": ("1905-07-12", None),
    }
    assert [r["Autre"] for r in tab.where("Nom = 'other'").collect()] == [styled]


def test_typed_tabs_are_read_by_column(spark, workbooks, tmp_path):
    files = read_workbook_files(spark, workbooks)
    rows_of = decode_tabs(files, ["Titulaires", 1], ["Matricule", "Nom", "Grade"])
    write_table(rows_of, f"{tmp_path}/typed")
    back = read_table(spark, f"{tmp_path}/typed")
    assert rows(typed_tab(back, "Titulaires", ["Matricule", "Nom"], with_order=False)) == [
        ("T1", "Zoé & co"), ("T2", None), ("T4", "C"),
    ]
    assert rows(typed_tab(back, 1, ["Matricule", "Grade"], with_order=False)) == [("T3", None)]
    assert {r["sheet"] for r in back.select("sheet").collect()} == {"Titulaires", "Contractuels"}
    plan = typed_tab(back, 1, ["Nom"], with_order=False)._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.rindex("ReadSchema"):]
    assert "Nom" in schema and "Matricule" not in schema and "Grade" not in schema


def test_a_partitioned_table_is_gathered_and_rewritten_in_part(spark, tmp_path):
    df = spark.range(4000).selectExpr("id", "cast(id % 4 as int) as y").repartition(16)
    path = f"{tmp_path}/t"
    assert write_table(df, path, ["y"]) == 4000
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("y=*/*.parquet")}
    assert len(files) <= 8  # one or two a year, not one a task and year
    assert write_table(df.where("y = 2 and id < 100").withColumn("id", -F.col("id")), path, ["y"], keep_others=True) == 25
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("y=*/*.parquet")}
    kept = {p: t for p, t in files.items() if "y=2" not in str(p)}
    assert {p: t for p, t in after.items() if "y=2" not in str(p)} == kept
    assert read_table(spark, path).selectExpr("count(*)", "sum(if(id < 0, 1, 0))").first() == (3025, 25)


def test_broken_workbook_fails_the_job(spark, tmp_path):
    (tmp_path / "b.xlsx").write_bytes(b"not a zip file")
    with pytest.raises(PythonException, match="BadZipFile"):
        read_workbook_tab(spark, f"{tmp_path}/b.xlsx", 0, ["x"]).collect()


@pytest.mark.parametrize("headings_only", [True, False])
def test_task_code_needs_no_install_on_executors(tmp_path, headings_only):
    """Functions sent to Python workers load in a process that cannot import this code."""
    for number, function in enumerate([_decoder(headings_only), workbook_bytes]):
        path = tmp_path / f"{number}.pickle"
        path.write_bytes(cloudpickle.dumps(function))
        load = f"import pickle; pickle.load(open({str(path)!r}, 'rb'))"
        subprocess.run([sys.executable, "-c", load], cwd=tmp_path, check=True, timeout=60)


SHEET = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


def with_sheet(change):
    """A workbook of 3,000 rows, the text of its sheet changed."""
    rows = [[f"T{i}", "a <b> & c", None if i % 7 else "", i] for i in range(3000)]
    made = zipfile.ZipFile(io.BytesIO(workbook_bytes({"s": (["Code", "Note", "Vide", "Rang"], rows)})))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name in made.namelist():
            text = made.read(name).decode()
            book.writestr(name, change(text) if name.startswith("xl/worksheets/") else text)
    return out.getvalue()


def decoded(content):
    batch = pa.RecordBatch.from_pydict({"path": ["f"], "content": pa.array([content], pa.binary())})
    return [(r["row_no"], dict(r["cells"])) for b in _decoder(False)(iter([batch])) for r in b.to_pylist()]


def plain_row(i):
    note = {"Code": f"T{i}", "Note": "a <b> & c", "Rang": str(i)}
    return i + 2, note if i % 7 else {**note, "Vide": ""}


def test_rows_of_common_form_are_not_parsed_one_by_one(monkeypatch):
    fed = []

    class Counting(ElementTree.XMLParser):
        def feed(self, data):
            fed.append(len(data))
            return super().feed(data)

    sizes = []
    content = with_sheet(lambda text: (sizes.append(len(text)), text)[1])
    monkeypatch.setattr(ElementTree, "XMLParser", Counting)
    assert decoded(content) == [plain_row(i) for i in range(3000)]
    assert sum(fed) < sizes[0] / 4


@pytest.mark.parametrize(
    ("old", "new", "found"),
    [
        ('<c r="D2002"><v>2000</v></c>', '<c r="D2002"><v>2000</v></c><!-- </row> -->', {}),
        ('<c r="D2002"><v>2000</v></c>', '<c r="D2002" t="str"><v>&#233;</v></c>', {"Rang": "é"}),
        ('<c r="D2002"><v>2000</v></c>', '<c r="D2002" t="b"><v>1</v></c>', {"Rang": "True"}),
        ('<c r="D2002"><v>2000</v></c>', '<c r="F2002" t="s"><v>1</v></c>', {"Rang": None, "Unnamed: 5": "Note"}),
        ('<c r="D2002"><v>2000</v></c>', '<c r="D2002"><v>1</v></c><c r="D2002"><v>5</v></c>', {"Rang": "5"}),
        ('<row r="2002">', "<row>", {}),
    ],
)
def test_rows_of_other_forms_among_common_ones(old, new, found):
    want = [plain_row(i) for i in range(3000)]
    cells = {**want[2000][1], **found}
    want[2000] = (2002, {k: v for k, v in cells.items() if v is not None})
    assert decoded(with_sheet(lambda text: text.replace(old, new))) == want


def test_heading_after_many_empty_rows():
    empty = "".join(f'<row r="{i}"></row>' for i in range(1, 2000))

    def later(text):
        return re.sub(r'(<row r="|<c r="[A-Z])(\d+)', lambda m: f"{m[1]}{int(m[2]) + 2000}", text)

    want = [(n + 2000, cells) for n, cells in map(plain_row, range(3000))]
    assert decoded(with_sheet(lambda text: later(text).replace("<sheetData>", f"<sheetData>{empty}"))) == want


def test_workbook_of_a_table_has_the_cells_of_its_rows():
    days = [datetime.date(2020, 1, 2), None, datetime.date(1905, 5, 6)]
    columns = {"t": ["x & <y>", None, "é"], "n": [1, 2, 3], "d": days, "f": [1.5, None, 2.0]}
    parts = []
    for rows in ([*zip(*columns.values())], pa.table(columns)):
        book = zipfile.ZipFile(io.BytesIO(workbook_bytes({"s": ([*columns], rows)})))
        parts.append({n: book.read(n) for n in book.namelist()})
    assert parts[0] == parts[1]
