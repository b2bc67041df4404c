"""Steps of the full run whose cost per row was too high; the rows stay as they were."""

import datetime
import io
import random
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from limpid.functions.dates import DAY_FIRST, iso_text, to_date_coerce
from limpid.plans import gold
from limpid.plans.silver import clean_effectifs
from limpid.sources import ROW_ORDER, decode_workbooks, headings_of_tabs, plain_headings, workbook_tab
from limpid.sources.workbook import _decoder
from workload.cells import NBSP
from workload.entities import thousands
from workload.xlsx import workbook_bytes

HEADINGS = ["Code", "Note", "A.b", "note"]


def rows_of(rng, n):
    texts = [None, "", "x", "a <b> & c", "é", "1", " "]
    return [[f"T{i}", rng.choice(texts), rng.choice(texts), rng.choice([None, i])] for i in range(n)]


def book(rng, n):
    """Two tabs; the second has a column more, and cells beyond its heading."""
    more = [[*r, rng.choice([None, "z"]), rng.choice([None, "far"])] for r in rows_of(rng, n)]
    made = workbook_bytes({"p": (HEADINGS, rows_of(rng, n)), "q": ([*HEADINGS, "Fin"], more)})
    return made


def indented(content):
    """The same book written row by row with blanks between, which other writers do."""
    out, old = io.BytesIO(), zipfile.ZipFile(io.BytesIO(content))
    with zipfile.ZipFile(out, "w") as new:
        for name in old.namelist():
            text = old.read(name).decode()
            sheet = text.replace("</c><c", "</c>\n  <c").replace("<row r", "\n <row r").replace('t="inlineStr"', 's="1" t="inlineStr"')
            new.writestr(name, sheet if "worksheets" in name else text)
    return out.getvalue()


@pytest.mark.parametrize("change", [lambda x: x, indented])
def test_cells_in_a_struct_are_those_of_the_map(change):
    content = change(book(random.Random(3), 3000))
    batch = pa.RecordBatch.from_pydict({"path": ["f"], "content": pa.array([content], pa.binary())})

    def decoded(*columns):
        return [r for b in _decoder(False, columns=columns)(iter([batch])) for r in b.to_pylist()]

    maps, structs = decoded(), decoded("Code", "Note", "Fin")
    assert len(maps) == len(structs) == 6000
    for m, s in zip(maps, structs):
        together = {h: v for h, v in s["cells"].items() if v is not None} | dict(s["others"] or [])
        assert together == dict(m["cells"])
        assert m["row_no"] == s["row_no"]
    assert any(s["others"] and dict(s["others"]).get("Unnamed: 5") for s in structs)


def test_tabs_read_from_columns(spark, tmp_path):
    rng = random.Random(4)
    files = spark.createDataFrame([(f"b{i}", bytearray(book(rng, 40))) for i in range(2)], "path string, content binary")
    names = headings_of_tabs(decode_workbooks(files, headings_only=True), ["p", "q", 0])
    assert names == [HEADINGS, [*HEADINGS, "Fin"], HEADINGS]
    # One of two headings that differ in case only, and none with a sign, becomes a column.
    columns = plain_headings(names[1])
    assert columns == ["Code", "Note", "Fin"]
    maps = decode_workbooks(files)
    decode_workbooks(files, columns=columns).write.parquet(f"{tmp_path}/bronze")
    written = spark.read.parquet(f"{tmp_path}/bronze")
    assert written.schema["cells"].dataType.names == columns
    for sheet in ("p", "q", 1):
        asked = [h for h in names[1] if h != "note"]  # a table has no two names that differ in case
        for some in (asked, ["note"]):
            want = sorted(map(str, workbook_tab(maps, sheet, some).collect()))
            assert sorted(map(str, workbook_tab(written, sheet, some).collect())) == want


def test_enrolment_is_read_once_for_known_schools_and_orphans(spark, tmp_path):
    rows = [("a", "10", "5"), ("b", "1 000", None), (None, "3", "4"), ("a", "7", "6"), ("z", "x", "1")]
    raw = spark.createDataFrame([(*r, "f", 0, i) for i, r in enumerate(rows)],
                                "code_etablissement string, nb_garcons string, nb_filles string, "
                                "_src_file string, _src_block bigint, _src_row bigint")
    dim = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "code_etablissement string")
    cuts = []

    def cut(df, name):
        cuts.append(name)
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    found = clean_effectifs(raw, dim, strategy="delete", run_ts="t", cut=cut)
    assert cuts == ["effectifs"]
    assert sorted(map(tuple, found.clean.collect())) == [("a", 7, 6), ("a", 10, 5)]
    orphans = found.rejects["sans_etablissement"]
    assert sorted(map(str, map(tuple, orphans.collect()))) == ["('z', None, 1.0)", "(None, 3.0, 4.0)"]
    # The orphans come from the written rows, not from the raw text again.
    assert all(str(tmp_path) in f for f in orphans.inputFiles()) and orphans.inputFiles()
    assert not set(ROW_ORDER) & set(orphans.columns)


def test_teachers_of_one_school_meet_no_year_one_by_one(spark):
    rng = random.Random(5)
    etab = [(f"s{i}", rng.choice(["N", "S", None])) for i in range(20)]
    etab += [("s0", "N"), ("s0", "N"), ("s1", "S"), (None, "N")]
    years = [(f"s{i}", f"20{y}", 1, 1) for i in range(18) for y in range(10, 14) if rng.random() < 0.7]
    ens = [(f"t{rng.randrange(60)}", f"s{rng.randrange(22)}") for _ in range(80)] + [(None, "s1"), ("t1", None), ("t2", "s3"), ("t2", "s3")]
    places = spark.createDataFrame(etab, "code_etablissement string, region string")
    eff = spark.createDataFrame(years, "code_etablissement string, annee_scolaire string, nb_garcons int, nb_filles int")
    posts = spark.createDataFrame(ens, "matricule string, code_etablissement string")
    want = {}
    for school, region in etab:
        for code, year, *_ in years:
            for teacher, at in ens:
                if region and school == code == at:
                    want.setdefault((region, year), set()).update([teacher] if teacher else [])
    found = gold.enseignants_par_region(places, eff, posts)
    assert {(r["region"], r["annee"]): r["nb_enseignants"] for r in found.collect()} == {k: len(v) for k, v in want.items()}
    # Counted at the school before the years multiply it.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan


def test_dates_without_the_layouts_sign_are_not_tried(spark):
    texts = ["5/3/2020", "2020-01-01", "31/02/2020", "", None, "1/2/20", " 5/3/2020", "a/b/c"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    one = df.select(to_date_coerce(F.col("x"), DAY_FIRST).alias("d"))
    assert [r["d"] for r in one.collect()] == [datetime.date(2020, 3, 5)] + [None] * 7
    assert "contains" in one._jdf.queryExecution().analyzed().toString().lower()
    days = spark.sql("select explode(array(date'0001-01-01', date'2020-03-05', date'9999-12-31', cast(null as date))) d")
    assert [r[0] for r in days.select(iso_text(F.col("d"))).collect()] == ["0001-01-01", "2020-03-05", "9999-12-31", None]


def test_thousands_as_the_number_format_writes_them(spark):
    numbers = [0, 7, 999, 1000, 1001, 20050, 999_999, 1_000_000, 12_345_678, -1, -5000, None]
    found = spark.createDataFrame([(n,) for n in numbers], "n bigint").select(thousands(F.col("n"))).collect()
    assert [r[0] for r in found] == [None if n is None else f"{n:,}".replace(",", NBSP) for n in numbers]
