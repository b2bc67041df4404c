from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.operators import distinct_profile
from limpid.operators import quality as Q
from limpid.sources import file_footers
from tests.conftest import rows


def sample(spark):
    data = [("a", 1, 0.5, "2020-01-01"), ("a", -1, 1.5, "01/02/2020"), (None, None, None, None)]
    return spark.createDataFrame(data, "k string, n bigint, r double, d string")


def found(report):
    return {(r["check"], r["column_name"]): (r["n_bad"], r["passed"]) for r in report.collect()}


def test_row_rules_run_as_one_aggregate(spark):
    rules = [
        Q.not_null("k"),
        Q.in_range("n", low=0),
        Q.in_range("r", 0, 1),
        Q.in_domain("k", ["b"]),
        Q.iso_date("d"),
        Q.agrees_with("r", F.col("n") * 0.5),
    ]
    report = Q.check_rows(sample(spark), "t", rules)
    assert found(report) == {
        ("not_null", "k"): (1, False),
        ("in_range", "n"): (1, False),
        ("in_range", "r"): (1, False),
        ("in_domain", "k"): (2, False),
        ("iso_date", "d"): (1, False),
        ("formula", "r"): (1, False),
    }
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_a_range_without_bounds_finds_nothing(spark):
    assert found(Q.check_rows(sample(spark), "t", [Q.in_range("n")])) == {("in_range", "n"): (0, True)}


def test_keys_references_and_domains(spark):
    df, dim = sample(spark), spark.createDataFrame([("b",)], "k string")
    checks = [
        Q.check_unique(df, "t", ["k"]),
        Q.check_reference(df, "t", "k", dim),
        Q.check_covers(df, "t", "k", ["a", "b", "c"]),
    ]
    assert found(Q.quality_report(checks)) == {
        ("unique", "k"): (1, False),
        ("reference", "k"): (3, False),
        ("covers_domain", "k"): (2, False),
    }


def test_covers_on_an_empty_table(spark):
    assert found(Q.check_covers(sample(spark).where("n > 9"), "t", "k", ["a"])) == {
        ("covers_domain", "k"): (1, False)
    }


def test_schema_checks(spark, tmp_path):
    df = sample(spark).withColumn("day", F.lit(date(2020, 1, 1)))
    assert found(Q.check_columns(df, "t", ["k", "zz"])) == {
        ("column_present", "k"): (0, True),
        ("column_present", "zz"): (1, False),
    }
    kinds = {"k": "string", "n": "integer", "r": "float", "d": "date", "day": "date", "zz": "numeric"}
    assert {c: ok for (_, c), (_, ok) in found(Q.check_types(df, "t", kinds)).items()} == {
        "k": True,
        "n": True,
        "r": True,
        "d": False,
        "day": True,
        "zz": False,
    }
    assert found(Q.check_exists(spark, {"t": f"{tmp_path}/none"})) == {("exists", None): (1, False)}


def test_schema_drift(spark):
    contract = T.StructType(
        [
            T.StructField("k", T.StringType()),
            T.StructField("n", T.IntegerType()),
            T.StructField("gone", T.StringType()),
        ]
    )
    assert rows(Q.schema_drift(sample(spark), contract)) == [
        ("d", "new", None, "string", 2),
        ("gone", "missing", "string", None, 3),
        ("n", "retyped", "int", "bigint", 2),
        ("r", "new", None, "double", 2),
    ]
    assert Q.schema_drift(sample(spark), sample(spark).schema).count() == 0


CONTRACT = T.StructType(
    [
        T.StructField("k", T.StringType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("at", T.TimestampNTZType()),
        T.StructField("seen", T.TimestampType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("lot", T.IntegerType()),
    ]
)
KEPT = "SELECT 'a' AS k, 1 AS n, timestamp_ntz'2020-01-01' AS at, timestamp'2020-01-01' AS seen, array('x') AS tags"


def test_drift_names_the_file(spark, tmp_path):
    root = tmp_path / "a table, 100%"
    lots = {
        1: KEPT,
        2: KEPT.replace("1 AS n", "CAST(NULL AS BIGINT) AS n") + ", 2.5D AS extra",
        3: "SELECT 'a' AS k, 1 AS n",
        4: f"SELECT * FROM ({KEPT}) WHERE n > 9",
    }
    for lot, sql in lots.items():
        spark.sql(sql).coalesce(1).write.parquet(f"{root}/lot={lot}")
    (root / "lot=5").mkdir()
    (root / "lot=5" / "part.parquet").write_bytes(b"no table")
    (root / "lot=6").mkdir()
    (root / "lot=6" / "part.parquet").write_bytes(b"")  # no scan sees an empty file
    lot = F.regexp_extract("file", "lot=(.)", 1).alias("lot")
    drift = Q.file_drift(file_footers(spark, str(root)), CONTRACT, in_folders=["lot"])
    plan = drift._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    told = drift.withColumn("actual", F.when(F.col("kind") != "unreadable", F.col("actual")))
    assert rows(told.select(lot, *[c for c in drift.columns if c != "file"])) == [
        ("2", "extra", "new", None, "double", 1, 1),
        ("2", "n", "retyped", "int", "bigint", 1, 0),
        ("3", "at", "missing", "timestamp_ntz", None, 1, 1),
        ("3", "seen", "missing", "timestamp", None, 1, 1),
        ("3", "tags", "missing", "array<string>", None, 1, 1),
        ("5", None, "unreadable", None, None, None, None),
    ]
    assert {r["file"].rsplit("/", 2)[1] for r in drift.collect()} == {f"lot={i}" for i in (2, 3, 5)}
    # A column of folder names is missing in each file that can be read, unless it is named.
    everywhere = Q.file_drift(file_footers(spark, str(root), "*.parquet"), CONTRACT)
    assert everywhere.where("column_name = 'lot' AND kind = 'missing'").count() == 4
    nothing = Q.file_drift(file_footers(spark, str(root)), T.StructType([]))
    assert nothing.where("kind = 'new'").count() == 5 + 6 + 2 + 5


def test_distinct_profile(spark):
    assert rows(distinct_profile(sample(spark), ["k", "n"])) == [("k", 1), ("n", 2)]
