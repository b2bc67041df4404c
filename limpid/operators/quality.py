"""Data-quality checks, one row per check: (entity, check, column_name, n_bad, passed)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.operators.dedup import duplicate_count
from limpid.operators.profile import one_row_per
from limpid.sources.tables import table_exists

TYPE_CLASSES = {
    "string": (T.StringType,),
    "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType),
    "numeric": (T.NumericType,),
    "date": (T.DateType, T.TimestampType, T.TimestampNTZType),
}


@dataclass(frozen=True)
class Rule:
    """A row is bad when ``bad`` is true; NULL counts as good."""

    check: str
    column: str
    bad: Column


def not_null(column: str) -> Rule:
    return Rule("not_null", column, F.col(column).isNull())


def in_domain(column: str, domain: Sequence) -> Rule:
    return Rule("in_domain", column, ~F.col(column).isin(*domain))


def in_range(column: str, low=None, high=None) -> Rule:
    value, never = F.col(column), F.lit(False)
    below = value < low if low is not None else never
    above = value > high if high is not None else never
    return Rule("in_range", column, below | above)


def iso_date(column: str) -> Rule:
    value = F.col(column).cast("string")
    parsed = F.try_to_date(value, "yyyy-MM-dd")
    return Rule("iso_date", column, value.isNotNull() & parsed.isNull())


def agrees_with(column: str, formula: Column, tolerance: float = 0.01) -> Rule:
    gap = F.abs(F.col(column).cast("double") - formula)
    return Rule("formula", column, (gap < tolerance) == F.lit(False))


def _verdict(df: DataFrame) -> DataFrame:
    n_bad = F.col("n_bad").cast("bigint")
    return df.select("entity", "check", "column_name", n_bad.alias("n_bad"), (n_bad == 0).alias("passed"))


Fact = tuple[str, str, str | None, int]


def fact_rows(spark: SparkSession, facts: Sequence[Fact]) -> DataFrame:
    """Checks answered without reading a row, all in one constant row set."""
    rows = F.array(
        *(
            F.struct(
                F.lit(entity).alias("entity"),
                F.lit(check).alias("check"),
                F.lit(column).cast("string").alias("column_name"),
                F.lit(n_bad).cast("bigint").alias("n_bad"),
            )
            for entity, check, column, n_bad in facts
        )
    )
    return _verdict(spark.range(1, numPartitions=1).select(F.inline(rows)))


def found_facts(found: Mapping[str, bool]) -> list[Fact]:
    return [(entity, "exists", None, int(not ok)) for entity, ok in found.items()]


def column_facts(df: DataFrame, entity: str, required: Sequence[str]) -> list[Fact]:
    present = set(df.columns)
    return [(entity, "column_present", c, int(c not in present)) for c in required]


def type_facts(df: DataFrame, entity: str, classes: Mapping[str, str]) -> list[Fact]:
    """``classes`` maps a column to a key of ``TYPE_CLASSES``; absent columns fail."""
    kinds = {f.name: f.dataType for f in df.schema}
    return [
        (entity, f"type_{kind}", c, int(not isinstance(kinds.get(c), TYPE_CLASSES[kind])))
        for c, kind in classes.items()
    ]


def check_found(spark: SparkSession, found: Mapping[str, bool]) -> DataFrame:
    return fact_rows(spark, found_facts(found))


def check_exists(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    return check_found(spark, {entity: table_exists(spark, p) for entity, p in paths.items()})


def check_columns(df: DataFrame, entity: str, required: Sequence[str]) -> DataFrame:
    return fact_rows(df.sparkSession, column_facts(df, entity, required))


def check_types(df: DataFrame, entity: str, classes: Mapping[str, str]) -> DataFrame:
    return fact_rows(df.sparkSession, type_facts(df, entity, classes))


def _absent(column: str, domain: Sequence) -> Column:
    """Values of a closed domain that never occur, as one aggregate."""
    seen = [F.max((F.col(column) == F.lit(v)).cast("int")) for v in domain]
    return reduce(lambda a, b: a + b, [F.lit(1) - F.coalesce(s, F.lit(0)) for s in seen])


def check_rows(
    df: DataFrame,
    entity: str,
    rules: Sequence[Rule],
    covers: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """All row rules of a table, and domains to be covered, in one aggregate job."""
    names = [(r.check, r.column) for r in rules] + [("covers_domain", c) for c in covers or {}]
    bad = [F.count_if(r.bad) for r in rules]
    bad += [_absent(c, domain).cast("bigint") for c, domain in (covers or {}).items()]
    counted = one_row_per({f"{i}": [n] for i, n in enumerate(bad)}, df, ["n_bad"])
    label = F.col("label").cast("int")
    return _verdict(
        counted.select(
            F.lit(entity).alias("entity"),
            F.get(F.array(*[F.lit(check) for check, _ in names]), label).alias("check"),
            F.get(F.array(*[F.lit(column) for _, column in names]), label).alias("column_name"),
            "n_bad",
        )
    )


def check_unique(df: DataFrame, entity: str, keys: Sequence[str]) -> DataFrame:
    counted = duplicate_count(df, keys)
    return _verdict(
        counted.select(
            F.lit(entity).alias("entity"),
            F.lit("unique").alias("check"),
            F.lit(",".join(keys)).alias("column_name"),
            F.col("n_duplicates").alias("n_bad"),
        )
    )


def check_reference(df: DataFrame, entity: str, key: str, dim: DataFrame) -> DataFrame:
    """Rows whose key is NULL or absent from ``dim``."""
    orphans = df.select(key).join(dim.select(key), key, "left_anti")
    return _verdict(
        orphans.agg(F.count(F.lit(1)).alias("n_bad")).select(
            F.lit(entity).alias("entity"),
            F.lit("reference").alias("check"),
            F.lit(key).alias("column_name"),
            "n_bad",
        )
    )


def check_covers(df: DataFrame, entity: str, column: str, domain: Sequence) -> DataFrame:
    """Values of a closed domain that never occur, counted in one pass."""
    return check_rows(df, entity, [], {column: domain})


def quality_report(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), checks)


def schema_drift(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Columns that left, joined or changed type against a declared contract.

    (column_name, kind, expected, actual, n_values): how many non-null values
    each finding touches, so a harmless empty column tells itself apart. A
    missing column touches every row.
    """
    wanted = {f.name: f.dataType.simpleString() for f in expected}
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    drift = [
        (c, kind, wanted.get(c), found.get(c))
        for c in {**wanted, **found}
        if (
            kind := "missing"
            if c not in found
            else "new"
            if c not in wanted
            else "retyped"
            if wanted[c] != found[c]
            else None
        )
    ]
    schema = "column_name string, kind string, expected string, actual string, n_values bigint"
    if not drift:
        return df.sparkSession.createDataFrame([], schema)
    measures = {
        c: [F.count(F.lit(1)) if kind == "missing" else F.count(F.col(c))]
        for c, kind, _, _ in drift
    }
    facts = F.create_map(
        *[
            part
            for c, kind, was, now in drift
            for part in (
                F.lit(c),
                F.struct(
                    F.lit(kind).alias("kind"),
                    F.lit(was).cast("string").alias("expected"),
                    F.lit(now).cast("string").alias("actual"),
                ),
            )
        ]
    )
    counted = one_row_per(measures, df, ["n_values"])
    return counted.withColumn("_f", facts[F.col("label")]).select(
        F.col("label").alias("column_name"), "_f.kind", "_f.expected", "_f.actual", "n_values"
    )


def file_drift(
    footers: DataFrame, expected: T.StructType, in_folders: Sequence[str] = ()
) -> DataFrame:
    """``schema_drift`` of each file by itself, so that one odd file among many is named.

    (file, column_name, kind, expected, actual, n_rows, n_values), a row per finding;
    ``footers`` are those of ``file_footers``. Files that keep to the contract have no
    row. Kinds are missing, new and retyped, and ``unreadable`` for a file that is no
    Parquet. ``n_values`` are the non-null values that the finding touches, by the
    statistics of the file, or NULL if there are none; a missing column touches every row.
    Columns in ``in_folders`` stand in folder names and are not looked for in files.

    The contract is a constant of the plan: no join, no shuffle, nothing to the driver.
    """
    wanted = F.array(
        *(
            F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("kind"))
            for f in expected
            if f.name not in in_folders
        )
    )
    if len(expected) == len(in_folders):
        wanted = F.expr("CAST(array() AS array<struct<name: string, kind: string>>)")

    def finding(name: Column, kind: str, was: Column, now: Column, n_values: Column) -> Column:
        return F.struct(
            name.alias("column_name"),
            F.lit(kind).alias("kind"),
            was.cast("string").alias("expected"),
            now.cast("string").alias("actual"),
            n_values.cast("bigint").alias("n_values"),
        )

    def same_name(columns: Column, name: Column) -> Column:
        return F.filter(columns, lambda c: c["name"] == name)

    nothing, found = F.lit(None), F.col("columns")
    with_values = F.col("n_rows")
    absent = F.transform(
        F.filter(wanted, lambda w: F.size(same_name(found, w["name"])) == 0),
        lambda w: finding(w["name"], "missing", w["kind"], nothing, with_values),
    )
    added = F.transform(
        F.filter(found, lambda c: F.size(same_name(wanted, c["name"])) == 0),
        lambda c: finding(c["name"], "new", nothing, c["kind"], with_values - c["n_nulls"]),
    )
    retyped = F.transform(
        F.filter(
            found, lambda c: F.exists(wanted, lambda w: (w["name"] == c["name"]) & (w["kind"] != c["kind"]))
        ),
        lambda c: finding(
            c["name"],
            "retyped",
            F.get(same_name(wanted, c["name"]), F.lit(0))["kind"],
            c["kind"],
            with_values - c["n_nulls"],
        ),
    )
    broken = F.array(finding(nothing.cast("string"), "unreadable", nothing, F.col("fault"), nothing))
    drift = F.when(F.col("fault").isNotNull(), broken).otherwise(F.concat(absent, added, retyped))
    return footers.select("file", "n_rows", F.explode(drift).alias("_f")).select(
        "file", "_f.column_name", "_f.kind", "_f.expected", "_f.actual", "n_rows", "_f.n_values"
    )
