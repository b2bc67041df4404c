from __future__ import annotations

import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from limpid.functions import to_count
from limpid.operators import (
    delete_missing,
    group_median,
    handle_missing,
    impute_group_median,
    missing_rate,
    null_profile,
    overall_median,
    stats_before_after,
    zero_fill,
)
from tests.conftest import rows

SCHEMA = "code string, v double"


def groups(seed: int, n: int):
    """One group with a third of the rows, constant, empty and tiny groups."""
    rng = random.Random(seed)
    data = [("hot", round(rng.expovariate(0.02), 2)) for _ in range(n // 3)]
    data += [("same", 5.0)] * (n // 6) + [("empty", None)] * 4 + [("one", 3.5), ("two", 1.0), ("two", 2.0)]
    data += [(f"g{rng.randrange(40)}", float(rng.randrange(-50, 50))) for _ in range(n // 2)]
    data += [(None, 1000.0 + i) for i in range(5)]
    return data


def checked(spark, data, parts=5):
    df = spark.createDataFrame(data, SCHEMA).repartition(parts)
    known = {k: [v for g, v in data if g == k and v is not None] for k, _ in data if k is not None}
    assert rows(group_median(df, "v", "code")) == sorted((k, median(v)) for k, v in known.items() if v)
    assert rows(overall_median(df, "v")) == [(median([v for _, v in data if v is not None]),)]


@pytest.mark.parametrize("n", [40, 3000])
def test_medians_match_brute_force(spark, n):
    checked(spark, groups(n, n))


def test_median_of_nothing_is_null(spark):
    df = spark.createDataFrame([("a", None), ("a", float("nan"))], SCHEMA)
    assert rows(overall_median(df, "v")) == [(None,)]
    assert rows(group_median(df, "v", "code")) == []


def test_groups_of_disjoint_ranges_and_hot_values(spark):
    data = [(f"g{g:02}", float(g * 10_000 + v)) for g in range(30) for v in range(0, 101 + g % 2)]
    data += [("hot", float(v)) for v in range(3001)] + [("value", 7.0)] * 3000 + [("value", 8.0)] * 3000
    checked(spark, data)


def test_a_large_group_is_split_over_slices(spark, tmp_path):
    from limpid.operators import median as module

    df = spark.createDataFrame([("hot", float(v)) for v in range(4000)] + [("b", 1.0)], SCHEMA)
    counts = module.value_counts(df, "v", ["code"])
    spread = counts.repartitionByRange(8, "code", "v").where("code = 'hot'")
    assert spread.select(F.spark_partition_id()).distinct().count() > 4


def test_infinite_and_large_values(spark):
    inf, big = float("inf"), 1.6e308
    data = [("a", 1.0), ("a", inf), ("a", inf), ("b", big), ("b", big), ("c", -inf), ("c", 2.0), ("c", 3.0),
            ("d", big), ("d", 1.5e308)]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(group_median(df, "v", "code")) == [("a", inf), ("b", big), ("c", 2.0), ("d", 1.55e308)]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", 3.0)], SCHEMA)
    assert missing_rate(df, "v") == 1 / 3
    clean, audit, strategy = handle_missing(df, "v", "code", run_ts="t")
    assert strategy == "impute" and rows(clean) == [("a", 1.0), ("a", 2.0), ("a", 3.0)]
    assert audit.count() == 1
    assert delete_missing(df, "v")[0].count() == 2


def test_rate_and_threshold_are_inclusive(spark):
    df = spark.createDataFrame([("a", None)] + [("a", 1.0)] * 19, SCHEMA)
    assert missing_rate(df, "v") == 0.05
    clean, audit, strategy = handle_missing(df, "v", "code", run_ts="t")
    assert (strategy, clean.count()) == ("delete", 19)
    assert rows(audit) == [("a", None, "t", "valeur_manquante_v")]


def test_above_threshold_imputes(spark):
    df = spark.createDataFrame([("a", None)] + [("a", 1.0)] * 18, SCHEMA)
    clean, audit, strategy = handle_missing(df, "v", "code", run_ts="t")
    assert (strategy, clean.count(), audit.count()) == ("impute", 19, 1)


def test_empty_table_passes_through(spark):
    df = spark.createDataFrame([], SCHEMA)
    clean, audit, strategy = handle_missing(df, "v", "code")
    assert (strategy, clean.count(), audit.count()) == ("delete", 0, 0)


def test_no_gap_keeps_all(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], SCHEMA)
    clean, audit, _ = handle_missing(df, "v", "code")
    assert (clean.count(), audit.count()) == (2, 0)


def test_imputation_by_group_then_overall(spark):
    data = [("a", 1.0), ("a", 4.0), ("a", None), ("b", None), (None, None), ("c", 10.0)]
    df = spark.createDataFrame(data, SCHEMA)
    filled, audit = impute_group_median(df, "v", "code", "t")
    assert rows(filled.withColumn("v", to_count(F.col("v")))) == [
        ("a", 1),
        ("a", 2),
        ("a", 4),
        ("b", 4),
        ("c", 10),
        (None, 4),
    ]
    assert rows(audit) == [
        ("a", None, 2.5, 2.5, 4.0, False, "t"),
        ("b", None, 4.0, 4.0, 4.0, True, "t"),
        (None, None, 4.0, 4.0, 4.0, True, "t"),
    ]
    assert audit.columns[2:] == [
        "valeur_imputee",
        "mediane_etablissement",
        "mediane_globale_fallback",
        "etablissement_sans_median",
        "date_imputation",
    ]


def test_all_missing_stays_missing(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], SCHEMA)
    filled, audit = impute_group_median(df, "v", "code", "t")
    assert rows(filled) == [("a", None), ("b", None)] and audit.count() == 2


def test_strategy_can_be_forced(spark):
    df = spark.createDataFrame([("a", None), ("a", 2.0)], SCHEMA)
    assert handle_missing(df, "v", "code", strategy="delete")[0].count() == 1
    assert handle_missing(df, "v", "code", strategy="impute")[0].count() == 2
    with pytest.raises(ValueError):
        handle_missing(df, "v", "code", strategy="guess")


def test_delete_pushes_its_filter_to_the_scan(spark, tmp_path):
    spark.createDataFrame([("a", None), ("a", 2.0)], SCHEMA).write.parquet(f"{tmp_path}/t")
    kept, _ = delete_missing(spark.read.parquet(f"{tmp_path}/t"), "v")
    assert "PushedFilters: [IsNotNull(v)]" in kept._jdf.queryExecution().executedPlan().toString()


def test_zero_fill_and_profile(spark):
    raw = [("N/A", "1.5"), (" en attente", "12d"), ("7", None)]
    df = spark.createDataFrame(raw, "a string, b string")
    assert rows(zero_fill(df, ["a", "b"])) == [(0.0, 0.0), (0.0, 1.5), (7.0, 0.0)]
    assert rows(null_profile(df)) == [("a", 3, 0, 0.0), ("b", 3, 1, 1 / 3)]
    assert rows(null_profile(df.where("a = 'x'"), ["a"])) == [("a", 0, 0, 0.0)]


def test_stats_before_after(spark):
    before = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None)], SCHEMA)
    after, _ = impute_group_median(before, "v", "code", "t")
    assert rows(stats_before_after(before, after, "v")) == [("apres", 1.5, 1.5), ("avant", 1.5, 1.5)]


def test_a_numeric_sentinel_counts_as_unknown(spark):
    df = spark.createDataFrame([(" -1 ",), ("2",)], "a string")
    assert rows(zero_fill(df, ["a"], ["-1", "N/A"])) == [(0.0,), (2.0,)]
