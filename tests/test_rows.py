"""Duplicates, foreign keys and unions, against brute force in Python."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from limpid.operators import (
    duplicate_count,
    duplicate_groups,
    keep_first,
    missing_keys,
    split_by_reference,
    tagged_union,
)
from tests.conftest import rows

RANK = {"a": 1, "b": 2}


def skewed(n=2000, seed=7):
    """A third of the rows on one key, some on a NULL key."""
    rng = random.Random(seed)
    keys = [7] * (n // 3) + [None] * (n // 20) + [rng.randrange(n // 3) for _ in range(n)]
    rng.shuffle(keys)
    return [(i, k, rng.choice("ab")) for i, k in enumerate(keys[:n])]


def test_keep_first_splits_every_row_once(spark):
    data = skewed()
    df = spark.createDataFrame(data, "pos int, k int, s string").repartition(7)
    kept, removed = keep_first(df, ["k"], ["pos"])
    first = {}
    for row in data:
        first.setdefault(row[1], row)
    assert rows(kept) == rows(spark.createDataFrame(list(first.values()), df.schema))
    assert sorted(rows(kept) + rows(removed), key=str) == sorted(data, key=str)


def test_keep_first_by_priority(spark):
    data = skewed(seed=8)
    df = spark.createDataFrame(data, "pos int, k int, s string").repartition(7)
    priority = F.when(F.col("s") == "a", 1).otherwise(2)
    kept, removed = keep_first(df, ["k"], ["pos"], priority)
    best = {}
    for row in sorted(data, key=lambda r: (RANK[r[2]], r[0])):
        best.setdefault(row[1], row)
    assert sorted(rows(kept), key=str) == sorted(best.values(), key=str)
    assert kept.columns == df.columns and removed.columns == df.columns
    assert sorted(rows(kept) + rows(removed), key=str) == sorted(data, key=str)


def test_keep_first_prunes_before_the_shuffle(spark):
    df = spark.createDataFrame(skewed(), "pos int, k int, s string")
    kept, removed = keep_first(df, ["k"], ["pos"])
    plan = kept._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert "Window" not in removed._jdf.queryExecution().toString()


def test_duplicate_groups_and_count(spark):
    data = skewed(seed=9)
    df = spark.createDataFrame(data, "pos int, k int, s string")
    keys = [r[1] for r in data]
    many = [r for r in data if keys.count(r[1]) > 1]
    assert sorted(rows(duplicate_groups(df, ["k"])), key=str) == sorted(many, key=str)
    assert rows(duplicate_count(df, ["k"])) == [(len(data), len(data) - len(set(keys)))]
    assert rows(duplicate_count(df.where("pos < 0"), ["k"])) == [(0, 0)]


def test_reference_split(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "code string, n int")
    dim = spark.createDataFrame([("a",), ("z",), (None,)], "code string")
    kept, orphans = split_by_reference(df, dim, "code")
    assert rows(kept) == [("a", 1), ("a", 4)]
    assert rows(orphans) == [("b", 2), (None, 3)]
    assert split_by_reference(df, None, "code") == (df, None)
    assert rows(missing_keys(df, dim, "code")) == [("b",), (None,)]


def test_tagged_union_fills_missing_columns(spark):
    left = spark.createDataFrame([(1, "x")], "a int, b string")
    right = spark.createDataFrame([("y", 2)], "c string, a int")
    both = tagged_union({"l": left, "r": right}, "tag")
    assert rows(both, "a", "b", "c", "tag") == [(1, "x", None, "l"), (2, None, "y", "r")]


def test_a_skewed_shuffle_join_keeps_every_row(spark):
    """With broadcasts off and tiny skew thresholds AQE splits the hot key."""
    data = skewed(6000, seed=3)
    df = spark.createDataFrame(data, "pos int, k int, s string").repartition(16)
    dim = spark.range(0, 2000).select(F.col("id").cast("int").alias("k"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        kept, orphans = split_by_reference(df, dim, "k")
        kept_rows = kept.collect()
        assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()
        first, removed = keep_first(df, ["k"], ["pos"])
        assert first.count() + removed.count() == len(data)
        assert len(kept_rows) + orphans.count() == len(data)
        assert len(kept_rows) == sum(1 for r in data if r[1] is not None and r[1] < 2000)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
