"""States that roll up, against plain Python sets and sorted lists."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from limpid.operators import rollup
from limpid.operators.median import group_median, overall_median
from tests.conftest import rows


@pytest.fixture(scope="module")
def visits(spark):
    rng = random.Random(4)
    data = [(f"r{rng.randint(0, 3)}", 2020 + rng.randint(0, 2), rng.randint(0, 70_000)) for _ in range(6000)]
    data += [("r0", 2020, None), (None, 2021, 5), ("hot", 2020, 9)] + [("hot", 2021, k) for k in range(3000)]
    return spark.createDataFrame(data, "region string, annee int, ecole int").repartition(5), data


def distinct(data, width):
    found = defaultdict(set)
    for row in data:
        if row[2] is not None:
            found[row[:width]].add(row[2])
    return sorted([(*group, len(keys)) for group, keys in found.items()], key=str)


def test_numbers_have_no_gaps_and_follow_the_keys(visits):
    df, data = visits
    numbers = rollup.key_numbers(df, "ecole").orderBy("_number").collect()
    keys = sorted({r[2] for r in data if r[2] is not None})
    assert [(r["ecole"], r["_number"]) for r in numbers] == list(zip(keys, range(1, len(keys) + 1)))


def test_bitmaps_roll_up_exactly(visits):
    df, data = visits
    bitmaps = rollup.distinct_bitmaps(df, rollup.key_numbers(df, "ecole"), "ecole", ["region", "annee"]).cache()
    for width in (2, 1, 0):
        found = rollup.bitmap_counts(bitmaps, ["region", "annee"][:width], "n")
        assert sorted([tuple(r) for r in found.collect()], key=str) == distinct(data, width)
    # Batches of rows merge too.
    halves = [
        rollup.distinct_bitmaps(df.where(f"ecole % 2 = {i}"), rollup.key_numbers(df, "ecole"), "ecole", ["region"])
        for i in (0, 1)
    ]
    both = rollup.bitmap_counts(halves[0].unionByName(halves[1]), ["region"], "n")
    assert sorted([tuple(r) for r in both.collect()], key=str) == distinct([(r[0], None, r[2]) for r in data], 1)


def test_bits_beyond_one_bitmap(spark):
    df = spark.range(1, 3 * rollup.BITMAP + 5).selectExpr("id as k", "'x' as g")
    bitmaps = rollup.distinct_bitmaps(df, rollup.key_numbers(df, "k"), "k", ["g"])
    assert bitmaps.count() == 4
    assert rows(rollup.bitmap_counts(bitmaps, ["g"], "n")) == [("x", 3 * rollup.BITMAP + 4)]


def test_sketched_counts_stay_within_the_error(visits):
    df, data = visits
    sketches = rollup.distinct_sketches(df, "ecole", ["region", "annee"])
    found = {r["region"]: r["n"] for r in rollup.sketch_counts(sketches, ["region"], "n").collect()}
    for group, exact in distinct([(r[0], None, r[2]) for r in data], 1):
        assert abs(found[group] - exact) <= max(1, 4 * rollup.DISTINCT_ERROR * exact)


@pytest.mark.parametrize("shape", ["even", "ties", "skewed"])
def test_sketched_medians_stay_within_the_rank_error(spark, shape):
    rng = random.Random(len(shape))
    draw = {"even": rng.random, "ties": lambda: rng.randint(0, 5), "skewed": lambda: rng.paretovariate(0.5)}[shape]
    data = [(g, float(draw())) for g in ("a", "b") for _ in range(20_000)] + [("c", 1.0), ("c", None), ("d", None)]
    data += [("c", float("nan")), (None, 3.0)]
    df = spark.createDataFrame(data, "g string, v double").repartition(7)
    found = {r["g"]: r["group_median"] for r in group_median(df, "v", "g", exact=False).collect()}
    assert set(found) == {"a", "b", "c"} and found["c"] == 1.0
    for g in ("a", "b"):
        values = [v for k, v in data if k == g]
        below, upto = sum(v < found[g] for v in values), sum(v <= found[g] for v in values)
        assert below <= len(values) * (0.5 + rollup.RANK_ERROR) and upto >= len(values) * (0.5 - rollup.RANK_ERROR)


def test_medians_of_nothing(spark):
    none = spark.createDataFrame([], "g string, v double")
    assert group_median(none, "v", "g", exact=False).collect() == []
    assert overall_median(none, "v").collect()[0][0] is None
    some = spark.createDataFrame([("a", 1.0), ("b", 4.0), (None, 9.0), ("c", None)], "g string, v double")
    assert overall_median(some, "v").collect()[0][0] == 4.0
    assert overall_median(some, "v", exact=False).collect()[0][0] == 4.0
