"""Operators on vectors against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from limpid.llm import embedding_dedup, neighbours
from tests.llm import brute
from tests.llm.conftest import SF, bag

SCHEMA = "vec_id bigint, embedding array<float>, label int, node int, v int, id int"


def rows_of(n=300, d=8, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[50:100] = x[:50] + rng.normal(size=(50, d)) * 0.2
    x[100:140] = x[0]
    x[140:150] = x[1] * 3
    rows = [(i * 5, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    bad = [None, [], [0.0] * d, [1.0] * (d - 1) + [None], [float("nan")] * d, [float("inf")] + [0.0] * (d - 1), [1.0, 2.0]]
    return rows + [(7000 + i * 20, v) for i, v in enumerate(bad)]


def usable(rows, d=8):
    return [
        (i, np.array(v, float)) for i, v in rows
        if v is not None and len(v) == d and None not in v and np.isfinite(v).all() and np.any(v)
    ]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows_of()], SCHEMA).repartition(3)


def near_brute(rows, d=8):
    used = usable(rows, d)
    x = np.stack([v for _, v in used])
    ids = [i for i, _ in used]
    norm = np.sqrt((x * x).sum(axis=1))
    linked = (x @ x.T) / np.outer(norm, norm) >= 0.95
    np.fill_diagonal(linked, False)
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(linked), strict=True)]
    root = brute.smallest(ids, links)
    out = {i: (i, 0, i, True) for i, _ in rows}
    out |= {i: (i, int(linked[n].sum()), root[i], root[i] == i) for n, i in enumerate(ids)}
    return sorted(out.values(), key=str)


@pytest.mark.parametrize("tile", [4096, 20])
def test_near_vectors(spark, vectors, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    assert bag(embedding_dedup.near_vectors(vectors)) == near_brute(rows_of())


def test_near_vectors_of_the_given_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    d = len(rows[0][1])
    used = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) == d]
    assert len(used) == len(rows)
    found = {r["vec_id"]: r for r in embedding_dedup.near_vectors(df).collect()}
    x = np.stack([v for _, v in used])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    linked = unit @ unit.T >= 0.95
    assert [found[i]["n_links"] for i, _ in used] == (linked.sum(axis=1) - 1).tolist()


def test_bounds_hold_for_every_pair():
    rng = np.random.default_rng(4)
    x = embedding_dedup.unit(rng.normal(size=(80, 16)) * 10.0 ** rng.integers(-9, 9, (80, 16)))
    steps, scale, length, error = embedding_dedup.quantised(x)
    near = (steps * scale[:, None]) @ (steps * scale[:, None]).T
    bound = np.outer(length + error, length + error) - np.outer(length, length)
    assert (np.abs(x @ x.T - near) <= bound + 1e-12).all()


def test_boxes_never_part_linked_vectors():
    rng = np.random.default_rng(5)
    x = embedding_dedup.unit(rng.normal(size=(200, 4)))
    low, high = x[:, None, :].min(axis=1), x[:, None, :].max(axis=1)
    reach = float(np.sqrt(2 - 2 * 0.95)) + 1e-5
    near = dict(embedding_dedup.near_boxes(low, high, reach))
    for i, j in zip(*np.nonzero(x @ x.T >= 0.95), strict=True):
        assert j in near[i]


def nearest_brute(rows, d=8, k=20):
    used = usable(rows, d)
    x = np.stack([v for _, v in used])
    ids = np.array([i for i, _ in used])
    out = {}
    for n in np.flatnonzero(ids % 20 == 0):
        score = x @ x[n]
        score[n] = -np.inf
        best = np.lexsort((ids, -np.round(score, 12)))[: min(k, len(ids) - 1)]
        out[int(ids[n])] = [(int(ids[b]), score[b]) for b in best]
    return out


def test_neighbours(spark, vectors):
    want = nearest_brute(rows_of())
    found: dict[int, list] = {}
    for r in neighbours.nearest(vectors).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert found.keys() == want.keys()
    hits = 0
    for q, best in want.items():
        assert [r for r, _, _ in found[q]] == [*range(1, len(best) + 1)]
        assert [(-s, v) for _, v, s in found[q]] == sorted((-s, v) for _, v, s in found[q])
        assert all(v != q for _, v, _ in found[q])
        hits += len({v for _, v, _ in found[q]} & {v for v, _ in best})
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_recall_on_the_given_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want = nearest_brute(rows, len(rows[0][1]))
    found: dict[int, set] = {}
    for r in neighbours.nearest(df).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = sum(len(found[q] & {v for v, _ in best}) for q, best in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


def mixed_rows():
    rows = [(i, v) for i, v in rows_of(120, 8) if v is None or len(v) != 2]
    for d, seed in ((1, 1), (3, 3)):
        rng = np.random.default_rng(seed)
        rows += [(10_000 * d + 5 * i, rng.normal(size=d).astype(np.float32).tolist()) for i in range(25)]
        rows += [(10_000 * d + 500, [1.0] * d), (10_000 * d + 501, [1.0] * d), (10_000 * d + 520, [2.0] * d)]
    return rows


@pytest.mark.parametrize("tile", [4096, 7])
def test_each_dimension_links_within_itself(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    rows = mixed_rows()
    df = spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], SCHEMA)
    want = {}
    for d in (1, 3, 8):
        want |= {r[0]: r for r in near_brute([(i, v) for i, v in rows if v is not None and len(v) == d], d)}
    want |= {i: (i, 0, i, True) for i, _ in rows if i not in want}
    assert bag(embedding_dedup.near_vectors(df)) == sorted(want.values(), key=str)


@pytest.mark.parametrize(("n", "d"), [(2, 8), (3, 8), (4, 3), (5, 1), (5, 2), (200, 4), (200, 5), (3, 1500)])
def test_few_or_narrow_or_wide_vectors(spark, n, d):
    rng = np.random.default_rng(n * d)
    x = rng.normal(size=(n, d)).astype(np.float32)
    x[-1] = x[0] * np.float32(1.5)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], SCHEMA)
    assert bag(embedding_dedup.near_vectors(df)) == near_brute(rows, d)


def test_neighbours_of_each_dimension_and_groups_in_slices(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "GROUP_ROWS", 4)
    monkeypatch.setattr(neighbours, "SAMPLE", 32)
    rows = mixed_rows()
    df = spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], SCHEMA)
    found: dict[int, list] = {}
    for r in neighbours.nearest(df).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    hits = wanted = 0
    asked = set()
    for d in (1, 3, 8):
        for q, best in nearest_brute(rows, d).items():
            asked.add(q)
            hits += len(set(found[q]) & {v for v, _ in best})
            wanted += len(best)
    assert set(found) == asked and hits >= 0.9 * wanted


def test_slices_keep_groups_small_beyond_the_sample():
    rng = np.random.default_rng(2)
    forest = neighbours.plant(rng.normal(size=(200, 4)), 20.0, 10**9)
    first, parts = neighbours.dealt(forest, 1, 10**9)
    rows = forest.weight * 10**9 / parts
    assert rows.max() <= 2 * neighbours.GROUP_ROWS and (np.diff(first, axis=1) == parts[:, :-1]).all()


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(20, [1.0, 0.0]), (21, [0.5, 1.0]), (21, [0.5, 1.0])], "vec_id bigint, embedding array<double>")
    assert bag(neighbours.nearest(few)) == [(20, 1, 21, 0.5)]
    none = few.limit(0)
    assert neighbours.nearest(none).collect() == [] and embedding_dedup.near_vectors(none).collect() == []
    bad = spark.createDataFrame([(1, None), (None, None)], "vec_id bigint, embedding array<double>")
    assert bag(embedding_dedup.near_vectors(bad)) == sorted([(1, 0, 1, True), (None, 0, None, True)], key=str)
