"""Vector codes against plain loops over every entry."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from limpid.llm import vector_codes
from tests.llm.conftest import bag

SCHEMA = "vec_id bigint, embedding array<double>, label string, v int, d int, id int, of int, key int"


def rows_of(n, d, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * 0.2
    x[: n // 4] = x[0]
    x[n // 4 : n // 2] = np.round(x[n // 4 : n // 2], 1)
    return [(int(i) * 3 + d * 100_000, v.tolist(), [None, "a", "b"][i % 3]) for i, v in enumerate(x)]


BAD = [(1, None, "a"), (2, [None] * 16, "a"), (3, [float("nan")] * 16, "a"), (4, [float("inf")] + [0.0] * 15, None)]
EDGES = [(90, [], "c"), (None, [0.25] * 16, None), (91, [0.0] * 16, "a"), (92, [1e200] * 16, "d"), (93, [-1e200] * 16, "d")]


def exact(x):
    return math.floor(x) * 256 if abs(x) > 2.0**53 else math.floor(x * 256)


def plain(rows):
    used = [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    out = []
    for d in sorted({len(v) for _, v, _ in used}):
        mine = sorted((r for r in used if len(r[1]) == d), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        cut = [(k * d // 16, (k + 1) * d // 16) for k in range(16)]
        whole = [[exact(c) for c in v] for _, v, _ in mine]
        books = [[w[i:j] for w in whole[:64]] for i, j in cut]

        def assigned():
            hits = []
            for w in whole:
                row = []
                for (i, j), book in zip(cut, books, strict=True):
                    row.append(min((sum((x - y) ** 2 for x, y in zip(w[i:j], e, strict=True)), n) for n, e in enumerate(book)))
                hits.append(row)
            return hits

        for _ in range(2):
            hits = assigned()
            for k, (i, j) in enumerate(cut):
                for n in range(len(books[k])):
                    of = [w[i:j] for w, row in zip(whole, hits, strict=True) if row[k][1] == n]
                    if of:
                        books[k][n] = [sum(c) // len(of) for c in zip(*of, strict=True)]
        digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
        for (key, _, label), row in zip(mine, assigned(), strict=True):
            out.append([key, "".join(f"{n:02x}" for _, n in row), sum(f for f, _ in row), label, digest])
    total = {}
    for _, _, error, label, _ in out:
        total[label] = total.get(label, 0) + error
    long = lambda x: x if x < 2**63 else None
    return sorted([(k, c, long(e), long(total[lab]), h) for k, c, e, lab, h in out], key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("n", [1, 5, 64, 300])
def test_codes(spark, n):
    rows = rows_of(n, 32) + BAD
    assert bag(vector_codes.vector_codes(table(spark, rows))) == plain(rows)


def test_edges_mixed_dimensions_and_repeated_rows(spark):
    rows = rows_of(80, 16) + rows_of(90, 20, 1) + rows_of(10, 3, 2) + BAD + EDGES
    rows += [rows[0], rows[0], (rows[1][0], [0.5] * 16, "b"), (None, [0.1] * 16, "a")]
    assert bag(vector_codes.vector_codes(table(spark, rows))) == plain(rows)


def test_sums_of_many_tasks_meet(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "MEETING", 2)
    monkeypatch.setattr(vector_codes, "ROWS", 7)
    rows = rows_of(200, 16, 5)
    df = table(spark, rows).repartition(9)
    assert bag(vector_codes.vector_codes(df)) == plain(rows)


def test_empty(spark):
    found = vector_codes.vector_codes(table(spark, BAD))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and found.collect() == []


@pytest.mark.parametrize("spread", [1, 3, 1000, 10**15])
def test_the_tree_finds_the_nearest_entry_and_the_smaller_of_equals(spread):
    rng = np.random.default_rng(spread % 97)
    kind = object if spread > 10**6 else np.int64
    entries = rng.integers(-spread, spread + 1, (64, 3)).astype(kind)
    points = rng.integers(-spread, spread + 1, (500, 3)).astype(kind)
    index, far = vector_codes.nearest_entries(points, vector_codes.Gnat(entries, np.arange(64)))
    every = np.array([[int(((p - e) ** 2).sum()) for e in entries] for p in points], object)
    want = [min(range(64), key=lambda n: (row[n], n)) for row in every]
    assert index.tolist() == want and far.tolist() == [row[n] for row, n in zip(every, want, strict=True)]


def test_subtrees_are_dropped():
    rng = np.random.default_rng(8)
    centres = rng.integers(-10_000, 10_000, (8, 4)).repeat(8, axis=0)
    entries = centres + rng.integers(-20, 20, (64, 4))
    tree = vector_codes.Gnat(entries, np.arange(64))
    points = entries[rng.integers(0, 64, 400)] + rng.integers(-5, 5, (400, 4))
    visited = []
    plain_search = vector_codes.Gnat.search
    try:
        vector_codes.Gnat.search = lambda self, p, rows, *rest: (visited.append(len(rows)), plain_search(self, p, rows, *rest))[1]
        vector_codes.nearest_entries(points, tree)
    finally:
        vector_codes.Gnat.search = plain_search
    assert sum(visited) <= 3 * len(points)  # the root, the query's own cluster, little else
