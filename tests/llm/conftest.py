from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"
PASSAGE = "This passage of more than fifty bytes, été included, stands in many of the documents here."


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 7))) for _ in range(n))


def _corpus() -> list[tuple]:
    base = words(1, 120)
    near = base.split()
    near[60] = "changed"
    other = base.split()
    other[10:40] = words(9, 30).split()
    texts = [
        (7, base), (3, base), (3, base), (12, base.upper()), (5, " ".join(near)), (6, " ".join(other)),
        (20, None), (21, ""), (22, " \t\n"), (23, "one two"), (24, "one  two"), (25, "ONE two"),
        (30, words(2, 40) + " " + PASSAGE), (31, PASSAGE + "\n" + words(3, 40)), (29, PASSAGE),
        (32, "x" * 49), (33, "x" * 49), (34, "x" * 50), (35, "x" * 500), (36, "x" * 51),
        (40, "a b " * 30), (41, "a b " * 31), (50, words(5, 30_000)), (51, words(5, 30_000) + " end"),
        (None, base), (None, words(6, 50)), (None, None), (60, "é" * 60), (61, "zé" + "é" * 60),
        (62, words(2, 40)[:80]),
    ]
    return [(i, t, "en", f"src{n % 3}", len(t or ""), n) for n, (i, t) in enumerate(texts)]


CORPUS = _corpus()
# Other columns carry the names that operators use inside.
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id int, block int, rest int, node int, n int"


@pytest.fixture(scope="session")
def corpus(spark):
    rows = [(*r[:5], r[5], 1, 2, 3, 4) for r in CORPUS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def bag(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)
