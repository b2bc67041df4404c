from __future__ import annotations

import pytest

from limpid.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Apply an expression to a list of texts: ``values(texts, expr)``."""
    from pyspark.sql import functions as F

    def apply(cells, expr, kind="string"):
        df = spark.createDataFrame(list(enumerate(cells)), f"i int, x {kind}")
        rows = df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()
        return [r["y"] for r in rows]

    return apply


def rows(df, *columns):
    """Rows as a sorted list of tuples, NULL last."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is None, str(v)) for v in t])
