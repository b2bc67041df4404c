"""Connected components of links, on Spark: every id learns the smallest id it reaches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.llm.layout import cut

LINKS = "big bigint, small bigint"


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number that each of ``n`` numbers reaches over the links (a, b)."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            shorter = root[root]
            if np.array_equal(shorter, root):
                break
            root = shorter


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a batch as stars with the same components."""
    for batch in batches:
        a, b = (batch.column(i).to_numpy() for i in (0, 1))
        ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = roots(len(ids), at[: len(a)], at[len(a) :])
        far = root != np.arange(len(ids))
        yield pa.RecordBatch.from_arrays([pa.array(ids[far]), pa.array(ids[root[far]])],
                                         names=["big", "small"])


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in the two columns of ``links``, but for roots.

    Large-star and small-star steps in turn: each id hangs its larger neighbours, then
    its smaller ones, under the smallest of all. A step is a partial aggregate and a join,
    both on ids; a hub's links are split by Spark. Each round is written, so a lost
    executor repeats a round at most. An id not in the result is a component's smallest
    or has no link.
    """
    a, b = (F.col(f"`{c}`").cast("bigint") for c in links.columns[:2])
    rows = links.select(F.greatest(a, b).alias("big"), F.least(a, b).alias("small"))
    stars = cut(rows.where("big > small").mapInArrow(_forest, LINKS).distinct(), "stars")
    seen = None
    while True:
        mark = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("big", "small"))).first()
        if mark == seen:
            return stars.select(F.col("big").alias("id"), F.col("small").alias("component"))
        seen = mark
        both = stars.unionByName(stars.select(F.col("small").alias("big"), F.col("big").alias("small")))
        least = both.groupBy("big").agg(F.min("small").alias("low"))
        least = least.select(F.col("big").alias("hub"), F.least("big", "low").alias("low"))
        # Large star: a larger neighbour hangs under the smallest.
        hung = stars.join(least, F.col("small") == F.col("hub")).select("big", F.col("low").alias("small"))
        hung = cut(hung.where("big > small").distinct(), "stars")
        # Small star: an id and its smaller neighbours hang under the smallest.
        low = hung.groupBy("big").agg(F.min("small").alias("low"))
        near = hung.join(low, "big").where("small > low").select(F.col("small").alias("big"), F.col("low").alias("small"))
        joined = near.unionByName(low.select("big", F.col("low").alias("small")))
        stars = cut(joined.mapInArrow(_forest, LINKS).distinct(), "stars")
