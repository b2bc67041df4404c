"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

Equal vectors form classes. Classes are cut into tiles of about ``TILE`` by medians along the
main directions of a bounded sample; a tile pair is left out only if the boxes that hold
*all* its vectors in those directions are farther apart than linked vectors can be. A kept
pair of tiles is one group: its vectors, scaled to length one, are rounded to 127 steps
with an own scale each; products of whole numbers (exact in single precision, 1,024 columns at a
time) estimate the cosines. For each vector the length of its rounding error is known, and so is the
largest error of every product. Only pairs whose estimate plus bound reaches the threshold
are computed again in double precision. A task returns counts and a spanning
forest of its links, never its pairs.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.llm.components import components, roots
from limpid.llm.layout import NO_ID, cut, known_id
from limpid.llm.vectors import classes_of, dimensions, matrix, packed, scaled, unpacked, vector_rows

COSINE = 0.95
TILE = 4096
SAMPLE = 20_000
DIRECTIONS = 6
STRIP = 1024
AGAIN = 1 << 16
LEVELS = 127
EXACT = 1024  # 127 * 127 * 1024 < 2 ** 24
# Slack for rounding in the bounds themselves; far above what doubles and singles lose.
SLACK = 1e-5

TILES = "tile bigint, leaf int, d int, nodes binary, copies binary, rows binary, low array<double>, high array<double>"
FOUND = "node bigint, links bigint, root bigint"


def unit(rows: np.ndarray) -> np.ndarray:
    rows = scaled(rows)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def quantised(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(whole numbers, scale, length of the rounded vector, length of its error)."""
    scale = np.abs(rows).max(axis=1) / LEVELS
    steps = np.rint(rows / scale[:, None])
    near = steps * scale[:, None]
    length = np.sqrt((near * near).sum(axis=1))
    error = np.sqrt(((rows - near) ** 2).sum(axis=1))
    return steps.astype(np.int8), scale, length, error


def linked_pairs(a: np.ndarray, b: np.ndarray, cosine: float, same: bool):
    """Yield (i, j) of rows of ``a`` and ``b`` whose cosine reaches the threshold.

    x y = x' y' + x' f + e y' + e f for x = x' + e and y = y' + f, so the product of the
    rounded vectors is off by at most |x'||f| + |e||y'| + |e||f|.
    """
    unit_a, unit_b = unit(a), unit(b)
    steps_a, scale_a, length_a, error_a = quantised(unit_a)
    steps_b, scale_b, length_b, error_b = quantised(unit_b)
    right = steps_b.astype(np.float32).T
    norm_a = np.sqrt((scaled(a) ** 2).sum(axis=1))
    norm_b = np.sqrt((scaled(b) ** 2).sum(axis=1))
    for at in range(0, len(a), STRIP):
        s = slice(at, at + STRIP)
        estimate = np.float32(0)
        for c in range(0, len(right), EXACT):  # single precision holds these sums exactly
            part = steps_a[s, c : c + EXACT].astype(np.float32) @ right[c : c + EXACT]
            estimate = part if not c else estimate.astype(np.float64) + part
        estimate = estimate * scale_a[s, None].astype(np.float32)
        estimate *= scale_b[None, :].astype(np.float32)
        bound = (length_a + error_a)[s, None].astype(np.float32) * (length_b + error_b)[None, :].astype(np.float32)
        bound -= length_a[s, None].astype(np.float32) * length_b[None, :].astype(np.float32)
        estimate += bound
        i, j = np.nonzero(estimate >= cosine - SLACK)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), AGAIN):
            x, y = i[k : k + AGAIN], j[k : k + AGAIN]
            exact = (scaled(a[x]) * scaled(b[y])).sum(axis=1) / (norm_a[x] * norm_b[y])
            hit = exact >= cosine
            yield x[hit], y[hit]


def _compared(table: pa.Table) -> pa.Table:
    """Links between two tiles, or within one: counts and a forest."""
    order = np.argsort(table.column("tile").to_numpy(), kind="stable")
    table = table.take(pa.array(order))
    d = table.column("d")[0].as_py()
    sides = [0, 0] if table.num_rows == 1 else [0, 1]
    nodes = [np.frombuffer(table.column("nodes")[i].as_py(), np.int64) for i in sides]
    copies = [np.frombuffer(table.column("copies")[i].as_py(), np.int64) for i in sides]
    rows = [unpacked(table.column("rows")[i].as_py(), d) for i in sides]
    same = sides == [0, 0]
    base = 0 if same else len(nodes[0])
    n = base + len(nodes[1])
    links, root = np.zeros(n, np.int64), np.arange(n)
    for i, j in linked_pairs(rows[0], rows[1], COSINE, same):
        np.add.at(links, i, copies[1][j])
        np.add.at(links, base + j, copies[0][i])
        joined = roots(n, root[i], root[base + j])
        root = joined[root]
    every = nodes[1] if same else np.concatenate(nodes)
    used = np.flatnonzero(links)
    return pa.table({"node": every[used], "links": links[used], "root": every[root[used]]})


def _directions(sample: np.ndarray) -> np.ndarray:
    """Orthonormal main directions of a sample of unit vectors."""
    if len(sample) < 2:
        return np.eye(sample.shape[1])[: min(DIRECTIONS, sample.shape[1])]
    _, _, axes = np.linalg.svd(sample - sample.mean(axis=0), full_matrices=False)
    return axes[:DIRECTIONS]


def _medians(points: np.ndarray, depth: int) -> list[np.ndarray]:
    """Thresholds of a tree that halves the sample ``depth`` times, directions in turn."""
    leaf = np.zeros(len(points), np.int64)
    levels = []
    for level in range(depth):
        value = points[:, level % points.shape[1]]
        cuts = np.array([
            np.median(value[leaf == k]) if (leaf == k).any() else 0.0 for k in range(1 << level)
        ])
        levels.append(cuts)
        leaf = leaf * 2 + (value > cuts[leaf])
    return levels


def _placed(axes: np.ndarray, levels: list[np.ndarray]):
    def leaf_of(points: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(points), np.int64)
        for level, cuts in enumerate(levels):
            leaf = leaf * 2 + (points[:, level % points.shape[1]] > cuts[leaf])
        return leaf

    def emit(batches):
        for batch in batches:
            leaf = leaf_of(unit(matrix(batch.column("v"))) @ axes.T)
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf.astype(np.int32))], names=[*names, "leaf"]
            )

    return emit


def _tiled(axes: np.ndarray):
    def emit(key, table):
        rows = matrix(table.column("v"))
        points = unit(rows) @ axes.T
        return pa.table({
            "tile": pa.array([key[0].as_py()], pa.int64()),
            "leaf": pa.array([table.column("leaf")[0].as_py()], pa.int32()),
            "d": pa.array([rows.shape[1]], pa.int32()),
            "nodes": pa.array([table.column("node").to_numpy().tobytes()], pa.binary()),
            "copies": pa.array([table.column("copies").to_numpy().tobytes()], pa.binary()),
            "rows": pa.array([packed(rows)], pa.binary()),
            "low": [points.min(axis=0).tolist()],
            "high": [points.max(axis=0).tolist()],
        })

    return emit


def near_boxes(low: np.ndarray, high: np.ndarray, reach: float):
    """(i, other boxes at most ``reach`` away) for each box."""
    for i in range(len(low)):
        gap = np.maximum(0, np.maximum(low - high[i], low[i] - high))
        yield i, np.flatnonzero((gap * gap).sum(axis=1) <= reach * reach)


def _tiles(classes: DataFrame, total: int) -> DataFrame:
    """One row per tile of about ``TILE`` classes, written once."""
    spark = classes.sparkSession
    share = min(1.0, SAMPLE / total)
    rows = classes.select("v").where(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    sample = unit(np.array([r["v"] for r in rows.limit(SAMPLE).toLocalIterator()], np.float64))
    axes = _directions(sample)
    depth = max(0, min(int(np.ceil(np.log2(total / TILE))), int(np.log2(len(sample) / 8)) if len(sample) > 8 else 0))
    levels = _medians(sample @ axes.T, depth)
    kind = "node bigint, copies bigint, v array<double>, leaf int"
    placed = cut(classes.select("node", "copies", "v").mapInArrow(_placed(axes, levels), kind), "placed")
    # A leaf of more than a tile, where the sample ends, is dealt into several.
    counts = placed.groupBy("leaf").count().orderBy("leaf").collect()  # at most SAMPLE / 8 leaves
    parts = {r["leaf"]: -(-r["count"] // TILE) for r in counts}
    base, first = {}, 0
    for leaf, n in parts.items():
        base[leaf], first = first, first + n
    shape = spark.createDataFrame(
        [(leaf, base[leaf], n) for leaf, n in parts.items()], "leaf int, base bigint, parts int"
    )
    tile = (F.col("base") + F.pmod(F.xxhash64("node"), F.col("parts"))).alias("tile")
    dealt = placed.join(shape, "leaf").select(tile, "leaf", "node", "copies", "v")
    return cut(dealt.groupBy("tile").applyInArrow(_tiled(axes), TILES), "tiles")


def _found(classes: DataFrame, total: int) -> DataFrame:
    spark = classes.sparkSession
    tiles = _tiles(classes, total)
    boxes = (
        tiles.groupBy("leaf")
        .agg(
            F.min("tile").alias("first"), F.max("tile").alias("last"),
            *(F.array(*(f(F.get(F.col(name), F.lit(i))) for i in range(DIRECTIONS))).alias(name)
              for f, name in ((F.min, "low"), (F.max, "high"))),
        )
        .orderBy("leaf").collect()
    )  # at most SAMPLE / 8 leaves
    clean = lambda v: [0.0 if x is None else x for x in v]  # noqa: E731  fewer directions than asked
    low, high = (np.array([clean(b[c]) for b in boxes]) for c in ("low", "high"))
    reach = float(np.sqrt(2 - 2 * COSINE)) + SLACK
    near = [
        (boxes[i]["leaf"], [(int(boxes[j]["first"]), int(boxes[j]["last"])) for j in others])
        for i, others in near_boxes(low, high, reach)
    ]
    kind = T.StructType([
        T.StructField("leaf", T.IntegerType()),
        T.StructField("spans", T.ArrayType(T.StructType([
            T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))),
    ])
    partners = spark.createDataFrame(near, kind)
    others = F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["last"])))
    meets = tiles.join(partners, "leaf").withColumn("other", F.explode(others))
    meets = meets.select(
        F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"),
        "tile", "d", "nodes", "copies", "rows",
    )
    return cut(meets.groupBy("a", "b").applyInArrow(_compared, FOUND), "vector-links")


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``df``.

    Rows link if the cosine of their vectors, in double precision, is at least 0.95; copies
    of a vector link with each other. Vectors of different dimensions never link. Vectors
    that are null, zero, or hold a null or no finite number link with nothing: no links, own
    component, kept. A row without id comes after all others; its component is null if it meets none
    with an id. Other columns play no part; an empty table gives an empty one.
    """
    rows = vector_rows(df, key, vector)
    classes = classes_of(rows, 1)
    sizes = dimensions(classes)
    if sizes:
        found = reduce(
            DataFrame.unionByName, [_found(classes.where(F.size("v") == d), n) for d, n in sizes.items()]
        )
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
        labels = components(found.where("node <> root").select("node", "root"))
        labels = labels.withColumnRenamed("id", "node")
        placed = classes.select("digest", "node", "rep", "copies").join(labels, "node", "left")
        placed = placed.join(links, "node", "left").withColumn("label", F.coalesce("component", "node"))
        least = placed.groupBy("label").agg(F.min("rep").alias("component_id"))
        placed = placed.join(least, "label").select(
            "digest", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
        )
        linked = rows.select("id", "digest").join(placed, "digest").select("id", "n_links", "component_id")
    else:
        linked = rows.select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    # Rows that take no part are what is left of all rows, copies of an id included.
    every = df.select(known_id(key).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    part = rows.groupBy("id").agg(F.count(F.lit(1)).alias("used"))
    left = every.join(part, "id", "left").withColumn("n", F.col("n") - F.coalesce("used", F.lit(0)))
    bare = left.where("n > 0").select(
        F.explode(F.array_repeat("id", F.col("n").cast("int"))).alias("id"),
        F.lit(0).cast("bigint").alias("n_links"),
    )
    bare = bare.select("id", "n_links", F.col("id").alias("component_id"))
    none = F.lit(NO_ID)
    return linked.unionByName(bare).select(
        F.nullif("id", none).alias("vec_id"), "n_links",
        F.nullif("component_id", none).alias("component_id"),
        (F.col("id") == F.col("component_id")).alias("kept"),
    )
