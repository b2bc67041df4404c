"""Approximate nearest neighbours by a forest of random-projection trees.

Largest inner product becomes nearest distance by one more component, which fills every
vector up to the largest length. The ``TREES`` trees are made from a bounded sample: each
level of a tree has a random direction, each node the median of its sample. Every vector
is routed to one leaf of each tree; the index holds all of them.

A query walks all trees through one shared priority queue, ordered by how far, squared, the
cuts on the way lie on the wrong side, until the leaves taken are expected to hold
``budget`` times the rows. The budget is measured before on queries of the sample: the
smallest of a ladder that finds ``RECALL`` of the true neighbours; the last is enough to take
every leaf. So it is small where vectors crowd and near one where they do not.

Neighbouring leaves of a tree form groups; a group is one task's work, with the queries
that visit it and their leaves. Scores are computed on the original vectors in double
precision; a group returns the best of each query, and the best of all are ranked.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limpid.llm.layout import cut
from limpid.llm.vectors import classes_of, dimensions, matrix, vector_rows

NEAREST = 20
QUERY_EVERY = 20
TREES = 4
SAMPLE = 20_000
LEAF_ROWS = 64
GROUP_ROWS = 2048
PROBES = 200
RECALL = 0.96
LADDER = (0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9, 1.1, 1.4, 1.8, 2.5, float(TREES))
QUERY_BATCH = 256

ROWS = "tree int, grp int, leaf int, node bigint, v array<double>"
VISITS = "tree int, grp int, node bigint, v array<double>, leaves array<int>"
NEIGHBOURS = "query_id bigint, rank int, vec_id bigint, score double"
BEST = "query bigint, nodes array<bigint>, scores array<double>"


@dataclass
class Forest:
    """Directions and medians of all trees; bounded by the sample."""

    directions: np.ndarray  # tree, level, component
    medians: list[np.ndarray]  # by level: tree, node
    length: float  # largest, squared
    weight: np.ndarray  # tree, leaf: share of the sample

    @property
    def depth(self) -> int:
        return len(self.medians)

    def projected(self, rows: np.ndarray, queries: bool) -> np.ndarray:
        """Rows as (row, tree, level), with the component that evens their lengths out."""
        spare = np.zeros(len(rows)) if queries else np.sqrt(
            np.maximum(self.length - (rows * rows).sum(axis=1), 0)
        )
        full = np.concatenate([rows, spare[:, None]], axis=1)
        return np.einsum("nd,tld->ntl", full, self.directions, optimize=True)

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree."""
        at = np.zeros((len(rows), len(self.directions)), np.int64)
        value = self.projected(rows, False)
        tree = np.arange(at.shape[1])
        for level, medians in enumerate(self.medians):
            at = at * 2 + (value[:, :, level] > medians[tree, at])
        return at

    def visits(self, query: np.ndarray, budget: float) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of the shared queue until the budget is used."""
        value = self.projected(query[None, :], True)[0]
        queue = [(0.0, tree, 0, 0) for tree in range(len(value))]
        heapq.heapify(queue)
        found, used = [], 0.0
        while queue and used < budget:
            far, tree, level, node = heapq.heappop(queue)
            while level < self.depth:
                gap = value[tree, level] - self.medians[level][tree, node]
                near = int(gap > 0)
                heapq.heappush(queue, (far + gap * gap, tree, level + 1, node * 2 + 1 - near))
                node, level = node * 2 + near, level + 1
            found.append((tree, node))
            used += float(self.weight[tree, node])
        return found


def plant(sample: np.ndarray, longest: float, total: int, seed: int = 7) -> Forest:
    """Trees whose leaves hold about ``LEAF_ROWS`` of the rows, or 8 of the sample."""
    rng = np.random.default_rng(seed)
    d = sample.shape[1] + 1
    depth = max(0, int(np.floor(np.log2(max(1, min(total / LEAF_ROWS, len(sample) / 8))))))
    directions = np.zeros((TREES, depth, d))
    for tree in range(TREES):
        for at in range(0, depth, d):
            base, _ = np.linalg.qr(rng.normal(size=(d, d)))
            directions[tree, at : at + d] = base[: depth - at]
    forest = Forest(directions, [], longest, np.ones((TREES, 1)))
    value = forest.projected(sample, False)
    at = np.zeros((len(sample), TREES), np.int64)
    for level in range(depth):
        medians = np.zeros((TREES, 1 << level))
        for tree in range(TREES):
            order = np.argsort(at[:, tree], kind="stable")
            cuts = np.searchsorted(at[order, tree], np.arange((1 << level) + 1))
            for node in range(1 << level):
                mine = order[cuts[node] : cuts[node + 1]]
                if len(mine):
                    medians[tree, node] = np.median(value[mine, tree, level])
        forest.medians.append(medians)
        at = at * 2 + (value[:, :, level] > medians[np.arange(TREES), at])
    forest.weight = np.stack(
        [np.bincount(at[:, t], minlength=1 << depth) / max(1, len(sample)) for t in range(TREES)]
    )
    # A leaf that the sample missed still costs something.
    forest.weight = np.maximum(forest.weight, 1e-9)
    return forest


def calibrate(forest: Forest, sample: np.ndarray, probes: np.ndarray) -> float:
    """The smallest budget of the ladder that finds ``RECALL`` of the sample's neighbours."""
    k = min(NEAREST, len(sample) - 1)
    if k < 1:
        return LADDER[-1]
    score = sample[probes] @ sample.T
    score[np.arange(len(probes)), probes] = -np.inf
    true = np.argpartition(-score, k - 1, axis=1)[:, :k]
    leaf = forest.leaves(sample)
    # Rank of the leaf at which each true neighbour turns up, as budget used by then.
    need = []
    for i, probe in enumerate(probes):
        used, when = 0.0, {}
        for tree, node in forest.visits(sample[probe], float(TREES)):
            when[tree, node] = used
            used += float(forest.weight[tree, node])
        for row in true[i]:
            need.append(min(when.get((t, int(leaf[row, t])), np.inf) for t in range(TREES)))
    need = np.array(need)
    for budget in LADDER:
        if (need < budget).mean() >= RECALL:
            return budget
    return LADDER[-1] + 1


def dealt(forest: Forest, leaves_a_group: int, total: int) -> tuple[np.ndarray, np.ndarray]:
    """(first number, number of slices) of each group of leaves, by tree.

    The trees end where the sample does; a group that the sample expects to be larger than
    two groups is dealt into slices, so no task's rows grow with the table.
    """
    starts = np.arange(0, forest.weight.shape[1], leaves_a_group)
    rows = np.add.reduceat(forest.weight, starts, axis=1) * total
    parts = np.maximum(1, np.ceil(rows / (2 * GROUP_ROWS))).astype(np.int64)
    return np.cumsum(parts, axis=1) - parts, parts


def _routed(shared, leaves_a_group: int):
    def emit(batches):
        forest, _, first, parts = shared.value
        for batch in batches:
            leaf = forest.leaves(matrix(batch.column("v"))).astype(np.int32)
            for tree in range(TREES):
                own = leaf[:, tree]
                group = own // leaves_a_group
                # Nodes are numbered as they come, so their last digits deal them evenly.
                grp = first[tree, group] + batch.column("node").to_numpy() % parts[tree, group]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), tree, np.int32)), pa.array(grp.astype(np.int32)),
                     pa.array(own), batch.column("node"), batch.column("v")],
                    names=["tree", "grp", "leaf", "node", "v"],
                )

    return emit


def _visiting(shared, leaves_a_group: int):
    def emit(batches):
        forest, budget, first, parts = shared.value
        for batch in batches:
            rows = matrix(batch.column("v"))
            at, trees, groups, lists = [], [], [], []
            for i, query in enumerate(rows):
                by_group: dict[tuple[int, int], list[int]] = {}
                for tree, leaf in forest.visits(query, budget):
                    by_group.setdefault((tree, leaf // leaves_a_group), []).append(leaf)
                for (tree, group), leaves in by_group.items():
                    for part in range(parts[tree, group]):
                        at.append(i)
                        trees.append(tree)
                        groups.append(first[tree, group] + part)
                        lists.append(leaves)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(trees, pa.int32()), pa.array(groups, pa.int32()),
                 batch.column("node").take(at), batch.column("v").take(at),
                 pa.array(lists, pa.list_(pa.int32()))],
                names=["tree", "grp", "node", "v", "leaves"],
            )

    return emit


def _best(rows: pa.Table, queries: pa.Table) -> pa.Table:
    """The best rows of a group for each query that visits it, in its leaves only."""
    out: list[tuple] = []
    if rows.num_rows and queries.num_rows:
        x, y = matrix(rows.column("v")), matrix(queries.column("v"))
        leaf, node = rows.column("leaf").to_numpy(), rows.column("node").to_numpy()
        lists = queries.column("leaves").to_pylist()
        names = queries.column("node").to_pylist()
        # Own class included, and room for rounding in the fast product.
        most = NEAREST + 1 + 4
        low = int(leaf.min())
        for at in range(0, len(y), QUERY_BATCH):
            part = y[at : at + QUERY_BATCH]
            seen = np.zeros((len(part), int(leaf.max()) - low + 1), bool)
            for i, leaves in enumerate(lists[at : at + QUERY_BATCH]):
                own = np.array(leaves) - low
                seen[i, own[(own >= 0) & (own < seen.shape[1])]] = True
            score = np.where(seen[:, leaf - low], part @ x.T, -np.inf)
            k = min(most, score.shape[1])
            top = np.argpartition(-score, k - 1, axis=1)[:, :k]
            for i in range(len(part)):
                mine = top[i][score[i, top[i]] > -np.inf]
                exact = (x[mine] * part[i]).sum(axis=1)
                out.append((names[at + i], node[mine].tolist(), exact.tolist()))
    columns = zip(*out, strict=True) if out else ([], [], [])
    kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()))
    return pa.Table.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["query", "nodes", "scores"]
    )


def _merged(table: pa.Table) -> pa.Table:
    """A query's best over all groups: its own class and ``NEAREST`` others, ties included."""
    nodes = np.concatenate([np.array(x, np.int64) for x in table.column("nodes").to_pylist()])
    scores = np.concatenate([np.array(x, np.float64) for x in table.column("scores").to_pylist()])
    nodes, one = np.unique(nodes, return_index=True)
    scores = scores[one]
    if len(scores) > NEAREST + 1:
        least = np.partition(scores, len(scores) - NEAREST - 1)[len(scores) - NEAREST - 1]
        nodes, scores = nodes[scores >= least], scores[scores >= least]
    kinds = (pa.list_(pa.int64()), pa.list_(pa.float64()))
    return pa.table({
        "query": table.column("query").slice(0, 1),
        "nodes": pa.array([nodes.tolist()], kinds[0]),
        "scores": pa.array([scores.tolist()], kinds[1]),
    })


def nearest(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = QUERY_EVERY
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for each query.

    Queries are the rows whose id is divisible by ``every``; candidates all other rows.
    Nearness is the inner product in double precision, ties go to the smaller id. Copies of
    a vector are indexed once and listed each. Vectors meet those of their own dimension,
    each dimension in a forest of its own. Vectors that are null, zero, or hold a null or no
    finite number take no part, nor do rows without id. Repeated rows of one id count as one. Other columns play no part; an empty
    table gives an empty one.
    """
    spark = df.sparkSession
    rows = vector_rows(df.where(F.col(key).isNotNull()), key, vector).dropDuplicates(["id", "digest"])
    every_class = classes_of(rows, NEAREST + 1)
    found = [
        _nearest(rows.where(F.size("v") == d), every_class.where(F.size("v") == d), every)
        for d in dimensions(every_class)
    ]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], NEIGHBOURS)


def _nearest(rows: DataFrame, classes: DataFrame, every: int) -> DataFrame:
    """The same for vectors of one dimension, of which there are some."""
    spark = rows.sparkSession
    facts = classes.agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("longest"),
    ).first()
    total = facts["n"]
    share = int(min(1.0, SAMPLE / total) * (1 << 20)) + 1
    picked = classes.where(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < share).select("v").limit(SAMPLE)
    sample = np.array([r["v"] for r in picked.toLocalIterator()], np.float64)
    if not len(sample):
        sample = np.array([classes.select("v").first()["v"]], np.float64)
    forest = plant(sample, float(facts["longest"]), total)
    probes = np.arange(0, len(sample), max(1, len(sample) // PROBES))
    budget = calibrate(forest, sample, probes)
    leaves = 1 << forest.depth
    leaves_a_group = max(1, round(GROUP_ROWS * leaves / total))
    shared = spark.sparkContext.broadcast((forest, budget, *dealt(forest, leaves_a_group, total)))

    indexed = classes.select("node", "v").mapInArrow(_routed(shared, leaves_a_group), ROWS)
    asking = rows.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), "digest")
    asking = cut(asking.join(classes.select("digest", "node"), "digest").select("query_id", "node"), "queries")
    queries = classes.join(asking.select("node").distinct(), "node").select("node", "v")
    visits = queries.mapInArrow(_visiting(shared, leaves_a_group), VISITS)
    found = (
        indexed.groupBy("tree", "grp").cogroup(visits.groupBy("tree", "grp")).applyInArrow(_best, BEST)
    )
    # One row a query again before anything is joined.
    best = found.groupBy("query").applyInArrow(_merged, BEST)
    pairs = best.select("query", F.explode(F.arrays_zip("nodes", "scores")).alias("x"))
    pairs = pairs.select("query", F.col("x.nodes").alias("node"), F.col("x.scores").alias("score"))
    kept = pairs.join(classes.select("node", "ids"), "node").select(
        "query", "score", F.explode("ids").alias("vec_id")
    )
    answers = asking.join(kept, F.col("node") == F.col("query")).where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEAREST)
    return ranked.select("query_id", "rank", "vec_id", "score")
