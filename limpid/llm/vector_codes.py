"""Vectors compressed to one byte a part, the nearest entries found through a GNAT.

Components become whole numbers and vectors are cut into equal parts. Each part position has
a codebook of at most 64 entries, so one fits in every task whatever the data. Its entries
stand in a geometric near-neighbour access tree: split points hold, for the entries under
every other split point, the range of their distances to it. A query that measured its
distance to a split point drops each subtree whose range cannot reach its best distance.
Distances are whole squares; their roots are rounded outwards, and a subtree goes only if it
is strictly farther, so that ties reach the exact comparison: smaller square, then smaller
index. Sums of a round are added in the tasks, then over groups of tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limpid.llm.layout import known_id

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
SPLITS = 8
ROWS = 4096
# Tasks whose sums meet in one group before those of all groups meet.
MEETING = 256
# Above what the rounding of a root of a whole square can be off.
SLACK = 2.0**-48

SUMS = "d int, part int, meeting int, counts array<bigint>, sums array<string>"


def usable(vector: Column) -> Column:
    """Not null, every component a finite number; zero vectors and empty ones are."""
    infinite = float("inf")
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite)), F.lit(False))


def whole(rows: np.ndarray) -> np.ndarray:
    """floor(256 x) of each component; Python numbers where squares could pass 64 bits."""
    largest = np.abs(rows).max(initial=0.0)
    d = max(1, rows.shape[1])
    if largest * SCALE < 2.0**30 / np.sqrt(d):
        return np.floor(rows * SCALE).astype(np.int64)
    exact = [int(x) * SCALE if abs(x) > 2.0**53 else int(np.floor(x * SCALE)) for x in rows.ravel().tolist()]
    return np.array(exact, object).reshape(rows.shape)


def spans(d: int) -> list[tuple[int, int]]:
    """Bounds of the parts; equal where 16 divides the dimension, else one apart."""
    return [(k * d // PARTS, (k + 1) * d // PARTS) for k in range(PARTS)]


def squares(points: np.ndarray, entry: np.ndarray) -> np.ndarray:
    step = points - entry
    if not step.shape[1]:
        return np.zeros(len(points), points.dtype)
    return (step * step).sum(axis=1)


def roots(square: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(at most, at least) the distances of whole squares."""
    if square.dtype == object:  # squares may pass what a double holds, their roots do not
        floor = np.array([math.isqrt(x) for x in square.ravel().tolist()], np.float64).reshape(square.shape)
        return floor * (1 - SLACK), (floor + 1) * (1 + SLACK)
    root = np.sqrt(square.astype(np.float64))
    return root * (1 - SLACK), root * (1 + SLACK)


class Gnat:
    """A subtree over the entries ``members``; children hold what is nearest their split point."""

    def __init__(self, entries: np.ndarray, members: np.ndarray):
        self.entries = entries
        chosen = [0]
        near = squares(entries[members], entries[members[0]])
        while len(chosen) < min(SPLITS, len(members)):
            # The next split point is the one farthest from those chosen.
            far = max((i for i in range(len(members)) if i not in chosen), key=lambda i: (near[i], -i))
            chosen.append(far)
            near = np.minimum(near, squares(entries[members], entries[members[far]]))
        self.splits = members[chosen]
        rest = np.delete(members, chosen)
        self.children: list[Gnat | None] = [None] * len(self.splits)
        if not len(rest):
            return
        far = np.stack([squares(entries[rest], entries[s]) for s in self.splits], axis=1)
        owner = np.array([min(range(far.shape[1]), key=lambda j: (row[j], j)) for row in far])
        k = len(self.splits)
        self.low, self.high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        for j in range(k):
            mine = np.flatnonzero(owner == j)
            if not len(mine):
                continue
            self.children[j] = Gnat(entries, rest[mine])
            low, high = roots(far[mine])
            self.low[:, j], self.high[:, j] = low.min(axis=0), high.max(axis=0)

    def search(self, points: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        """Improve the best square and entry of ``points[rows]``, ties to the smaller entry."""
        here = points[rows]
        square = np.stack([squares(here, self.entries[s]) for s in self.splits], axis=1)
        for j, s in enumerate(self.splits.tolist()):
            held, at = best[rows], square[:, j]
            better = (at < held) | ((at == held) & (s < index[rows]))
            best[rows[better]], index[rows[better]] = at[better], s
        if all(child is None for child in self.children):
            return
        low, high = roots(square)
        turn = np.argsort(low, axis=1, kind="stable")
        for place in range(len(self.splits)):
            for j, child in enumerate(self.children):
                if child is None:
                    continue
                mine = np.flatnonzero(turn[:, place] == j)
                if not len(mine):
                    continue
                # The least that any entry of the child can be away, seen from every split point.
                least = np.maximum(low[mine] - self.high[:, j], self.low[:, j] - high[mine]).max(axis=1)
                reach = roots(best[rows[mine]])[1]
                alive = mine[least * (1 - SLACK) <= reach]
                if len(alive):
                    child.search(points, rows[alive], best, index)


def nearest_entries(points: np.ndarray, tree: Gnat) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, its squared distance) of each point."""
    first = tree.splits[0]
    best, index = squares(points, tree.entries[first]), np.full(len(points), first, np.int64)
    tree.search(points, np.arange(len(points)), best, index)
    return index, best


Books = dict[int, list[np.ndarray]]  # by dimension, then part position


def _trees(books: Books) -> dict[int, list[Gnat]]:
    return {d: [Gnat(e, np.arange(len(e))) for e in parts] for d, parts in books.items()}


def _coded(batches: Iterator[pa.RecordBatch], books: Books):
    """Yield (rows of the batch, dimension, whole vectors, codes, squares), dimension by dimension."""
    trees = _trees(books)
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            piece = batch.slice(at, ROWS)
            vectors = piece.column("v")
            sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(sizes).tolist():
                of = np.flatnonzero(sizes == d)
                flat = vectors.take(pa.array(of)).flatten().to_numpy(zero_copy_only=False)
                rows = whole(flat.reshape(len(of), d))
                codes, far = np.zeros((len(of), PARTS), np.int64), np.zeros((len(of), PARTS), object)
                for k, (i, j) in enumerate(spans(d)):
                    codes[:, k], far[:, k] = nearest_entries(_alike(rows[:, i:j], trees[d][k]), trees[d][k])
                yield piece.take(pa.array(of)), d, rows, codes, far


def _alike(points: np.ndarray, tree: Gnat) -> np.ndarray:
    """Python numbers if the entries are, so that no difference overflows."""
    return points.astype(object) if tree.entries.dtype == object else points


def _round_sums(shared):
    """Counts and sums of each entry over the rows of a task."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        counts = {d: np.zeros((PARTS, ENTRIES), np.int64) for d in books}
        sums = {d: [np.zeros((ENTRIES, j - i), object) for i, j in spans(d)] for d in books}
        for _, d, rows, codes, _ in _coded(batches, books):
            for k, (i, j) in enumerate(spans(d)):
                counts[d][k] += np.bincount(codes[:, k], minlength=ENTRIES)
                # At most ROWS numbers of half the bits of a square: no overflow.
                added = np.zeros((ENTRIES, j - i), rows.dtype)
                np.add.at(added, codes[:, k], rows[:, i:j])
                sums[d][k] += added.astype(object)
        meeting = TaskContext.get().partitionId() // MEETING
        used = [(d, k) for d in books for k in range(PARTS) if counts[d][k].any()]
        if used:
            yield pa.RecordBatch.from_pydict({
                "d": pa.array([d for d, _ in used], pa.int32()),
                "part": pa.array([k for _, k in used], pa.int32()),
                "meeting": pa.array([meeting] * len(used), pa.int32()),
                "counts": pa.array([counts[d][k].tolist() for d, k in used], pa.list_(pa.int64())),
                "sums": pa.array([[str(x) for x in sums[d][k].ravel()] for d, k in used], pa.list_(pa.string())),
            })

    return emit


def _added(table: pa.Table) -> pa.Table:
    counts = np.sum([np.array(c) for c in table.column("counts").to_pylist()], axis=0)
    sums = [sum(map(int, column)) for column in zip(*table.column("sums").to_pylist(), strict=True)]
    return pa.table({
        "d": table.column("d")[:1], "part": table.column("part")[:1],
        "meeting": pa.array([0], pa.int32()),
        "counts": pa.array([counts.tolist()], pa.list_(pa.int64())),
        "sums": pa.array([[str(x) for x in sums]], pa.list_(pa.string())),
    })


def _first_books(rows: DataFrame) -> Books:
    """The parts of the ``ENTRIES`` smallest ids of each dimension."""
    order = Window.partitionBy("d").orderBy("id", "v")
    first = rows.select("id", "v", F.size("v").alias("d")).withColumn("place", F.row_number().over(order))
    kept = first.where(F.col("place") <= ENTRIES).select("d", "place", "v").collect()
    books: Books = {}
    for d in {r["d"] for r in kept}:
        mine = sorted((r for r in kept if r["d"] == d), key=lambda r: r["place"])
        points = whole(np.array([r["v"] for r in mine], np.float64).reshape(len(mine), d))
        books[d] = [points[:, i:j] for i, j in spans(d)]
    return books


def _improved(rows: DataFrame, books: Books) -> Books:
    """One round: entries become the floored mean of their parts; unused ones stay."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    found = rows.select("v").mapInArrow(_round_sums(shared), SUMS)
    for keys in (("d", "part", "meeting"), ("d", "part")):
        found = found.groupBy(*keys).applyInArrow(_added, SUMS)
    after = {d: list(parts) for d, parts in books.items()}
    for r in found.toLocalIterator():
        entries = after[r["d"]][r["part"]]
        sums = np.array([int(x) for x in r["sums"]], object).reshape(ENTRIES, entries.shape[1])
        means = [
            [s // n for s in sums[e]] if (n := r["counts"][e]) else entries[e].tolist() for e in range(len(entries))
        ]
        after[r["d"]][r["part"]] = np.array(means, entries.dtype).reshape(entries.shape)
    return after


def codebooks(rows: DataFrame, rounds: int = ROUNDS) -> Books:
    """Entries after the rounds; at most 64 vectors of each dimension are on the driver."""
    books = _first_books(rows)
    for _ in range(rounds if books else 0):
        books = _improved(rows, books)
    return books


def codebook_digest(parts: list[np.ndarray]) -> str:
    numbers = ",".join(str(x) for entries in parts for x in entries.ravel().tolist())
    return hashlib.sha256(numbers.encode()).hexdigest()


def _final(shared):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        digest = {d: codebook_digest(parts) for d, parts in books.items()}
        for piece, d, _, codes, far in _coded(batches, books):
            errors = [e if e < 2**63 else None for e in far.sum(axis=1).tolist()]
            text = codes.astype(np.uint8).tobytes().hex()
            width = 2 * PARTS
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), piece.column("label"),
                 pa.array([text[i * width : (i + 1) * width] for i in range(len(codes))], pa.string()),
                 pa.array(errors, pa.int64()), pa.array([digest[d]] * len(codes), pa.string())],
                names=["id", "label", "code", "error", "codebooks_sha256"],
            )

    return emit


def vector_codes(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row that takes part.

    Vectors that are null or hold a null or no finite number are dropped; zero vectors take
    part. The first entries are those of the smallest ids, then of the smallest vectors where
    ids repeat; rows without id come last and keep a null id. Vectors of several dimensions
    have codebooks of their own; where 16 does not divide the dimension, parts differ by
    one. An ``error`` beyond 63 bits is null, and so is its label's. An empty table gives an
    empty one; other columns play no part.
    """
    v = F.col(vector).cast("array<double>")
    rows = df.select(known_id(key).alias("id"), F.col(key).cast("bigint").alias("key"), F.col(label).alias("label"), v.alias("v"))
    rows = rows.where(usable(F.col("v")))
    shared = df.sparkSession.sparkContext.broadcast(codebooks(rows))
    kind = rows.schema["label"].dataType.simpleString()
    found = rows.select(F.col("key").alias("id"), "label", "v").mapInArrow(
        _final(shared), f"id bigint, label {kind}, code string, error bigint, codebooks_sha256 string"
    )
    total = F.when(F.count("error") == F.count(F.lit(1)), F.try_sum("error"))
    totals = found.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    return found.join(totals, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256"
    )


def oracle_sql(rounds: int = ROUNDS) -> str:
    """The same in SQL: every part against every entry."""
    nearest = """nearest{n} AS (SELECT vec_id, label, p, v, min({{'far': list_sum(list_transform(list_zip(v, b),
      lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'entry': entry}}) AS hit
      FROM parts JOIN books{n} USING (p) GROUP BY ALL)"""
    improve = """used{n} AS (SELECT p, entry, list(m ORDER BY i) AS b FROM (
      SELECT p, hit.entry AS entry, i, (sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS m
      FROM nearest{n}, range(1, 1 + len(v)) AS r(i) GROUP BY ALL) GROUP BY ALL),
    books{m} AS (SELECT p, entry, coalesce(used{n}.b, books{n}.b)::BIGINT[] AS b FROM books{n} LEFT JOIN used{n} USING (p, entry))"""
    steps = [nearest.format(n=0)]
    for n in range(rounds):
        steps += [improve.format(n=n, m=n + 1), nearest.format(n=n + 1)]
    chain = ",\n    ".join(steps)
    return f"""WITH kept AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (SELECT vec_id, label, p, list_transform(e[p * (len(e) // {PARTS}) + 1 : (p + 1) * (len(e) // {PARTS})],
      lambda x: floor({SCALE} * x)::BIGINT) AS v FROM kept, range({PARTS}) AS r(p)),
    books0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS entry, v AS b FROM parts
      QUALIFY entry < {ENTRIES}),
    {chain},
    final AS (SELECT vec_id, any_value(label) AS label, sum(hit.far)::BIGINT AS error,
      string_agg(printf('%02x', hit.entry), '' ORDER BY p) AS code FROM nearest{rounds} GROUP BY vec_id),
    digest AS (SELECT sha256(string_agg(array_to_string(b, ','), ',' ORDER BY p, entry)) AS codebooks_sha256 FROM books{rounds})
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM final, digest"""
