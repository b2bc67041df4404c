"""Near-duplicate documents by bottom-k sketches of one hash function.

1. A document's set is its distinct five-word shingles, hashed once; the ``K`` smallest
   hashes are its sketch (``K`` follows from the threshold). Documents of one set form a
   class; only classes go on.
2. Inverted lists of retained values. Sets at the threshold (85 % unless said) keep about
   that share of the smallest values of their union in common, so two sketches of s values
   share s/2 of them but for a chance below one in a million; each then shares one of its
   s/2 + 1 *rarest* values. Only those are listed, so passages common to many documents make no
   long lists, and a document of mostly unseen values makes none.
3. Every list has a pivot, the member whose values are the most common. Members pair with
   pivots; the sketch of the union estimates each pair; the best pair of each member
   is verified on the full sets. Groups of copies end here, as stars.
4. The rest: lists of one pivot whose members are not all in its star compare all members,
   in tiles of ``TILE``: the same estimate tells who may have a link elsewhere, and a
   product of membership tables counts their common shingles exactly. Only a
   spanning forest of the links leaves a task. No list or partner is cut off.
5. Components of the verified links give each document its smallest relative.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limpid.llm.components import components, roots
from limpid.llm.hashing import (
    U64, binary_bounds, gram_hashes, lowered, mixed, multipliers, text_slices,
    word_hashes, word_spans,
)
from limpid.llm.layout import NO_ID, cut, known_id, row_mark

SHINGLE = 5
LINK_PERCENT = 85
K_STEP = 16
# The estimate of a pair at the threshold is below this less than once in a million.
LEAST_ESTIMATE = 0.5
MISS = 1e-6
TILE = 512
VERIFY_ROWS = 2000
ESTIMATE_ROWS = 1 << 16
PRODUCT_COLUMNS = 4096
FLAGGED = "pivot bigint, low int, high int, node bigint, side int"
NONE = np.iinfo(np.int64).max

Emit = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def miss_chance(percent: int, k: int) -> float:
    """Chance that sketches of ``k`` estimate a pair at ``percent`` below ``LEAST_ESTIMATE``."""
    p = percent / 100
    return sum(math.comb(k, i) * p**i * (1 - p) ** (k - i) for i in range(math.ceil(k * LEAST_ESTIMATE)))


def sketch_size(percent: int) -> int:
    """The ``K`` of a threshold: 32 at 85 %, 48 at 80 %."""
    if not 60 <= percent <= 100:
        raise ValueError("the threshold is a percentage from 60 to 100")
    k = 2 * K_STEP
    while miss_chance(percent, k) >= MISS:
        k += K_STEP
    return k


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct 63-bit hashes of each text's shingles."""
    data, bounds = binary_bounds(column)
    data = lowered(data)
    starts, lengths, limits = word_spans(data, bounds)
    words = word_hashes(data, starts, lengths)
    grams = (gram_hashes(words, SHINGLE) >> U64(1)).astype(np.int64)
    for a, b in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            yield np.unique(grams[a : b - SHINGLE + 1])
        elif b > a:
            few = np.full(1, b - a, U64)
            for word in range(a, b):
                few = mixed(few * multipliers(1) + words[word : word + 1])
            yield (few >> U64(1)).astype(np.int64)
        else:
            yield np.zeros(0, np.int64)


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))


def _sketches(k: int) -> Emit:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            sizes, digests, sketches = [], [], []
            for values in shingle_sets(batch.column("text")):
                sizes.append(len(values))
                digests.append(_digest(values))
                sketches.append(values[:k])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("mark"), pa.array(sizes, pa.int64()),
                 pa.array(digests, pa.binary()), _lists(sketches)],
                names=["id", "mark", "n", "digest", "sketch"],
            )

    return emit


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    """Sketches as rows of ``k``, filled up with a number no sketch has."""
    counts = np.diff(column.offsets.to_numpy())
    out = np.full((len(column), k), NONE, np.int64)
    flat = column.flatten().to_numpy()
    row = np.repeat(np.arange(len(column)), counts)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
    out[row, place] = flat
    return out


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard of pairs of sketches: the common share of the union's sketch."""
    k = a.shape[1]
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    real = both != NONE
    again = np.zeros(both.shape, bool)
    again[:, 1:] = (both[:, 1:] == both[:, :-1]) & real[:, 1:]
    place = np.cumsum(real & ~again, axis=1)
    first = place <= k
    return (again & first).sum(axis=1) / np.maximum((real & ~again & first).sum(axis=1), 1)


def _close(n_a, n_b, percent: int):
    return np.minimum(n_a, n_b) * 100 >= percent * np.maximum(n_a, n_b)


def _estimated(percent: int, k: int) -> Emit:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            share = estimates(_matrix(batch.column("sketch_a"), k), _matrix(batch.column("sketch_b"), k))
            keep = (share >= LEAST_ESTIMATE) & _close(
                batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), percent
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep)),
                 pa.array(share[keep])],
                names=["a", "b", "share"],
            )

    return emit


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        wanted = batch.column("digest").to_pylist()
        sets = [*shingle_sets(batch.column("text"))]
        keep = [i for i, s in enumerate(sets) if _digest(s) == wanted[i]]
        for at in range(0, len(keep), VERIFY_ROWS):
            some = keep[at : at + VERIFY_ROWS]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(some)),
                 pa.array([sets[i].tobytes() for i in some], pa.binary())],
                names=["node", "values"],
            )


def _verified(percent: int) -> Emit:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                a = np.frombuffer(left.as_buffer(), np.int64)
                b = np.frombuffer(right.as_buffer(), np.int64)
                both = np.sort(np.concatenate([a, b]))
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"]
            )

    return emit


def _apart(percent: int, k: int) -> Callable[[pa.Table], pa.Table]:
    """Members of two tiles that look similar to one of another component."""

    def emit(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side = table.column("side").to_numpy()
        node, label, n = (table.column(c).to_numpy() for c in ("node", "label", "n"))
        sketch = _matrix(table.column("sketch").chunk(0), k)
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        values, count = np.unique(sketch, return_counts=True)
        values = values[(values != NONE) & (count > 1)]
        if not len(values):
            return table.select(["pivot", "low", "high", "node", "side"]).slice(0, 0)
        spot = np.minimum(np.searchsorted(values, sketch), len(values) - 1)
        marks = np.zeros((len(node), len(values)), np.float32)
        row, column = np.nonzero(values[spot] == sketch)
        marks[row, spot[row, column]] = 1
        size = (sketch != NONE).sum(axis=1)
        flag = np.zeros(len(node), bool)
        overlap = marks[left] @ marks[right].T
        need = np.maximum((size[left][:, None] + 1) // 2, (size[right][None, :] + 1) // 2)
        fit = (overlap >= need) & (label[left][:, None] != label[right][None, :])
        fit &= _close(n[left][:, None], n[right][None, :], percent)
        i, j = np.nonzero(fit)
        for at in range(0, len(i), ESTIMATE_ROWS):
            x, y = left[i[at : at + ESTIMATE_ROWS]], right[j[at : at + ESTIMATE_ROWS]]
            likely = estimates(sketch[x], sketch[y]) >= LEAST_ESTIMATE
            flag[x[likely]] = flag[y[likely]] = True
        return table.select(["pivot", "low", "high", "node", "side"]).filter(pa.array(flag))

    return emit


def common_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the left with the right sets, exactly."""
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, number, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count > 1)
    column = np.full(len(count), -1)
    column[shared] = np.arange(len(shared))
    column = column[number]
    row, column = row[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(shared), PRODUCT_COLUMNS):
        a, b = np.searchsorted(column, [at, at + PRODUCT_COLUMNS])
        marks = np.zeros((len(sets), PRODUCT_COLUMNS), np.float32)
        marks[row[a:b], column[a:b] - at] = 1
        total += marks[left] @ marks[right].T  # whole numbers, exact in single precision
    return total.astype(np.int64)


def _tile_links(percent: int) -> Callable[[pa.Table], pa.Table]:
    """A spanning forest of the links between two tiles, by full sets."""

    def emit(table: pa.Table) -> pa.Table:
        side, node = table.column("side").to_numpy(), table.column("node").to_numpy()
        sets = [np.frombuffer(x, np.int64) for x in table.column("values").to_pylist()]
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        if not len(left) or not len(right):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        common = common_counts(sets, left, right)
        size = np.array([len(s) for s in sets])
        union = size[left][:, None] + size[right][None, :] - common
        i, j = np.nonzero(100 * common >= percent * union)
        root = roots(len(node), left[i], right[j])
        far = np.flatnonzero(root != np.arange(len(node)))
        return pa.table({"a": node[far], "b": node[root[far]]})

    return emit


def _sets(used: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, values): the full sets of the classes in ``used``, from their texts."""
    wanted = classes.join(used.select("node").distinct(), "node")
    wanted = wanted.select(F.col("rep").alias("id"), F.col("rep_mark").alias("mark"), "digest", "node")
    # The mark tells rows of one id, or of none, apart: one text a class, not all of the id.
    texts = docs.join(wanted, ["id", "mark"]).select("node", "digest", "text")
    sets = texts.mapInArrow(_full_sets, "node bigint, values binary").dropDuplicates(["node"])
    return cut(sets, "shingle-sets")


def _verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that are links by their full sets."""
    sets = _sets(pairs.select(F.explode(F.array("a", "b")).alias("node")), classes, docs)
    left = sets.select(F.col("node").alias("a"), F.col("values").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("values").alias("set_b"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")
    return both.select("a", "b", "set_a", "set_b").mapInArrow(_verified(percent), "a bigint, b bigint")


def _rare_postings(classes: DataFrame) -> DataFrame:
    """(value, node, weight): each class at the rarest of its values that others have.

    ``weight`` tells how common all values of a class are.
    """
    postings = classes.select("node", F.size("sketch").alias("s"), F.explode("sketch").alias("value"))
    common = postings.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    own = Window.partitionBy("node")
    ranked = (
        postings.join(common, "value")
        .withColumn("alone", F.col("s") - F.count(F.lit(1)).over(own))
        .withColumn("weight", F.sum(F.round(F.log2("df") * 1024).cast("bigint")).over(own))
        .withColumn("place", F.row_number().over(own.orderBy("df", "value")))
    )
    return ranked.where("place + alone <= s div 2 + 1").select("value", "node", "weight")


def near_duplicate_links(classes: DataFrame, docs: DataFrame, percent: int = LINK_PERCENT) -> DataFrame:
    """(a, b): links between classes whose components are those of all links.

    The sketches of ``classes`` are those of ``sketch_size(percent)``.
    """
    k = sketch_size(percent)
    postings = cut(_rare_postings(classes), "postings")
    best = F.max(F.struct("weight", (-F.col("node")).alias("minus"))).alias("best")
    pivots = postings.groupBy("value").agg(best, F.count(F.lit(1)).alias("members")).where("members > 1")
    pivots = pivots.select("value", (-F.col("best.minus")).alias("b"))
    pairs = (
        postings.join(pivots, "value").where("node <> b")
        .select(F.col("node").alias("a"), "b").distinct()
    )
    side_a = classes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    side_b = classes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    likely = (
        pairs.join(side_b, "b").join(side_a, "a")
        .mapInArrow(_estimated(percent, k), "a bigint, b bigint, share double")
    )
    top = F.max(F.struct("share", (-F.col("b")).alias("minus"))).alias("top")
    likely = cut(likely.groupBy("a").agg(top).select("a", (-F.col("top.minus")).alias("b")), "stars-to-verify")
    links = cut(_verify(likely, classes, docs, percent), "links")

    # Each member's star, or the star its hub belongs to; good enough to see who is apart.
    hubs = links.select(F.col("a").alias("hub"), F.col("b").alias("next"))
    stars = links.join(hubs, F.col("b") == F.col("hub"), "left")
    stars = stars.select(F.col("a").alias("node"), F.coalesce("next", "b").alias("star"))
    placed = (
        postings.select("value", "node").join(pivots, "value")
        .select(F.col("b").alias("pivot"), "node").distinct()
        .join(stars, "node", "left")
        .select("pivot", "node", F.coalesce("star", "node").alias("label"))
    )
    placed = cut(placed, "members")
    unsettled = (
        placed.groupBy("pivot")
        .agg(F.min("label").alias("least"), F.max("label").alias("most"), F.count(F.lit(1)).alias("members"))
        .where("least < most")
        .select("pivot", F.ceil(F.col("members") / TILE).cast("int").alias("tiles"))
    )
    tile = F.pmod(F.xxhash64("node"), "tiles").cast("int")
    members = placed.join(unsettled, "pivot").withColumn("tile", tile)
    # A tile meets itself and every other tile of its list once.
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    # 0 and 1: the two sides; 2: both.
    side = F.when(F.col("tile") == F.col("other"), 2).when(F.col("tile") < F.col("other"), 0).otherwise(1)
    members = members.select(
        "pivot", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"),
        "node", "label", side.alias("side"),
    )
    tiles = members.join(classes.select("node", "n", "sketch"), "node")
    flagged = tiles.groupBy("pivot", "low", "high").applyInArrow(_apart(percent, k), FLAGGED)
    flagged = cut(flagged, "rest-to-verify")
    sets = _sets(flagged, classes, docs)
    rest = (
        flagged.join(sets, "node").groupBy("pivot", "low", "high")
        .applyInArrow(_tile_links(percent), "a bigint, b bigint")
    )
    return links.unionByName(rest)


def _places(docs: DataFrame, key: str, text: str, percent: int) -> tuple[DataFrame, DataFrame]:
    """Each row's (id, mark, n, digest), and each set's (digest, label, component_id).

    Sets of one ``label`` are of one component; ``component_id`` is its smallest id.
    """
    rows = docs.select(
        known_id(key).alias("id"), row_mark(key, text).alias("mark"),
        F.col(text).cast("binary").alias("text"),
    )
    kinds = "id bigint, mark bigint, n bigint, digest binary, sketch array<bigint>"
    sketches = cut(rows.mapInArrow(_sketches(sketch_size(percent)), kinds), "sketches")
    classes = (
        sketches.where("n > 0").groupBy("digest")
        .agg(
            F.min(F.struct("id", "mark")).alias("least"),
            F.first("n").alias("n"), F.first("sketch").alias("sketch"),
        )
        .select("digest", F.col("least.id").alias("rep"), F.col("least.mark").alias("rep_mark"), "n", "sketch")
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = cut(classes, "classes")
    links = near_duplicate_links(classes, rows, percent)
    labels = components(links).withColumnRenamed("id", "node")
    placed = classes.join(labels, "node", "left").select(
        "digest", "rep", F.coalesce("component", "node").alias("label")
    )
    smallest = placed.groupBy("label").agg(F.min("rep").alias("component_id"))
    places = placed.join(smallest, "label").select("digest", "label", "component_id")
    return sketches.select("id", "mark", "n", "digest"), places


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = LINK_PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``.

    Rows link if their sets agree to ``percent`` of their union; ``component_id`` is the smallest
    doc_id reachable over links, ``kept`` marks the rows having it. A text of fewer
    than five words is one shingle; a null text or one without words links with nothing.
    A row without id comes after all others and, if it meets none with an id, has
    no component and is kept. Rows of one id and one set share their result. Other
    columns play no part; an empty table gives an empty one.
    """
    rows, places = _places(docs, key, text, percent)
    found = rows.where("n > 0").join(places, "digest").select("id", "n", "component_id")
    bare = rows.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    none = F.lit(NO_ID)
    return found.unionByName(bare).select(
        F.nullif("id", none).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.nullif("component_id", none).alias("component_id"),
        (F.col("id") == F.col("component_id")).alias("kept"),
    )


def without_near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = LINK_PERCENT
) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its component.

    A row is judged by id and text, so one row of a repeated id may go and another stay; rows
    that have the smallest id of their component all stay. Of a component without any
    id one row stays. Rows without words all stay.
    """
    rows, places = _places(docs, key, text, percent)
    found = rows.where("n > 0").join(places, "digest").select("id", "mark", "label", "component_id")
    gone = found.where("id > component_id").select("id", "mark")
    # Components without any id: the text of the smallest mark stays, once.
    nameless = found.where(F.col("component_id") == NO_ID)
    texts = nameless.groupBy("label", "mark").agg(F.count(F.lit(1)).alias("n"))
    texts = cut(texts, "texts-without-id")
    stays = texts.groupBy("label").agg(F.min(F.struct("mark", "n")).alias("least")).select("label", "least.*")
    again = stays.where("n > 1").select(F.lit(NO_ID).alias("id"), "mark")
    later = texts.join(stays.select("label", F.col("mark").alias("least")), "label").where("mark > least")
    later = later.select(F.lit(NO_ID).alias("id"), "mark")
    gone = cut(gone.unionByName(later).unionByName(again).distinct(), "near-copies")

    def same(marks: DataFrame) -> Column:
        return (known_id(key) == marks["gone_id"]) & (row_mark(key, text) == marks["gone_mark"])

    gone, again = (m.select(F.col("id").alias("gone_id"), F.col("mark").alias("gone_mark")) for m in (gone, again))
    once = docs.where(known_id(key) == NO_ID).join(again, same(again), "left_semi")
    once = once.groupBy(row_mark(key, text).alias("mark")).agg(F.first(F.struct(*docs.columns)).alias("row"))
    return docs.join(gone, same(gone), "left_anti").unionByName(once.select("row.*"))
