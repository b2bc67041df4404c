"""Packing of documents into training sequences of several permitted lengths.

Documents longer than the longest length are cut into pieces of it. Pieces are dealt into
groups of about ``GROUP_PIECES`` whatever their sizes and packed group by group, best fit by
falling size: a piece goes into the open bin that it leaves the least room in. If none
has room, a bin is opened in the length of least cost per expected word: for each permitted
length the pieces still to come are walked, largest first, into the room that it would leave,
and the contents found are charged at the length they would shrink to.

The walk knows nothing of other bins that want the same small pieces. So each group is
packed with several reserves, the size below which the walk counts on no piece, and the
packing of least total cost stands. The largest reserve counts on nothing to come and
always opens the shortest length that fits. At the end each bin shrinks to the shortest
permitted length that holds its contents.

A group's ends waste a few bins, so the loss against one large packing is below one in a
thousand; no piece is dropped, and groups only grow in number.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.llm.hashing import binary_bounds, text_slices, word_spans
from limpid.llm.layout import NO_ID, cut, known_id

LENGTHS = (256, 512, 1024, 2048, 4096)
ATTENTION = 32_768
GROUP_PIECES = 20_000

PACKED = "row bigint, bin bigint, capacity int, position int"


def sequence_cost(length: int) -> float:
    """Cost of a sequence: linear layers and, per ``ATTENTION`` words, as much for attention."""
    return length * (1 + length / ATTENTION)


def reserves(lengths: Sequence[int]) -> list[int]:
    """Sizes below which a new bin counts on no piece: none, half of each length, all."""
    return [1, *(c // 2 for c in sorted(lengths) if c > 3), max(lengths) + 1]


def expected_fill(falling: Sequence[int], at: int, room: int, least: int) -> int:
    """Words that pieces from ``at`` on, none below ``least``, bring into ``room``, largest first.

    ``falling`` holds the sizes negated, so that it ascends.
    """
    fill = 0
    while room >= least:
        at = bisect_left(falling, -room, at)
        if at == len(falling) or -falling[at] < least:
            break
        size = -falling[at]
        end = bisect_left(falling, 1 - size, at)
        taken = min(end - at, room // size) * size
        fill, room, at = fill + taken, room - taken, end
    return fill


@dataclass
class Packing:
    """Bin and position of each piece; opened and final length of each bin."""

    bins: list[int]
    positions: list[int]
    opened: list[int]
    lengths: list[int]


def packed_with(
    sizes: Sequence[int], lengths: Sequence[int], cost: Callable[[int], float], least: int
) -> Packing:
    """Best fit whose new bins count on no piece below ``least``."""
    lengths = sorted(lengths)
    costs = [cost(c) for c in lengths]
    falling = [-s for s in sizes]
    rooms: list[tuple[int, int]] = []  # (room, bin), ascending
    opened, used = [], []
    bins, positions = [], []

    def cost_per_word(i: int, done: int, size: int) -> float:
        words = size + expected_fill(falling, done, lengths[i] - size, least)
        return costs[bisect_left(lengths, words)] / words

    for done, size in enumerate(sizes, 1):
        at = bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, number = rooms.pop(at)
        else:
            fits = range(bisect_left(lengths, size), len(lengths))
            best = min(fits, key=lambda i: (cost_per_word(i, done, size), i))
            number, room = len(opened), lengths[best]
            opened.append(room)
            used.append(0)
        bins.append(number)
        positions.append(used[number])
        used[number] += size
        if room > size:
            insort(rooms, (room - size, number))
    return Packing(bins, positions, opened, [lengths[bisect_left(lengths, u)] for u in used])


def best_fit(
    sizes: Sequence[int],
    lengths: Sequence[int] = LENGTHS,
    cost: Callable[[int], float] = sequence_cost,
) -> tuple[list[int], list[int], list[int]]:
    """(bin of each piece, position of each piece, length of each bin).

    ``sizes`` must fall and lie between 1 and the longest length. Of equally cheap packings
    that of the smallest reserve stands.
    """
    tried = (packed_with(sizes, lengths, cost, least) for least in reserves(lengths))
    best = min(tried, key=lambda p: sum(map(cost, sorted(p.lengths))))
    return best.bins, best.positions, best.lengths


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        data, bounds = binary_bounds(batch.column("text"))
        _, _, limits = word_spans(data, bounds)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(np.diff(limits).astype(np.int64))], names=["id", "n"]
        )


def _packed(lengths: Sequence[int]):
    def pack(key, table):
        size, row = table.column("size").to_numpy(), table.column("row").to_numpy()
        order = np.lexsort((row, -size))
        bins, positions, capacity = best_fit(size[order].tolist(), lengths)
        bins = np.array(bins, np.int64)
        group = key[0].as_py()
        return pa.table({
            "row": row[order],
            "bin": (group << 24) | bins,
            "capacity": np.array(capacity, np.int32)[bins],
            "position": np.array(positions, np.int32),
        })

    return pack


def packed_documents(
    docs: DataFrame, lengths: Sequence[int] = LENGTHS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, piece, start, n_words, bin, capacity, position): the pieces of every row.

    ``start`` is a piece's first word in its document, ``position`` its first word in the
    bin. A row without words has one piece, of no words, in no bin. Rows repeat as given; a
    row without id keeps none; an empty table gives an empty one. Other columns play no part.
    """
    longest = max(lengths)
    rows = docs.select(known_id(key).alias("id"), F.col(text).cast("binary").alias("text"))
    counted = rows.mapInArrow(_word_counts, "id bigint, n bigint")
    last = F.greatest(F.ceil(F.col("n") / longest) - 1, F.lit(0)).cast("bigint")
    pieces = counted.select("id", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece"))
    start = F.col("piece") * longest
    pieces = cut(
        pieces.select(
            "id", "piece", start.alias("start"), F.least(F.col("n") - start, F.lit(longest)).alias("size"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "pieces",
    )
    filled = pieces.where("size > 0")
    groups = max(1, -(-filled.count() // GROUP_PIECES))
    dealt = filled.select("row", "size", F.pmod(F.xxhash64("row"), F.lit(groups)).alias("grp"))
    packed = dealt.groupBy("grp").applyInArrow(_packed(lengths), PACKED)
    return pieces.join(packed, "row", "left").select(
        F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "piece", "start",
        F.col("size").alias("n_words"), "bin", "capacity", "position",
    )
