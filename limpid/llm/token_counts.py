"""Token counts of texts under a public piece vocabulary, by heap and linked list.

A text starts as one symbol per character in a linked list. A heap holds the adjacent pairs
that the vocabulary knows; the pair of best score, the leftmost among equals, is popped and
merged until none is left. The count is the initial symbols minus the merges; a character
outside the vocabulary counts as its bytes. No identifiers are made.

No piece of a supported vocabulary has another sign before a blank, so no merge crosses the
start of a run of blanks: the stretches between such starts are counted one by one, and one
met again is looked up in a table of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"  # how the vocabulary writes a blank
LIMIT = 4096
STRETCH = re.compile(f"{BLANK}+[^{BLANK}]*")
# Characters that the table of stretches holds before it starts afresh.
REMEMBERED = 8 << 20
REMEMBERED_LENGTH = 256
PROBES = ("", " ", "a", " two  blanks ", "é\t\u0000😀 <s> Word", "1234 " + BLANK + "x")


def piece_ranks(path: str) -> dict[str, int]:
    """Rank of each piece that merges may make: 0 for the best score, equal scores alike.

    A vocabulary with own symbols, unused pieces, another treatment of blanks or another
    normalisation is refused.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        i for i in range(model.vocab_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
    ]
    scores = {i: model.get_score(i) for i in plain}
    place = {score: n for n, score in enumerate(sorted(set(scores.values()), reverse=True))}
    ranks = {model.id_to_piece(i): place[scores[i]] for i in plain}
    inner = re.compile(f"[^{BLANK}]{BLANK}")
    counts = StretchCounts(ranks)
    if (
        any(model.is_unused(i) for i in plain)
        or any(inner.search(piece) for piece in ranks)
        or any(counts.of_text(probe) != len(model.encode(probe)) for probe in PROBES)
    ):
        raise ValueError(f"{path}: not a byte-pair vocabulary of the supported kind")
    return ranks


def merged_count(stretch: str, ranks: dict[str, int]) -> int:
    """Initial symbols minus merges."""
    symbol: list[str | None] = list(stretch)
    n = len(symbol)
    weight = [1 if c in ranks else len(c.encode()) for c in stretch]
    count = sum(weight)
    before = list(range(-1, n - 1))
    after = list(range(1, n + 1))
    heap = []
    for i in range(n - 1):
        joined = stretch[i : i + 2]
        if joined in ranks:
            heap.append((ranks[joined], i, joined))
    heapify(heap)
    while heap:
        _, left, joined = heappop(heap)
        head, right = symbol[left], after[left]
        if head is None or right == n or len(head) + len(symbol[right]) != len(joined):
            continue  # one of the two has merged otherwise since
        count -= weight[left] + weight[right] - 1
        symbol[left], symbol[right], weight[left] = joined, None, 1
        beyond = after[left] = after[right]
        if beyond < n:
            before[beyond] = left
            pair = joined + symbol[beyond]
            if pair in ranks:
                heappush(heap, (ranks[pair], left, pair))
        previous = before[left]
        if previous >= 0:
            pair = symbol[previous] + joined
            if pair in ranks:
                heappush(heap, (ranks[pair], previous, pair))
    return count


class StretchCounts(dict):
    """Counts of the stretches met so far, of bounded size."""

    def __init__(self, ranks: dict[str, int]):
        super().__init__()
        self.ranks = ranks
        self.held = 0

    def __missing__(self, stretch: str) -> int:
        count = merged_count(stretch, self.ranks)
        if len(stretch) <= REMEMBERED_LENGTH:
            if self.held > REMEMBERED:
                self.clear()
                self.held = 0
            self.held += len(stretch)
            self[stretch] = count
        return count

    def of_text(self, text: str) -> int:
        if not text:
            return 0
        spaced = BLANK + text.replace(" ", BLANK)
        return sum(map(self.__getitem__, STRETCH.findall(spaced)))


def _counted(shared):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = StretchCounts(shared.value)
        for batch in batches:
            tokens = [counts.of_text(text.as_py() or "") for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("n_bytes"), pa.array(tokens, pa.int64())],
                names=["key", "n_bytes", "n_tokens"],
            )

    return emit


def token_counts(
    docs: DataFrame, vocabulary: str, limit: int = LIMIT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    A null text is empty and has no tokens; rows repeat as they are given, ids may be null;
    an empty table gives an empty one; other columns play no part. Strings of special
    tokens are plain text. No shuffle: each row is counted where it is read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(piece_ranks(vocabulary))
    rows = docs.select(
        F.col(key).cast("bigint").alias("key"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
        F.col(text).cast("string").alias("text"),
    )
    counted = rows.mapInArrow(_counted(shared), "key bigint, n_bytes bigint, n_tokens bigint")
    return counted.select(
        F.col("key").alias("doc_id"), "n_bytes", "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
