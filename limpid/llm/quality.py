"""Document quality by supervised subword embeddings.

Every word, every pair of neighbouring words and every run of 3 to 5 characters of a word (its
blanks included) is hashed into one of ``BUCKETS`` learned vectors; a document is the average
of its vectors; a softmax layer tells good from bad. Training is numpy stochastic gradient descent over at most ``SAMPLE``
labelled documents, those of the smallest hashed ids, whole texts; their counts per bucket
are made by Spark tasks. Scoring reads every whole text: with the layer fixed, the logit is
the average of one number per bucket, so a task needs a table of ``BUCKETS`` floats.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.llm.hashing import (
    STEP, U64, binary_bounds, mixed, text_slices, word_hashes, word_spans,
)

BUCKETS = 1 << 16
DIMENSIONS = 16
LENGTHS = (3, 4, 5)
SAMPLE = 4000
EPOCHS = 6
RATE = 0.5
ACCEPT = 0.7
PIECE = 1 << 18
UNIT = 1 << 22


def held_out(key: Column) -> Column:
    """Rows whose labels are never learned; false without an id."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def _bordered(text: str) -> Column:
    """The text between blanks, so that borders of words are seen and texts part."""
    return F.concat(F.lit(" "), F.coalesce(F.col(text), F.lit("")), F.lit(" ")).cast("binary")


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> U64(64 - BUCKETS.bit_length() + 1)).astype(np.int32)


def characters(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one number per UTF-8 character, bounds of texts in characters).

    The number is made of the character's bytes. Stray bytes that continue nothing belong
    to the character before, which counts its first four bytes.
    """
    later = (data & 0xC0) == 0x80
    if not later.any():
        return data.astype(np.uint32), bounds
    later[bounds[:-1][bounds[:-1] < len(data)]] = False  # a character ends with its text
    starts = np.flatnonzero(~later)
    value, more = data[starts].astype(np.uint32), np.ones(len(starts), bool)
    for k in (1, 2, 3):
        at = np.minimum(starts + k, len(data) - 1)
        more &= later[at] & (starts + k < len(data))
        value |= np.where(more, data[at].astype(np.uint32) << np.uint32(8 * k), np.uint32(0))
    return value, np.searchsorted(starts, bounds)


def subwords(chars: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(offset, bucket, is a subword) of the character runs of each length, piece by piece."""
    blank = (chars == 32) | ((chars >= 9) & (chars <= 13))
    plain = np.where(blank, np.uint32(32), chars)
    ahead = max(LENGTHS)
    for at in range(0, len(chars), PIECE):
        size = min(PIECE, len(chars) - at)
        near = np.full(size + ahead, 32, U64)
        part = plain[at : at + size + ahead]
        near[: len(part)] = part
        gap = np.ones(size + ahead, bool)
        gap[: len(part)] = blank[at : at + size + ahead]
        run, inside = near[:size], np.ones(size, bool)
        for n in range(2, ahead + 1):
            run = mixed(run * STEP + near[n - 1 : n - 1 + size])
            if n > 2:
                inside = inside & ~gap[n - 2 : n - 2 + size]
            if n in LENGTHS:
                ok = inside.copy()
                ok[max(0, len(chars) - at - n + 1) :] = False
                yield at, _slots(run), ok


def whole_words(data: np.ndarray, bounds: np.ndarray):
    """(buckets, is one, bounds of texts) of words, then of pairs of neighbours.

    A pair is hashed by the difference of its words, so all repeated words are one pair.
    """
    starts, lengths, limits = word_spans(data, bounds)
    words = word_hashes(data, starts, lengths)
    later = np.ones(len(words), bool)
    later[limits[:-1][limits[:-1] < len(words)]] = False
    pair = mixed(np.diff(words, prepend=words[:1]) + STEP)
    return (_slots(mixed(words)), np.ones(len(words), bool), limits), (_slots(pair), later, limits)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of each document with their counts."""
    for batch in batches:
        slots, counts = [], []
        for text in batch.column("text"):
            data = np.frombuffer(text.as_buffer(), np.uint8)
            bounds = np.array([0, len(data)])
            total = np.zeros(BUCKETS, np.int64)
            for _, slot, ok in subwords(characters(data, bounds)[0]):
                total += np.bincount(slot[ok], minlength=BUCKETS)
            for slot, ok, _ in whole_words(data, bounds):
                total += np.bincount(slot[ok], minlength=BUCKETS)
            used = np.flatnonzero(total)
            slots.append(used.astype("<u2").tobytes())  # below BUCKETS
            counts.append(total[used].astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("good"), batch.column("place"), pa.array(slots, pa.binary()),
             pa.array(counts, pa.binary())],
            names=["good", "place", "slots", "counts"],
        )


@dataclass
class Model:
    """Learned vectors and softmax layer."""

    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    def bucket_logits(self) -> tuple[np.ndarray, float]:
        """What each bucket adds to the logit of "good", in parts of ``UNIT``, and the bias.

        Whole numbers, so that sums do not depend on how rows are batched.
        """
        side = (self.layer[:, 1] - self.layer[:, 0]).astype(np.float64)
        value = np.clip(np.round(self.vectors @ side * UNIT), -(2**31) + 1, 2**31 - 1)
        return value.astype(np.int32), float(self.bias[1] - self.bias[0])


def train(examples: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 1) -> Model:
    """Softmax regression on averaged vectors by stochastic gradient descent.

    Each example moves the vectors of its buckets in proportion to their share, scaled so
    that the document's average moves by the step. Without examples all are good.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    if not examples:
        return Model(np.zeros_like(vectors), layer, np.array([-50.0, 50.0], np.float32))
    done, steps = 0, EPOCHS * len(examples)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            good, slots, share = examples[i]
            rate = RATE * (1 - done / steps)
            done += 1
            mean = share @ vectors[slots]
            logit = mean @ layer + bias
            logit = np.exp(logit - logit.max())
            error = (logit / logit.sum()).astype(np.float32)
            error[good] -= 1
            back = layer @ error
            layer -= rate * np.outer(mean, error)
            bias -= 0.1 * rate * error
            vectors[slots] -= (rate / float(share @ share)) * share[:, None] * back
    return Model(vectors, layer, bias)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` labelled rows that are not held out."""
    picked = (
        labels.where(F.col("quality").isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
        .select(F.col(key).alias("_id"), (F.col("quality") > 0).cast("int").alias("good"))
        .orderBy(F.xxhash64("_id"), "_id", "good")
        .limit(sample)
    )
    # Only key and text meet the labels, under names of their own.
    texts = docs.select(F.col(f"`{key}`").alias("_key"), _bordered(text).alias("_text"))
    rows = texts.join(picked, F.col("_key") == F.col("_id"))
    counted = rows.select("good", F.xxhash64("_id").alias("place"), F.col("_text").alias("text")).mapInArrow(
        _counted, "good int, place bigint, slots binary, counts binary"
    )
    # A partition at a time, and no more than the sample though an id had several rows.
    found = [
        (place, good, slots, np.frombuffer(counts, "<f4"))
        for good, place, slots, counts in islice(counted.toLocalIterator(), sample)
        if counts
    ]
    found.sort(key=lambda x: x[:3])
    examples = [(good, np.frombuffer(slots, "<u2"), count / count.sum()) for _, good, slots, count in found]
    return train(examples)


def _scored(shared):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = shared.value
        for batch in text_slices(batches):
            data, bounds = binary_bounds(batch.column("text"))
            n = batch.num_rows
            total, count = np.zeros(n, np.int64), np.zeros(n, np.int64)
            chars, edges = characters(data, bounds)
            for at, slot, ok in subwords(chars):
                # Documents of this piece, cut at its ends; every document holds two blanks.
                first = np.searchsorted(edges, at, side="right") - 1
                last = np.searchsorted(edges, at + len(slot), side="left")
                cuts = np.maximum(edges[first:last] - at, 0)
                total[first:last] += np.add.reduceat(table[slot] * ok, cuts, dtype=np.int64)
                count[first:last] += np.add.reduceat(ok, cuts, dtype=np.int64)
            for slot, ok, limits in whole_words(data, bounds):
                sums = np.concatenate([[0], np.cumsum(table[slot] * ok, dtype=np.int64)])
                total += sums[limits[1:]] - sums[limits[:-1]]
                sums = np.concatenate([[0], np.cumsum(ok)])
                count += sums[limits[1:]] - sums[limits[:-1]]
            logit = total / (UNIT * np.maximum(count, 1)) + bias
            score = 1 / (1 + np.exp(-np.clip(logit, -60, 60)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rest"), pa.array(score)], names=["rest", "score"]
            )

    return emit


def scored(
    docs: DataFrame, model: Model, text: str = "text", carried: list[str] | None = None
) -> DataFrame:
    """(rest, score): ``rest`` is a struct of the columns ``carried``, by default all."""
    shared = docs.sparkSession.sparkContext.broadcast(model.bucket_logits())
    rest = F.struct(*(F.col(f"`{c}`") for c in carried or docs.columns)).alias("rest")
    rows = docs.select(rest, _bordered(text).alias("text"))
    kind = rows.schema["rest"].dataType.simpleString()
    return rows.mapInArrow(_scored(shared), f"rest {kind}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Scores depend on the text alone. A null text is empty; an empty text has the score of
    the bias; without labels every score is 1. Rows repeat as given; an empty table
    gives an empty one.
    """
    model = fit(docs, labels, key, text)
    found = scored(docs.select(key, text), model, text, carried=[key])
    doc_id = F.col("rest").getField(key)
    return found.select(
        doc_id.alias("doc_id"),
        held_out(doc_id).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is at least ``ACCEPT``, all columns."""
    found = scored(docs, fit(docs, labels, key, text), text).where(F.col("score") >= ACCEPT)
    return found.select(*(F.col("rest").getField(c).alias(c) for c in docs.columns))
