"""Duplicate byte strings across documents, by run-compressed Burrows-Wheeler indexes.

Windows of ``WINDOW`` bytes that an earlier document has too are found by the exchange
in ``repeats``. Each group of contexts is indexed as follows:

- the suffixes at all window starts are sorted by their first ``WINDOW`` bytes (ranks of
  8, 16, 32, then 50 bytes), which is the order of a Burrows-Wheeler transform as deep
  as the windows; suffixes that agree so far are ordered by the byte before them;
- the transform (the byte before each suffix) is kept as runs, which overlapping
  contexts and copies make few. A run keeps a sample at its end: the class of the suffix
  reached by stepping over its byte. The first run of a class, the suffixes equal in all
  ``WINDOW`` bytes, also keeps the smallest document of the class;
- each context streams through the index from its last window to its first. A step is
  one binary search for the run of its byte, and keeps a match of ``WINDOW`` bytes at
  least; the class reached tells the first document having the window.

All documents of a group stream against one index, so work follows the runs and the
distinct contexts, not the pairs of copies.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.llm.repeats import FAR, Scheme, mask_of, remove_repeats

WINDOW = 50
SEED = 24
REACH = WINDOW - SEED
WIDTH = 80  # 2 * REACH + SEED tokens, then padding
PAD = 0xFF  # in no UTF-8 text
START = 256  # the byte before a first window


def _bytes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data, bounds


def _dense(keys: np.ndarray) -> np.ndarray:
    """Rank of each key, equal keys alike."""
    flat = keys.ravel()
    order = np.argsort(flat)
    found = flat[order]
    rank = np.empty(len(flat), np.uint64)
    rank[order] = np.cumsum(np.concatenate([[0], found[1:] != found[:-1]])).astype(np.uint64)
    return rank.reshape(keys.shape)


def window_ranks(rows: np.ndarray) -> np.ndarray:
    """Lexicographic rank of the window at each of the first ``REACH + 1`` places of a row."""
    grid = np.lib.stride_tricks.sliding_window_view(rows, 8, axis=1)[:, : REACH + WINDOW - 7]
    rank = _dense(np.ascontiguousarray(grid).view(">u8")[..., 0].astype(np.uint64))
    for shift, places in ((8, REACH + WINDOW - 15), (16, REACH + WINDOW - 31), (18, REACH + 1)):
        rank = _dense((rank[:, :places] << np.uint64(32)) | rank[:, shift : shift + places])
    return rank.astype(np.int64)


@dataclass
class RunIndex:
    """Runs of the transform as (class, byte), with what their ends have sampled."""

    runs: np.ndarray  # class * 512 + byte before, ascending
    step: np.ndarray  # class reached over the run's byte
    first: np.ndarray  # smallest document of each class

    @classmethod
    def build(cls, rank: np.ndarray, before: np.ndarray, valid: np.ndarray, doc: np.ndarray):
        """``rank`` and ``before`` at every window start; ``doc`` of each row."""
        classes = int(rank.max()) + 1
        order = np.argsort((rank * 512 + before)[valid])
        transform = (rank * 512 + before)[valid][order]
        ends = np.flatnonzero(np.concatenate([transform[1:] != transform[:-1], [True]]))
        reached = np.concatenate([np.zeros((len(rank), 1), np.int64), rank[:, :-1]], axis=1)
        owner = np.broadcast_to(doc[:, None], rank.shape)[valid][order]
        first = np.full(classes, FAR, np.int64)
        starts = np.concatenate([[0], ends[:-1] + 1])
        least = np.minimum.reduceat(owner, starts)
        np.minimum.at(first, transform[starts] >> 9, least)
        return cls(transform[ends], reached[valid][order][ends], first)

    def back(self, at: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The classes reached from classes ``at`` over the bytes before them."""
        return self.step[np.searchsorted(self.runs, at * 512 + byte)]


def first_docs(rows: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Per row and place: the first document having the window there, else ``FAR``."""
    places = np.arange(REACH + 1)
    real = rows[:, : 2 * REACH + SEED] != PAD
    left = real.argmax(axis=1)
    last = real.shape[1] - real[:, ::-1].argmax(axis=1) - WINDOW
    valid = (places >= left[:, None]) & (places <= last[:, None])
    rank = window_ranks(rows)
    before = np.full(rank.shape, START, np.int64)
    before[:, 1:] = rows[:, :REACH]
    before[places == left[:, None]] = START
    index = RunIndex.build(rank, before, valid, doc)
    out = np.full(rank.shape, FAR, np.int64)
    live = np.arange(len(rows))
    place = last.copy()
    at = rank[live, place]
    while len(live):
        out[live, place] = index.first[at]
        more = place > left[live]
        live, place, at = live[more], place[more], at[more]
        at = index.back(at, before[live, place])
        place = place - 1
    return out


SCHEME = Scheme(WINDOW, SEED, WIDTH, PAD, "u1", _bytes, first_docs)


def _spans(n: int, copy: bool, start: np.ndarray, stop: np.ndarray) -> np.ndarray | None:
    """True for removed bytes; None if there are none."""
    if copy:
        return np.ones(n, bool) if n >= WINDOW else None
    return mask_of(n, start, stop) if len(start) else None


def _digest(text: bytes, copy: bool, start: np.ndarray, stop: np.ndarray) -> dict:
    gone = _spans(len(text), copy, start, stop)
    if gone is None:
        kept, removed, spans = text, 0, 0
    else:
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        removed = int(gone.sum())
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return {
        "n_bytes": len(text),
        "n_removed": removed,
        "n_spans": spans,
        "kept_sha256": hashlib.sha256(kept).hexdigest(),
    }


def _kept_text(text: bytes, copy: bool, start: np.ndarray, stop: np.ndarray) -> dict:
    gone = _spans(len(text), copy, start, stop)
    if gone is not None:
        data = np.frombuffer(text, np.uint8)
        char = np.cumsum((data & 0xC0) != 0x80) - 1  # a character goes whole
        broken = np.zeros(len(data) + 1, bool)
        broken[char[gone]] = True
        text = data[~broken[char]].tobytes()
    return {"kept": text.decode("utf-8", "ignore")}


def duplicate_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs``.

    A byte goes if a window of 50 bytes over it also starts in a document of a smaller id.
    A null text is empty; a row without id comes after all others and may lose text to
    them; rows of one id keep what they share. An empty table gives an empty one; other
    columns, whatever their names, play no part.
    """
    made = {"n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"}
    found = remove_repeats(docs.select(key, text), SCHEME, _digest, made, key, text)
    return found.select(F.col("rest").getField(key).alias("doc_id"), *made)


def without_duplicate_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with those bytes taken out of the texts; a character goes whole.

    All rows and columns stay; a text may become empty, and a null text stays null.
    """
    found = remove_repeats(docs, SCHEME, _kept_text, {"kept": "string"}, key, text)

    def column(name: str) -> Column:
        return F.col("kept") if name == text else F.col("rest").getField(name)

    return found.select(*(column(c).alias(c) for c in docs.columns))
