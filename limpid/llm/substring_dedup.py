"""Duplicate word sequences across documents, by prefix-partitioned suffix trees.

Windows of ``WINDOW`` words that an earlier document has too are found by the exchange in
``repeats``: a seed of ``SEED`` words is the prefix by which suffixes meet; a frequent one
is replaced by the whole window, the longest prefix there is. Within a group the suffixes
at all window starts are split by prefixes of as many words as it takes until a part has at
most ``LIMIT`` suffixes. Each part becomes a subtree: its suffixes sorted, with the
common prefix lengths of neighbours. Neighbours that agree in ``WINDOW`` words or more stand
below one deep internal node, a repeat; the node knows its smallest document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.llm.hashing import U64, word_hashes, word_spans
from limpid.llm.repeats import FAR, Scheme, mask_of, remove_repeats

WINDOW = 13
SEED = 4
REACH = WINDOW - SEED
WIDTH = 2 * REACH + SEED
PAD = 0
LIMIT = 100_000


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, lengths, limits = word_spans(data, bounds)
    # A real word never looks like padding.
    return np.maximum(word_hashes(data, starts, lengths), U64(1)), limits


def prefix_parts(
    words: np.ndarray, row: np.ndarray, place: np.ndarray, limit: int = LIMIT
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Parts of the suffixes (row, place), split by ever longer prefixes until small.

    Suffixes of one part may have several short prefixes, but equal windows never part.
    """
    pending = [(row, place, 0)]
    while pending:
        row, place, depth = pending.pop()
        if len(row) <= limit or depth == WINDOW:
            yield row, place
            continue
        word = words[row, place + depth]
        order = np.argsort(word, kind="stable")
        word, row, place = word[order], row[order], place[order]
        cuts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1], [True]]))
        start = 0
        for here, following in zip(cuts[:-1], cuts[1:], strict=True):
            if following - start > limit and here > start:
                pending.append((row[start:here], place[start:here], depth))
                start = here
            if following - here > limit:
                pending.append((row[here:following], place[here:following], depth + 1))
                start = following
        if start < len(row):
            pending.append((row[start:], place[start:], depth))


def deep_nodes(words: np.ndarray, row: np.ndarray, place: np.ndarray):
    """Sorted suffixes of a subtree and the number of the deep node above each."""
    suffix = words[row[:, None], place[:, None] + np.arange(WINDOW)]
    order = np.lexsort(suffix.T[::-1])
    suffix = suffix[order]
    common = np.cumprod(suffix[1:] == suffix[:-1], axis=1, dtype=np.int8).sum(axis=1)
    return order, np.cumsum(np.concatenate([[0], common < WINDOW]))


def first_docs(rows: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Per row and place: the first document having the window there, else ``FAR``."""
    places = np.arange(REACH + 1)
    real = rows != PAD
    left = real.argmax(axis=1)
    last = WIDTH - real[:, ::-1].argmax(axis=1) - WINDOW
    row, place = np.nonzero((places >= left[:, None]) & (places <= last[:, None]))
    out = np.full((len(rows), REACH + 1), FAR, np.int64)
    for r, p in prefix_parts(rows, row, place):
        order, node = deep_nodes(rows, r, p)
        least = np.full(int(node[-1]) + 1, FAR, np.int64)
        np.minimum.at(least, node, doc[r[order]])
        out[r[order], p[order]] = least[node]
    return out


SCHEME = Scheme(WINDOW, SEED, WIDTH, PAD, "<u8", _words, first_docs)


def _digest(text: bytes, copy: bool, start: np.ndarray, stop: np.ndarray) -> dict:
    words = text.split()  # bytes are split at the same blanks
    n = len(words)
    if copy and n >= WINDOW:
        kept = []
    elif len(start) and not copy:
        gone = mask_of(n, start, stop).tolist()
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
    else:
        kept = words
    return {
        "n_words": n,
        "n_removed": n - len(kept),
        "kept_sha256": hashlib.sha256(b" ".join(kept)).hexdigest(),
    }


def duplicate_words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row of ``docs``.

    A word goes if a window of 13 words over it also starts in a document of a smaller id.
    A null text has no words; a row without id comes after all others; rows of one id keep
    what they share. An empty table gives an empty one; other columns play no part.
    """
    made = {"n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"}
    found = remove_repeats(docs.select(key, text), SCHEME, _digest, made, key, text)
    return found.select(F.col("rest").getField(key).alias("doc_id"), *made)
