"""Vectorised hashing of bytes and words, shared by the text operators.

A batch of texts is one byte array with the bounds of each text. Words are maximal runs
of bytes other than blank and tab to carriage return, as ``[^\\x20\\x09-\\x0D]+`` finds
them: those bytes never occur inside a UTF-8 character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 4 << 20
# Odd multipliers of a 64-bit mix.
MIX_1 = U64(0xBF58476D1CE4E5B9)
MIX_2 = U64(0x94D049BB133111EB)
STEP = U64(0x9E3779B97F4A7C15)

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LOW_BYTES = (U64(1) << (U64(8) * np.arange(8, dtype=U64))) - U64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix; works in place on its own copy."""
    x = (x ^ (x >> U64(30))) * MIX_1
    x ^= x >> U64(27)
    x *= MIX_2
    x ^= x >> U64(31)
    return x


def multipliers(n: int) -> np.ndarray:
    """``n`` odd 64-bit numbers."""
    return mixed(np.arange(1, n + 1, dtype=U64) * STEP) | U64(1)


def binary_bounds(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, bounds) of a binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null(b"")
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of at most ``most`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column)
        kind = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
        bounds = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1]
        start = 0
        while start < len(texts):
            stop = int(np.searchsorted(bounds, bounds[start].astype(np.int64) + most, side="right")) - 1
            stop = max(stop, start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def sliding_words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as one number, zeros after the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), "<u8", padded, strides=(1,))


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length) of each word of all texts, and the bounds of each text in words."""
    blank = np.ones(len(data) + 1, dtype=bool)
    blank[:-1] = _BLANK[data]
    before = np.ones(len(data) + 1, dtype=bool)
    before[1:] = blank[:-1]
    before[bounds] = True  # a word ends with its text
    starts = np.flatnonzero(before & ~blank)
    stops = np.zeros(len(data) + 1, dtype=bool)
    stops[1:] = ~blank[:-1]
    after = blank.copy()
    after[bounds] = True
    ends = np.flatnonzero(after & stops)
    return starts, ends - starts, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes a round."""
    if len(starts) == 0:
        return np.zeros(0, U64)
    eight = sliding_words(data)
    out = lengths.astype(U64) * STEP
    live, at, left = None, starts, lengths
    while len(at):
        part = eight[at]
        short = left < 8
        part[short] &= _LOW_BYTES[left[short]]
        if live is None:
            out = mixed(out ^ part)
            live = np.flatnonzero(left > 8)
        else:
            out[live] = mixed(out[live] + part * STEP)
            live = live[left > 8]
        more = left > 8
        at, left = at[more] + 8, left[more] - 8
    return out


def gram_hashes(tokens: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the ``n`` tokens from each position on (bytes or 64-bit words)."""
    count = len(tokens) - n + 1
    if count <= 0:
        return np.zeros(0, U64)
    if tokens.dtype == np.uint8:
        if n < 8:
            raise ValueError("byte grams need at least 8 bytes")
        eight = sliding_words(tokens).copy()
        places = [*range(0, n - 8, 8), n - 8]
        parts = [eight[p : p + count] for p in places]
    else:
        parts = [tokens[p : p + count] for p in range(n)]
    out = np.zeros(count, U64)
    for part, factor in zip(parts, multipliers(len(parts)), strict=True):
        out += (part ^ (part >> U64(29))) * factor
    return mixed(out)
