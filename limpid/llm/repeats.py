"""Windows of tokens that an earlier document has too: the exchange of both substring
operators. A token is a byte or a word; a window is ``window`` tokens of one document.

1. Seeds. Of the ``seed``-grams of each window the one with the smallest hash is its
   seed, so equal windows have equal seeds. Only about two in ``window - seed + 2``
   positions are seeds. Each block of documents sends its seeds, four bytes each, to the
   seed's bucket, which tells the block those that other documents have too. A false
   answer (equal four bytes in one bucket) costs work, never a wrong result.
2. Contexts. Around each shared seed stand all windows it can be the seed of. The block
   sends distinct contexts with their occurrences to the seed's group, where every
   occurrence of those windows meets. A seed with over ``hot`` entries sends its
   windows by the hash of the whole window instead, so that no group grows with it.
3. An operator's index over the contexts of a group finds the first document of each
   window. As all windows of a context hold its seed, those that an earlier document has
   cover one interval, which goes back to the block.

Texts are read by scans or dealt out by block, never by content; a task holds one block
of some ``BLOCK_BYTES`` or one group. Later copies of a whole text neither index nor ask.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.llm.hashing import U64, binary_bounds, gram_hashes, mixed, multipliers, text_slices
from limpid.llm.layout import cut, known_id, later_copies, row_mark, slices, text_digests

BLOCK_BYTES = 4 << 20
GROUP_BYTES = 4 << 20
FLUSH_TOKENS = 8 << 20
PIECE = 1 << 17
FAR = np.iinfo(np.int64).max

SEEDS = "bucket int, hashes binary, blocks binary"
SHARED = "block int, bucket int, hashes binary, hot binary, copies array<bigint>"
CONTEXTS = "grp int, block int, whole boolean, keys binary, doc binary, row binary, at binary, key binary"
COVERED = "block int, row binary, start binary, stop binary, copies array<bigint>"


@dataclass(frozen=True)
class Scheme:
    """What a token is and how a group's contexts are indexed."""

    window: int
    seed: int
    width: int  # tokens of a stored context row, padding included
    pad: int  # a token that no text has
    dtype: str
    tokens: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    first_docs: Callable[[np.ndarray, np.ndarray], np.ndarray]
    hot: int = 512  # entries of a seed beyond which its windows part

    @property
    def reach(self) -> int:
        """Tokens of a context before its seed, and places a window can start at less one."""
        return self.window - self.seed


def find_seeds(tokens: np.ndarray, bounds: np.ndarray, window: int, seed: int):
    """(position, hash) of the seeds of all windows inside one text, each once."""
    n = len(tokens) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    edge = np.zeros(len(tokens) + 1, np.int32)
    long = np.diff(bounds) >= window
    np.add.at(edge, bounds[:-1][long], 1)
    np.add.at(edge, bounds[1:][long] - window + 1, -1)
    inside = np.cumsum(edge[:n], dtype=np.int32) > 0
    width = window - seed + 1
    low = U64((1 << 20) - 1)
    places, hashes = [], []
    for at in range(0, n, PIECE):
        grams = gram_hashes(tokens[at : at + PIECE + window - 1], seed)
        least = (grams & ~low) | np.arange(len(grams), dtype=U64)
        span = 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[: span - width], least[width - span :])
        found = (least[inside[at : at + PIECE]] & low).astype(np.int64)
        if len(found):
            found = found[np.concatenate([[True], found[1:] != found[:-1]])]
            places.append(found + at)
            hashes.append(grams[found])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    place, value = np.concatenate(places), np.concatenate(hashes)
    once = np.concatenate([[True], place[1:] != place[:-1]])
    return place[once], value[once]


def _bucket(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> U64(32)) * U64(n)) >> U64(32)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _segments(sorted_keys: np.ndarray):
    """(key, slice) of each run of equal keys."""
    cuts = [*np.flatnonzero(_changes(sorted_keys)), len(sorted_keys)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(sorted_keys[a]), slice(a, b)


def _packed(values: np.ndarray) -> bytes:
    data = values.tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpacked(data: bytes, dtype) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], size, codec="zstd"), dtype)


def _unpacked_column(column: pa.ChunkedArray, dtype) -> list[np.ndarray]:
    return [_unpacked(x, dtype) for x in column.to_pylist()]


def _joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    data, _ = binary_bounds(column)
    return np.frombuffer(data.tobytes(), dtype)


def _table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema)


_ARROW = {
    "int": pa.int32(),
    "binary": pa.binary(),
    "boolean": pa.bool_(),
    "bigint": pa.int64(),
    "string": pa.string(),
    "array<bigint>": pa.list_(pa.int64()),
}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, _ARROW[t]) for n, t in (f.strip().split(" ") for f in ddl.split(","))])


def _seed_rows(scheme: Scheme, n_buckets: int):
    schema = _schema(SEEDS)

    def flush(parts) -> pa.RecordBatch | None:
        hashes, blocks, docs = (np.concatenate(x) for x in zip(*parts, strict=True))
        if not len(hashes):
            return None
        where = (_bucket(hashes, n_buckets) << U64(32)) | blocks.astype(U64)
        rest = hashes.astype(np.uint32)
        order = np.lexsort((docs, rest, where))
        where, rest, docs = where[order], rest[order], docs[order]
        new = _changes(where, rest, docs)  # a document counts once
        where, rest = where[new], rest[new]
        first = _changes(where, rest)
        second = np.zeros(len(first), dtype=bool)
        second[1:] = first[:-1] & ~first[1:]
        keep = first | second  # twice is enough to be shared
        where, rest = where[keep], rest[keep]
        rows = [
            {
                "bucket": b,
                "hashes": rest[s].tobytes(),
                "blocks": (where[s] & U64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
            }
            for b, s in _segments(where >> U64(32))
        ]
        return pa.RecordBatch.from_pylist(rows, schema)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, first_doc = [], 0, 0
        for batch in text_slices(batches):
            tokens, bounds = scheme.tokens(*binary_bounds(batch.column("text")))
            place, value = find_seeds(tokens, bounds, scheme.window, scheme.seed)
            doc = np.searchsorted(bounds, place, side="right") - 1
            block = batch.column("block").to_numpy(zero_copy_only=False)
            parts.append((value, block[doc].astype(np.uint32), doc + first_doc))
            held, first_doc = held + len(tokens), first_doc + batch.num_rows
            if held > FLUSH_TOKENS:
                out = flush(parts)
                parts, held = [], 0
                if out is not None:
                    yield out
        if parts and (out := flush(parts)) is not None:
            yield out

    return emit


def _shared_seeds(table: pa.Table, hot_entries: int) -> pa.Table:
    """Of one bucket: the seeds that two documents have, told to each block having them."""
    bucket = table.column("bucket")[0].as_py()
    hashes, blocks = _joined(table.column("hashes"), "<u4"), _joined(table.column("blocks"), "<u4")
    order = np.argsort(hashes)
    hashes, blocks = hashes[order], blocks[order]
    run = np.cumsum(_changes(hashes)) - 1
    count = np.bincount(run)[run]
    keep = count > 1
    where = (blocks[keep].astype(U64) << U64(32)) | hashes[keep].astype(U64)
    where, first = np.unique(where, return_index=True)
    hot = (count[keep] > hot_entries)[first]
    value = where.astype(np.uint32)
    rows = [
        {"block": b, "bucket": bucket, "hashes": value[s].tobytes(), "hot": hot[s].tobytes()}
        for b, s in _segments(where >> U64(32))
    ]
    return _table([{**r, "copies": None} for r in rows], _schema(SHARED))


@dataclass
class Block:
    """The rows of a block in an order that any task finds again."""

    doc: np.ndarray
    text: pa.Array
    copy: np.ndarray
    table: pa.Table

    @classmethod
    def of(cls, docs: pa.Table, told: pa.Table) -> Block:
        docs = docs.combine_chunks()
        docs = docs.take(pc.sort_indices(docs, [("id", "ascending"), ("text", "ascending")]))
        doc = docs.column("id").to_numpy()
        lists = [c for c in told.column("copies").to_pylist() if c]
        copies = np.unique(np.concatenate(lists)) if lists else np.zeros(0, np.int64)
        mark = docs.column("mark").to_numpy()
        return cls(doc, docs.column("text"), np.isin(mark, copies), docs)


def _context_rows(scheme: Scheme, n_buckets: int, n_groups: int):
    schema = _schema(CONTEXTS)
    w, k, reach = scheme.window, scheme.seed, scheme.reach

    def shared(told: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        told = told.filter(pc.is_valid(told.column("bucket")))
        keys, hot = [], []
        for bucket, values, flags in zip(
            told.column("bucket").to_pylist(),
            told.column("hashes").to_pylist(),
            told.column("hot").to_pylist(),
            strict=True,
        ):
            keys.append((U64(bucket) << U64(32)) | np.frombuffer(values, "<u4").astype(U64))
            hot.append(np.frombuffer(flags, bool))
        if not keys:
            return np.zeros(0, U64), np.zeros(0, bool)
        keys, hot = np.concatenate(keys), np.concatenate(hot)
        order = np.argsort(keys)
        return keys[order], hot[order]

    def rows_of(block_id, whole, group, hashes, keys, doc, row, at):
        """Distinct keys of each group with their occurrences."""
        order = np.lexsort((hashes, group))
        group, hashes, doc, row, at = (x[order] for x in (group, hashes, doc, row, at))
        new = _changes(group, hashes)
        number = np.cumsum(new) - 1
        picked = order[new]
        for g, s in _segments(group):
            first = number[s.start]
            yield {
                "grp": g,
                "block": block_id,
                "whole": whole,
                "keys": _packed(keys(picked[first : number[s.stop - 1] + 1])),
                "doc": _packed(doc[s]),
                "row": _packed(row[s].astype("<u4")),
                "at": _packed(at[s].astype("<u4")),
                "key": _packed((number[s] - first).astype("<u4")),
            }

    def emit(key, docs: pa.Table, told: pa.Table) -> pa.Table:
        if docs.num_rows == 0:
            return _table([], schema)
        wanted, hot = shared(told)
        block = Block.of(docs, told)
        tokens, bounds = scheme.tokens(*binary_bounds(block.text))
        place, value = find_seeds(tokens, bounds, w, k)
        row = np.searchsorted(bounds, place, side="right") - 1
        keep = ~block.copy[row]
        place, value, row = place[keep], value[keep], row[keep]
        ids = (_bucket(value, n_buckets) << U64(32)) | (value & U64(0xFFFFFFFF))
        spot = np.searchsorted(wanted, ids)
        spot[spot == len(wanted)] = 0
        keep = wanted[spot] == ids if len(wanted) else np.zeros(len(ids), bool)
        place, value, row, is_hot = place[keep], value[keep], row[keep], hot[spot[keep]]
        padded = np.concatenate([np.full(reach, scheme.pad, tokens.dtype), tokens,
                                 np.full(scheme.width, scheme.pad, tokens.dtype)])
        out = []
        block_id = int(key[0].as_py())

        def contexts(some: np.ndarray) -> np.ndarray:
            """Tokens around the seeds ``some``; padding where the text has ended."""
            p, r = place[some], row[some]
            grid = np.lib.stride_tricks.sliding_window_view(padded, scheme.width)[p].copy()
            column = np.arange(scheme.width)
            real = p[:, None] - reach + column  # position in tokens
            grid[(real < bounds[r][:, None]) | (real >= bounds[r + 1][:, None])] = scheme.pad
            grid[:, 2 * reach + k :] = scheme.pad
            return grid

        cold = np.flatnonzero(~is_hot)
        if len(cold):
            hashes = np.concatenate(
                [_row_hashes(contexts(cold[i : i + PIECE])) for i in range(0, len(cold), PIECE)]
            )
            group = _bucket(mixed(value[cold]), n_groups).astype(np.int64)
            out += rows_of(block_id, False, group, hashes ^ value[cold],
                           lambda i: contexts(cold[i]), block.doc[row[cold]], row[cold],
                           place[cold] - bounds[row[cold]])
        warm = np.flatnonzero(is_hot)
        if len(warm):
            start = (place[warm][:, None] + np.arange(-reach, 1)).ravel()
            r = np.repeat(row[warm], reach + 1)
            ok = (start >= bounds[r]) & (start + w <= bounds[r + 1])
            start, once = np.unique(start[ok], return_index=True)
            r = r[ok][once]
            one, two = _window_hashes(tokens, start, w)
            group = _bucket(mixed(one), n_groups).astype(np.int64)
            out += rows_of(block_id, True, group, one ^ (two >> U64(1)),
                           lambda i: np.stack([one[i], two[i]], axis=1), block.doc[r], r,
                           start - bounds[r] + reach)
        return _table(out, schema)

    return emit


def _row_hashes(grid: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each context; equal only for equal contexts, but once in 2^64."""
    words = grid.view(U64) if grid.dtype == np.uint8 else grid
    out = np.zeros(len(words), U64)
    for column, factor in zip(words.T, multipliers(words.shape[1]), strict=True):
        out = mixed(out + column * factor)
    return out


def _window_hashes(tokens: np.ndarray, start: np.ndarray, window: int):
    """128 bits of each whole window, in two numbers."""
    one, two = np.zeros(len(start), U64), np.full(len(start), STEP_2, U64)
    for j in range(window):
        token = tokens[start + j].astype(U64)
        one = mixed(one * MULTIPLY + token)
        two = mixed((two ^ token) * MULTIPLY + U64(j))
    return one, two


MULTIPLY = multipliers(1)[0]
STEP_2 = multipliers(2)[1]


def _covered_rows(scheme: Scheme):
    schema = _schema(COVERED)

    def covered(table: pa.Table) -> pa.Table:
        found: dict[int, list] = {}
        for whole in (False, True):
            part = table.filter(pc.equal(table.column("whole"), whole))
            if part.num_rows:
                _cover(part, whole, found)
        rows = []
        for block, pieces in found.items():
            row, start, stop = (np.concatenate(x) for x in zip(*pieces, strict=True))
            rows.append({"block": block, "row": _packed(row), "start": _packed(start),
                         "stop": _packed(stop), "copies": None})
        return _table(rows, schema)

    def _cover(part: pa.Table, whole: bool, found: dict[int, list]) -> None:
        keys = np.concatenate(
            _unpacked_column(part.column("keys"), "<u8" if whole else scheme.dtype)
        ).reshape(-1, 2 if whole else scheme.width)
        doc = _unpacked_column(part.column("doc"), "<i8")
        row, at, key = (_unpacked_column(part.column(c), "<u4") for c in ("row", "at", "key"))
        sizes = [int(k.max()) + 1 for k in key]
        base = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        number = np.concatenate([k + b for k, b in zip(key, base, strict=True)])
        docs = np.concatenate(doc)
        # Equal contexts of several blocks become one, with its first document.
        hashes = _row_hashes(keys)
        _, one, same = np.unique(hashes, return_index=True, return_inverse=True)
        first = np.full(len(one), FAR, np.int64)
        np.minimum.at(first, same[number], docs)
        if whole:
            firsts = first[:, None]
        else:
            firsts = scheme.first_docs(keys[one], first)
        done = 0
        for i, block in enumerate(part.column("block").to_pylist()):
            n = len(doc[i])
            mine = same[number[done : done + n]]
            done += n
            for s in range(0, n, PIECE):
                part_of = slice(s, s + PIECE)
                old = firsts[mine[part_of]] < doc[i][part_of][:, None]
                hit = np.flatnonzero(old.any(axis=1))
                if not len(hit):
                    continue
                old = old[hit]
                begin = at[i][part_of][hit].astype(np.int64) - scheme.reach
                lo = begin + old.argmax(axis=1)
                hi = begin + (old.shape[1] - 1 - old[:, ::-1].argmax(axis=1)) + scheme.window
                found.setdefault(block, []).append(
                    (row[i][part_of][hit], lo.astype("<u4"), hi.astype("<u4"))
                )

    return covered


def _results(finish: Callable, names: list[str], types: list[pa.DataType]):
    def emit(docs: pa.Table, told: pa.Table) -> pa.Table:
        block = Block.of(docs, told)
        told = told.filter(pc.is_valid(told.column("row")))
        row, start, stop = (
            np.concatenate([np.zeros(0, np.int64), *_unpacked_column(told.column(c), "<u4")])
            for c in ("row", "start", "stop")
        )
        order = np.argsort(row, kind="stable")
        row, start, stop = row[order], start[order], stop[order]
        limits = np.searchsorted(row, np.arange(len(block.doc) + 1))
        rows = []
        for i, text in enumerate(block.text.to_pylist()):
            mine = slice(limits[i], limits[i + 1])
            rows.append(finish(text or b"", bool(block.copy[i]), start[mine], stop[mine]))
        made = _table(rows, pa.schema([*zip(names, types, strict=True)]))
        rest = block.table.column("rest")
        return pa.Table.from_arrays([rest, *made.columns], names=["rest", *names])

    return emit


def mask_of(n: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """True for the tokens that the intervals cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, stop, -1)
    return np.cumsum(edge[:n]) > 0


def remove_repeats(
    docs: DataFrame,
    scheme: Scheme,
    finish: Callable[[bytes, bool, np.ndarray, np.ndarray], dict],
    made: dict[str, str],
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(rest, columns ``made``), a row per document, by ``finish(text, is copy, starts, stops)``.

    ``rest`` is a struct of the columns of ``docs``. Starts and stops are tokens of windows
    that also start in a document of a smaller id. A row without id comes after all
    others; rows of one id do not remove each other.
    """
    digests = text_digests(docs, key, text)
    total = digests.agg(F.sum("n_bytes")).first()[0] or 0
    n_blocks, n_buckets = slices(total, BLOCK_BYTES), slices(total, GROUP_BYTES)
    block = F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int").alias("block")
    copies = later_copies(digests).groupBy(block).agg(F.collect_set("mark").alias("copies"))
    copies = cut(copies, "copies")
    others = [c for c in docs.columns if c != text]
    rows = docs.select(
        known_id(key).alias("id"),
        row_mark(key, text).alias("mark"),
        F.col(text).cast("binary").alias("text"),
        F.struct(*(F.col(f"`{c}`") for c in others)).alias("rest"),
    )
    # The same rows for both passes over texts, so that Spark shuffles them once.
    whole = rows.select("id", "mark", block, "text", "rest")
    seeds = whole.select("block", "text").mapInArrow(_seed_rows(scheme, n_buckets), SEEDS)
    shared = seeds.groupBy("bucket").applyInArrow(
        lambda bucket: _shared_seeds(bucket, scheme.hot), SHARED
    )
    told = shared.unionByName(copies, allowMissingColumns=True)
    contexts = whole.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        _context_rows(scheme, n_buckets, n_buckets), CONTEXTS
    )
    covered = contexts.groupBy("grp").applyInArrow(_covered_rows(scheme), COVERED)
    replies = covered.unionByName(copies, allowMissingColumns=True)
    kind = whole.schema["rest"].dataType.simpleString()
    names = [*made]
    types = [_ARROW[t] for t in made.values()]
    return whole.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        _results(finish, names, types),
        ", ".join([f"rest {kind}", *(f"`{n}` {t}" for n, t in made.items())]),
    )
