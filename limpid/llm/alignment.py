"""Tokens of two vocabularies aligned over each text, and how often they stand for each other.

Rows are shuffled by their full text, so that each distinct text is encoded and aligned
once, with the number of its rows as weight. Texts are taken in blocks. A block lists its
distinct token pairs with the weight of the texts that link them; Spark adds these up over
all blocks and finds the best of each first token; each block gets the counts of its own
pairs back and sums them per text. A pair crosses the shuffle once a block, not once an
occurrence. Measures are joined to the rows by the text's 256-bit digest.

Within a block, a stretch from one blank after a visible sign to the next is aligned once:
tokens of both vocabularies end there, so no group reaches across. For the same reason new
stretches are encoded several to a line. The stretches met most often are remembered from
block to block. A text in which a stretch does not come back byte for byte is encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.llm.bpe import byte_characters
from limpid.llm.layout import cut

BLANK = "▁"
# Characters of a block, of a slice encoded at once, and of the stretches remembered from
# block to block.
BLOCK_CHARS = 2 << 20
SLICE_CHARS = 1 << 18
REMEMBERED = 2 << 20
# Stretches encoded as one line, and its characters at most.
LINE = 16
LINE_CHARS = 4096
# Links of a group that are listed one by one; more are counted by pair first.
FEW = 4096
# A blank counts as a cut only after a sign that is no blank in either vocabulary.
CUT = re.compile(f"(?<=[^\\s{BLANK}])(?= )")
UNCUT = re.compile(f"[\\s{BLANK}] ")
LOW = (1 << 32) - 1

MEASURES = ("n_a", "n_b", "n_groups", "n_links")
BLOCKS = (
    "block bigint, digests binary, groups binary, measures binary, bounds binary, "
    "which binary, times binary, pairs array<bigint>, weights array<bigint>"
)
OUT = (
    "digest binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "n_best bigint, count_sum bigint, groups_sha256 string"
)


class Units:
    """Aligned stretches or texts, in columns: a unit is a place in each.

    Pairs are ``a << 32 | b``, one pair possibly several times, each with a number of links.
    """

    def __init__(self):
        self.groups: list[str] = []
        self.sound = b""  # 0 for a unit whose bytes do not come back
        self.measures = array("q")
        self.pairs = array("q")
        self.times = array("q")
        self.starts = array("q", [0])

    def extend(self, groups, sound, measures, pairs, times, sizes) -> None:
        """Add units: their pairs one after another, ``sizes`` of them for each."""
        self.groups += groups
        self.sound += sound.astype(np.uint8).tobytes()
        for column, values in (
            (self.measures, measures), (self.pairs, pairs), (self.times, times),
            (self.starts, self.starts[-1] + np.cumsum(sizes)),
        ):
            column.frombytes(np.ascontiguousarray(values, np.int64).tobytes())

    def spots(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of pairs of each unit, their places one after another)."""
        starts = np.array(self.starts, np.int64)
        size = np.diff(starts)[units]
        return size, np.arange(size.sum()) + np.repeat(starts[units] - np.cumsum(size) + size, size)

    def picked(self, units: np.ndarray) -> Units:
        """These units alone, renumbered in the order given."""
        size, at = self.spots(units)
        out = Units()
        out.extend(
            [self.groups[k] for k in units.tolist()], np.frombuffer(self.sound, np.uint8)[units],
            np.array(self.measures, np.int64).reshape(-1, 4)[units],
            np.array(self.pairs, np.int64)[at], np.array(self.times, np.int64)[at], size,
        )
        return out


class Tokenizers:
    """Both vocabularies in a task: ids of a text, and the bytes of each id."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {c: n for n, c in enumerate(byte_characters())}
        self.bytes_a = {
            i: bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
            for token, i in self.a.get_vocab(with_added_tokens=True).items()
        }
        self.bytes_b = []
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            raw = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(BLANK, " ").encode()
            self.bytes_b.append(raw)
        self.blank = self.b.piece_to_id(BLANK)
        n = 1 + max(*self.bytes_a, len(self.bytes_b))
        self.length_a = np.array([len(self.bytes_a.get(i, b"")) for i in range(n)])
        self.length_b = np.array([len(x) for x in self.bytes_b])
        self.digits = np.array([len(str(i)) for i in range(n)])
        self.names_a, self.names_b = (
            {mark: np.array([f"{i}{mark}" for i in range(n)], object) for mark in marks} for marks in (",|", ",;")
        )

    @staticmethod
    def check(path_a: str, path_b: str) -> None:
        """Refuse vocabularies that do not cut where this module does."""
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        split = spec["pre_tokenizer"] or {}
        kind = (split.get("type"), split.get("add_prefix_space"), split.get("use_regex"), spec["normalizer"])
        if kind != ("ByteLevel", False, True, None):
            raise ValueError(f"{path_a}: not a plain byte-level vocabulary")
        both = Tokenizers(path_a, path_b)
        inner = re.compile(f"[^{BLANK}]{BLANK}")
        pieces = (both.b.id_to_piece(i) for i in range(len(both.bytes_b)))
        if any(inner.search(p) for p in pieces) or both.b.encode("x  y", out_type=str)[0] != BLANK + "x":
            raise ValueError(f"{path_b}: pieces reach across blanks")

    def ids(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """(ids under A of blank + text, ids under B of text); B puts the blank itself."""
        a = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        b = self.b.encode(texts, num_threads=1)
        # B drops its own blank where nothing follows.
        return [e.ids for e in a], [ids if t else [self.blank] for t, ids in zip(texts, b, strict=True)]

    def _flat(self, ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return size, np.fromiter(chain.from_iterable(ids), np.int64, size.sum())

    def _sound(self, texts: list[str], a: list[list[int]], b: list[list[int]]) -> np.ndarray:
        """Whether both sides give back blank + text byte for byte."""
        raw = [b" " + t.encode() for t in texts]
        ends = np.cumsum([len(r) for r in raw])
        line, sound = b"".join(raw), np.ones(len(texts), bool)
        for of, length, ids in ((self.bytes_a, self.length_a, a), (self.bytes_b, self.length_b, b)):
            size, flat = self._flat(ids)
            until = np.concatenate([[0], np.cumsum(length[flat])])[np.cumsum(size)]
            if (until != ends).any() or b"".join(map(of.__getitem__, flat.tolist())) != line:
                sound &= [b"".join([of[i] for i in x]) == r for x, r in zip(ids, raw, strict=True)]
        return sound

    def _tokens(self, texts: list[str], each: int) -> tuple[tuple, tuple, np.ndarray]:
        """(number of tokens of each text, their ids in a row) for A and for B, and which texts
        come back byte for byte on both sides; the others have no tokens."""
        # Up to ``each`` texts are encoded as one line if both vocabularies cut at every blank of it.
        runs = []
        for n in range(0, len(texts), each):
            run = texts[n : n + each]
            line = " ".join(run)
            alone = len(line) > LINE_CHARS or BLANK in line or UNCUT.search(" " + line)
            runs += [[t] for t in run] if alone else [run]
        lines = [" ".join(run) for run in runs]
        a, b = self.ids(lines)
        fine, number = self._sound(lines, a, b), np.fromiter(map(len, runs), np.int64, len(runs))
        if (number[~fine] > 1).any():
            return self._tokens(texts, 1)
        if not fine.all():
            a, b = ([ids if ok else [] for ids, ok in zip(x, fine, strict=True)] for x in (a, b))
        sound = np.repeat(fine, number)
        sizes = map(len, texts) if all(map(str.isascii, lines)) else (len(t.encode()) for t in texts)
        ends = np.cumsum((np.fromiter(sizes, np.int64, len(texts)) + 1) * sound)
        sides = []
        for ids, length in ((a, self.length_a), (b, self.length_b)):
            flat = self._flat(ids)[1]
            until = np.concatenate([[0], np.cumsum(length[flat])])
            last = np.searchsorted(until, ends, side="right") - 1
            if (until[last] != ends).any():
                return self._tokens(texts, 1)
            sides.append((np.diff(last, prepend=0), flat))
        return *sides, sound

    def align(self, units: Units, texts: list[str], each: int = LINE) -> None:
        """Add a unit per text, a slice of bounded size at a time, up to ``each`` texts a line."""
        start, held = 0, 0
        for n, text in enumerate(texts):
            held += len(text)
            if held > SLICE_CHARS or n == len(texts) - 1:
                self._align(units, texts[start : n + 1], each)
                start, held = n + 1, 0

    def _align(self, units: Units, texts: list[str], each: int) -> None:
        """Add a unit per text: its groups between common ends."""
        (n_a, flat_a), (n_b, flat_b), sound = self._tokens(texts, each)
        # All texts in one row of bytes: both sides end where a text ends.
        end_a, end_b = np.cumsum(self.length_a[flat_a]), np.cumsum(self.length_b[flat_b])
        place = np.searchsorted(end_b, end_a)
        common = end_b[place] == end_a if len(end_b) else np.zeros(0, bool)
        last_a, last_b = np.flatnonzero(common), place[common]
        first_a, first_b = (np.concatenate([[0], last + 1])[:-1] for last in (last_a, last_b))
        wide_a, wide_b = last_a - first_a + 1, last_b - first_b + 1
        owner = np.repeat(np.arange(len(texts)), n_a)[last_a]
        links = wide_a * wide_b
        measures = np.stack([n_a, n_b, np.bincount(owner, minlength=len(texts)), np.zeros_like(n_a)], axis=1)
        np.add.at(measures[:, 3], owner, links)
        # Every link of the small groups; the large ones are counted by pair first.
        small = np.flatnonzero(links <= FEW)
        group = np.repeat(small, links[small])
        starts = np.cumsum(links[small]) - links[small]
        inner = np.arange(len(group)) - np.repeat(starts, links[small])
        pair = flat_a[first_a[group] + inner // wide_b[group]] << 32 | flat_b[first_b[group] + inner % wide_b[group]]
        of, pairs, times = [owner[group]], [pair], [np.ones(len(pair), np.int64)]
        for g in np.flatnonzero(links > FEW).tolist():
            x, m = np.unique(flat_a[first_a[g] : last_a[g] + 1], return_counts=True)
            y, n = np.unique(flat_b[first_b[g] : last_b[g] + 1], return_counts=True)
            pairs.append((x[:, None] << 32 | y[None, :]).ravel())
            times.append(np.outer(m, n).ravel())
            of.append(np.full(len(pairs[-1]), owner[g]))
        of, pairs, times = (np.concatenate(x) for x in (of, pairs, times))
        order = np.argsort(of, kind="stable")
        units.extend(
            self._shown(n_a, n_b, flat_a, flat_b, common, place, last_b),
            sound, measures, pairs[order], times[order], np.bincount(of, minlength=len(texts)),
        )

    def _shown(self, n_a, n_b, flat_a, flat_b, common, place, last_b) -> list[str]:
        """The groups of each text as text: a token of B stands after all of A up to its end."""
        closing = np.zeros(len(flat_b), bool)
        closing[last_b] = True
        group_a = np.cumsum(common) - common
        before_b = np.concatenate([[0], last_b + 1])[group_a]
        group_b = np.cumsum(closing) - closing
        until_a = np.concatenate([np.flatnonzero(common) + 1, [len(flat_a)]])[group_b]
        at_a, at_b = np.arange(len(flat_a)) + before_b, np.arange(len(flat_b)) + until_a
        total = len(flat_a) + len(flat_b)
        shown, size = np.empty(total, object), np.zeros(total + 1, np.int64)
        for at, flat, names, mark, last in (
            (at_a, flat_a, self.names_a, "|", common), (at_b, flat_b, self.names_b, ";", closing)
        ):
            shown[at] = np.where(last, names[mark][flat], names[","][flat])
            size[at + 1] = self.digits[flat] + 1
        ends = np.cumsum(size)[np.concatenate([[0], np.cumsum(n_a + n_b)])].tolist()
        line = "".join(shown.tolist())
        return [line[i : max(i, j - 1)] for i, j in zip(ends[:-1], ends[1:], strict=True)]


class Numbers(dict):
    """Numbers of stretches, written without the blank before them, in the order first met."""

    def __init__(self, known: list[str]):
        super().__init__(zip(known, range(len(known)), strict=True))
        self.fresh: list[str] = []

    def __missing__(self, stretch: str) -> int:
        number = self[stretch] = len(self)
        self.fresh.append(stretch)
        return number


class BlockAligner:
    """Aligns blocks of distinct texts; remembers stretches up to a bound."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.number = Numbers([])
        self.units = Units()
        self.used = np.zeros(0, np.int64)
        self.held = 0

    def _forget(self) -> None:
        """Keep the stretches met most often, up to half of the bound; those met once go."""
        known = list(self.number)
        size = np.fromiter(map(len, known), np.int64, len(known)) + 1
        order = np.argsort(-self.used, kind="stable")
        kept = np.sort(order[(self.used[order] > 1) & (np.cumsum(size[order]) <= REMEMBERED // 2)])
        self.number = Numbers([known[k] for k in kept.tolist()])
        self.units = self.units.picked(kept)
        self.used = self.used[kept] // 2
        self.held = int(size[kept].sum())

    def _stretches(self, texts: list[str]) -> tuple[list[list[int]], np.ndarray]:
        """(numbers of the stretches of each text, the same in a row), all of them aligned."""
        if self.held > REMEMBERED:
            self._forget()
        number, parts = self.number, []
        for text in texts:
            spaced = " " + text
            # Without runs of blanks every blank is a cut.
            stretches = [s[1:] for s in CUT.split(spaced)] if UNCUT.search(spaced) else text.split(" ")
            parts.append(list(map(number.__getitem__, stretches)))
        fresh, number.fresh = number.fresh, []
        self.held += sum(map(len, fresh)) + len(fresh)
        self.tokenizers.align(self.units, fresh)
        unit = np.fromiter(chain.from_iterable(parts), np.int64, sum(map(len, parts)))
        self.used = np.bincount(unit, minlength=len(number)) + np.pad(self.used, (0, len(number) - len(self.used)))
        return parts, unit

    def block(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(measures, group strings, text of each link kind, its pair, its number of links)."""
        parts, unit = self._stretches(texts)
        units = self.units
        owner = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
        odd = np.unique(owner[np.frombuffer(units.sound, np.uint8)[unit] == 0])
        measures, groups, owner, pair, times = self._summed(units, len(texts), parts, owner, unit)
        if not len(odd):
            return measures, groups, owner, pair, times
        # Texts in which a stretch does not come back are judged whole.
        whole = Units()
        self.tokenizers.align(whole, [texts[n] for n in odd], 1)
        own = np.arange(len(odd))
        w_measures, w_groups, w_owner, w_pair, w_times = self._summed(whole, len(odd), own[:, None], own, own)
        measures[odd] = w_measures
        for n, g in zip(odd.tolist(), w_groups, strict=True):
            groups[n] = g
        plain = ~np.isin(owner, odd)
        owner = np.concatenate([owner[plain], odd[w_owner]])
        order = np.argsort(owner, kind="stable")
        pair, times = np.concatenate([pair[plain], w_pair]), np.concatenate([times[plain], w_times])
        return measures, groups, owner[order], pair[order], times[order]

    @staticmethod
    def _summed(units: Units, n: int, parts, owner: np.ndarray, unit: np.ndarray):
        each = np.array(units.measures, np.int64).reshape(-1, 4)
        flat_pairs, flat_times = np.array(units.pairs, np.int64), np.array(units.times, np.int64)
        measures = np.zeros((n, 4), np.int64)
        np.add.at(measures, owner, each[unit])
        # A stretch once per text, then its pairs, then a pair once per text.
        kinds = len(units.groups) or 1
        both, again = np.unique(owner * kinds + unit, return_counts=True)
        owner, unit = both // kinds, both % kinds
        size, at = units.spots(unit)
        owner, pair, times = np.repeat(owner, size), flat_pairs[at], flat_times[at] * np.repeat(again, size)
        # One sort: ids are far below 2 ** 21, and a block has fewer texts than that.
        narrow = (pair >> 32) * ((pair & LOW).max(initial=0) + 1) + (pair & LOW)
        order = np.argsort(owner * (narrow.max(initial=0) + 1) + narrow)
        owner, pair, times = owner[order], pair[order], times[order]
        new = np.ones(len(pair), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (pair[1:] != pair[:-1])
        times = np.add.reduceat(times, np.flatnonzero(new)) if len(times) else times
        groups = [";".join([units.groups[k] for k in p]) for p in parts]
        return measures, groups, owner[new], pair[new], times


def _blocks(path_a: str, path_b: str):
    def packed(aligner: BlockAligner, number: int, digests: list[bytes], copies: list[int], texts: list[str]):
        measures, groups, owner, pair, times = aligner.block(texts)
        pairs, which = np.unique(pair, return_inverse=True)
        weights = np.zeros(len(pairs), np.int64)
        np.add.at(weights, which, np.array(copies, np.int64)[owner])
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        shown = [hashlib.sha256(g.encode()).digest() if m[0] else b"" for g, m in zip(groups, measures, strict=True)]
        return pa.RecordBatch.from_pydict({
            "block": pa.array([number], pa.int64()),
            "digests": pa.array([b"".join(digests)], pa.binary()),
            "groups": pa.array([b"".join(s.ljust(32, b"\0") for s in shown)], pa.binary()),
            "measures": pa.array([measures.tobytes()], pa.binary()),
            "bounds": pa.array([bounds.astype(np.int64).tobytes()], pa.binary()),
            "which": pa.array([which.astype(np.int32).tobytes()], pa.binary()),
            "times": pa.array([times.tobytes()], pa.binary()),
            "pairs": pa.array([pairs], pa.list_(pa.int64())),
            "weights": pa.array([weights], pa.list_(pa.int64())),
        })

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = BlockAligner(Tokenizers(path_a, path_b))
        number = TaskContext.get().partitionId() << 32
        rows: tuple[list, list, list] = ([], [], [])
        held = 0
        for batch in batches:
            columns = [batch.column(c) for c in ("digest", "copies", "text")]
            for row in zip(*columns, strict=True):
                for values, cell in zip(rows, row, strict=True):
                    values.append(cell.as_py())
                held += len(rows[2][-1])
                if held > BLOCK_CHARS:
                    yield packed(aligner, number, *rows)
                    rows, held, number = ([], [], []), 0, number + 1
        if rows[0]:
            yield packed(aligner, number, *rows)

    return emit


def _summed(key, blocks: pa.Table, counts: pa.Table) -> pa.Table:
    """The counts of a block's pairs, added up per text."""
    if not blocks.num_rows:
        raise ValueError(f"counts of a block that is not there: {key}")
    cell = {name: blocks.column(name)[0].as_py() for name in blocks.schema.names}
    spot = counts.column("spot").to_numpy()
    count, best = np.zeros(len(spot), np.int64), np.zeros(len(spot), np.int64)
    count[spot] = counts.column("count").to_numpy()
    best[spot] = counts.column("best").to_numpy()
    which, times = np.frombuffer(cell["which"], np.int32), np.frombuffer(cell["times"], np.int64)
    bounds = np.frombuffer(cell["bounds"], np.int64)
    measures = np.frombuffer(cell["measures"], np.int64).reshape(-1, 4)

    def per_text(values: np.ndarray) -> np.ndarray:
        running = np.concatenate([[0], np.cumsum(values)])
        return running[bounds[1:]] - running[bounds[:-1]]

    n = len(measures)
    width = [cell[name][i * 32 : i * 32 + 32] for name in ("digests", "groups") for i in range(n)]
    shown = [g.hex() if m[0] else "" for g, m in zip(width[n:], measures, strict=True)]
    return pa.table({
        "digest": pa.array(width[:n], pa.binary()),
        **{name: pa.array(measures[:, k]) for k, name in enumerate(MEASURES)},
        "n_best": pa.array(per_text(times * best[which])),
        "count_sum": pa.array(per_text(times * count[which])),
        "groups_sha256": pa.array(shown, pa.string()),
    })


def _digest(text: str):
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """One row per block of distinct texts, written once."""
    texts = docs.select(F.col(text).cast("string").alias("text")).where("text <> ''")
    distinct = texts.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    rows = distinct.select(_digest("text").alias("digest"), "copies", "text")
    return cut(rows.mapInArrow(_blocks(path_a, path_b), BLOCKS), "aligned")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, a, b, count, best): rows that hold a pair linked, and whether no other pair of
    its ``a`` has more."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "weights")).alias("x"))
    counts = each.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.weights").alias("count"))
    counts = cut(
        counts.select(
            "pair", F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(F.lit(LOW)).alias("b"), "count"
        ),
        "pair-counts",
    )
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("pair", "a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def token_alignment(
    docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row.

    A encodes blank + text, B the text. Texts null, empty or not given back byte for byte by
    both have no tokens: zeros and ''. A pair's count is the number of rows whose text links
    it, repeated rows and rows without id included; ties for the best all count. Repeated
    rows come back as given; an empty table gives an empty one; other columns play no part.
    """
    Tokenizers.check(path_a, path_b)
    blocks = aligned_blocks(docs, path_a, path_b, text)
    known = pair_counts(blocks).select("pair", "count", F.col("best").cast("bigint").alias("best"))
    asked = blocks.select(F.col("block").alias("asker"), F.posexplode("pairs").alias("spot", "pair"))
    answers = asked.join(known, "pair").select("asker", "spot", "count", "best")
    held = blocks.drop("pairs", "weights")
    measured = held.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(_summed, OUT)
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.select("doc_id", F.when(F.col("text") != "", _digest("text")).alias("digest"))
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("bigint").alias(name)
    return rows.join(measured, "digest", "left").select(
        "doc_id", *(zero(name) for name in (*MEASURES, "n_best", "count_sum")),
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
