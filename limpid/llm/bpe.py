"""Byte-pair encoding and decoding with a public vocabulary, by a pair occurrence index.

The texts of a partition are taken in chunks. All distinct words of a chunk are encoded
together: symbols stand in one linked list, and the index maps every mergeable pair to all
its positions. Active ranks are applied in ascending order, each to all its positions at
once; a merge updates the lists of the pairs to its left and right only. Each document is
then its words' ids in order.

Normalising, splitting and decoding follow the vocabulary's own definition: NFC, white
space to blanks, lower case character by character; words of letters, single digits, runs
of other signs and English clitics; a word end mark; tokens joined by blanks on decoding.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_CHARS = 24 << 20
WORD_END = "</w>"
# The vocabulary's own pattern and the blanks it knows.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
NOT_BLANK_HERE = re.compile("[\x1c-\x1f]")


def byte_characters() -> list[str]:
    """The visible character standing for each byte: itself, or the next from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


@dataclass
class Vocabulary:
    """What a vocabulary file says, as arrays; its size is the file's, whatever the data."""

    pairs: np.ndarray  # left << 32 | right, ascending
    ranks: np.ndarray  # of each pair
    left: np.ndarray  # by rank
    right: np.ndarray
    made: np.ndarray
    inner: np.ndarray  # id of a byte within a word, and at its end
    final: np.ndarray
    tokens: list[str]
    special: dict[str, int]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        pairs = left << 32 | right
        order = np.argsort(pairs)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [""] * (max([*ids.values(), *special.values()]) + 1)
        for token, i in [*ids.items(), *special.items()]:
            tokens[i] = token
        letters = byte_characters()
        return cls(
            pairs[order], order, left, right, made,
            np.array([ids[c] for c in letters], np.int64),
            np.array([ids[c + WORD_END] for c in letters], np.int64),
            tokens, special,
        )


class PairIndex:
    """The words of a chunk as symbols, and where each active pair stands."""

    def __init__(self, vocabulary: Vocabulary, words: list[bytes]):
        self.v = vocabulary
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        self.first = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        self.symbol = vocabulary.inner[data]
        self.symbol[ends - 1] = vocabulary.final[data[ends - 1]]
        self.next = np.arange(1, len(data) + 1)
        self.next[ends - 1] = -1
        self.before = np.arange(-1, len(data) - 1)
        self.before[self.first] = -1
        self.places: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self._enter(np.flatnonzero(self.next >= 0))

    def _enter(self, at: np.ndarray) -> None:
        """Put the pairs that begin at ``at`` into the lists of their ranks."""
        key = self.symbol[at] << 32 | self.symbol[self.next[at]]
        spot = np.searchsorted(self.v.pairs, key)
        spot[spot == len(self.v.pairs)] = 0
        known = self.v.pairs[spot] == key
        at, rank = at[known], self.v.ranks[spot[known]]
        if not len(at):
            return
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = [0, *(np.flatnonzero(rank[1:] != rank[:-1]) + 1).tolist(), len(rank)]
        for a, b, r in zip(cuts[:-1], cuts[1:], rank[cuts[:-1]].tolist(), strict=True):
            if r not in self.places:
                self.places[r] = []
                heapq.heappush(self.active, r)
            self.places[r].append(at[a:b])

    def merge(self) -> None:
        while self.active:
            rank = heapq.heappop(self.active)
            lists = self.places.pop(rank)
            at = np.unique(np.concatenate(lists))
            self._apply(rank, at)

    def _apply(self, rank: int, at: np.ndarray) -> None:
        a, b = self.v.left[rank], self.v.right[rank]
        after = self.next[at]
        here = (self.symbol[at] == a) & (after >= 0) & (self.symbol[after] == b)
        at, after = at[here], after[here]
        if a == b and len(at) > 1:
            # Of pairs that overlap in a row, every second one from the left merges.
            chained = np.concatenate([[False], after[:-1] == at[1:]])
            index = np.arange(len(at))
            start = np.maximum.accumulate(np.where(chained, 0, index))
            free = (index - start) % 2 == 0
            at, after = at[free], after[free]
        if not len(at):
            return
        beyond = self.next[after]
        self.symbol[at] = self.v.made[rank]
        self.symbol[after] = -1
        self.next[at] = beyond
        inner = beyond >= 0
        self.before[beyond[inner]] = at[inner]
        left = self.before[at]
        self._enter(np.concatenate([left[left >= 0], at[inner]]))

    def ids(self) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, bounds of each word)."""
        alive = self.symbol >= 0
        bounds = np.concatenate([[0], np.cumsum(alive)])
        return self.symbol[alive], bounds[np.concatenate([self.first, [len(alive)]])]


def encode_words(vocabulary: Vocabulary, words: list[bytes]) -> list[list[int]]:
    if not words:
        return []
    index = PairIndex(vocabulary, words)
    index.merge()
    ids, bounds = index.ids()
    flat, cuts = ids.tolist(), bounds.tolist()
    return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def normalised(text: str) -> str:
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # a capital sigma lowers alike at a word's end
            return "".join(c.lower() for c in text)
    return text.lower()


class ChunkEncoder:
    """Encodes a chunk of texts: words once, documents as sequences of words."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.special = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")")

    def _pieces(self, text: str) -> Iterable[str]:
        """Blank-free pieces of a text; a special token stands as its own piece."""
        parts = self.special.split(text) if "<|" in text else [text]
        for part in parts:
            if part in self.v.special:
                yield "<" + part  # no piece of ordinary text has both marks in front
                continue
            plain = normalised(part)
            if NOT_BLANK_HERE.search(plain):
                yield from WORD.findall(plain)
            else:
                yield from plain.split()

    def encode(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """(number of tokens, ids as text, decoded text) of each text."""
        number: dict[str, int] = {}
        documents = []
        for text in texts:
            parts = self._pieces(text)
            documents.append(
                np.fromiter((number.setdefault(p, len(number)) for p in parts), np.int32)
            )
        words: dict[str, int] = {}
        pieces: list[list[int]] = []
        for piece in number:
            special = self.v.special.get(piece[1:]) if piece.startswith("<<|") else None
            if special is not None:
                pieces.append([-1 - special])
            else:
                pieces.append([words.setdefault(w, len(words)) for w in WORD.findall(piece)])
        encoded = encode_words(self.v, [w.encode() for w in words])
        ids_of, text_of = [], []
        counts = np.zeros(len(pieces), np.int64)
        for i, piece in enumerate(pieces):
            ids: list[int] = []
            for w in piece:
                ids += encoded[w] if w >= 0 else [-1 - w]
            counts[i] = len(ids)
            ids_of.append(" ".join(map(str, ids)))
            text_of.append(" ".join([self.v.tokens[j] for j in ids]))
        for document in documents:
            order = document.tolist()
            yield (
                int(counts[document].sum()),
                " ".join([ids_of[j] for j in order]),
                " ".join([text_of[j] for j in order]),
            )


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _encoded(shared, full: bool):
    names = ["key", "n_tokens", "ids", "decoded"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(shared.value)

        def done(keys: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
            rows = [[], [], []]
            held = 0
            start = 0
            for i, (n, ids, text) in enumerate(encoder.encode(texts)):
                values = (n, ids, text) if full else (n, _digest(ids), _digest(text))
                for column, value in zip(rows, values, strict=True):
                    column.append(value)
                held += len(ids) if full else 0
                if held > CHUNK_CHARS or i == len(texts) - 1:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[start : i + 1], pa.int64()), pa.array(rows[0], pa.int64()),
                         pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())],
                        names=names,
                    )
                    rows, held, start = [[], [], []], 0, i + 1

        keys, texts, held = [], [], 0
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                keys.append(key)
                texts.append(text.as_py() or "")
                held += len(texts[-1])
                if held > CHUNK_CHARS:
                    yield from done(keys, texts)
                    keys, texts, held = [], [], 0
        if texts:
            yield from done(keys, texts)

    return emit


def _run(docs: DataFrame, path: str, key: str, text: str, full: bool) -> DataFrame:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary.load(path))
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(
        _encoded(shared, full), "key bigint, n_tokens bigint, ids string, decoded string"
    )


def encode_documents(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_tokens, ids array<int>, decoded) of every row of ``docs``."""
    ids = F.when(F.col("ids") == "", F.array().cast("array<int>")).otherwise(
        F.split("ids", " ").cast("array<int>")
    )
    return _run(docs, vocabulary, key, text, True).select(
        F.col("key").alias("doc_id"), "n_tokens", ids.alias("ids"), "decoded"
    )


def encoding_digests(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of ``docs``.

    A null text is empty and has no tokens; rows repeat as they are given; an empty table
    gives an empty one; other columns play no part. The strings of special tokens are
    special tokens.
    """
    return _run(docs, vocabulary, key, text, False).select(
        F.col("key").alias("doc_id"), "n_tokens",
        F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"),
    )
