"""Token counts and cross-tokenizer alignment against the public libraries."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from limpid.llm import alignment, token_counts
from limpid.llm.queries import QUERIES
from tests.llm.conftest import CORPUS, SCHEMA, SF, bag

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def odd_texts(n=300):
    rng = random.Random(3)
    signs = "ab  ▁\t\n1é日😀  \x1c<|>'seng"
    mixed = ["".join(rng.choices(signs, k=rng.randint(1, 40))) for _ in range(n)]
    return [
        *mixed, " ", "  ", "a ", " a", "a  b ", "▁", "a▁b", "<|endoftext|> x <s> </s> <unk> <0x41>", "\x00", "​",
        "a" * 5000, "日" * 3000, " " * 2000, "don't you're we'll", "x\r\n y", "é é",
    ]


@pytest.fixture(scope="module")
def rows():
    odd = odd_texts()
    return [(i, t) for i, t, *_ in CORPUS] + list(enumerate([*odd, odd[0], odd[0]], 100_000))


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0, 1, 2, 3, 4, 5) for i, t in rows], SCHEMA).repartition(3)


def plain_counts(rows):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = [(i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in rows]
    return sorted([(i, b, n, n > 4096) for i, b, n in found], key=str)


def test_counts_equal_the_library(table, rows):
    assert bag(token_counts.token_counts(table, PIECES)) == plain_counts(rows)


def test_counts_with_a_table_of_stretches_that_starts_afresh(table, rows, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 50)
    ranks = token_counts.piece_ranks(PIECES)
    counts = token_counts.StretchCounts(ranks)
    assert [(n, counts.of_text(t or "")) for n, (_, t) in enumerate(rows)] == [
        (n, token_counts.StretchCounts(ranks).of_text(t or "")) for n, (_, t) in enumerate(rows)
    ]


def test_counts_of_the_given_table(spark, documents):
    given = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert bag(QUERIES["op13_token_counts"](spark, SF)) == plain_counts(given)


def test_a_vocabulary_of_another_kind_is_refused():
    with pytest.raises(ValueError):
        alignment.Tokenizers.check(WORDS, PIECES)


def plain_alignment(rows):
    """Every text by itself, every link listed."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    signs = [n for n in range(256) if chr(n).isprintable() and n not in (32, 0xA0, 0xAD)]
    byte_of = {chr(n): n for n in signs} | {
        chr(256 + k): n for k, n in enumerate(x for x in range(256) if x not in signs)
    }

    def spans(tokens):
        ends, at = [], 0
        for token in tokens:
            ends.append((at, at + len(token)))
            at += len(token)
        return ends

    shown, counts = [], Counter()
    for _, text in rows:
        found = None
        if text:
            raw = (" " + text).encode()
            code = a.encode(" " + text, add_special_tokens=False)
            side_a = [bytes(byte_of[c] for c in t) for t in code.tokens]
            ids_b = b.encode(text)
            names = [b.id_to_piece(i) for i in ids_b]
            side_b = [
                bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in zip(ids_b, names, strict=True)
            ]
            if b"".join(side_a) == raw == b"".join(side_b):
                at_a, at_b = spans(side_a), spans(side_b)
                ends = sorted({e for _, e in at_a} & {e for _, e in at_b})
                groups = [
                    tuple(
                        [i for i, (s, e) in zip(ids, at, strict=True) if low <= s and e <= high]
                        for ids, at in ((code.ids, at_a), (ids_b, at_b))
                    )
                    for low, high in zip([0, *ends], ends, strict=False)
                ]
                links = Counter((x, y) for p, q in groups for x in p for y in q)
                counts.update(links.keys())
                text_of = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
                found = (len(code.ids), len(ids_b), len(groups), links, hashlib.sha256(text_of.encode()).hexdigest())
        shown.append(found)
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for (i, _), found in zip(rows, shown, strict=True):
        if found is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, digest = found
        best = sum(m for p, m in links.items() if counts[p] == most[p[0]])
        total = sum(m * counts[p] for p, m in links.items())
        out.append((i, n_a, n_b, n_groups, sum(links.values()), best, total, digest))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def short(rows):
    """Brute force lists every span per group; long texts are compared by the given table."""
    return [(i, t) for i, t in rows if len(t or "") < 1500]


def test_alignment_equals_brute_force(spark, short):
    table = spark.createDataFrame([(i, t, "en", "s", 0, 1, 2, 3, 4, 5) for i, t in short], SCHEMA).repartition(3)
    assert bag(alignment.token_alignment(table, BYTES, PIECES)) == plain_alignment(short)


@pytest.mark.parametrize(("few", "remembered", "block"), [(0, 10, 100), (1, 4 << 20, 1), (4096, 10, 4 << 20)])
def test_blocks_of_any_size_align_alike(short, monkeypatch, few, remembered, block):
    monkeypatch.setattr(alignment, "FEW", few)
    monkeypatch.setattr(alignment, "REMEMBERED", remembered)
    aligner = alignment.BlockAligner(alignment.Tokenizers(BYTES, PIECES))
    texts = [t for _, t in short if t]
    want = [r for r in plain_alignment([(n, t) for n, t in enumerate(texts)])]
    want = {r[0]: r for r in want}
    at = 0
    while at < len(texts):
        piece, size = [], 0
        while at + len(piece) < len(texts) and size < block:
            piece.append(texts[at + len(piece)])
            size += len(piece[-1])
        measures, groups, owner, pair, times = aligner.block(piece)
        for n, row in enumerate(measures.tolist()):
            assert tuple(row) == want[at + n][1:5], piece[n]
            assert hashlib.sha256(groups[n].encode()).hexdigest() == want[at + n][7] or not row[0]
            assert int(times[owner == n].sum()) == row[3] and len(set(pair[owner == n].tolist())) == (owner == n).sum()
        at += len(piece)


class Heard(alignment.Tokenizers):
    """Keeps what the libraries are asked to encode."""

    def __init__(self):
        super().__init__(BYTES, PIECES)
        self.asked = []

    def ids(self, texts):
        self.asked.append(list(texts))
        return super().ids(texts)


def test_common_stretches_outlive_the_bound(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 400)
    heard = Heard()
    aligner = alignment.BlockAligner(heard)
    for block in range(20):
        rare = " ".join(f"rare{block}x{n}" for n in range(40))
        measures, groups, _, _, _ = aligner.block([f"the of the of the of {rare} the of"])
        n_a, n_b = (len(x[0]) for x in heard.ids([f"the of the of the of {rare} the of"]))
        heard.asked.pop()
        assert measures[0].tolist()[:2] == [n_a, n_b]
        assert groups[0].count(";") + 1 == measures[0][2]
        assert aligner.held < 1000
    asked = " ".join(t for texts in heard.asked for t in texts).split(" ")
    assert (asked.count("the"), asked.count("of")) == (1, 1)


def test_stretches_are_encoded_in_lines():
    heard = Heard()
    alignment.BlockAligner(heard).block([" ".join(f"word{n}" for n in range(1000))])
    assert sum(map(len, heard.asked)) <= 100


def test_lines_with_a_text_that_does_not_come_back():
    # The sign of a blank comes back as a blank; its neighbours in the line keep their tokens.
    texts = ["one two", "a▁b c", "three", "", "four ", " five", "é  six"]
    units, alone = alignment.Units(), alignment.Units()
    both = alignment.Tokenizers(BYTES, PIECES)
    both.align(units, texts)
    for text in texts:
        both.align(alone, [text])
    assert (units.groups, units.sound, units.measures) == (alone.groups, alone.sound, alone.measures)
    assert (units.pairs, units.times, units.starts) == (alone.pairs, alone.times, alone.starts)
    assert units.sound == bytes([1, 0, 1, 1, 1, 1, 1])


def test_lines_that_are_not_given_back_are_encoded_text_by_text():
    class Dropping(Heard):
        def ids(self, texts):
            a, b = super().ids(texts)
            return [x[:-1] if " " in t else x for t, x in zip(texts, a, strict=True)], b

    texts = ["one", "twofold", "three", "über", "日本"]
    dropping, units, alone = Dropping(), alignment.Units(), alignment.Units()
    dropping.align(units, texts)
    alignment.Tokenizers(BYTES, PIECES).align(alone, texts, 1)
    assert [len(x) for x in dropping.asked] == [1, 5]
    assert (units.groups, units.sound, units.pairs) == (alone.groups, bytes([1] * 5), alone.pairs)


def test_alignment_of_long_texts_keeps_its_sums(spark):
    texts = ["a" * 4000, "日本" * 2000, "word " * 5000]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in alignment.token_alignment(table, BYTES, PIECES).collect()}
    both = alignment.Tokenizers(BYTES, PIECES)
    a, b = both.ids(texts)
    for n in range(len(texts)):
        assert (found[n]["n_a"], found[n]["n_b"]) == (len(a[n]), len(b[n]))
        assert found[n]["count_sum"] >= found[n]["n_links"] >= found[n]["n_groups"] > 0


def test_empty_tables(spark, empty):
    none = spark.createDataFrame([(1, None), (None, "")], "doc_id bigint, text string")
    assert alignment.token_alignment(empty, BYTES, PIECES).collect() == []
    assert token_counts.token_counts(empty, PIECES).collect() == []
    assert bag(alignment.token_alignment(none, BYTES, PIECES)) == sorted(
        [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")], key=str
    )
    assert bag(token_counts.token_counts(none, PIECES)) == sorted([(1, 0, 0, False), (None, 0, 0, False)], key=str)
