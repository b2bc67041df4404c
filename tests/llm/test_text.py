"""Operators on texts against brute force, edge cases included."""

from __future__ import annotations

import dataclasses
import math
import re
import types

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from limpid.llm import bpe, hashing, minhash_dedup, quality, substring_dedup, suffix_dedup
from limpid.llm.components import components, roots
from tests.llm import brute
from tests.llm.conftest import CORPUS, SF, bag, words

PAIRS = [(r[0], r[1]) for r in CORPUS]
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def pairs_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def as_bag(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("hot", [512, 2])
def test_bytes_against_brute_force(corpus, documents, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "SCHEME", dataclasses.replace(suffix_dedup.SCHEME, hot=hot))
    assert bag(suffix_dedup.duplicate_bytes(corpus)) == as_bag(brute.bytes_removed(PAIRS))
    got = bag(suffix_dedup.duplicate_bytes(documents))
    assert got == as_bag(brute.bytes_removed(pairs_of(documents)))
    assert sum(r[2] for r in got) > 0


@pytest.mark.parametrize("hot", [512, 2])
def test_words_against_brute_force(corpus, documents, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "SCHEME", dataclasses.replace(substring_dedup.SCHEME, hot=hot))
    assert bag(substring_dedup.duplicate_words(corpus)) == as_bag(brute.words_removed(PAIRS))
    got = bag(substring_dedup.duplicate_words(documents))
    assert got == as_bag(brute.words_removed(pairs_of(documents)))
    assert sum(r[2] for r in got) > 0


def test_prefixes_split_until_small():
    rng = np.random.default_rng(0)
    rows = rng.integers(1, 3, (400, substring_dedup.WIDTH)).astype(np.uint64)
    row, place = (x.ravel() for x in np.indices((400, 10)))
    parts = [*substring_dedup.prefix_parts(rows, row, place, limit=50)]
    windows = [{tuple(rows[r, p : p + 13]) for r, p in zip(*part, strict=True)} for part in parts]
    assert sum(len(p[0]) for p in parts) == 4000
    assert sum(map(len, windows)) == len(set().union(*windows))  # equal windows stay together
    assert max(len(p[0]) for p in parts) <= 50 or all(
        len(w) == 1 for p, w in zip(parts, windows, strict=True) if len(p[0]) > 50
    )


def test_window_ranks_sort_windows():
    rng = np.random.default_rng(1)
    rows = np.full((30, suffix_dedup.WIDTH), suffix_dedup.PAD, np.uint8)
    rows[:, :76] = rng.integers(97, 99, (30, 76))
    rows[10:20] = rows[:10]
    rank = suffix_dedup.window_ranks(rows)
    flat = sorted((rows[r, p : p + 50].tobytes(), rank[r, p]) for r in range(30) for p in range(27))
    assert all((a[0] == b[0]) == (a[1] == b[1]) and a[1] <= b[1] for a, b in zip(flat, flat[1:], strict=False))


def test_texts_lose_whole_characters_and_keep_columns(corpus):
    found = suffix_dedup.without_duplicate_bytes(corpus)
    assert found.columns == corpus.columns and found.count() == len(CORPUS)
    texts = {r["id"]: r["text"] for r in found.collect()}
    assert texts[6] is None or texts[6] == ""
    assert "This passage" not in texts[13] and "This passage" in texts[14]
    assert all("�" not in (t or "") for t in texts.values())


def test_near_duplicates_against_brute_force(corpus, documents):
    assert bag(minhash_dedup.near_duplicates(corpus)) == as_bag(brute.near_groups(PAIRS))
    assert bag(minhash_dedup.near_duplicates(documents)) == as_bag(brute.near_groups(pairs_of(documents)))


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_at_a_threshold(documents, percent):
    want = brute.near_groups(pairs_of(documents), percent)
    assert bag(minhash_dedup.near_duplicates(documents, percent=percent)) == as_bag(want)
    kept = minhash_dedup.without_near_duplicates(documents, percent=percent)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _, _, k in want if k)


def test_thresholds_of_the_table_differ(documents):
    rows = pairs_of(documents)
    assert as_bag(brute.near_groups(rows, 80)) != as_bag(brute.near_groups(rows, 85))


def test_sketches_grow_as_the_threshold_falls():
    assert (minhash_dedup.sketch_size(85), minhash_dedup.sketch_size(80)) == (32, 48)
    assert minhash_dedup.miss_chance(80, 32) > 3e-5 and minhash_dedup.miss_chance(80, 48) < 1e-6


def chain(n, size=80):
    """Texts whose neighbours are near and whose ends are not, and a hub of none."""
    words = [f"w{i}" for i in range(size + 3 * n)]
    return [(i, " ".join(words[3 * i : 3 * i + size])) for i in range(n)]


@pytest.mark.parametrize("tile", [512, 4])
def test_links_that_miss_the_pivot(spark, monkeypatch, tile):
    monkeypatch.setattr(minhash_dedup, "TILE", tile)
    near = []
    base = [f"b{i}" for i in range(60)]
    for i in range(40):  # near to each other in part only
        text = list(base)
        text[i] = f"own{i}"
        near.append((100 + i, " ".join(text)))
    rows = chain(30) + near
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert bag(minhash_dedup.near_duplicates(df)) == as_bag(brute.near_groups(rows))


def test_one_document_of_each_group_stays(corpus):
    kept = minhash_dedup.without_near_duplicates(corpus)
    assert kept.columns == corpus.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    wanted = {i for i, _, _, k in brute.near_groups(PAIRS) if k and i is not None}
    assert set(ids) == wanted and ids.count(3) == 2


def test_rows_of_one_id_or_none_are_judged_one_by_one(spark):
    text = [words(100 + i, 60) for i in range(7)]
    near = [t + " end" for t in text]
    rows = [
        (1, text[0]), (None, near[0]),  # a near copy of a row with an id goes alone
        (None, text[1]), (None, text[1]), (None, near[1]),  # one of three stays
        (None, text[2]), (None, None), (None, ""), (None, " "),  # nothing like them
        (2, text[3]), (5, near[3]), (5, text[4]),  # two texts under one id
        (7, text[5]), (7, text[5]), (8, text[5]),
    ]
    df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id bigint, text string, mark int")
    found = minhash_dedup.without_near_duplicates(df.repartition(4))
    assert found.columns == df.columns
    got = [(r["doc_id"], r["text"]) for r in found.collect()]
    # By brute force: every row an id of its own, those without id last, then one a group.
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is None, rows[n][0] or 0))
    own = brute.near_groups([(k, rows[n][1]) for k, n in enumerate(order)])
    kept = {order[k] for k, (_, _, _, stays) in enumerate(own) if stays} | {13}  # 7 twice, alike
    inside = [r for r in got if r[0] is None and (r[1] or "").strip()]
    assert len(got) == len(kept) and len(inside) == 2
    assert as_bag(r for r in got if r not in inside) == as_bag(
        rows[n] for n in kept if rows[n][0] is not None or not (rows[n][1] or "").strip()
    )
    assert {r[1] in (text[2],) for r in inside} == {True, False}
    assert {r[1] for r in inside} - {text[2]} <= {text[1], near[1]}


def test_common_counts_are_exact():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, 40)) for _ in range(9)]
    found = minhash_dedup.common_counts(sets, np.arange(4), np.arange(3, 9))
    assert found.tolist() == [[len(np.intersect1d(sets[i], sets[j])) for j in range(3, 9)] for i in range(4)]


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))]
    links += [(1000 + i, 1001 + i) for i in range(200)] + [(5000, i) for i in range(5001, 5100)]
    ids = sorted({i for link in links for i in link})
    want = brute.smallest(ids, links)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint").repartition(7)).collect()}
    assert {i: got.get(i, i) for i in ids} == want
    assert roots(4, np.array([3, 1]), np.array([1, 2])).tolist() == [0, 1, 1, 1]


ODD = [
    "", " ", "aaaa aaaaaaa aaa", "Hello<|endoftext|>World <|startoftext|>", "<|ENDOFTEXT|> x",
    "ΣΑΣ ΟΔΟΣ. İstanbul ﬁ Å é \x1c\x1d\x85　 a\x1cb", "it's we'll I'D don''t 's", "12345 ①²½ 😀😀👍🏽 --- ...!!",
    "<<|endoftext|>", "a\x00b ​", "नमस्ते दुनिया", "<|<|endoftext|>|>", "'re're" + "x" * 300, "ͅᾼ",
]


def test_encoding_equals_the_library(spark, corpus, documents):
    library = Tokenizer.from_file(VOCABULARY)
    rows = [*enumerate(ODD), (99, None)] + pairs_of(documents) + PAIRS
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), brute.sha(" ".join(map(str, ids)).encode()), brute.sha(decoded.encode())))
    assert bag(bpe.encoding_digests(df, VOCABULARY)) == as_bag(want)
    full = bpe.encode_documents(corpus, VOCABULARY).collect()
    assert {(r["doc_id"], r["n_tokens"]) for r in full} == {
        (i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in PAIRS
    }
    assert all(len(r["ids"]) == r["n_tokens"] for r in full)


def test_scores_learn_from_other_rows_only(spark, documents):
    labels = spark.read.parquet(f"{SF.replace('0.001', '0.1')}/labels.parquet")
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.1')}/documents.parquet")
    found = quality.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in found) / len(found)
    good = [r["predicted"] for r in found if r["quality"] == 1]
    assert len(found) > 800 and right > 0.95 and sum(good) / len(good) > 0.98
    # Held-out labels and other columns change nothing.
    from pyspark.sql import functions as F

    turned = labels.withColumn(
        "quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    sample = docs.where("doc_id < 300")
    one = bag(quality.quality_scores(sample, labels))
    other = bag(quality.quality_scores(sample.withColumn("lang", F.lit("xx")), turned))
    assert one == other


def test_scores_with_columns_named_as_inside(spark, corpus):
    from pyspark.sql import functions as F

    labels = spark.createDataFrame([(3, 1, 0), (6, 0, 0)], "doc_id bigint, quality int, toxic int")
    clash = corpus
    for name in ("good", "_id", "_key", "_text", "place", "rest", "score", "quality", "slots"):
        clash = clash.withColumn(name, F.lit("x"))
    assert bag(quality.quality_scores(clash, labels)) == bag(quality.quality_scores(corpus, labels))
    kept = quality.accepted(clash, labels)
    assert kept.columns == clash.columns
    same = [c for c in corpus.columns if c != "rest"]
    assert bag(kept, *same) == bag(quality.accepted(corpus, labels), *same)


def test_scores_of_odd_texts(spark, corpus):
    labels = spark.createDataFrame([(3, 1, 0), (6, 0, 0), (30, None, 1), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    found = quality.quality_scores(corpus, labels).collect()
    assert len(found) == len(CORPUS)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in found)
    alike = {r["score"] for r in found if r["doc_id"] in (20, 21)}
    assert len(alike) == 1
    none = quality.quality_scores(corpus, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {1.0}
    assert quality.accepted(corpus, labels.limit(0)).count() == len(CORPUS)


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for found in (
        suffix_dedup.duplicate_bytes(empty), substring_dedup.duplicate_words(empty),
        minhash_dedup.near_duplicates(empty), bpe.encoding_digests(empty, VOCABULARY),
        quality.quality_scores(empty, labels), minhash_dedup.without_near_duplicates(empty),
    ):
        assert found.collect() == []


def slow_score(text, model):
    """Word by word and character by character, with the library's hashes of single numbers."""
    number = hashing.U64
    table, bias = model.bucket_logits()
    shift, mask = 64 - quality.BUCKETS.bit_length() + 1, (1 << 64) - 1

    def mix(x):
        return int(hashing.mixed(np.array([x & mask], number))[0])

    found = []
    # Blanks end a run and count inside it as one kind.
    chars = [" " if c in " \t\n\v\f\r" else c for c in f" {text} "]
    codes = [int.from_bytes(c.encode(), "little") for c in chars]
    for i in range(len(chars)):
        for n in quality.LENGTHS:
            if i + n > len(chars) or " " in chars[i + 1 : i + n - 1]:
                continue
            run = codes[i]
            for code in codes[i + 1 : i + n]:
                run = mix(run * int(hashing.STEP) + code)
            found.append(run)
    plain = []
    for word in re.findall(r"[^\x20\x09-\x0D]+", text):
        data = np.frombuffer(word.encode(), np.uint8)
        plain.append(int(hashing.word_hashes(data, np.array([0]), np.array([len(data)]))[0]))
    found += [mix(w) for w in plain]
    found += [mix(b - a + int(hashing.STEP)) for a, b in zip(plain, plain[1:])]
    total = sum(int(table[h >> shift]) for h in found)
    logit = total / (quality.UNIT * max(len(found), 1)) + bias
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, logit))))


def test_scores_equal_a_slow_average_over_characters(spark, corpus, monkeypatch):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(spark.read.parquet(f"{SF}/documents.parquet"), labels, sample=200)
    texts = [r[1] for r in CORPUS if len(r[1] or "") < 5000]
    texts += ["日本語 テスト", "é", "éa\tßß\u2003x", "😀😀 a😀b", "a", " ", "\u00a0", "naïve café\nÅngström"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").coalesce(2)
    want = [pytest.approx(slow_score(t or "", model), rel=1e-12) for t in texts]
    got = quality.scored(rows, model, carried=["doc_id"]).collect()
    assert [r["score"] for r in sorted(got, key=lambda r: r["rest"][0])] == want
    # In pieces of seven characters, all texts in one batch.
    monkeypatch.setattr(quality, "PIECE", 7)
    batch = pa.RecordBatch.from_pydict(
        {"rest": list(range(len(texts))), "text": [f" {t or ''} ".encode() for t in texts]}
    )
    shared = types.SimpleNamespace(value=model.bucket_logits())
    assert pa.Table.from_batches(quality._scored(shared)([batch])).column("score").to_pylist() == want


def test_characters_of_broken_text():
    data = np.frombuffer(b"a\x80\x80\x80\x80\x80b\xc3\xa9\xe2\x82", np.uint8)
    values, bounds = quality.characters(data, np.array([0, 2, 2, 8, 11]))
    # A stray byte that begins a text is a character of its own.
    assert values.tolist() == [0x8061, 0x80808080, 0x62, 0xC3, 0xA9, 0x82E2]
    assert bounds.tolist() == [0, 1, 1, 4, 6]
