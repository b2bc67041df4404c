"""Sharding, packing and archives."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from limpid.llm import packing, sharding, warc
from tests.llm.conftest import CORPUS, bag


def test_slots_are_gapless_and_only_the_new_shard_gains(corpus):
    rows = sharding.sharded(corpus).collect()
    assert len(rows) == len(CORPUS)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 24) and 0 <= r["shard"] < 24
    assert all(sorted(s) == [*range(len(s))] for s in slots.values())
    assert {r["size"] for r in rows if r["doc_id"] in (20, 21)} == {8}
    assert len({r["shard"] for r in rows if r["doc_id"] == 3}) == 1


@pytest.mark.parametrize("partitions", ["2", "40"])
def test_rows_without_id_and_of_one_id_are_split(spark, partitions):
    rows = [(None, f"text {i % 900}") for i in range(3000)] + [(7, "x" * (i % 50)) for i in range(500)]
    rows += [(i, "t") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = sharding.sharded(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r["shard"]].append(((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]), r["slot"]))
    for members in by_shard.values():
        members.sort(key=lambda m: m[1])
        assert [slot for _, slot in members] == [*range(len(members))]
        assert [key for key, _ in members] == sorted(key for key, _ in members)


def test_small_counts_grow_from_their_own_founding_tree(spark):
    from pyspark.sql import functions as F

    with pytest.raises(ValueError, match="founding"):
        sharding.shard_tree(20)
    ids = spark.range(0, 5000)
    trees = [sharding.shard_tree(n, founding=3) for n in (3, 4, 5, 23, 24)]
    rows = ids.select(*(sharding.shard_of(F.col("id"), t).alias(f"s{i}") for i, t in enumerate(trees))).collect()
    for i, new in ((0, 3), (1, 4), (3, 23)):
        assert all(r[i + 1] in (r[i], new) for r in rows)


def test_growth_step_by_step_and_weights(spark):
    from pyspark.sql import functions as F

    ids = spark.range(0, 40_000)
    trees = [sharding.shard_tree(n) for n in (24, 25, 26, 27)]
    rows = ids.select(*(sharding.shard_of(F.col("id"), t).alias(f"s{i}") for i, t in enumerate(trees))).collect()
    for i, new in enumerate((24, 25, 26)):
        assert all(r[i + 1] in (r[i], new) for r in rows)
    counts = Counter(r[0] for r in rows)
    assert max(counts.values()) < 1.15 * 40_000 / 24 and min(counts.values()) > 0.85 * 40_000 / 24
    heavy = sharding.grown(trees[0], 24, weight=6.0)
    share = ids.select(sharding.shard_of(F.col("id"), heavy).alias("s")).where("s = 24").count() / 40_000
    assert abs(share - 6 / 30) < 0.01


def test_weight_change_moves_rows_within_its_subtree(spark):
    from pyspark.sql import functions as F

    def tree(weight):
        leaf = [sharding.Node(f"s{i}", weight if i == 0 else 1.0, i) for i in range(4)]
        racks = [sharding.inner("k0", leaf[:2]), sharding.inner("k1", leaf[2:])]
        # The rack keeps its weight, so only its own shards exchange rows.
        racks[0] = sharding.Node("k0", 2.0, None, racks[0].children)
        return sharding.Node("root", 4.0, None, tuple(racks))

    both = spark.range(0, 5000).select(
        sharding.shard_of(F.col("id"), tree(1.0)).alias("a"), sharding.shard_of(F.col("id"), tree(3.0)).alias("b")
    )
    moved = {(r["a"], r["b"]) for r in both.where("a <> b").collect()}
    assert moved == {(1, 0)}


def test_packing_is_whole_and_tight(corpus, documents):
    for docs in (corpus, documents):
        rows = packing.packed_documents(docs).collect()
        bins, pieces = defaultdict(list), defaultdict(list)
        for r in rows:
            pieces[r["doc_id"]].append(r)
            if r["n_words"]:
                bins[r["bin"]].append(r)
            else:
                assert r["bin"] is None and r["piece"] == 0
        for members in bins.values():
            at = 0
            for r in sorted(members, key=lambda r: r["position"]):
                assert r["position"] == at
                at += r["n_words"]
            assert {r["capacity"] for r in members} == {min(c for c in packing.LENGTHS if c >= at)}
        counted = Counter()
        for r in docs.select("doc_id", "text").collect():
            counted[r["doc_id"]] += len((r["text"] or "").split())
        assert {i: sum(r["n_words"] for r in p) for i, p in pieces.items()} == dict(counted)
    words = sum(r["n_words"] for r in rows)
    assert words / sum({r["bin"]: r["capacity"] or 0 for r in rows}.values()) > 0.9


def test_best_fit_takes_the_tightest_bin():
    bins, positions, capacity = packing.best_fit([6, 5, 3, 2], (4, 8))
    # 6 opens 8 (room 2), 5 opens 8 (room 3), 3 fills the second, 2 the first.
    assert bins == [0, 1, 1, 0] and positions == [0, 0, 5, 6] and capacity == [8, 8]
    assert packing.best_fit([3], (4, 8))[2] == [4]
    assert packing.best_fit([], (4, 8)) == ([], [], [])


def slow_packing(sizes, lengths, cost, least):
    """Best fit with all bins and all pieces to come looked at, one by one."""
    bins, opened, where = [], [], []
    for i, size in enumerate(sizes):
        fits = [b for b in range(len(bins)) if opened[b] - sum(bins[b]) >= size]
        if fits:
            chosen = min(fits, key=lambda b: (opened[b] - sum(bins[b]), b))
        else:
            prices = []
            for length in sorted(lengths):
                words = size
                for later in sizes[i + 1 :]:
                    if later >= least and words + later <= length:
                        words += later
                if words <= length:
                    prices.append((cost(min(c for c in lengths if c >= words)) / words, length))
            chosen = len(bins)
            opened.append(min(prices)[1])
            bins.append([])
        bins[chosen].append(size)
        where.append(chosen)
    return where, opened, [min(c for c in lengths if c >= sum(b)) for b in bins]


PERMITTED = st.sampled_from([(4, 8), (8, 16, 32), (5, 7, 40), (10,), packing.LENGTHS])


@settings(max_examples=150, deadline=None)
@given(st.data(), PERMITTED)
def test_packing_equals_a_slow_one(data, lengths):
    some = st.integers(1, max(lengths)) | st.integers(1, min(lengths))
    sizes = sorted(data.draw(st.lists(some, max_size=40)), reverse=True)

    def cost(length):
        return length * (1 + length / (8 * max(lengths)))

    slow = [slow_packing(sizes, lengths, cost, least) for least in packing.reserves(lengths)]
    for least, (where, opened, final) in zip(packing.reserves(lengths), slow):
        fast = packing.packed_with(sizes, lengths, cost, least)
        assert (fast.bins, fast.opened, fast.lengths) == (where, opened, final)
    bins, _, final = packing.best_fit(sizes, lengths, cost)
    totals = [sum(map(cost, sorted(s[2]))) for s in slow]
    best = slow[totals.index(min(totals))]
    assert (bins, final) == (best[0], best[2])


def test_a_longer_bin_wins_and_bins_shrink():
    lengths, cost = (512, 1024), packing.sequence_cost
    # Three pieces of 300 cost less in one bin of 1024 than in three of 512.
    assert packing.best_fit([300, 300, 300], lengths, cost) == ([0, 0, 0], [0, 300, 600], [1024])
    # The last one alone shrinks back to the short length.
    assert packing.best_fit([300] * 4, lengths, cost)[2] == [1024, 512]
    shrunk = 0
    rng = random.Random(3)
    for _ in range(300):
        sizes = sorted((rng.randint(1, 32) for _ in range(rng.randint(1, 12))), reverse=True)
        for least in packing.reserves((8, 16, 32)):
            found = packing.packed_with(sizes, (8, 16, 32), packing.sequence_cost, least)
            shrunk += sum(a > b for a, b in zip(found.opened, found.lengths))
    assert shrunk > 0


def test_joint_packing_costs_no_more_than_one_length_or_the_shortest(documents):
    words = [len((r["text"] or "").split()) for r in documents.select("text").collect()]
    sizes = sorted((min(n - a, 4096) for n in words for a in range(0, n, 4096)), reverse=True)

    def total(final):
        return sum(map(packing.sequence_cost, final))

    joint = total(packing.best_fit(sizes)[2])
    shortest = packing.packed_with(sizes, packing.LENGTHS, packing.sequence_cost, 4097)
    assert joint <= total(shortest.lengths) < total(packing.best_fit(sizes, (4096,))[2])


PAGES = [
    (1, "http://a/ä b", "<p>é</p>" * 200), (2, "http://a/2", "<p>é</p>" * 200), (9, None, "<p>é</p>" * 200),
    (3, "http://a/%41\r\nx: y", "short"), (4, "http://a/4", "short"), (5, "http://a/5", None), (6, "", ""),
    (7, "http://a/7", "a\r\n\r\nWARC/1.1\r\n" * 100), (8, "http://a/8", "z" * 300_000), (None, "http://n", "<p>é</p>" * 200),
    (9, None, "<p>é</p>" * 200),
]
PAGE_SCHEMA = "page_id bigint, url string, html string, digest string, archive int, offset int"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "x", 1, 2) for p in PAGES], PAGE_SCHEMA).repartition(3)


def page_rows():
    last = defaultdict(lambda: -1)
    for i, _, html in PAGES:
        if len((html or "").encode()) >= 1000:
            last[html] = max(last[html], -1 if i is None else i)
    for i, _, html in PAGES:
        data = (html or "").encode()
        to = last[html] if html in last and last[html] != i else None
        kind = "response" if to is None else "revisit"
        yield i, len(data), hashlib.sha1(data).hexdigest(), kind, to


def test_archives_round_trip(spark, pages, tmp_path, monkeypatch):
    assert bag(warc.archived_pages(pages)) == sorted(page_rows(), key=str)
    folder = str(tmp_path / "archives")
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 500)
    index = warc.write_archives(pages, folder)
    back = {(r["page_id"], r["url"]): r for r in warc.read_records(index, folder).collect()}
    assert {k[1] for k in back} == {p[1] for p in PAGES}
    for i, url, html in PAGES:
        row = back[i, url]
        if row["record_type"] == "response":
            assert bytes(row["payload"]) == (html or "").encode()
    some = index.where("page_id in (3, 8)")
    assert {r["page_id"] for r in warc.read_records(some, folder).collect()} == {3, 8}


def test_archives_of_no_pages(pages):
    assert warc.archived_pages(pages.limit(0)).collect() == []


def test_ranges_join_near_reads():
    assert warc.ranges([(0, 10), (10, 5), (40, 5), (200, 1)], gap=30, most=60) == [(0, 45, 3), (200, 201, 1)]
    assert warc.ranges([(0, 50), (50, 50)], gap=30, most=60) == [(0, 50, 1), (50, 100, 1)]
    assert warc.ranges([]) == []


def test_damage_is_found():
    data = warc.record(1, "http://x", b"payload", None)
    assert warc.parse(data)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"payload\r\n", b"Payload\r\n"))
