import itertools
import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from changeflow.llm import certified_packing as cp

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \t\n\r'stvrelmd0a\xa0 ß中é|<>endoftext")), max_size=60))
def test_ids_equal_the_library(text):
    assert cp.encoder(PATH).encode(text).tolist() == ids_of(text)


@pytest.mark.parametrize("text", ["a" * 9000, " " * 9000 + "x", "<|endoftext|>", "a <|endoftext|> b", "x" * 3000 + " y " * 4000, "​" * 2500, "é" * 5000])
def test_ids_of_special_and_unbroken_texts(text):
    assert cp.encoder(PATH).encode(text).tolist() == ids_of(text)


def fewest_bins(lengths, capacity):
    """The true optimum by trying, for each item in turn, every open bin and a new one."""
    best = [len(lengths)]

    def place(at, rooms):
        if len(rooms) >= best[0]:
            return
        if at == len(lengths):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[at] and rooms[k] not in rooms[:k]:
                place(at + 1, rooms[:k] + [rooms[k] - lengths[at]] + rooms[k + 1 :])
        place(at + 1, [*rooms, capacity - lengths[at]])

    place(0, [])
    return best[0]


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=9), st.integers(30, 40))
def test_bound_never_exceeds_the_optimum_nor_the_optimum_the_packing(lengths, capacity):
    items = np.array(lengths)
    bins, offsets = cp.best_fit_decreasing(items, capacity)
    optimum = fewest_bins(sorted(lengths, reverse=True), capacity)
    assert cp.lower_bound(items, capacity) <= optimum <= len(set(bins.tolist()))
    for b in set(bins.tolist()):
        spans = sorted((int(offsets[i]), int(items[i])) for i in range(len(items)) if bins[i] == b)
        assert spans[0][0] == 0 and sum(n for _, n in spans) <= capacity
        assert all(o + n == p for (o, n), (p, _) in itertools.pairwise(spans))


def test_bound_beats_the_sum_of_lengths():
    assert cp.lower_bound(np.array([600] * 9), 1024) == 9
    assert cp.lower_bound(np.array([400] * 9), 1024) == 5
    assert cp.lower_bound(np.array([], dtype=int), 1024) == 0


def check(rows, pairs, capacity):
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for spans in by_sequence.values():
        spans.sort()
        assert spans[0][0] == 0 and sum(n for _, n in spans) <= capacity
        assert all(o + n == p for (o, n), (p, _) in itertools.pairwise(spans))
    want = defaultdict(list)
    for doc_id, text in pairs:
        ids = np.array([*ids_of(text or ""), 2], dtype="<u4")
        cuts = list(range(len(ids), 0, -capacity))[::-1]
        for piece, end in enumerate(cuts):
            start = cuts[piece - 1] if piece else 0
            want[doc_id].append((piece, start, end - start, crc32(ids[start:end].tobytes())))
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in want.items()}
    return len(by_sequence)


def corpus():
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma's", "δ", "12345"]) for _ in range(rng.randint(1, 300))) for _ in range(300)]
    return list(enumerate(texts + [None, "", " ", "long text " * 5000])) + [(0, texts[0]), (0, texts[0]), (None, "x"), (None, None)]


def test_packing_is_whole_gapless_and_near_the_bound(docs_of):
    pairs = corpus()
    packed, certificates = cp.pack_documents(docs_of(pairs).withColumn("bin", F.lit("b")), PATH, group_items=60)
    rows = packed.collect()
    sequences = check(rows, pairs, 1024)
    bound = cp.lower_bound(np.array([r["length"] for r in rows if r["length"] < 1024])) + sum(r["length"] == 1024 for r in rows)
    assert bound <= sequences <= bound + 3
    proofs = certificates.collect()
    assert all(r["bound"] <= r["bins"] for r in proofs)
    assert len(proofs) > 5


def test_groups_with_gaps_exchange_documents(spark):
    # lengths where best-fit decreasing of small groups often misses the bound
    rng = random.Random(0)
    lengths = [rng.choice([170, 205, 256, 257, 341, 342, 410, 511, 513]) for _ in range(400)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long")
    packed, certificates = cp.pack(df, group_items=25)
    rows, proofs = packed.collect(), certificates.collect()
    assert sorted((r["doc_id"], r["length"]) for r in rows) == list(enumerate(lengths))
    alone = sum(r["bins"] for r in proofs if r["round"] == 0)
    used = len({r["sequence_id"] for r in rows})
    assert max(r["round"] for r in proofs) > 0 and used <= alone
    fill = defaultdict(int)
    for r in rows:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 1024


def test_ids_come_along_and_empty_tables_pack(docs_of):
    packed, _ = cp.pack_documents(docs_of([(1, "some words")]), PATH, with_ids=True)
    assert packed.first()["ids"] == [*ids_of("some words"), 2]
    packed, certificates = cp.pack_documents(docs_of([]), PATH)
    assert packed.count() == 0 and certificates.count() == 0


def test_groups_are_merged_where_no_bin_may_stay(spark):
    # even lengths never fill an odd capacity, and no group of the first round meets its bound
    rng = random.Random(2)
    for _ in range(96):
        rng.choice([300, 360, 400, 440])
    lengths = [2 * rng.randint(90, 260) for _ in range(90)]
    df = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, length long").coalesce(1)
    packed, certificates = cp.pack(df, 1025, group_items=30)
    first = [r for r in certificates.collect() if r["round"] == 0]
    assert len(first) == 3 and not any(r["kept"] for r in first)
    assert packed.select("sequence_id").distinct().count() < sum(r["bins"] for r in first)
    assert packed.count() == len(lengths) and packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1025").count() == 0


def test_exchange_goes_on_while_rounds_gain(spark):
    rng = random.Random(0)
    lengths = [rng.choice([170, 205, 256, 257, 341, 342, 410, 511, 513]) for _ in range(900)]
    df = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, length long").coalesce(1)
    packed, certificates = cp.pack(df, group_items=6)
    assert certificates.agg(F.max("round")).first()[0] > 3
    four = cp.pack(df, group_items=6, rounds=4)[0].select("sequence_id").distinct().count()
    assert packed.select("sequence_id").distinct().count() < four
    assert packed.count() == len(lengths) and packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0


def test_the_exchange_ends_once_the_whole_is_certified(spark):
    lengths = [600, 424] * 60 + [1000] * 5
    df = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, length long").coalesce(1)
    packed, certificates = cp.pack(df, group_items=125)
    assert packed.select("sequence_id").distinct().count() == 65
    rows = certificates.collect()
    assert {r["total_bound"] for r in rows} == {65} and {r["round"] for r in rows} == {0}
    # many groups, each with its own bound
    df = spark.createDataFrame([(i, 600) for i in range(90)], "doc_id long, length long").coalesce(1)
    packed, certificates = cp.pack(df, group_items=10)
    rows = certificates.collect()
    assert len(rows) > 1 and sum(r["kept"] for r in rows) == rows[0]["total_bound"] == 90
    assert packed.select("sequence_id").distinct().count() == 90


def test_merged_groups_stay_within_their_limit(spark, monkeypatch):
    rng = random.Random(3)
    lengths = [2 * rng.randint(90, 260) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, length long").coalesce(1)
    monkeypatch.setattr(cp, "MOST_ITEMS", 40)
    sizes, inner = [], cp._pack_groups
    monkeypatch.setattr(cp, "_pack_groups", lambda items, groups, salt, capacity: sizes.append(items.count() / groups) or inner(items, groups, salt, capacity))
    packed, certificates = cp.pack(df, 1025, group_items=30)
    assert len(sizes) > 1 and max(sizes) <= 40
    assert packed.select("sequence_id").distinct().count() >= certificates.first()["total_bound"]
    assert sorted(r["doc_id"] for r in packed.collect()) == list(range(200))
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1025").count() == 0
