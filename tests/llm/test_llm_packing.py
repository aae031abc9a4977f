from __future__ import annotations

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import EDGES, documents, texts
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from tillstream.llm import packing
from tillstream.session import materialize

PATH = public_tokenizers.path("word_bpe_49k.json")


def library_ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


def subset_sums(left, room):
    sums = {0}
    for length, count in left.items():
        sums = {s + k * length for s in sums for k in range(count + 1) if s + k * length <= room}
    return sums


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 25), st.integers(0, 3), max_size=5), st.integers(0, 40))
def test_fullest_is_the_largest_sum(left, room):
    chosen = packing.fullest(left, room)
    assert all(0 < times <= left[length] for length, times in chosen)
    assert sum(length * times for length, times in chosen) == max(subset_sums(left, room))


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), max_size=12))
def test_plan_places_every_piece_once(counts):
    plan = packing.plan_bins(counts, 50)
    used = {}
    for combination, bins in plan:
        assert bins > 0 and sum(length * times for length, times in combination) <= 50
        for length, times in combination:
            used[length] = used.get(length, 0) + bins * times
    assert used == counts


def test_plan_is_near_the_least_number_of_bins():
    rng = random.Random(5)
    counts = {}
    for _ in range(20_000):
        length = min(4096, int(rng.lognormvariate(6.5, 1.2)) + 1)
        counts[length] = counts.get(length, 0) + 1
    plan = packing.plan_bins(counts, 4096)
    bins = sum(bins for _, bins in plan)
    assert bins <= math.ceil(sum(n * k for n, k in counts.items()) / 4096) * 1.001 + 1
    assert len(plan) < 3 * len(counts)


def check(placed, capacity):
    """Sequences without gaps, overlaps or too many ids."""
    by_sequence = {}
    for row in placed:
        by_sequence.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_pieces_of_long_documents(spark):
    long = " ".join(f"word{k}" for k in range(300))
    rows = packing.pack(texts(spark, "a b c", long, None, ""), PATH, capacity=64).collect()
    pieces = {}
    for row in sorted(rows, key=lambda row: (row["doc"], row["piece"])):
        pieces.setdefault(row["doc"], []).append(row)
    for doc, text in ((1, "a b c"), (2, long), (3, None), (4, "")):
        ids = [*library_ids(text), 1]
        assert [row["piece"] for row in pieces[doc]] == list(range(math.ceil(len(ids) / 64)))
        for row in pieces[doc]:
            part = ids[row["start"] : row["start"] + 64]
            assert row["length"] == len(part)
            assert row["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    check(rows, 64)


def test_sequences_hold_the_ids(spark):
    values = [" ".join(f"w{k * n % 31}" for k in range(5 + 7 * n % 40)) for n in range(60)]
    packed = materialize(packing.pack(texts(spark, *values), PATH, capacity=64, with_ids=True))
    filled = {row["sequence_id"]: row["ids"] for row in packing.sequences(packed).collect()}
    for row in packed.collect():
        part = filled[row["sequence_id"]][row["offset"] : row["offset"] + row["length"]]
        assert part == row["ids"]
        ids = [*library_ids(values[row["doc"] - 1]), 1]
        assert ids[row["start"] : row["start"] + row["length"]] == part
    assert sum(map(len, filled.values())) == sum(row["length"] for row in packed.collect())


def test_hot_length(spark, monkeypatch):
    """One length in most rows, numbered over many groups."""
    monkeypatch.setattr(packing, "GROUP_ROWS", 20)
    rows = [(k, 0, 8 if k % 4 else 1 + k % 30, 0) for k in range(1000)]
    pieces = materialize(spark.createDataFrame(rows, "doc long, piece int, length long, ids_crc32 long"))
    placed = packing.place_pieces(pieces, ["doc", "piece", "ids_crc32"], 32).collect()
    assert len(placed) == 1000
    assert check(placed, 32) <= math.ceil(sum(row[2] for row in rows) / 32) + 2


def test_equal_rows_spread_over_groups(spark, monkeypatch):
    """Thousands of rows without id and of one text: no window gets more than a few groups' worth."""
    monkeypatch.setattr(packing, "GROUP_ROWS", 50)
    sizes = []
    number = packing.numbered

    def watched(pieces, counts, order):
        group = F.pmod(F.xxhash64(*order), F.lit(pieces.count() // 50 + 1))
        sizes.append(pieces.groupBy("length", group).count().agg(F.max("count")).first()[0])
        return number(pieces, counts, order)

    monkeypatch.setattr(packing, "numbered", watched)
    frame = documents(spark, [(None, "a b c d e f", "en", "a", 0)] * 4000)
    packed = packing.pack(frame, PATH)
    assert packed.columns == ["doc", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = packed.collect()
    assert len(rows) == 4000 and sizes[0] < 150
    assert check(rows, 4096) == math.ceil(sum(row["length"] for row in rows) / (4096 // rows[0]["length"] * rows[0]["length"]))


@pytest.mark.parametrize("clash", [False, True])
def test_edges(spark, clash):
    rows = packing.pack(documents(spark, EDGES, clash), PATH).collect()
    assert sum(row["length"] for row in rows) == sum(len(library_ids(row[1])) + 1 for row in EDGES)
    assert sum(row["doc"] is None for row in rows) == 1
    assert sum(row["doc"] == 5 for row in rows) == 2
    check(rows, 4096)


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), PATH).collect() == []
