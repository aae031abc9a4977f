from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from llm_fixtures import EDGES, documents

from tillstream.llm import ngram_join
from tillstream.llm.components import components


def gram_set(text, words):
    lowered = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
    for space in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(space, " ")
    parts = [x for x in lowered.split(" ") if x]
    size = min(words, len(parts))
    return {tuple(parts[k : k + size]) for k in range(len(parts) - size + 1)} if parts else set()


def brute(rows, words, similarity):
    """Components by comparing all pairs; rows of one id are one document."""
    numerator, denominator = similarity
    sets = [(doc, gram_set(text, words)) for doc, text, *_ in rows]
    parent = {doc: doc for doc, _ in sets if doc is not None}

    def find(doc):
        while parent[doc] != doc:
            doc = parent[doc]
        return doc

    for (a, x), (b, y) in combinations([s for s in sets if s[0] is not None and s[1]], 2):
        common = len(x & y)
        if denominator * common >= numerator * (len(x) + len(y) - common):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return sorted(((doc, len(s), None if doc is None else find(doc)) for doc, s in sets), key=repr)


def check(spark, rows, words=3, similarity=(90, 100), clash=False):
    found = ngram_join.similar_documents(
        documents(spark, rows, clash), words=words, similarity=similarity
    )
    expected = brute(rows, words, similarity)
    assert sorted(map(tuple, found.collect()), key=repr) == expected
    return expected


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(40)}"
    return " ".join(words)


def corpus(seed, similar=60, others=60):
    """Copies with more and less edits of two texts, and texts that share a passage with all."""
    rng = random.Random(seed)
    bases = [[f"b{n}w{rng.randrange(200)}" for _ in range(n)] for n in (50, 90)]
    passage = [f"p{k}" for k in range(30)]
    texts = [edited(rng, rng.choice(bases), rng.randrange(9)) for _ in range(similar)]
    texts += [
        " ".join([f"o{rng.randrange(60)}" for _ in range(rng.randrange(1, 30))] + passage)
        for _ in range(others)
    ]
    texts += [" ".join(passage)] * 5 + ["a b", "a b", "A b", "a", "", " \n"]
    rng.shuffle(texts)
    return [(k * 3 % 401, text, "en", "a", 0) for k, text in enumerate(texts)]


@pytest.mark.parametrize(
    ("seed", "words", "similarity"), [(1, 3, (90, 100)), (2, 5, (80, 100)), (3, 1, (50, 100))]
)
def test_same_components_as_all_pairs(spark, seed, words, similarity):
    expected = check(spark, corpus(seed), words, similarity)
    assert len({row[2] for row in expected}) < len(expected) - 10


def test_links_that_the_hubs_miss(spark):
    """A chain of edits: its ends are not similar, and hubs alone do not connect it."""
    words = [f"w{k}" for k in range(100)]
    rows = []
    for k in range(30):
        rows.append((100 - k, " ".join(words), "en", "a", 0))
        words[(k * 3) % 100] = f"x{k}"
    assert len({row[2] for row in check(spark, rows)}) == 1


def passages(seed, texts, pool=40, each=9):
    """Unlike texts made of shared passages: all their rare tokens are those of many texts."""
    rng = random.Random(seed)
    parts = [" ".join(f"p{k}w{j}" for j in range(60)) for k in range(pool)]
    return [(k, " ".join(rng.sample(parts, each)), "en", "a", 0) for k in range(texts)]


def test_unlike_texts_of_shared_passages_leave_no_pairs(spark, monkeypatch):
    """The pairs that leave the tiles do not grow with the square of the group."""
    counts = []
    met_in_tiles = ngram_join._met_in_tiles

    def counted(*arguments):
        met = met_in_tiles(*arguments)
        counts.append(met.count())
        return met

    monkeypatch.setattr(ngram_join, "_met_in_tiles", counted)
    monkeypatch.setattr(ngram_join, "PAIRED", 4)
    for texts in (150, 600):
        counts.clear()
        rows = passages(texts, texts)
        found = ngram_join.similar_documents(documents(spark, rows), words=5, similarity=(80, 100))
        assert found.where("doc <> component").count() == sum(x[0] != x[2] for x in brute(rows, 5, (80, 100)))
        assert len(counts) == 1 and counts[0] <= texts


@pytest.mark.parametrize("rows", [4, 1024])
def test_tiles_find_what_hubs_do_not(spark, monkeypatch, rows):
    """Without pairs of small groups, in tiles of a few members and of many."""
    monkeypatch.setattr(ngram_join, "TILE_ROWS", rows)
    monkeypatch.setattr(ngram_join, "PAIRED", 2)
    mixed = corpus(8, 50, 30) + [(1000 + k, text, *rest) for k, text, *rest in passages(3, 40, 12, 9)]
    check(spark, mixed, 5, (80, 100))


def test_tallies_of_sets_of_any_size():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2)) for size in (1, 70, 500, 2000)]
    sets.append(np.arange(5000, dtype=np.uint64))
    tallies = [ngram_join._tally(x) for x in sets]
    assert len(tallies[-1]) == 0
    folded, none = ngram_join._folded(tallies)
    assert none.tolist() == [False] * 4 + [True]
    assert [int(x.sum()) for x in folded[:4]] == [len(x) for x in sets[:4]]
    coarse = [ngram_join._coarse_tally(x) for x in sets]
    assert [len(x) for x in coarse[:4]] == [64, 64, 64, 256] and len(coarse[4]) == 0
    assert [int(x.sum()) for x in coarse[:4]] == [len(x) for x in sets[:4]]


def test_exactly_at_the_threshold(spark):
    words = [f"w{k}" for k in range(21)]
    rows = [(1, " ".join(words[:20]), "", "", 0), (2, " ".join(words[:18]), "", "", 0)]
    rows += [(3, " ".join(words[:17]), "", "", 0), (4, " ".join(words), "", "", 0)]
    check(spark, rows, 1, (90, 100))
    check(spark, rows, 1, (86, 100))


@pytest.mark.parametrize("clash", [False, True])
def test_edges(spark, clash):
    check(spark, EDGES, clash=clash)


def test_one_id_with_several_texts(spark):
    """Its texts make one document, which links through any of them."""
    rows = [(5, "a b c d", "", "", 0), (5, "k l m n", "", "", 0), (7, "a b c d", "", "", 0)]
    rows += [(3, "k l m n", "", "", 0), (9, None, "", "", 0), (5, "", "", "", 0)]
    got = {(row[0], row[2]) for row in check_rows(spark, rows)}
    assert got == {(5, 3), (7, 3), (3, 3), (9, 9)}


def check_rows(spark, rows):
    return [tuple(row) for row in ngram_join.similar_documents(documents(spark, rows), words=3).collect()]


def test_empty_table(spark):
    assert check_rows(spark, []) == []
    assert {row[2] for row in check_rows(spark, [(1, None, "", "", 0), (2, "", "", "", 0)])} == {1, 2}


def test_copies_are_one_node(spark):
    """A group of copies is a third of all rows; its tokens are compared once."""
    rows = corpus(6, 40, 40)
    rows += [(1000 + k, rows[0][1], "en", "a", 0) for k in range(60)]
    check(spark, rows)


def test_larger_tables_take_the_other_join(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "fits_broadcast", lambda ids: False)
    check(spark, corpus(4, 30, 20))


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    links += [(100 + k, 101 + k) for k in range(40)] + [(200, 200 + k) for k in range(1, 50)] + [(7, 7)]
    parent = list(range(300))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    nodes = {x for a, b in links if a != b for x in (a, b)}
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, find(x)) for x in nodes)


def test_components_without_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
