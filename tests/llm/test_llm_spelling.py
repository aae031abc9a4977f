from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import EDGES, documents, texts

from tillstream.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(rows, one_in=199, min_chars=6, min_count=5):
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            drawn = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if drawn % one_in == 0:
                place = drawn % len(run)
                run = run[:place] + run[place + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= min_chars and n >= min_count}


def edited(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(words):
    rows, forms = {}, {}
    for word, n in words.items():
        near = [x for x in words if edited(word, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 5 * n:
            forms[word] = best
        rows[word] = (n, len(near))
    out = []
    for word, (n, near) in rows.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        out.append((word, form, root, n, near, words[form] if form else None))
    return sorted(out, key=repr)


def grouped(spark, words):
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    return sorted(map(tuple, spelling.group_variants(frame).collect()), key=repr)


def vocabulary(seed, size, letters, longest):
    draw = random.Random(seed)
    words = {}
    while len(words) < size:
        base = "".join(draw.choices(letters, k=draw.randint(6, longest)))
        words[base] = draw.randint(5, 40)
        for _ in range(draw.randint(0, 3)):
            k = draw.randrange(len(base))
            other = draw.choice([base[:k] + base[k + 1 :], base[:k] + "z" + base[k:], base[:k] + "é" + base[k + 1 :]])
            if len(other) >= 6:
                words[other] = draw.choice([5, 6, 30, 200, 1000])
    return words


@pytest.mark.parametrize(("letters", "longest"), [("ab", 8), ("abcdefgh", 9), ("aéÿßx", 14)])
def test_against_all_pairs(spark, letters, longest):
    words = vocabulary(len(letters), 150, letters, longest)
    assert grouped(spark, words) == brute(words)


def test_many_blocks_of_one_tile(spark, monkeypatch):
    """Words that share a half, cut into blocks, matrices and batches of a few words."""
    words = vocabulary(5, 300, "ab", 9)
    expected = brute(words)
    monkeypatch.setattr(spelling, "TILE_WORDS", 7)
    assert grouped(spark, words) == expected
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        assert grouped(spark, words) == expected
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_blocks_of_a_matrix(monkeypatch):
    words = sorted({"".join(w) for w in np.random.default_rng(1).choice(list("ab"), (200, 8)).tolist()})
    same = np.zeros(len(words), dtype=np.int64)
    arguments = (words, 8, same, same, same > 0)
    whole = spelling.single_edits(*arguments, same > 0)
    late = spelling.single_edits(*arguments, same == 0)
    got = {(int(a), int(b)) for a, b in zip(*whole, strict=True)} | {(int(a), int(b)) for a, b in zip(*late, strict=True)}
    expected = {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if edited(words[i], words[j])}
    assert got == expected and len(whole[0]) + len(late[0]) == len(expected)
    monkeypatch.setattr(spelling, "_BLOCK_ROWS", 3)
    monkeypatch.setattr(spelling, "_BLOCK_COLUMNS", 5)
    again = spelling.single_edits(*arguments, same > 0)
    assert sorted(zip(*again, strict=True)) == sorted(zip(*whole, strict=True))


def test_chains_and_ties(spark):
    words = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 700, "bbaaaa": 5, "cbaaaa": 25, "bcaaaa": 25}
    got = {row[0]: row for row in grouped(spark, words)}
    assert got["aaaaaa"][1:3] == ("aaaaab", "aaabbb")
    assert got["bbaaaa"][1] == "bcaaaa"
    assert sorted(got.values(), key=repr) == brute(words)


def test_long_words(spark):
    long = "ab" * 30_000
    words = {long: 100, long[1:]: 5, long[:-1]: 6, long[:20_000] + "x" + long[20_000:]: 7, "abababx": 9}
    assert grouped(spark, words) == brute(words)


def test_counts_with_typos(spark):
    draw = random.Random(3)
    pool = ["".join(draw.choices("ABcdeÉñÿ", k=draw.randint(1, 9))) for _ in range(60)]
    rows = [(k, " ".join(draw.choices(pool, k=80)) + "1x-y×÷z", "en", "a", 0) for k in range(60)]
    rows += [(None, " ".join(pool), "en", "a", 0), (None, None, None, None, None), (3, "", "en", "a", 0)]
    runs = spelling.letter_runs(documents(spark, rows, clash=True))
    got = dict(map(tuple, spelling.count_words(spelling.with_typos(runs, 7)).collect()))
    assert got == counts([row[:2] for row in rows], 7)


@pytest.mark.parametrize("rows", [EDGES, []])
def test_edges(spark, rows):
    runs = spelling.letter_runs(documents(spark, rows, clash=True))
    got = spelling.group_variants(spelling.count_words(spelling.with_typos(runs)))
    expected = brute(counts([row[:2] for row in rows]))
    assert sorted(map(tuple, got.collect()), key=repr) == expected


def test_words_without_others(spark):
    frame = texts(spark, *["lonely words"] * 5)
    runs = spelling.letter_runs(frame)
    got = spelling.group_variants(spelling.count_words(runs)).collect()
    assert [tuple(row) for row in got] == [("lonely", None, "lonely", 5, 0, None)]
