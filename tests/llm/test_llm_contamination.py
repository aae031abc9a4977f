from __future__ import annotations

import random
import re

import numpy as np
import pytest
from llm_fixtures import EDGES, documents
from pyspark.sql import functions as F

from tillstream.llm import inverted_index
from tillstream.session import scratch_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def windows(text, size):
    w = words(text)
    return [w[k : k + size] for k in range(max(len(w) - size + 1, 1))] if w else []


def ends(w, begin, window, slop):
    """The place behind the first match in order that begins there, if it is short enough."""
    here = begin
    for word in window[1:]:
        here = next((k for k in range(here + 1, min(begin + len(window) + slop, len(w))) if w[k] == word), None)
        if here is None:
            return None
    return here + 1


def brute(rows, items, size=10, slop=0):
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for item, item_text in items:
            for window in windows(item_text, size):
                for begin in range(len(w)):
                    if w[begin] == window[0] and (stop := ends(w, begin, window, slop)):
                        hit |= set(range(begin, stop))
                        found.add("" if item is None else str(item))
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def found(spark, rows, items, **options):
    frame = rows if hasattr(rows, "columns") else documents(spark, rows)
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = inverted_index.find_contamination(frame, tests, scratch_path(spark, "index"), **options)
    out = []
    for row in got.collect():
        spans = row.spans or []
        covered = {k for s in spans for k in range(s.starts, s.stops)}
        assert len(covered) == row.n_hit
        out.append((row.doc, row.n_words, row.n_hit, row["items"]))
    return sorted(out, key=repr)


def random_case(seed, docs=60, pool=12, length=60):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choices("abÉc7", k=draw.randint(1, 3))) for _ in range(pool)]
    rows = [(k, " ".join(draw.choices(vocabulary, k=draw.randint(0, length))), "en", "a", 0) for k in range(docs)]
    items = []
    for k in range(12):
        w = words(draw.choice(rows)[1])
        at = draw.randrange(max(len(w) - 8, 1))
        items.append((k % 9, " - ".join(w[at : at + draw.randint(1, 8)]).upper()))
    return rows, items


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("slop", [0, 2])
def test_against_brute_force(spark, seed, slop):
    rows, items = random_case(seed)
    expected = brute([row[:2] for row in rows], items, size=4, slop=slop)
    assert found(spark, rows, items, size=4, slop=slop) == expected
    assert any(row[2] for row in expected)


def test_many_segments_and_blocks(spark, monkeypatch):
    rows, items = random_case(9, docs=80)
    expected = brute([row[:2] for row in rows], items, size=3)
    monkeypatch.setattr(inverted_index, "SEGMENT_BYTES", 300)
    monkeypatch.setattr(inverted_index, "WINDOW_BLOCK", 5)
    monkeypatch.setattr(inverted_index, "_CANDIDATES", 4)
    assert found(spark, rows, items, size=3) == expected


def test_phrases_do_not_cross_documents(spark):
    text = " ".join(f"w{k}" for k in range(10))
    rows = [(1, "w0 w1 w2 w3 w4", "en", "a", 0), (2, "w5 w6 w7 w8 w9", "en", "a", 0), (3, f"x {text} y", "en", "a", 0)]
    for slop in (0, 3, inverted_index.MAX_SLOP):
        got = found(spark, rows, [(4, text)], slop=slop)
        assert got == [(1, 5, 0, []), (2, 5, 0, []), (3, 12, 10, ["4"])]


def test_proximity(spark):
    text = " ".join(f"w{k}" for k in range(10))
    spread = text.replace("w4", "w4 um er")
    rows = [(1, spread, "en", "a", 0), (2, text, "en", "a", 0), (3, text.replace("w4 w5", "w5 w4"), "en", "a", 0)]
    assert [row[2] for row in found(spark, rows, [(4, text)])] == [0, 10, 0]
    assert [row[2] for row in found(spark, rows, [(4, text)], slop=1)] == [0, 10, 0]
    assert [row[2] for row in found(spark, rows, [(4, text)], slop=2)] == [12, 10, 0]
    with pytest.raises(ValueError, match="slop"):
        found(spark, rows, [(4, text)], slop=99)


def test_edges(spark):
    tests = [(1, None), (2, ""), (None, "without an ID"), (3, " ".join(f"word{k}" for k in range(500, 520)))]
    tests += [(12, "text"), (12, "twice."), (2, "日本語"), (2, "日本語"), (5, "---"), (100, "same text")]
    expected = brute([row[:2] for row in EDGES], tests)
    frame = documents(spark, EDGES, clash=True).withColumn("segment", F.lit("x"))
    assert found(spark, frame, tests) == expected
    assert found(spark, [], tests) == []
    assert found(spark, EDGES, []) == sorted([(d, len(words(t)), 0, []) for d, t, *_ in EDGES], key=repr)


def test_items_that_share_windows(spark):
    """Passages in many documents and in many items."""
    passage = " ".join(f"p{k}" for k in range(30))
    tests = [(k, passage + f" end{k}") for k in range(50)] + [(99, passage)]
    rows = [(k, f"own{k} {passage}" + (f" end{k}" if k % 2 else ""), "en", "a", 0) for k in range(40)]
    assert found(spark, rows, tests) == brute([row[:2] for row in rows], tests)


def test_hashes_of_long_texts(monkeypatch):
    text = ("Ärger " + "x" * 70 + " " + "y" * 500 + " Z9 ").encode() * 30 + b"tail"
    whole = inverted_index.word_hashes(text)
    assert len(whole) == 121 and len(set(whole.tolist())) == 5
    for piece in (1, 64, 500, 2000):
        monkeypatch.setattr(inverted_index, "_PIECE", piece)
        assert np.array_equal(inverted_index.word_hashes(text), whole)
    assert inverted_index.word_hashes(b"") .size == 0
    assert inverted_index.word_hashes(b"-- \x00").size == 0


def test_ids_of_any_type(spark):
    frame = spark.createDataFrame([("a", "one two"), (None, "two")], "doc_id string, text string")
    assert found(spark, frame, [(1, "two")]) == [("a", 2, 1, ["1"]), (None, 1, 1, ["1"])]
