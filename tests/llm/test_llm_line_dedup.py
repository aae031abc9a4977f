from __future__ import annotations

import pytest
from llm_fixtures import EDGES, documents, texts

from tillstream.llm.line_dedup import dedup_lines, lines_to_drop

LINE = "This line is long enough to be counted, surely."
OTHER = "Another line that is long enough to count too."


def brute(rows, min_chars=40, min_docs=5):
    def key(line):
        stripped = line.strip(" \t\n\x0b\x0c\r")
        return "".join(x.lower() if "A" <= x <= "Z" else x for x in stripped)

    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x
            for x in lines
            if len(holders.get(key(x), ())) < min_docs or doc == max(d for d in holders[key(x)] if d)
        ]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def result(frame):
    got = dedup_lines(frame, stats=True).select("doc_id", "text", "n_lines", "n_dropped").collect()
    return sorted(((d, t or "", n, k) for d, t, n, k in got), key=repr)


def test_shared_lines_stay_in_the_largest_document(spark):
    rows = [(k, f"{LINE}\nOwn line {k}\n  {LINE.upper()} \n", "en", "a", 0) for k in range(1, 6)]
    rows += [(9, f"{OTHER}\nShort", "en", "a", 0), (10, OTHER, "en", "a", 0)]
    expected = brute([row[:2] for row in rows])
    assert result(documents(spark, rows)) == sorted(expected, key=repr)
    assert {doc: dropped for doc, _, _, dropped in expected} == {1: 2, 2: 2, 3: 2, 4: 2, 5: 0, 9: 0, 10: 0}


def test_four_documents_are_too_few(spark):
    assert {row[3] for row in result(texts(spark, *[LINE] * 4))} == {0}


def test_a_whole_text_can_go(spark):
    kept = {row[0]: row[1] for row in result(texts(spark, *[LINE] * 5))}
    assert kept == {1: "", 2: "", 3: "", 4: "", 5: LINE}


def test_repeated_ids_are_one_document(spark):
    rows = [(k, LINE, "en", "a", 0) for k in (1, 1, 2, 3, 4)]
    assert {row[3] for row in result(documents(spark, rows))} == {0}
    assert [row[3] for row in result(documents(spark, [*rows, (5, LINE, "en", "a", 0)]))] == [1, 1, 1, 1, 1, 0]


def test_null_ids_count_as_one_and_come_first(spark):
    rows = [(None, LINE, "en", "a", 0)] * 2 + [(k, LINE, "en", "a", 0) for k in (1, 2, 3, 4)]
    dropped = sorted((row[0] or 0, row[3]) for row in result(documents(spark, rows)))
    assert dropped == [(0, 1), (0, 1), (1, 1), (2, 1), (3, 1), (4, 0)]


@pytest.mark.parametrize("clash", [False, True])
def test_edges(spark, clash):
    frame = documents(spark, EDGES, clash)
    assert dedup_lines(frame).columns == frame.columns
    assert result(frame) == sorted(brute([row[:2] for row in EDGES]), key=repr)


def test_counts_replace_columns_of_their_name(spark):
    frame = texts(spark, "x\ny").selectExpr("*", "'old' AS n_lines")
    assert [row.n_lines for row in dedup_lines(frame, stats=True).collect()] == [2]


def test_empty_table(spark):
    assert dedup_lines(documents(spark, []), stats=True).collect() == []


def test_hot_line_and_long_text(spark):
    """A line of all documents, and a text of many lines that all go."""
    body = "\n".join(f"{OTHER} number {k}" for k in range(3000))
    rows = [(k, f"{LINE}\nOwn {k}", "en", "a", 0) for k in range(200)]
    rows += [(1000 + k, body, "en", "a", 0) for k in range(5)]
    assert result(documents(spark, rows)) == sorted(brute([row[:2] for row in rows]), key=repr)


def test_hashes_are_gathered_per_text(spark):
    """Rows without id hold a shared line each; none is joined with the lines of the others."""
    lines = [f"{LINE} Number {k}." for k in range(30)]
    rows = [(None, f"{line}\nOwn", "en", "a", 0) for line in lines]
    rows += [(7, f"{line}\nOwn", "en", "a", 0) for line in lines]
    rows += [(k, "\n".join(lines), "en", "a", 0) for k in range(11, 15)]
    frame = documents(spark, rows)
    drops = lines_to_drop(frame, "doc_id", "text", 40, 5).collect()
    assert sorted(len(row["_drop"]) // 16 for row in drops) == [1] * 60 + [30] * 3
    assert result(frame) == sorted(brute([row[:2] for row in rows]), key=repr)
