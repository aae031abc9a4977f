from __future__ import annotations

import re

import pytest
from llm_fixtures import EDGES, documents
from pyspark.sql import functions as F

from tillstream.llm import mixing


def targets(totals, weights=(1, 2, 3), limit=3):
    """Shares by weight; what exceeds a limit is shared again until none is above."""
    names = sorted(totals, key=lambda x: (x is None, x or ""))
    weight = {x: weights[k % len(weights)] for k, x in enumerate(names)}
    fixed, left = {}, float(sum(totals.values()))
    while True:
        free = [x for x in names if x not in fixed]
        rest = left - sum(fixed.values())
        share = {x: rest * weight[x] / sum(weight[y] for y in free) for x in free}
        above = [x for x in free if share[x] > limit * totals[x]]
        if not above:
            return {**fixed, **share}
        fixed.update({x: limit * totals[x] for x in above})


def rows_of(sizes, start=0):
    return [
        (start + k, " ".join(["w"] * size), "en", source, None) for k, (source, size) in enumerate(sizes)
    ]


def plan(frame):
    return mixing.plan_mix(frame).collect()


def test_targets_share_what_limited_sources_leave(spark):
    sizes = [("a", 50)] * 40 + [("b", 30)] * 10 + [("c", 7)] * 5 + [(None, 1)] * 3 + [("é", 2)] * 4
    totals = {}
    for source, size in sizes:
        totals[source] = totals.get(source, 0) + size
    got = {row["source"]: row["target"] for row in plan(documents(spark, rows_of(sizes)))}
    expected = targets(totals)
    assert got.keys() == expected.keys()
    for source, target in expected.items():
        assert got[source] == pytest.approx(target)
        assert target <= 3 * totals[source] + 1e-9
    assert sum(got.values()) == pytest.approx(sum(totals.values()))


def test_taken_words_come_near_the_targets(spark):
    sizes = [(f"s{k % 6}", 20 + 13 * k % 190) for k in range(600)]
    taken, target = {}, {}
    for row in plan(documents(spark, rows_of(sizes))):
        rate = row["target"] / row["source_size"]
        assert int(rate) <= row["copies"] <= min(3, int(rate) + 1)
        taken[row["source"]] = taken.get(row["source"], 0) + row["size"] * row["copies"]
        target[row["source"]] = row["target"]
    for source in target:
        assert taken[source] == pytest.approx(target[source], rel=0.02)


def test_reruns_and_partitions_agree(spark):
    frame = documents(spark, rows_of([(f"s{k % 4}", 5 + k % 50) for k in range(200)]))
    once = sorted((row["doc"], row["copies"]) for row in plan(frame))
    assert once == sorted((row["doc"], row["copies"]) for row in plan(frame.repartition(7)))


def test_mix_emits_the_planned_copies(spark):
    frame = documents(spark, rows_of([(f"s{k % 4}", 5 + k % 50) for k in range(200)]))
    emitted = {}
    for row in mixing.mix(frame).collect():
        emitted[row.doc_id] = emitted.get(row.doc_id, 0) + 1
    assert emitted == {row["doc"]: row["copies"] for row in plan(frame) if row["copies"]}


@pytest.mark.parametrize("clash", [False, True])
def test_edges(spark, clash):
    frame = documents(spark, EDGES, clash)
    planned = plan(frame)
    assert len(planned) == len(EDGES)
    words = {row[0]: len(re.findall(r"[^\x20\x09-\x0D]+", row[1] or "")) for row in EDGES}
    assert all(row["size"] == words[row["doc"]] for row in planned)
    mixed = mixing.mix(frame)
    assert mixed.columns == frame.columns
    assert mixed.count() == sum(row["copies"] for row in planned)


@pytest.mark.parametrize("text", ["all the same words", None])
def test_rows_without_id_or_with_one_id_reach_the_targets(spark, text):
    """Equal rows draw each for itself: 2000 of a source, without an id, and as many of another one."""
    words = len((text or "").split())
    rows = [(None, text, "en", "a", 0)] * 2000 + [(7, "of another source", "en", "b", 0)] * 2000
    rows += [(k, "a b c d e", "en", "c", 0) for k in range(100)]
    frame = documents(spark, rows).repartition(5)
    planned = plan(frame)
    target = {row["source"]: row["target"] for row in planned}
    for source in "abc":
        copies = [row["copies"] for row in planned if row["source"] == source]
        taken = sum(row["size"] * row["copies"] for row in planned if row["source"] == source)
        assert taken == pytest.approx(target[source], rel=0.02, abs=1)
        assert max(copies) - min(copies) <= 1 and max(copies) <= 3
    assert words == 0 or target["a"] > 0
    emitted = mixing.mix(frame.withColumn("tags", F.create_map(F.lit("k"), F.rand(3)))).groupBy("source").count()
    expected = {}
    for row in planned:
        expected[row["source"]] = expected.get(row["source"], 0) + row["copies"]
    assert {row.source: row["count"] for row in emitted.collect()} == expected
    again = mixing.plan_mix(frame.repartition(2)).groupBy("doc", "copies").count()
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(
        map(tuple, mixing.plan_mix(frame).groupBy("doc", "copies").count().collect()), key=repr
    )


def test_many_sources(spark):
    """Targets of thousands of sources, some limited in the first round and some in later ones."""
    totals = {f"s{k:05d}": 1 + (k * k) % (10 if k % 4 else 5000) for k in range(3000)}
    sizes = spark.createDataFrame([("0" + k, v) for k, v in totals.items()], "key string, size long")
    got = {row["key"][1:]: row["target"] for row in mixing.source_targets(sizes).collect()}
    expected = targets(totals)
    assert got.keys() == expected.keys()
    assert all(got[source] == pytest.approx(expected[source]) for source in got)


def test_source_without_words(spark):
    frame = documents(spark, [(1, "", "en", "a", 0), (2, None, "en", "a", 0), (3, "x y", "en", "b", 3)])
    found = {row["doc"]: (row["target"], row["copies"]) for row in plan(frame)}
    assert found[1] == found[2] == (0.0, 1)
    assert found[3][0] == 2.0


def test_empty_table(spark):
    frame = documents(spark, [])
    assert plan(frame) == []
    assert mixing.mix(frame).collect() == []


def test_no_python_on_the_path(spark):
    frame = documents(spark, rows_of([("a", 3), ("b", 4)]))
    for result in (mixing.plan_mix(frame), mixing.mix(frame)):
        text = result._jdf.queryExecution().toString()
        assert "Python" not in text and "Arrow" not in text
