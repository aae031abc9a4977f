from __future__ import annotations

import random

import pytest
from conftest import plan, rows

from tillstream.operators.dedup import dedup


def test_last_and_first(spark):
    given = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, t int, v string"
    )
    assert rows(dedup(given, "k", "t")) == [("a", 2, "y"), ("b", 1, "z")]
    assert rows(dedup(given, "k", "t", keep="first")) == [("a", 1, "x"), ("b", 1, "z")]
    with pytest.raises(ValueError):
        dedup(given, "k", "t", keep="any")


def test_null_keys_are_one_group_and_null_times_lose(spark):
    given = spark.createDataFrame(
        [(None, 1), (None, 2), ("a", None), ("a", 3)], "k string, t int"
    )
    assert rows(dedup(given, "k", "t")) == [("a", 3), (None, 2)]


def test_ties_do_not_depend_on_the_order_of_the_rows(spark):
    data = [("a", 1, i, {"m": i}, [({"m": i},)]) for i in range(20)]
    schema = "k string, t int, v int, m map<string,int>, n array<struct<m:map<string,int>>>"
    results = set()
    for seed in range(3):
        random.Random(seed).shuffle(data)
        given = spark.createDataFrame(data, schema).repartition(3)
        results.add(dedup(given, "k", "t").first().v)
    assert results == {19}


def test_is_idempotent_and_keeps_every_key_of_a_skewed_table(spark):
    rng = random.Random(7)
    data = [
        (0 if rng.random() < 0.4 else rng.randrange(500), rng.randrange(50), rng.randrange(9), i)
        for i in range(5000)
    ]
    best = {}
    for k, t, v, i in data:
        best[k] = max(best.get(k, (t, v, i)), (t, v, i))
    given = spark.createDataFrame(data, "k int, t int, v int, i int").repartition(6)
    once = dedup(given, ["k"], ["t"], ["v", "i"])
    assert rows(once) == sorted([(k, *rest) for k, rest in best.items()], key=repr)
    assert rows(dedup(once, ["k"], ["t"], ["v", "i"])) == rows(once)


def test_ranks_before_the_shuffle(spark):
    given = spark.range(100).selectExpr("id % 7 AS k", "id AS t")
    physical = plan(dedup(given, "k", "t"))
    assert "row_number(), 1, Partial" in physical and "row_number(), 1, Final" in physical
