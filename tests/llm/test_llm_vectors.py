"""Near duplicates and nearest neighbours against all pairs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillstream.llm import e8_lattice, lattice_dedup, neighbours
from tillstream.llm.vantage_points import VantageTree, inner

KIND = "vec_id long, embedding array<float>, label int"


def clusters(seed, groups=8, size=12, alone=80, dim=24, noise=0.35):
    """Vectors around some centres, at cosines on either side of 0.9, and others."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dim))
    near = np.repeat(centres, size, 0) + noise * rng.standard_normal((groups * size, dim))
    return np.vstack([near, rng.standard_normal((alone, dim))]).astype(np.float32)


def frame(spark, vectors, first=0, clash=False):
    rows = [(first + k, None if v is None else [None if x is None else float(x) for x in v], k % 3)
            for k, v in enumerate(vectors)]
    made = spark.createDataFrame(rows, KIND)
    return made.selectExpr("*", "1 AS id", "2 AS node", "3 AS dim", "4 AS vector") if clash else made


def all_pairs(vectors, cosine=0.9):
    """Links and components of vectors 0, 1, 2..."""
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    close = unit @ unit.T >= cosine
    np.fill_diagonal(close, False)
    label = np.arange(len(vectors))
    while True:
        least = np.minimum(label, np.where(close, label[None], len(label)).min(1))
        if (least == label).all():
            return close.sum(1), label
        label = least


def test_lattice_points_are_the_nearest():
    rng = np.random.default_rng(0)
    points = rng.standard_normal((300, 8)) * 2
    found = e8_lattice.nearest(points)
    doubled = found * 2
    assert (doubled == np.rint(doubled)).all()
    # All whole or all halves, with an even sum.
    assert (np.ptp(np.mod(found, 1), axis=1) == 0).all() and (found.sum(1) % 2 == 0).all()
    distance = ((points - found) ** 2).sum(1)
    around = found[:, None] + e8_lattice.MINIMAL[None]
    assert (((points[:, None] - around) ** 2).sum(2) >= distance[:, None] - 1e-9).all()
    assert (distance <= 1 + 1e-9).all()
    assert len({tuple(x) for x in e8_lattice.MINIMAL}) == 240


def test_probes_are_the_nearest_neighbours_of_the_home():
    rng = np.random.default_rng(1)
    points = rng.standard_normal((40, 8))
    named = e8_lattice.cells(points, 6)
    assert named.shape == (40, 6) and all(len(set(row)) == 6 for row in named)
    home = e8_lattice.nearest(points)
    around = home[:, None] + e8_lattice.MINIMAL
    best = np.sort(((points[:, None] - around) ** 2).sum(2), 1)[:, :5]
    cells = np.ascontiguousarray(named).view(np.int8).reshape(40, 6, 8) / 2
    got = np.sort(((points[:, None] - cells[:, 1:]) ** 2).sum(2), 1)
    np.testing.assert_allclose(got, best)


@pytest.mark.parametrize("part_rows", [1024, 7])
def test_near_duplicates(spark, monkeypatch, part_rows):
    """Also where cells are split into many parts; a link counts once."""
    monkeypatch.setattr(lattice_dedup, "PART_ROWS", part_rows)
    vectors = clusters(2)
    links, component = all_pairs(vectors)
    got = sorted(map(tuple, lattice_dedup.near_duplicates(frame(spark, vectors)).collect()))
    found = np.array([row[1] for row in got])
    assert (found <= links).all() and found.sum() >= 0.98 * links.sum() > 100
    assert np.mean([row[2] == c for row, c in zip(got, component, strict=True)]) > 0.97


def test_dense_group_and_copies(spark, monkeypatch):
    monkeypatch.setattr(lattice_dedup, "PART_ROWS", 50)
    vectors = np.vstack([clusters(3, 1, 200, 100, noise=0.05), clusters(3, 1, 1, 0)])
    vectors = np.vstack([vectors, np.repeat(vectors[:2], 40, 0)])
    links, component = all_pairs(vectors)
    got = sorted(map(tuple, lattice_dedup.near_duplicates(frame(spark, vectors)).collect()))
    assert got == [(k, n, c) for k, (n, c) in enumerate(zip(links, component, strict=True))]


BAD = [None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [3.0], [-1.0, 0.0]]


@pytest.mark.parametrize("clash", [False, True])
def test_near_duplicate_edges(spark, clash):
    vectors = [[1.0, 0.0], [2.0, 0.0], [1.0, 0.001], *BAD, [1e30, 0.0], [1e-30, 0.0]]
    got = sorted(map(tuple, lattice_dedup.near_duplicates(frame(spark, vectors, clash=clash)).collect()))
    linked = {0, 1, 2, 11, 12}
    assert got == [(k, 4, 0) if k in linked else (k, 0, k) for k in range(len(vectors))]


def test_repeated_and_missing_ids(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.1], 0), (None, [1.0, 0.0], 0)]
    rows += [(3, [0.0, 1.0], 0), (3, [1.0, 0.0], 0)]
    got = lattice_dedup.near_duplicates(spark.createDataFrame(rows, KIND)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 0, 3), (3, 0, 3), (None, 0, None)], key=repr
    )


def test_no_vectors(spark):
    assert lattice_dedup.near_duplicates(frame(spark, [])).collect() == []
    assert sorted(map(tuple, lattice_dedup.near_duplicates(frame(spark, BAD[:4])).collect())) == [
        (k, 0, k) for k in range(4)
    ]


def test_only_vectors_with_a_similar_one_are_dealt_whole(spark, monkeypatch):
    """Vectors far apart share cells; none of them is kept again for a table or a cell of it."""
    rows = []

    class Counted(lattice_dedup.Scratch):
        def keep(self, df):
            kept = super().keep(df)
            rows.append(kept.count())
            return kept

    monkeypatch.setattr(lattice_dedup, "Scratch", Counted)
    vectors = np.random.default_rng(9).standard_normal((2000, 24)).astype(np.float32)
    vectors[-1] = vectors[0] * 1.5
    got = sorted(map(tuple, lattice_dedup.near_duplicates(frame(spark, vectors)).collect()))
    linked = {0: (1, 0), 1999: (1, 0)}
    assert got == [(k, *linked.get(k, (0, k))) for k in range(2000)]
    # Ids and digests, once each, and next to nothing of the 64 cells of a vector.
    assert sum(rows) < 2.1 * len(vectors)


@pytest.mark.parametrize("part_rows", [1 << 15, 7])
def test_passes_give_what_one_gives(spark, monkeypatch, part_rows):
    """Tables one by one and in shares, also of cells split into parts."""
    vectors = clusters(10, size=30)
    once = sorted(map(tuple, lattice_dedup.near_duplicates(frame(spark, vectors), tables=3).collect()))
    monkeypatch.setattr(lattice_dedup, "PART_ROWS", part_rows)
    monkeypatch.setattr(lattice_dedup, "PASS_BYTES", 120_000)
    monkeypatch.setattr(lattice_dedup, "PASS_VECTORS", 0)
    planned = []
    made = lattice_dedup.passes
    monkeypatch.setattr(lattice_dedup, "passes", lambda *a: planned.extend(made(*a)) or made(*a))
    got = sorted(map(tuple, lattice_dedup.near_duplicates(frame(spark, vectors), tables=3).collect()))
    assert got == once
    assert len(planned) >= 9 and all(x.moved <= 120_000 for x in planned)


def test_passes_hold_all_tables_and_no_more_than_told():
    crowds = {(64, 1): (np.array([5]), np.array([4]), np.array([1000]))}
    planned = lattice_dedup.passes({0: 100, 1: 100, 2: 0, 3: 100, 4: 100}, crowds, 10, 8, 2500)
    assert [(x.tables, x.shares) for x in planned[-1:]] == [((3, 4), 1)]
    assert planned[0].tables == (0,) and {x.tables for x in planned[1:-1]} == {(1,)}
    assert sorted(x.share for x in planned[1:-1]) == list(range(planned[1].shares))
    assert planned[1].shares * 2500 >= 1000 + 3 * 1000 * 9 * 10 and all(x.moved <= 2500 for x in planned)


def test_near_duplicates_of_doubles(spark):
    """Kept as they are: beyond what a float holds, and apart where floats are equal."""
    vectors = [[1e300, 0.0], [1e-300, 0.0], [1.0, 1e-12], [1.0, 0.0], [1.0, 0.0], [0.0, 1.0]]
    table = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = sorted(map(tuple, lattice_dedup.near_duplicates(table).collect()))
    assert got == [(k, 4, 0) for k in range(5)] + [(5, 0, 5)]


def test_rounded_vectors_are_no_further_than_said():
    rng = np.random.default_rng(11)
    unit = lattice_dedup.units(rng.standard_normal((500, 64)) ** 3)
    data, step = lattice_dedup.rounded(unit)
    off = np.linalg.norm(unit - data * step[:, None].astype(float), axis=1)
    assert (off <= [lattice_dedup.rounding(x[None], 64) * (1 + 1e-6) for x in step]).all()


def nearest(vectors, ids, asked, k):
    """Query, rank, id and score of all pairs, summed in order."""
    out = []
    for q in asked:
        others = [j for j in range(len(ids)) if j != q]
        scores = inner(np.repeat(vectors[q][None], len(others), 0), vectors[others])
        ranked = sorted(zip(-scores, [ids[j] for j in others], strict=True))[:k]
        out += [(ids[q], rank, i, -s) for rank, (s, i) in enumerate(ranked, 1)]
    return sorted(out)


@pytest.mark.parametrize("seed", [4, 5])
def test_tree_with_factor_one_is_exact(seed):
    vectors = clusters(seed, 20, 60, 900, dim=6) * np.random.default_rng(seed).uniform(0.1, 4, (2100, 1))
    vectors[50:120] = vectors[50]
    ids = np.random.default_rng(seed).permutation(2100).astype(np.int64)
    longest = float(np.sqrt((vectors**2).sum(1).max()))
    tree = VantageTree.from_bytes(VantageTree.build(ids, vectors, longest).to_bytes())
    asked = list(range(0, 2100, 30))
    scores, found = tree.search(ids[asked], vectors[asked], 20)
    got = [
        (int(ids[q]), rank + 1, int(found[n, rank]), scores[n, rank])
        for n, q in enumerate(asked)
        for rank in range(20)
    ]
    assert sorted(got) == nearest(vectors, ids, asked, 20)


def test_larger_factors_find_less_and_look_at_less():
    vectors = clusters(6, 40, 50, 1000, dim=5).astype(float)
    ids = np.arange(len(vectors))
    tree = VantageTree.build(ids, vectors, float(np.sqrt((vectors**2).sum(1).max())))
    exact = tree.search(ids[::20], vectors[::20], 10)[1]
    recall = []
    for factor in (1.0, 2.0, 8.0):
        found = tree.search(ids[::20], vectors[::20], 10, factor)[1]
        recall.append(np.mean([len({*a} & {*b}) / 10 for a, b in zip(exact, found, strict=True)]))
    assert recall[0] == 1 and recall[0] >= recall[1] >= recall[2]
    with pytest.raises(ValueError, match="factor"):
        tree.search(ids[:1], vectors[:1], 3, 0.5)


@pytest.mark.parametrize("stripe_blocks", [1, 2, 16])
def test_neighbours_over_shards(spark, monkeypatch, stripe_blocks):
    """Also where a tree meets several blocks, and several stripes."""
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 40)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 3)
    monkeypatch.setattr(neighbours, "STRIPE_BLOCKS", stripe_blocks)
    vectors = clusters(7, 10, 15, 100).astype(np.float32)
    vectors[10:40] = vectors[10]
    table = frame(spark, vectors)
    got = neighbours.nearest_neighbours(table, F.col("id") % 20 == 0).collect()
    wide = vectors.astype(float)
    asked = [k for k in range(len(vectors)) if k % 20 == 0]
    assert sorted(map(tuple, got)) == nearest(wide, list(range(len(vectors))), asked, 20)


def test_neighbours_where_shards_are_empty(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 1)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 1)
    vectors = clusters(8, 2, 6, 8)
    got = neighbours.nearest_neighbours(frame(spark, vectors), F.col("id") % 5 == 0).collect()
    asked = [k for k in range(len(vectors)) if k % 5 == 0]
    assert sorted(map(tuple, got)) == nearest(vectors.astype(float), list(range(len(vectors))), asked, 20)


@pytest.mark.parametrize("clash", [False, True])
def test_neighbour_edges(spark, clash):
    """Fewer candidates than asked for; other lengths and invalid vectors take no part."""
    vectors = [[1.0, 0.0], [2.0, 0.0], *BAD, [0.0, 1.0], [4.0, 4.0]]
    got = neighbours.nearest_neighbours(frame(spark, vectors, clash=clash), F.col("id") % 2 == 0).collect()
    assert [tuple(row) for row in sorted(got)] == [
        (0, 1, 11, 4.0), (0, 2, 1, 2.0), (0, 3, 10, 0.0), (0, 4, 9, -1.0),
        (10, 1, 11, 4.0), (10, 2, 0, 0.0), (10, 3, 1, 0.0), (10, 4, 9, 0.0),
    ]


def test_neighbours_of_repeated_and_missing_ids(spark):
    rows = [(0, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (None, [9.0, 9.0], 0), (1, [2.0, 0.0], 0)]
    got = neighbours.nearest_neighbours(spark.createDataFrame(rows, KIND), F.col("id") == 0).collect()
    assert [tuple(row) for row in got] == [(0, 1, 1, 2.0)]


def test_neighbours_of_nothing(spark):
    assert neighbours.nearest_neighbours(frame(spark, []), F.col("id") == 0).collect() == []
    assert neighbours.nearest_neighbours(frame(spark, [[1.0]]), F.col("id") == 0).collect() == []
