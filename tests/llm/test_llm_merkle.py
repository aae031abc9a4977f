from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from llm_fixtures import EDGES, documents
from pyspark.sql import functions as F

from tillstream.llm import merkle
from tillstream.session import scratch_path


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    parts = ["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (row[0], row[3], row[2], row[4], row[1])]
    return h("".join(parts))


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([h("".join(last[k : k + 16])) for k in range(0, len(last), 16)])
    return found


def path(found, place):
    """The siblings before and after, level by level."""
    out = []
    for level in found[:-1]:
        begin = place // 16 * 16
        out.append(("".join(level[begin:place]), "".join(level[place + 1 : begin + 16])))
        place //= 16
    return out


def brute(rows):
    """(id, leaf, subroot, root, path) of every row."""
    trees = defaultdict(list)
    for row in rows:
        trees[row[3]].append((row[0] is not None, row[0] or 0, leaf(row)))
    trees = {k: sorted(v) for k, v in trees.items()}
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {k: levels([x[2] for x in trees[k]]) for k in names}
    top = levels([built[k][-1][0] for k in names])
    out = []
    for nth, name in enumerate(names):
        for place, (known, doc, digest) in enumerate(trees[name]):
            steps = path(built[name], place) + path(top, nth)
            out.append((doc if known else None, digest, built[name][-1][0], top[-1][0], steps))
    return out


def proofs(spark, frame, wanted=None):
    manifest = merkle.write_manifest(frame, scratch_path(spark, "manifest"), {"id": F.col("doc_id")})
    leaves = None if wanted is None else manifest.leaves().where(wanted)
    return merkle.prove(manifest, leaves)


def plain(frame):
    rows = frame.withColumn("folded", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    out = []
    for row in rows:
        assert row.folded == row.root
        steps = [(bytes(s.before).hex(), bytes(s.after).hex()) for s in row.path]
        out.append((row.row.id, bytes(row.leaf).hex(), bytes(row.subroot).hex(), bytes(row.root).hex(), steps))
    return sorted(out, key=repr)


def sized(*sizes):
    rows = []
    for source, size in enumerate(sizes):
        rows += [(1000 * source + k, f"Text {k} É", "en", f"s{source}", k) for k in range(size)]
    return rows


@pytest.mark.parametrize("sizes", [(1,), (1, 2, 16, 17), (257, 33), (1,) * 18, (300, *[2] * 20)])
def test_every_size_of_tree(spark, sizes):
    rows = sized(*sizes)
    assert plain(proofs(spark, documents(spark, rows))) == sorted(brute(rows), key=repr)


def test_edges(spark):
    rows = EDGES + [(None, None, None, "a", None), (3, None, "en", "b", 0), *[(8, "x", "en", None, 1)] * 40]
    frame = documents(spark, rows, clash=True).withColumn("tree", F.lit("x")).withColumn("rank", F.lit(1))
    assert plain(proofs(spark, frame)) == sorted(brute(rows), key=repr)


def test_null_and_empty_differ(spark):
    found = brute([(1, None, "en", "a", 0)]) + brute([(1, "", "en", "a", 0)])
    assert found[0][1] != found[1][1]
    assert plain(proofs(spark, documents(spark, [(1, "", "en", "a", 0)])))[0][1] == found[1][1]


def test_no_rows(spark):
    assert plain(proofs(spark, documents(spark, []))) == []


def test_some_leaves(spark):
    rows = sized(300, 5, 1)
    got = plain(proofs(spark, documents(spark, rows), "row.id IN (7, 299, 1004, 2000)"))
    assert got == sorted((x for x in brute(rows) if x[0] in (7, 299, 1004, 2000)), key=repr)


def test_records_hold_equal_nodes_once(spark):
    frame = documents(spark, [(1, "x", "en", "a", 1)] * 256)
    manifest = merkle.write_manifest(frame, scratch_path(spark, "manifest"), {"id": F.col("doc_id")})
    assert [manifest.records("sources", k).count() for k in (1, 2)] == [1, 1]
    assert len(plain(merkle.prove(manifest))) == 256


def test_a_changed_text_leads_elsewhere(spark):
    rows = sized(40, 3)
    frame = documents(spark, rows)
    row = {"id": F.col("doc_id"), "changed": merkle.lowered_leaf_digest()}
    manifest = merkle.write_manifest(frame, scratch_path(spark, "manifest"), row)
    folded = merkle.prove(manifest).withColumn("folded", merkle.fold(F.col("row.changed"), F.col("path")))
    assert folded.where(F.col("folded") == F.col("root")).isEmpty()
