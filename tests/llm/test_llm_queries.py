"""The registered queries and the pipeline over the smallest tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest
import sentencepiece
from llm_fixtures import CLASHING, EDGES, SF_DIR, documents, needs_tables
from pyspark.sql import functions as F
from test_llm_ngram_join import brute as components_of
from test_llm_pii import brute as personal_data
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from check_oracle import bag
from tillstream.llm.oracle import ORACLE
from tillstream.llm.queries import PIECE_MODEL, QUERIES, WORD_TOKENIZER

pytestmark = needs_tables


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF_DIR}/documents.parquet").sort_values("doc_id")


def run(spark, number):
    name = next(x for x in QUERIES if x.startswith(f"op{number}_"))
    return QUERIES[name](spark, SF_DIR)


def test_all_are_registered():
    assert {int(re.match(r"op(\d+)_", x)[1]) for x in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLE)
def test_against_sql(spark, name):
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = QUERIES[name](spark, SF_DIR)
    cursor = connection.execute(ORACLE[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    assert bag(result.columns, result.collect()) == bag(columns, cursor.fetchall())


def library_ids(docs):
    encoded = Tokenizer.from_file(WORD_TOKENIZER).encode_batch(docs.text.fillna("").tolist(), add_special_tokens=False)
    return {doc: [*x.ids, 1] for doc, x in zip(docs.doc_id, encoded, strict=True)}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing(spark, docs):
    got = run(spark, 1).collect()
    ids = library_ids(docs)
    places, used = set(), Counter()
    for row in got:
        part = ids[row["doc_id"]][row["start"] : row["start"] + row["length"]]
        assert (row["length"], row["ids_crc32"]) == (len(part), crc(part))
        assert row["start"] == 4096 * row["piece"]
        places.add((row["sequence_id"], row["offset"]))
        used[row["sequence_id"]] += row["length"]
    total = sum(map(len, ids.values()))
    assert sum(used.values()) == total and len(places) == len(got) and max(used.values()) <= 4096
    assert len(used) <= math.ceil(total / 4096) + 1


def test_token_files(spark, docs):
    expected, start = [], 0
    for doc, ids in sorted(library_ids(docs).items()):
        expected.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, run(spark, 7).collect())) == expected


def test_token_counts(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    expected = []
    for doc, text in zip(docs.doc_id, docs.text, strict=True):
        n = len(library.encode(text or ""))
        expected.append((doc, len((text or "").encode()), n, n > 4096))
    assert sorted(map(tuple, run(spark, 4).collect())) == expected


def test_personal_data(spark, docs):
    text = dict(zip(docs.doc_id, docs.text, strict=True))
    rows = run(spark, 3).collect()
    assert len(rows) == len(docs)
    for row in rows:
        spans = personal_data(text[row.doc_id])
        base = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [
            sum(k == kind for k, _, _ in spans) for kind in ("email", "ip", "card", "phone")
        ]
        assert not spans or set(base.split(",")) <= set(row.spans.split(","))


def test_quality(spark, docs):
    labels = pd.read_parquet(f"{SF_DIR}/labels.parquet").set_index("doc_id").quality
    rows = run(spark, 9).collect()
    assert sorted(row.doc_id for row in rows) == docs.doc_id.tolist()
    judged = [(row.predicted, labels[row.doc_id]) for row in rows if row.held_out and row.doc_id in labels]
    assert np.mean([a == b for a, b in judged]) >= 0.8


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returns, written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    frames = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], SF_DIR).write.parquet(f"{folder}/{k}")
        frames.append(spark.read.parquet(f"{folder}/{k}"))
    return [frame.toPandas() for frame in frames]


def test_quality_stage(stages):
    labels = pd.read_parquet(f"{SF_DIR}/labels.parquet").set_index("doc_id").quality
    kept = set(stages[1].doc_id)
    good = [doc for doc, label in labels.items() if label == 1]
    bad = [doc for doc, label in labels.items() if label == 0]
    assert np.mean([doc in kept for doc in good]) > 0.95
    assert np.mean([doc in kept for doc in bad]) < 0.3


def test_line_stage(stages):
    assert sorted(stages[2].doc_id) == sorted(stages[1].doc_id)
    holders = Counter()
    for text in stages[2].text:
        holders.update({x.strip().lower() for x in text.split("\n") if len(x.strip()) >= 40})
    assert max(holders.values(), default=0) < 5
    assert (stages[2].n_chars == stages[2].text.str.len()).all()


def test_near_duplicate_stage(stages):
    rows = list(zip(stages[2].doc_id, stages[2].text, strict=True))
    groups = {component for _, _, component in components_of(rows, 5, (80, 100))}
    assert set(stages[3].doc_id) == groups


def test_mixing_stage(stages):
    assert set(stages[4].doc_id) <= set(stages[3].doc_id)
    assert stages[4].groupby("doc_id").size().max() <= 3


def test_packing_stage(stages):
    packed, source = stages[5], stages[4]
    assert packed[packed.piece == 0].groupby("doc_id").size().to_dict() == source.groupby("doc_id").size().to_dict()
    total = packed.length.sum()
    assert packed.sequence_id.nunique() <= math.ceil(total / 4096) + 1


def test_stages_return_the_columns_of_documents(stages):
    assert all(list(frame.columns) == list(stages[0].columns) for frame in stages[1:5])


def test_run_is_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.columns == list(stages[5].columns)
    assert got.count() == len(stages[5])


@pytest.mark.parametrize("rows", [EDGES, []])
def test_stages_take_edges(spark, rows):
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        frame = documents(spark, rows, clash=True)
        result = stage(spark, frame, SF_DIR)
        assert result.columns == frame.columns and set(CLASHING) <= set(result.columns)
        assert (result.count() > 0) == bool(rows)
    assert corpus_pipeline.pack_sequences(spark, documents(spark, rows), SF_DIR).count() >= len(rows)
    assert corpus_pipeline.keep_quality(spark, documents(spark, rows), SF_DIR).count() <= len(rows)


def test_one_row_of_a_repeated_id_and_text_stays(spark):
    rows = [(5, "b b b", "en", "a", 5), (5, "a a a", "en", "a", 5), (5, "a a a", "en", "a", 5)]
    rows += [(None, "x", "en", "a", 1), (None, "x", "en", "a", 1)]
    kept = corpus_pipeline.keep_one_of_each_group(spark, documents(spark, rows), SF_DIR).collect()
    assert sorted((row.doc_id or 0, row.text) for row in kept) == [(0, "x"), (0, "x"), (5, "a a a"), (5, "b b b")]


def test_unlike_texts_of_a_repeated_id_stay(spark):
    rows = [(5, "b b b", "en", "a", 5), (5, "a a a", "en", "a", 5), (5, "a a a", "en", "a", 5)]
    rows += [(6, None, "en", "a", 0), (6, None, "en", "a", 0), (6, "c c c", "en", "a", 5)]
    rows += [(7, "b b b", "en", "a", 5), (4, "c c c", "en", "a", 5), (None, "x", "en", "a", 1)]
    frame = documents(spark, rows, clash=True).withColumn("tags", F.create_map(F.lit("k"), F.lit(1)))
    kept = corpus_pipeline.keep_one_of_each_group(spark, frame, SF_DIR)
    assert kept.columns == frame.columns
    got = sorted(((row.doc_id, row.text) for row in kept.collect()), key=repr)
    expected = [(4, "c c c"), (5, "a a a"), (5, "b b b"), (6, None), (None, "x")]
    assert got == sorted(expected, key=repr)
