"""Ids and counts against the libraries, files by a round trip."""

from __future__ import annotations

import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import EDGES, LONG, documents, texts
from tokenizers import Tokenizer

from tillstream.llm import encoding, token_files
from tillstream.llm.bpe_count import PieceCounter, count_tokens
from tillstream.llm.elias_fano import EliasFano
from tillstream.llm.worker_memory import SMALL_BATCHES
from tillstream.session import session_options

WORD_PATH = public_tokenizers.path("word_bpe_49k.json")
PIECE_PATH = public_tokenizers.path("piece_bpe_32k.model")

ODD = "ab  \n\t▁eé日本語🙂́'sS<|endoftext|> \x1c\x00.,!09ﬁİΣß"
FIXED = [
    "", " ", "   ", "a  b", " " * 40 + "x", "\n", "\t\r\n", "don't DON'T 's", "</s><s><unk><0x41>",
    "x<|startoftext|>y <|endoftext|>", "İstanbul ΣΑΣ", "word, Word. WORD!! word###", LONG[:5000],
]


def odd_texts(n=400):
    rng = random.Random(1)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 60))) for _ in range(n)] + FIXED


def test_counts_agree_with_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_PATH)
    mine = PieceCounter(PIECE_PATH)
    for text in odd_texts():
        assert mine.count(text) == len(library.encode(text)), text


def test_counts_without_remembering(monkeypatch):
    monkeypatch.setattr("tillstream.llm.bpe_count.MAX_REMEMBERED", 3)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_PATH)
    mine = PieceCounter(PIECE_PATH)
    for text in FIXED:
        assert mine.count(text) == len(library.encode(text))
    assert len(mine) <= 3


@pytest.mark.parametrize("clash", [False, True])
def test_count_edges(spark, clash):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_PATH)
    found = count_tokens(documents(spark, EDGES, clash), PIECE_PATH)
    got = found.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    expected = []
    for doc, text, *_ in EDGES:
        n = len(library.encode(text or ""))
        expected.append((doc, len((text or "").encode()), n, n > 4096))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert any(row[3] for row in expected)
    assert count_tokens(documents(spark, []), PIECE_PATH).collect() == []


def test_ids_agree_with_the_library(monkeypatch):
    monkeypatch.setattr(encoding, "MAX_WORDS", 50)
    monkeypatch.setattr(encoding, "RUN_CHARS", 300)
    values = odd_texts()
    own = list(encoding.WordEncoder(WORD_PATH).encode_ended(values, 1))
    library = Tokenizer.from_file(WORD_PATH)
    assert len(own) == len(values)
    for text, ids in zip(values, own, strict=True):
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 1], text


def test_tokenizers_that_keep_spaces_are_refused():
    with pytest.raises(ValueError, match="words"):
        encoding.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2**63 - 1) | st.integers(0, 300), max_size=700))
def test_elias_fano_round_trip(numbers):
    numbers = sorted(numbers)
    data = b"xyz" + EliasFano.of(np.array(numbers, np.uint64)).to_bytes() + b"rest"
    held, behind = EliasFano.from_bytes(data, 3)
    assert behind == len(data) - 4
    assert held.all().tolist() == numbers
    for k in range(0, len(numbers), 7):
        assert held[k] == numbers[k]
    assert held.take(np.arange(len(numbers))).tolist() == numbers
    assert held.take(np.arange(len(numbers))[::-3]).tolist() == numbers[::-3]
    with pytest.raises(IndexError):
        held[len(numbers)]


def test_select_starts_from_the_samples_of_the_file():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 3000, 2000))
    data = EliasFano.of(ends).to_bytes()
    held, behind = EliasFano.from_bytes(data)
    assert behind == len(data)
    places = held.select_many(np.arange(len(ends)))
    stored = np.frombuffer(data, "<u4", -(-len(ends) // 256), len(data) - 4 * -(-len(ends) // 256))
    assert stored.tolist() == places[::256].tolist()
    # With other samples select goes elsewhere: it has nothing else to start from.
    shifted = data[: -stored.nbytes] + np.roll(stored, 1).tobytes()
    wrong, _ = EliasFano.from_bytes(shifted)
    assert wrong.select(300) != held.select(300) and wrong.take(np.array([300]))[0] != ends[300]


def test_spans_in_blocks():
    ids = [np.arange(k % 50 + 1) for k in range(1000)]
    docs = [None] * 7 + list(range(-500, 493))
    shard = token_files.Shard(token_files.shard_bytes(docs, ids, 2))
    for first, last in ((0, 1000), (0, 3), (5, 9), (7, 8), (999, 1000), (400, 400)):
        starts, ends = shard.spans(first, last)
        assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == [shard.span(k) for k in range(first, last)]
        assert shard.doc_ids(first, last) == docs[first:last]


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(0).integers(1, 2000, 100_000))
    assert len(EliasFano.of(ends).to_bytes()) < 100_000 * 13 / 8
    with pytest.raises(ValueError, match="decrease"):
        EliasFano.of(np.array([2, 1]))


def expected_files(rows):
    library = Tokenizer.from_file(WORD_PATH)
    out, start = [], 0
    for doc, text, *_ in sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("clash", [False, True])
def test_files_of_edges(spark, clash):
    manifest = token_files.write_token_files(documents(spark, EDGES, clash), WORD_PATH, shard_ids=40)
    got = sorted(map(tuple, token_files.read_token_files(manifest).collect()), key=lambda row: row[1])
    assert got == expected_files(EDGES)
    assert manifest.count() >= 2


def test_files_over_many_partitions_and_by_folder(spark, tmp_path):
    rows = [(k * 37 % 501 - 250, f"text number {k} " * (k % 9), "en", "a", 0) for k in range(501)]
    frame = documents(spark, rows).repartition(8)
    folder = f"file://{tmp_path}/ids"
    token_files.write_token_files(frame, WORD_PATH, folder, shard_ids=500)
    manifest = token_files.read_folder(spark, folder)
    got = sorted(map(tuple, token_files.read_token_files(manifest).collect()), key=lambda row: row[1])
    assert got == expected_files(rows)
    # Each file can be read by itself, document by document.
    shard = token_files.Shard(sorted(Path(tmp_path, "ids").iterdir())[0].read_bytes())
    first = expected_files(rows)[: shard.n_docs]
    for k, (doc, start, n, crc) in enumerate(first):
        begin, end = shard.span(k)
        assert (shard.doc_ids()[k], begin, end - begin) == (doc, start, n)
        assert encoding.checksum(shard.ids[begin:end]) == crc


def test_extreme_ids(spark):
    rows = [(k, "x", "en", "a", 0) for k in (-(2**63), -1, 0, 2**63 - 1)]
    manifest = token_files.write_token_files(documents(spark, rows).coalesce(1), WORD_PATH)
    got = token_files.read_token_files(manifest).collect()
    assert sorted(row["doc"] for row in got) == [row[0] for row in rows]


def test_no_files_for_an_empty_table(spark):
    manifest = token_files.write_token_files(documents(spark, []), WORD_PATH)
    assert manifest.collect() == [] and token_files.read_token_files(manifest).collect() == []


def test_foreign_files_are_refused():
    with pytest.raises(ValueError, match="token file"):
        token_files.Shard(bytes(100))


def test_texts_of_one_run(spark):
    assert [row["n_tokens"] for row in count_tokens(texts(spark, "a"), PIECE_PATH).collect()] == [1]


def test_counts_replace_columns_of_their_name(spark):
    frame = texts(spark, "a b").selectExpr("*", "'old' AS n_tokens", "'x' AS n_bytes")
    row = count_tokens(frame, PIECE_PATH).first()
    assert (row.n_bytes, row.n_tokens, row.text) == (3, 2, "a b")
    beside = count_tokens(frame, PIECE_PATH, prefix="new_").first()
    assert (beside.n_tokens, beside.new_n_tokens) == ("old", 2)
    assert count_tokens(frame.limit(0), PIECE_PATH).collect() == []


def test_small_batches_are_bounded_in_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], ["b", "n"])

    docs = spark.range(0, 2000, 1, 1).selectExpr("repeat('text ', 1000) AS text")
    with session_options(spark, SMALL_BATCHES):
        found = docs.mapInArrow(sizes, "b long, n long").collect()
    assert sum(row.n for row in found) == 2000
    assert max(row.b for row in found) <= 1 << 20
