"""Token-id files: concatenated ids, with the documents' boundaries as Elias-Fano lists.

Documents are ranged by id over the partitions, so shards in the order of their names hold the
documents in ascending order. A shard is one file: a header, the boundaries and the document ids
as Elias-Fano lists with their select samples, then the ids as 16-bit numbers, or 32-bit ones for
larger vocabularies. Readers find the boundaries of a document by select, a block of documents at a
time; no table of all boundaries is built.

A shard's name and content follow from its partition alone, and it gets its name only when it is
complete, so a task that is run again replaces the same files. Paths are resolved by Arrow's
file systems: a folder that all executors reach, local, HDFS or an object store.

Defined results: a NULL or empty text has the end id alone. NULL ids come first, as a count in the
header. Rows with the same id are documents of their own, in the order of a hash of their texts. An
empty table writes no shard and reads as an empty table. Only id and text are stored.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstream.llm.elias_fano import EliasFano
from tillstream.llm.encoding import checksum, encoder
from tillstream.llm.text import whole_text
from tillstream.llm.worker_memory import SMALL_BATCHES
from tillstream.session import materialize, scratch_path, session_options

END_ID = 1
# A shard is closed when it has so many ids or documents.
SHARD_IDS = 8_000_000
SHARD_DOCS = 500_000
# Documents whose boundaries a reader holds at once.
READ_DOCS = 2048

# Fixed values of the format: its mark and its header.
MAGIC = b"TSEF0002"
_HEAD = struct.Struct("<8sBQQQq")  # mark, bytes per id, documents, ids, NULL ids, least id

MANIFEST = "path string, shard string, n_docs long, n_ids long"
DOCUMENTS = "doc long, start long, n_tokens long, ids_crc32 long"


def shard_bytes(docs: list[int | None], ids: list[np.ndarray], width: int) -> bytes:
    """One file: documents in ascending order of id, NULL first, and their ids."""
    known = np.array([x for x in docs if x is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    ends = np.cumsum([len(x) for x in ids], dtype=np.int64)
    n_ids = int(ends[-1]) if len(ends) else 0
    head = _HEAD.pack(MAGIC, width, len(docs), n_ids, len(docs) - len(known), least)
    # As unsigned numbers the difference is right over the whole range of ids.
    above = known.view(np.uint64) - np.array(least, np.int64).view(np.uint64)
    lists = EliasFano.of(ends).to_bytes() + EliasFano.of(above).to_bytes()
    return head + lists + np.concatenate(ids).astype(f"<u{width}").tobytes()


class Shard:
    """A file that was read: ``boundaries`` and ``docs`` by number, ``ids`` as one array."""

    def __init__(self, data: bytes) -> None:
        mark, width, self.n_docs, self.n_ids, self.n_null, self._least = _HEAD.unpack_from(data)
        if mark != MAGIC:
            raise ValueError("not a token file")
        self.boundaries, at = EliasFano.from_bytes(data, _HEAD.size)
        self._above, at = EliasFano.from_bytes(data, at)
        self.ids = np.frombuffer(data, f"<u{width}", self.n_ids, at)

    def span(self, k: int) -> tuple[int, int]:
        """First and behind the last id of the k-th document."""
        return (self.boundaries[k - 1] if k else 0), self.boundaries[k]

    def spans(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """``span`` of the documents from ``first`` up to, but not including, ``last``."""
        ends = self.boundaries.take(np.arange(max(first - 1, 0), last)).astype(np.int64)
        starts = ends[:-1] if first else np.concatenate([[0], ends[:-1]])
        return starts, ends[1:] if first else ends

    def doc_ids(self, first: int = 0, last: int | None = None) -> list[int | None]:
        """Ids of the documents from ``first`` up to, but not including, ``last``."""
        last = self.n_docs if last is None else last
        least = np.array(self._least, np.int64).view(np.uint64)
        known = np.arange(max(first, self.n_null), max(last, self.n_null)) - self.n_null
        above = self._above.take(known) if len(known) else np.empty(0, np.uint64)
        return [None] * (last - first - len(known)) + (above + least).view(np.int64).tolist()


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _put(path: str, data: bytes) -> None:
    """Write under another name first, so that a name stands for a complete file."""
    files, place = _filesystem(path)
    files.create_dir(place.rpartition("/")[0], recursive=True)
    unfinished = f"{place}.{uuid.uuid4().hex}"
    with files.open_output_stream(unfinished) as out:
        out.write(data)
    files.move(unfinished, place)


def _get(path: str) -> bytes:
    files, place = _filesystem(path)
    with files.open_input_stream(place) as source:
        return source.read()


def _manifest_row(path: str) -> dict[str, object]:
    """A row of the manifest, from the header of a file."""
    files, place = _filesystem(path)
    with files.open_input_stream(place) as source:
        _, _, n_docs, n_ids, _, _ = _HEAD.unpack(source.read(_HEAD.size))
    shard = path.rpartition("/")[2].removesuffix(".ids")
    return {"path": path, "shard": shard, "n_docs": n_docs, "n_ids": n_ids}


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    folder: str | None = None,
    doc_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """Write the shards; the manifest has a row ``(path, shard, n_docs, n_ids)`` for each.

    Ties of an id are spread by a hash of the text, so no single id must fit one partition.
    """
    spark = docs.sparkSession
    folder = (folder or scratch_path(spark, "tokens")).rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(tokenizer)
        width = 2 if max(end_id, library.largest_id) < 1 << 16 else 4
        partition = TaskContext.get().partitionId()
        held: list[int | None] = []
        ids: list[np.ndarray] = []
        size = shards = 0

        def close() -> pa.RecordBatch:
            shard = f"{partition:06d}-{shards:06d}"
            path = f"{folder}/{shard}.ids"
            _put(path, shard_bytes(held, ids, width))
            row = {"path": path, "shard": shard, "n_docs": len(held), "n_ids": size}
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            names = batch.column("doc").to_pylist()
            texts = batch.column("text").to_pylist()
            for doc, own in zip(names, library.encode_ended(texts, end_id), strict=True):
                held.append(doc)
                ids.append(own.astype(f"<u{width}"))
                size += len(own)
                if size >= shard_ids or len(held) >= SHARD_DOCS:
                    yield close()
                    held, ids, size, shards = [], [], 0, shards + 1
        if held:
            yield close()
        library.forget()

    source = docs.select(F.col(doc_col).cast("long").alias("doc"), whole_text(text_col).alias("text"))
    ranged = source.withColumn("_tie", F.xxhash64("text")).repartitionByRange("doc", "_tie")
    ordered = ranged.sortWithinPartitions("doc", "_tie").drop("_tie")
    with session_options(spark, SMALL_BATCHES):
        return materialize(ordered.mapInArrow(write, MANIFEST))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``(doc, start, n_tokens, ids_crc32)`` per document, from the files.

    The ids before a shard are summed over the manifest, one row per file.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(batch.column(c).to_pylist() for c in ("path", "base")), strict=True):
                shard = Shard(_get(path))
                for first in range(0, shard.n_docs, READ_DOCS):
                    last = min(first + READ_DOCS, shard.n_docs)
                    starts, ends = shard.spans(first, last)
                    sums = [checksum(shard.ids[a:b]) for a, b in zip(starts, ends, strict=True)]
                    columns = [
                        pa.array(shard.doc_ids(first, last), pa.int64()),
                        pa.array(starts + base),
                        pa.array(ends - starts),
                        pa.array(sums, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc", "start", "n_tokens", "ids_crc32"])

    return based.repartition("path").mapInArrow(read, DOCUMENTS)


def read_folder(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of a folder, from the headers of its files."""
    from pyarrow import fs

    files, place = _filesystem(folder)
    paths = [x.base_name for x in files.get_file_info(fs.FileSelector(place)) if x.base_name.endswith(".ids")]
    names = spark.createDataFrame([(f"{folder.rstrip('/')}/{x}",) for x in sorted(paths)], "path string")

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_manifest_row(path) for path in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_pylist(rows)

    return names.mapInArrow(heads, MANIFEST)
