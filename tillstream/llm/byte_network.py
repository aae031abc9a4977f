"""Quality classifier: a convolutional network over the bytes of a text, in numpy.

The bytes are embedded; learned filters look at 8 bytes every 4 bytes. Their values are max-pooled
over chunks of two segments; each chunk overlaps the next by one segment, and together they cover
the whole text. Mean, maximum and minimum over the chunks go through one hidden layer to one
probability. A chunk that says the same again and again raises few filters, so the minimum tells it.

The network is fitted on a bounded sample: at most ``TRAIN_ROWS`` labelled documents, those with
the smallest hash of their id, of at most ``TRAIN_BYTES`` bytes each. Scores cover whole texts.

Defined results: a NULL or empty text is scored as one chunk of padding. Labels that are NULL or of
a NULL id are not used; several labels of a document count as the lowest. Without labels of both
kinds every score is the mean label, or 0.5 without any. NULL ids are held out by the remainder of
the empty string. Every row is scored by its text alone. Other columns are carried along, whatever
their names, but for ``score`` and ``predicted``, which ``classify`` replaces. An empty table gives an
empty table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.text import as_rows, own_columns, whole_text
from tillstream.llm.worker_memory import SMALL_BATCHES, remember
from tillstream.operators.joins import lookup_join
from tillstream.session import materialize, session_options

TRAIN_ROWS = 8000
TRAIN_BYTES = 16_384
THRESHOLD = 0.7
HELD_OUT = (4, 2)

SEGMENT = 512
STEP = 4
DIMENSIONS = 8
FILTERS = 64
HIDDEN = 32
PAD = 256
BATCH = 32
# Rows seen in a fit: each row so often, and all together at least so many.
EPOCHS = 8
LEAST_SEEN = 20_000
RATE = 3e-3

# Segments computed at a time, whatever the length of a text.
_BLOCK = 256
_RUN_BYTES = 1 << 20


@dataclass
class Network:
    """``embedding`` (257 x D), ``filters`` (2 * STEP * D x F) with ``bias``, and two dense layers."""

    weights: dict[str, np.ndarray]
    constant: float | None = None

    @classmethod
    def fresh(cls, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)

        def normal(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        embedding = rng.standard_normal((PAD + 1, DIMENSIONS)).astype(np.float32)
        return cls(
            {
                "embedding": embedding,
                "filters": normal(2 * STEP * DIMENSIONS, FILTERS),
                "bias": np.zeros(FILTERS, np.float32),
                "dense": normal(3 * FILTERS, HIDDEN),
                "dense_bias": np.zeros(HIDDEN, np.float32),
                "out": normal(HIDDEN, 1),
                "out_bias": np.zeros(1, np.float32),
            }
        )


def padded(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each filled up to whole segments, and the segments per text.

    A text starts with one step of padding, so the last window before it sees none of its bytes.
    """
    counts = np.array([-(-(STEP + len(x)) // SEGMENT) for x in texts])
    stream = np.full(int(counts.sum()) * SEGMENT + STEP, PAD, np.int16)
    at = 0
    for text, count in zip(texts, counts, strict=True):
        stream[at + STEP : at + STEP + len(text)] = np.frombuffer(text, np.uint8)
        at += count * SEGMENT
    return stream, counts


def _windows(weights: dict[str, np.ndarray], stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedded steps, and the filters at each window of two steps, by segment."""
    steps = weights["embedding"][stream].reshape(-1, STEP * DIMENSIONS)
    half = STEP * DIMENSIONS
    values = steps[:-1] @ weights["filters"][:half]
    values += steps[1:] @ weights["filters"][half:]
    return steps, values.reshape(-1, SEGMENT // STEP, FILTERS)


def _blocks(stream: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    segments = len(stream) // SEGMENT
    for first in range(0, segments, _BLOCK):
        last = min(first + _BLOCK, segments)
        yield first, stream[first * SEGMENT : last * SEGMENT + STEP]


def _pooled(segments: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per chunk the segment that holds each filter's maximum; chunks per text; first chunks."""
    ends = np.cumsum(counts)
    chunks = np.maximum(counts - 1, 1)
    firsts = np.cumsum(chunks) - chunks
    left = np.arange(chunks.sum()) + np.repeat(ends - counts - firsts, chunks)
    right = left + np.repeat(counts > 1, chunks)
    from_right = segments[right] > segments[left]
    return np.where(from_right, right[:, None], left[:, None]), chunks, firsts


def _head(
    weights: dict[str, np.ndarray], segments: np.ndarray, counts: np.ndarray
) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Probability of each text from its segments' maxima, and what a gradient needs."""
    source, chunks, firsts = _pooled(segments, counts)
    activations = np.maximum(np.take_along_axis(segments, source, 0) + weights["bias"], 0)
    mean = np.add.reduceat(activations, firsts) / chunks[:, None]
    most = np.maximum.reduceat(activations, firsts)
    least = np.minimum.reduceat(activations, firsts)
    features = np.hstack([mean, most, least]).astype(np.float32)
    hidden = np.tanh(features @ weights["dense"] + weights["dense_bias"])
    logit = (hidden @ weights["out"] + weights["out_bias"])[:, 0].astype(np.float64)
    kept = {"source": source, "chunks": chunks, "activations": activations}
    kept |= {"most": most, "least": least, "features": features, "hidden": hidden}
    return 1 / (1 + np.exp(-np.clip(logit, -60, 60))), kept


def scores(network: Network, texts: Sequence[str]) -> np.ndarray:
    """Probability that each whole text is labelled 1."""
    if network.constant is not None:
        return np.full(len(texts), network.constant)
    out, run, size = [], [], 0

    def finish() -> None:
        stream, counts = padded(run)
        maxima = [_windows(network.weights, part)[1].max(1) for _, part in _blocks(stream)]
        out.append(_head(network.weights, np.concatenate(maxima), counts)[0])

    for text in texts:
        run.append(text.encode("utf-8", "replace"))
        size += len(run[-1])
        if size >= _RUN_BYTES or len(run) >= 1000:
            finish()
            run, size = [], 0
    if run:
        finish()
    return np.concatenate(out) if out else np.zeros(0)


def _gradients(
    weights: dict[str, np.ndarray], texts: Sequence[bytes], labels: np.ndarray, importance: np.ndarray
) -> dict[str, np.ndarray]:
    """Gradients of the cross-entropy of a batch; through a maximum only its place counts."""
    stream, counts = padded(texts)
    steps, values = _windows(weights, stream)
    places = values.argmax(1)
    segments = np.take_along_axis(values, places[:, None, :], 1)[:, 0]
    probability, kept = _head(weights, segments, counts)
    error = ((probability - labels) * importance / importance.sum()).astype(np.float32)[:, None]
    grads = {"out": kept["hidden"].T @ error, "out_bias": error.sum(0)}
    hidden = error @ weights["out"].T * (1 - kept["hidden"] ** 2)
    grads |= {"dense": kept["features"].T @ hidden, "dense_bias": hidden.sum(0)}
    features = hidden @ weights["dense"].T
    chunks, activations = kept["chunks"], kept["activations"]
    owner = np.repeat(np.arange(len(chunks)), chunks)
    firsts = np.cumsum(chunks) - chunks
    chunk = features[owner, :FILTERS] / chunks[owner, None]
    for name, part in (("most", features[:, FILTERS:-FILTERS]), ("least", features[:, -FILTERS:])):
        there = activations == kept[name][owner]
        chunk += part[owner] * there / np.add.reduceat(there.astype(np.float32), firsts)[owner]
    chunk *= activations > 0
    grads["bias"] = chunk.sum(0)
    segment = np.zeros_like(segments)
    np.add.at(segment, (kept["source"], np.arange(FILTERS)[None]), chunk)
    # Each maximum leads back to its window: two steps of embedded bytes.
    window = places + np.arange(len(places))[:, None] * (SEGMENT // STEP)
    seen = np.concatenate([steps[window], steps[window + 1]], 2)
    grads["filters"] = np.einsum("sf,sfd->df", segment, seen, optimize=True)
    back = segment[:, :, None] * weights["filters"].T[None]
    at = window[:, :, None] * STEP + np.arange(2 * STEP)
    bytes_seen = stream[at].ravel()
    back = back.reshape(-1, DIMENSIONS)
    grads["embedding"] = np.stack(
        [np.bincount(bytes_seen, back[:, d], PAD + 1) for d in range(DIMENSIONS)], 1
    ).astype(np.float32)
    return grads


def fit(texts: Sequence[str], labels: Sequence[int], seed: int = 7) -> Network:
    """Fit by Adam; rows of the rarer label weigh more, up to an even share."""
    labels = np.asarray(labels, float)
    if len(set(labels.tolist())) < 2:
        return Network({}, float(labels.mean()) if len(labels) else 0.5)
    network = Network.fresh(seed)
    data = [x.encode("utf-8", "replace") for x in texts]
    share = labels.mean()
    importance = np.where(labels == 1, np.sqrt(1 / share), np.sqrt(1 / (1 - share)))
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in network.weights.items()}
    second = {k: np.zeros_like(v) for k, v in network.weights.items()}
    epochs = max(EPOCHS, -(-LEAST_SEEN // len(data)))
    step, steps = 0, epochs * -(-len(data) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for begin in range(0, len(order), BATCH):
            rows = order[begin : begin + BATCH]
            grads = _gradients(
                network.weights, [data[k] for k in rows], labels[rows], importance[rows]
            )
            step += 1
            rate = RATE * (1 - step / (steps + 1)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for name, grad in grads.items():
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.999 * second[name] + 0.001 * grad**2
                change = rate * first[name] / (np.sqrt(second[name]) + 1e-7)
                network.weights[name] -= change.astype(np.float32)
    return network


def held_out(doc: Column) -> Column:
    parts, remainder = HELD_OUT
    return F.crc32(F.coalesce(doc.cast("string"), F.lit("")).cast("binary")) % parts == remainder


def training_rows(
    docs: DataFrame,
    labels: DataFrame,
    doc_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = TRAIN_ROWS,
) -> DataFrame:
    """``(doc, text, label)`` of at most ``rows`` documents that are not held out."""
    judged = (
        labels.select(F.col(doc_col).alias("doc"), F.col(label_col).alias("label"))
        .where(F.col("doc").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc")))
        .groupBy("doc")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc"), "doc")
        .limit(rows)
    )
    texts = docs.select(F.col(doc_col).alias("doc"), whole_text(text_col).alias("text")).where(
        F.octet_length("text") <= TRAIN_BYTES
    )
    # At most ``rows`` ids are broadcast.
    return texts.join(F.broadcast(judged), "doc").groupBy("doc", "label").agg(F.min("text").alias("text"))


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = TRAIN_ROWS,
) -> Network:
    """Network fitted on the driver, on the bounded sample."""
    sample = training_rows(docs, labels, doc_col, text_col, label_col, rows).collect()
    sample.sort(key=lambda row: row.doc)
    return fit([row.text for row in sample], [row.label for row in sample])


def _nothing() -> None:
    """There is nothing to forget."""


def quality_score(text: Column, network: Network) -> Column:
    """Score of each whole text; the network has a fixed size and travels with the task."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        remember("byte_network", _nothing)
        return pd.Series(scores(network, texts.tolist()))

    return scored(whole_text(text))


def keep_good(
    docs: DataFrame, network: Network, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The documents that score at least ``threshold``.

    Texts are scored at once, in small batches, and only md5 digests of those below are written. These are
    looked up by broadcast while they fit, so that the documents stay where they are.
    """

    def digest(text: Column) -> Column:
        return F.unhex(F.md5(whole_text(text))).alias("_digest")

    text = F.col(text_col)
    below = docs.where(quality_score(text, network) < threshold).select(digest(text)).distinct()
    with session_options(docs.sparkSession, SMALL_BATCHES):
        below = materialize(below)
    rows = as_rows(docs).select("row", digest(F.col("row").getField(text_col)))
    return lookup_join(rows, below, "_digest", how="left_anti").select(*own_columns(docs))


def classify(
    docs: DataFrame, network: Network, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The documents with ``score`` and ``predicted``, which take the place of columns of these names."""
    return docs.withColumn("score", quality_score(F.col(text_col), network)).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
