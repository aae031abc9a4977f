"""Similarity join of documents on the Jaccard index of their word n-grams.

Filtering by several global orders: two similar sets share a token among their first few under any
order of all tokens. The first order puts rare tokens first and yields candidates; candidates must
share a prefix token under each other order as well, before their whole sets are compared.

Pairs are not listed within a group that shares a token. Equal sets are one node. In the first
round each member of a group is compared with one hub, its member with the token furthest in
front. What the links leave in different components meets pair by pair in groups of a few members, a
bounded number for each. In larger ones, where one token speaks for all that the same members share,
they meet in tiles: members of similar size in blocks of bounded number, where a bound on the common
tokens is compared in memory, and only what passes it leaves a tile as a pair for the other filters.
What comes out is the components, exactly.

Tokens are 64-bit hashes of n-grams. How often a token occurs is counted over the whole corpus in
2**18 cells by a part of the hash; any order is right, this one keeps frequent tokens out of prefixes.

Defined results: a NULL text, or one without words, has an empty set and links with nothing. With
fewer words than n, the whole sequence is the only token. Rows with the same id are one document,
which links through any of its texts. Rows without id link with nothing and have no component. An
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.components import components
from tillstream.llm.text import LOWERED, whole_text
from tillstream.llm.worker_memory import SMALL_BATCHES, give_back, remember
from tillstream.operators.joins import fits_broadcast
from tillstream.session import Scratch, materialize, session_options

WORDS = 5
SIMILARITY = (80, 100)

CELLS_LOG2 = 18
BITS_LOG2 = 27
_BLOCK = 1 << 14
_SLICE = 256
# Members of a tile, fewer for large sets: rows times their size are bounded.
TILE_ROWS = 1024
# Members of a group whose pairs are listed, those that size and place allow: a group that one tile
# would hold. Larger ones meet in tiles.
PAIRED = TILE_ROWS
_TILE_CELLS = 1 << 22
_MAX_REMEMBERED = 200_000
# One of these seeds per further order.
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MULTIPLIER = np.uint64(0x5851F42D4C957F2D)


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """Spread all bits over all bits, one to one."""
    numbers = (numbers ^ (numbers >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    numbers = (numbers ^ (numbers >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return numbers ^ (numbers >> np.uint64(31))


class _WordHashes(dict):
    """64-bit hash of each lower-cased word, remembered; 0 for no word."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _MAX_REMEMBERED:
            self.clear()
        digest = hashlib.blake2b(word.translate(LOWERED).encode(), digest_size=8).digest()
        value = (int.from_bytes(digest, "little") or 1) if word else 0
        self[word] = value
        return value


_HASHES = _WordHashes()


def _start_hashing() -> None:
    remember("ngram_join", _HASHES.clear)


def _stop_hashing() -> None:
    _HASHES.clear()
    give_back()


def tokens_of(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of a text."""
    for space in "\t\n\x0b\x0c\r":
        text = text.replace(space, " ")
    parts = text.split(" ")
    hashes = np.fromiter(map(_HASHES.__getitem__, parts), np.uint64, len(parts))
    hashes = hashes[hashes != 0]
    if not len(hashes):
        return hashes
    size = min(words, len(hashes))
    grams = np.full(len(hashes) - size + 1, size, np.uint64)
    for k in range(size):
        grams = grams * _MULTIPLIER + hashes[k : k + len(grams)]
    return np.unique(_mixed(grams))


class Similarity:
    """A Jaccard index of at least ``numerator / denominator``, in whole numbers."""

    def __init__(self, numerator: int, denominator: int) -> None:
        if not 0 < numerator <= denominator:
            raise ValueError("similarity must be above 0 and at most 1")
        self.numerator, self.denominator = numerator, denominator

    def prefix(self, size: int) -> int:
        """Tokens in front of which a similar set must have one."""
        return size - -(-self.numerator * size // self.denominator) + 1

    def holds(self, common: int, size_a: int, size_b: int) -> bool:
        return self.denominator * common >= self.numerator * (size_a + size_b - common)

    def possible(self, size_a: Column, place_a: Column, size_b: Column, place_b: Column) -> Column:
        """Whether sets can be similar whose first common token is at these places."""
        overlap = F.least(size_a - place_a, size_b - place_b)
        needed = (size_a + size_b) * self.numerator
        shorter, longer = F.least(size_a, size_b), F.greatest(size_a, size_b)
        return (overlap * (self.numerator + self.denominator) >= needed) & (
            shorter * self.denominator >= longer * self.numerator
        )


def slices(batches: Iterator[pa.RecordBatch], rows: int = _SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in small parts, so that a worker holds little beside the batch itself."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)
    give_back()


def _binaries(column: pa.Array, kind: type = np.uint64) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in column]


def token_sets(docs: DataFrame, doc_col: str, text_col: str, words: int) -> DataFrame:
    """``(doc, n, digest, tokens)``: set size, a digest of the set, and the sorted hashes."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _start_hashing()
        for batch in slices(batches):
            sets = [tokens_of(text, words) for text in batch.column("text").to_pylist()]
            data = [x.tobytes() for x in sets]
            columns = [
                batch.column("doc"),
                pa.array([len(x) for x in sets], pa.int64()),
                pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in data], pa.binary()),
                pa.array(data, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "n", "digest", "tokens"])
        _stop_hashing()

    source = docs.select(F.col(doc_col).cast("long").alias("doc"), whole_text(text_col).alias("text"))
    return source.mapInArrow(hashed, "doc long, n long, digest binary, tokens binary")


_BLOCKS = "block int, counts binary"


def _block_rows(blocks: Iterable[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    pairs = [(block, values.tobytes()) for block, values in blocks]
    columns = [pa.array([x[0] for x in pairs], pa.int32()), pa.array([x[1] for x in pairs], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["block", "counts"])


def _reduced(
    parts: DataFrame, add: Callable[[np.ndarray | None, np.ndarray], np.ndarray], kind: type
) -> dict[int, np.ndarray]:
    """The parts of each block combined, one after the other; a fixed number of blocks."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column("block").to_pylist(), batch.column("counts"), strict=True):
                sums[block] = add(sums.get(block), np.frombuffer(part.as_buffer(), np.uint32))
        if sums:
            yield _block_rows(sums.items())

    rows = parts.repartition("block").mapInArrow(combine, _BLOCKS).collect()
    return {row.block: np.frombuffer(row.counts, kind) for row in rows}


def token_frequencies(sets: DataFrame) -> np.ndarray:
    """Tokens of all sets per cell: a fixed number of counts, summed per task, then per block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELLS_LOG2, np.int64)
        for batch in slices(batches):
            tokens = np.concatenate(_binaries(batch.column("tokens")))
            cells += np.bincount((tokens >> np.uint64(64 - CELLS_LOG2)).view(np.int64), minlength=len(cells))
        limited = np.minimum(cells, 0xFFFFFFFF).astype(np.uint32).reshape(-1, _BLOCK)
        yield _block_rows(enumerate(limited))

    def add(total: np.ndarray | None, part: np.ndarray) -> np.ndarray:
        return part.astype(np.int64) if total is None else total + part

    sums = _reduced(sets.select("tokens").mapInArrow(count, _BLOCKS), add, np.int64)
    cells = np.zeros((1 << CELLS_LOG2) // _BLOCK * _BLOCK, np.int64).reshape(-1, _BLOCK)
    for block, values in sums.items():
        cells[block] = values
    return cells.ravel()


def token_bits(tokens: DataFrame) -> np.ndarray:
    """A bit for each of ``2**BITS_LOG2`` values of a part of the token's hash, set where one has it."""
    block_bits = 1 << (BITS_LOG2 - 8)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = np.unique(_slots(batch.column("token").to_numpy().view(np.uint64)))
            edges = np.searchsorted(slots, np.arange(257) * block_bits)
            inside = (slots % block_bits).astype(np.uint32)
            yield _block_rows((k, inside[edges[k] : edges[k + 1]]) for k in range(256))

    def mark(bits: np.ndarray | None, slots: np.ndarray) -> np.ndarray:
        bits = np.zeros(block_bits // 8, np.uint8) if bits is None else bits
        np.bitwise_or.at(bits, slots >> 3, np.left_shift(1, slots & 7).astype(np.uint8))
        return bits

    found = _reduced(tokens.select("token").mapInArrow(deal, _BLOCKS), mark, np.uint8)
    bits = np.zeros((256, block_bits // 8), np.uint8)
    for block, values in found.items():
        bits[block] = values
    return bits.ravel()


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(8)) & np.uint64((1 << BITS_LOG2) - 1)


def prefix_tokens(
    sets: DataFrame,
    frequencies: np.ndarray,
    similarity: Similarity,
    bits: np.ndarray | None = None,
) -> DataFrame:
    """``(token, doc, n, place)`` of the prefix of each set under the order by frequency.

    With ``bits`` only tokens whose bit is set; both tables have a fixed size.
    """
    context = sets.sparkSession.sparkContext
    limited = np.minimum(frequencies, 0xFFFFFFFF).astype(np.uint32)
    cells, wanted = context.broadcast(limited), context.broadcast(bits)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fronts, places = [], []
            for tokens in _binaries(batch.column("tokens")):
                counts = cells.value[tokens >> np.uint64(64 - CELLS_LOG2)]
                front = tokens[np.argsort(counts, kind="stable")[: similarity.prefix(len(tokens))]]
                place = np.arange(len(front), dtype=np.int32)
                if wanted.value is not None:
                    slots = _slots(front)
                    there = wanted.value[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8) & 1
                    front, place = front[there == 1], place[there == 1]
                fronts.append(front)
                places.append(place)
            rows = pa.array(np.repeat(np.arange(len(fronts)), [len(x) for x in fronts]))
            columns = [
                pa.array(np.concatenate(fronts).view(np.int64)),
                batch.column("doc").take(rows),
                batch.column("n").take(rows),
                pa.array(np.concatenate(places)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["token", "doc", "n", "place"])

    filled = sets.where("n > 0").select("doc", "n", "tokens")
    return filled.mapInArrow(cut, "token long, doc long, n long, place int")


def among(rows: DataFrame, ids: DataFrame, how: str, key: str | list[str] = "doc") -> DataFrame:
    """Rows whose key is, or is not, among the ids; these are broadcast if that is small."""
    return rows.join(F.broadcast(ids) if fits_broadcast(ids) else ids, key, how)


def _pairwise(
    pairs: DataFrame,
    values: DataFrame,
    keep: Callable[..., bool],
    columns: Sequence[str],
    kind: type,
    scratch: Scratch,
) -> DataFrame:
    """Pairs ``(a, b)`` whose values pass ``keep(*values of a, *values of b)``."""
    left = values.select(F.col("doc").alias("a"), *[F.col(c).alias(f"{c}_a") for c in columns])
    right = values.select(F.col("doc").alias("b"), *[F.col(c).alias(f"{c}_b") for c in columns])
    joined = pairs.join(left, "a").join(right, "b")

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = [_binaries(batch.column(f"{c}_{side}"), kind) for side in "ab" for c in columns]
            stay = pa.array([keep(*x) for x in zip(*own, strict=True)], pa.bool_())
            yield batch.select(["a", "b"]).filter(stay)

    return scratch.keep(joined.mapInArrow(passing, "a long, b long").distinct())


def _tally(tokens: np.ndarray) -> np.ndarray:
    """How many tokens have each value of the first bits of their hash, about one value per token.

    Nothing if a count does not fit one byte.
    """
    bits = min(max(len(tokens).bit_length() - 1, 6), 16)
    counts = np.bincount((tokens >> np.uint64(64 - bits)).view(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8) if counts.max(initial=0) < 256 else np.zeros(0, np.uint8)


def _most_common(a: np.ndarray, b: np.ndarray) -> int:
    """Upper bound of the tokens that sets with these tallies share."""
    if len(a) > len(b):
        a, b = b, a
    folded = b.reshape(len(a), -1).sum(1, dtype=np.int64)
    return int(np.minimum(a, folded).sum())


def _common(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


_SHORT = "doc long, first binary, second binary, tally binary, n binary"


def _shortened(held: DataFrame, similarity: Similarity) -> DataFrame:
    """Prefixes under the other orders and the tally of each set.

    Prefixes are the 16-bit ends of their hashes: what two share, their ends share too.
    """

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = _binaries(batch.column("tokens"))
            columns = [batch.column("doc")]
            for seed in _SEEDS:
                fronts = []
                for tokens in sets:
                    front = np.sort(_mixed(tokens ^ np.uint64(seed)))[: similarity.prefix(len(tokens))]
                    fronts.append(np.unique(front.astype(np.uint16)).tobytes())
                columns.append(pa.array(fronts, pa.binary()))
            columns.append(pa.array([_tally(tokens).tobytes() for tokens in sets], pa.binary()))
            columns.append(pa.array([np.uint64(len(x)).tobytes() for x in sets], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["doc", "first", "second", "tally", "n"])

    return held.mapInArrow(shorten, _SHORT)


def _ids(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    return scratch.keep(pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct())


def _verified(pairs: DataFrame, sets: DataFrame, similarity: Similarity, scratch: Scratch) -> DataFrame:
    """The pairs whose whole sets are similar."""

    def similar(a: np.ndarray, b: np.ndarray) -> bool:
        return similarity.holds(_common(a, b), len(a), len(b))

    whole = among(sets.select("doc", "tokens"), _ids(pairs, scratch), "left_semi")
    return _pairwise(pairs, whole, similar, ["tokens"], np.uint64, scratch)


def similar_pairs(
    pairs: DataFrame, sets: DataFrame, similarity: Similarity, scratch: Scratch
) -> DataFrame:
    """The pairs ``(a, b)`` that are similar: the other orders' prefixes, then the sets.

    Of the sets the tallies are compared first, that bound what they can share; whole sets for the
    few left.
    """

    def share(*fronts: np.ndarray) -> bool:
        half = len(fronts) // 2
        return all(_common(x, y) for x, y in zip(fronts[:half], fronts[half:], strict=True))

    def may_be_similar(a: np.ndarray, size_a: np.ndarray, b: np.ndarray, size_b: np.ndarray) -> bool:
        if not len(a) or not len(b):
            return True
        sizes = (int(size.view(np.uint64)[0]) for size in (size_a, size_b))
        return similarity.holds(_most_common(a, b), *sizes)

    held = among(sets.select("doc", "tokens"), _ids(pairs, scratch), "left_semi")
    short = scratch.keep(_shortened(held, similarity))
    passed = _pairwise(pairs, short, share, ["first", "second"], np.uint16, scratch)
    likely = _pairwise(passed, short, may_be_similar, ["tally", "n"], np.uint8, scratch)
    return _verified(likely, sets, similarity, scratch)


def _open_groups(rows: DataFrame, links: DataFrame) -> DataFrame:
    """The rows ``(token, doc, n, place)`` of groups in several components, with their ``component``."""
    found = components(links).select(F.col("node").alias("doc"), "component")
    placed = rows.join(found, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    ends = placed.groupBy("token").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    apart = ends.where("least < most").select("token")
    return placed.join(apart, "token", "left_semi").select("token", "doc", "n", "place", "component")


def _one_token_of_equal_groups(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Of tokens with the same members one, each member with its first place among them.

    The number of members and two sums of their hashes tell tokens apart. All these tokens are common
    to any two members, so the first one is at these places in both.
    """
    sums = [
        F.sum(F.xxhash64(F.lit(seed), "doc").cast("decimal(20,0)")).alias(f"s{seed}") for seed in (1, 2)
    ]
    members = scratch.keep(rows.groupBy("token").agg(F.count(F.lit(1)).alias("k"), *sums))
    same = ["k", "s1", "s2"]
    speakers = members.groupBy(*same).agg(F.min("token").alias("speaker"))
    spoken = rows.join(members.join(speakers, same).select("token", "speaker"), "token")
    firsts = spoken.groupBy("speaker", "doc", "n", "component").agg(F.min("place").alias("place"))
    return firsts.withColumnRenamed("speaker", "token")


def _pairs_of_few(rows: DataFrame, similarity: Similarity) -> DataFrame:
    """Members of small groups that are in different components."""
    x, y = rows.alias("x"), rows.alias("y")
    meeting = (
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.doc") < F.col("y.doc"))
        & (F.col("x.component") != F.col("y.component"))
        & similarity.possible(F.col("x.n"), F.col("x.place"), F.col("y.n"), F.col("y.place"))
    )
    return x.join(y, meeting).select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b")).distinct()


_TILE = ["token", "band", "row", "col"]


def _tiles(rows: DataFrame, similarity: Similarity) -> DataFrame:
    """Members by tile, with their own band of sizes and the block they are in.

    Similar sets are in one band or in neighbouring ones, so a set goes to the tiles of its own and of
    the next. Blocks are bounded in rows, and for large sets in cells of their tallies.
    """
    ratio = math.log(similarity.denominator / similarity.numerator) + 0.001
    own = F.floor(F.log("n") / ratio).cast("int")
    banded = rows.withColumn("own", own).withColumn("band", F.explode(F.array(own, own + 1)))
    fits = F.least(F.lit(TILE_ROWS), F.greatest(F.lit(64), F.floor(F.lit(_TILE_CELLS) / F.max("n"))))
    sizes = banded.groupBy("token", "band").agg(F.ceil(F.count(F.lit(1)) / fits).cast("int").alias("blocks"))
    dealt = banded.join(sizes, ["token", "band"]).withColumn(
        "block", F.pmod(F.xxhash64(F.lit("block"), "doc"), "blocks").cast("int")
    )
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("partner")
    return dealt.select("*", partner).select(
        "token",
        "band",
        F.least("block", "partner").alias("row"),
        F.greatest("block", "partner").alias("col"),
        "block",
        "own",
        "doc",
        "n",
        "component",
    )


def _coarse_tally(tokens: np.ndarray) -> np.ndarray:
    """The tally over about a value for four tokens, each in one byte, or nothing where one does not fit."""
    tally = _tally(tokens).astype(np.int64)
    width = max(64, len(tally) // 4) if len(tally) else 1
    coarse = tally.reshape(width, -1).sum(1) if len(tally) else tally
    return coarse.astype(np.uint8) if coarse.max(initial=0) < 256 else np.zeros(0, np.uint8)


def _folded(tallies: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Tallies of one length as rows, and which sets have none."""
    none = np.array([not len(x) for x in tallies])
    width = min((len(x) for x in tallies if len(x)), default=1)
    rows = [x.reshape(width, -1).sum(1) if len(x) else np.zeros(width) for x in tallies]
    return np.array(rows, dtype=np.uint16), none


def _passing(tile: pa.Table, similarity: Similarity) -> list[tuple[int, int]]:
    """Pairs of a tile in different components whose tallies let them be similar."""
    doc, n, component, own, block = (
        tile.column(x).to_numpy() for x in ("doc", "n", "component", "own", "block")
    )
    band, crossed = tile.column("band")[0].as_py(), tile.column("row")[0] != tile.column("col")[0]
    folded, none = _folded(_binaries(tile.column("tally").combine_chunks(), np.uint8))
    above, below = similarity.numerator, similarity.denominator
    found = []
    for k in range(len(doc) - 1):
        later = slice(k + 1, len(doc))
        may = component[later] != component[k]
        may &= np.minimum(n[later], n[k]) * below >= np.maximum(n[later], n[k]) * above
        if own[k] != band:
            may &= own[later] == band
        if crossed:
            may &= block[later] != block[k]
        others = np.flatnonzero(may) + k + 1
        if not len(others):
            continue
        common = np.minimum(folded[others], folded[k]).sum(1, dtype=np.int64)
        fits = none[others] | none[k] | (below * common >= above * (n[others] + n[k] - common))
        found += [(min(doc[k], doc[x]), max(doc[k], doc[x])) for x in others[fits]]
    return found


def _met_in_tiles(
    rows: DataFrame, sets: DataFrame, similarity: Similarity, scratch: Scratch
) -> DataFrame:
    """``(a, b)``: members of a group in different components whose tallies let them be similar."""

    def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            tallies = [_coarse_tally(tokens).tobytes() for tokens in _binaries(batch.column("tokens"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(tallies, pa.binary())], ["doc", "tally"])

    docs = scratch.keep(rows.select("doc").distinct())
    held = among(sets.select("doc", "tokens"), docs, "left_semi")
    known = scratch.keep(held.mapInArrow(tallied, "doc long, tally binary"))
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _tiles(rows, similarity).join(known, "doc").repartition(width, *_TILE).sortWithinPartitions(*_TILE)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        name = None

        def close() -> pa.RecordBatch:
            found = _passing(pa.Table.from_batches(held), similarity)
            a, b = np.array(found, dtype=np.int64).reshape(-1, 2).T
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            columns = [batch.column(x).to_numpy() for x in _TILE]
            changes = np.any([x[1:] != x[:-1] for x in columns], axis=0)
            bounds = [0, *(np.flatnonzero(changes) + 1), batch.num_rows]
            for begin, stop in zip(bounds[:-1], bounds[1:], strict=True):
                here = tuple(x[begin] for x in columns) if stop > begin else name
                if held and here != name:
                    yield close()
                    held = []
                name = here
                held.append(batch.slice(begin, stop - begin))
        if held:
            yield close()
        give_back()

    return dealt.mapInArrow(meet, "a long, b long").distinct()


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def links_between(sets: DataFrame, similarity: Similarity, scratch: Scratch) -> DataFrame:
    """``(a, b)``: links that connect whatever similar sets connect; sets are read repeatedly."""
    frequencies = token_frequencies(sets)
    tokens = prefix_tokens(sets, frequencies, similarity)
    hubs = tokens.groupBy("token").agg(
        F.min(F.struct("place", "doc", "n")).alias("hub"), F.count(F.lit(1)).alias("members")
    )
    # Tokens of one document alone, the most by far, end here, and mostly before the next shuffle.
    hubs = scratch.keep(hubs.where("members > 1").drop("members"))
    members = prefix_tokens(sets, frequencies, similarity, token_bits(hubs))
    shared = scratch.keep(members.join(hubs, "token"))
    with_hub = shared.where(
        (F.col("doc") != F.col("hub.doc"))
        & similarity.possible(F.col("n"), F.col("place"), F.col("hub.n"), F.col("hub.place"))
    )
    first = scratch.keep(with_hub.select(*_ordered(F.col("doc"), F.col("hub.doc"))).distinct())
    first_links = similar_pairs(first, sets, similarity, scratch)

    opened = scratch.keep(_open_groups(shared.drop("hub"), first_links))
    sizes = scratch.keep(opened.groupBy("token").agg(F.count(F.lit(1)).alias("members")))
    # Of two members one is the hub, so they have met.
    few = sizes.where(F.col("members").between(3, PAIRED)).select("token")
    many = sizes.where(F.col("members") > PAIRED).select("token")
    pairs = _pairs_of_few(opened.join(few, "token", "left_semi"), similarity)
    crowded = scratch.keep(opened.join(many, "token", "left_semi"))
    if not crowded.isEmpty():
        speaking = scratch.keep(_one_token_of_equal_groups(crowded, scratch))
        pairs = pairs.union(_met_in_tiles(speaking, sets, similarity, scratch)).distinct()
    second = scratch.keep(pairs.join(first, ["a", "b"], "left_anti"))
    return first_links.union(similar_pairs(second, sets, similarity, scratch))


def similar_documents(
    docs: DataFrame,
    doc_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    similarity: tuple[int, int] = SIMILARITY,
) -> DataFrame:
    """``(doc, n_shingles, component)`` per row of the documents.

    ``component`` is the least id that links lead to, the document's own included.
    """
    spark = docs.sparkSession
    with Scratch(spark) as scratch, session_options(spark, SMALL_BATCHES):
        sets = scratch.keep(token_sets(docs, doc_col, text_col, words))
        nodes = scratch.keep(
            sets.where("doc IS NOT NULL AND n > 0").groupBy("digest").agg(F.min("doc").alias("node"))
        )
        members = materialize(
            sets.select("doc", "n", "digest").join(nodes, "digest", "left").select("doc", "n", "digest", "node")
        )
        copies = scratch.keep(members.where("doc > node").select("doc", "digest").distinct())
        own = sets.where("doc IS NOT NULL AND n > 0")
        distinct_sets = among(own, copies, "left_anti", ["doc", "digest"]).select("doc", "n", "tokens")
        links = links_between(distinct_sets, Similarity(*similarity), scratch)
        # A document with several texts holds the nodes of all of them together.
        held = members.where("doc > node").select(F.col("doc").alias("a"), F.col("node").alias("b"))
        several = members.where("doc IS NOT NULL").groupBy("doc").agg(F.count_distinct("digest").alias("k"))
        bridges = held.join(several.where("k > 1"), held["a"] == several["doc"], "left_semi")
        found = components(links.union(bridges))
    joined = members.withColumn("_node", F.coalesce("node", "doc")).join(
        found.withColumnRenamed("node", "_node"), "_node", "left"
    )
    component = F.coalesce("component", F.when(F.col("n") > 0, F.col("node")), "doc")
    return joined.select("doc", F.col("n").alias("n_shingles"), component.alias("component"))
