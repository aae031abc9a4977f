"""Spelling variants: frequent words one edit apart, each with its more frequent form.

Words are compared as padded matrices of code points, block against block: where the lengths of the
common prefix and the common suffix of two words reach the longer length minus one, a single
insertion, deletion or replacement leads from one to the other.

Only blocks that can hold such a pair are compared. One edit leaves the longer half of the word whole
before or behind it, so each word is dealt to the tiles of its first and of its last half, for being
the longer or the shorter of a pair. A tile of many words is cut into blocks, and each pair of blocks is
a tile of its own, so no half of a word gathers in one task. A pair that shares both halves counts in the
tile of the first one. Tiles return sums and a minimum per word, never pairs.

Defined results: a NULL or empty text has no words; rows of equal id count each; a NULL id is the empty
text where the id is hashed. Words are counted over all rows. Without words the result is empty. Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.text import lower_ascii, whole_text
from tillstream.operators.joins import lookup_join
from tillstream.session import Scratch, materialize

# What a word is made of; all its letters have code points below 256.
LETTERS = "[A-Za-zÀ-ÿ]+"
ENCODING = "latin-1"

MIN_CHARS = 6
MIN_COUNT = 5
TYPO_ONE_IN = 199
FORM_FACTOR = 5

# Words of a tile, fewer for long words: rows times columns of a matrix are bounded.
TILE_WORDS = 4096
TILE_CELLS = 1 << 22
# Rows and columns of the blocks that are compared at once.
_BLOCK_ROWS = 128
_BLOCK_COLUMNS = 2048

_FOUND = "word string, n_near long, best struct<less: long, word: string>"


def letter_runs(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc, word)``: every run of letters, with A-Z lower-cased."""
    runs = F.regexp_extract_all(whole_text(text_col), F.lit(LETTERS), F.lit(0))
    return docs.select(F.col(doc_col).alias("doc"), F.explode(runs).alias("run")).select(
        "doc", lower_ascii(F.col("run")).alias("word")
    )


def with_typos(runs: DataFrame, one_in: int = TYPO_ONE_IN) -> DataFrame:
    """Runs of which one in so many lost a code point, chosen by a hash of id and run."""
    doc = F.coalesce(F.col("doc").cast("string"), F.lit(""))
    drawn = F.crc32(F.concat(doc, F.lit(":"), F.col("word")).cast("binary"))
    place = (F.col("_h") % F.length("word")).cast("int")
    cut = F.concat(
        F.substring(F.col("word"), F.lit(1), place),
        F.substring(F.col("word"), place + 2, F.length("word")),
    )
    hashed = runs.withColumn("_h", drawn)
    return hashed.withColumn("word", F.when(F.col("_h") % one_in == 0, cut).otherwise(F.col("word"))).drop("_h")


def count_words(runs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of the words long and frequent enough; summed per task before the shuffle."""
    counted = runs.where(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def _halves(words: DataFrame) -> DataFrame:
    """``(length, side, half, word, n)``: the tiles a word belongs to, ``length`` being the longer one's."""
    word = F.col("word")

    def tile(longer: Column, side: str) -> Column:
        kept = F.floor(longer / 2).cast("int")
        half = F.substring(word, F.lit(1), kept) if side == "first" else F.right(word, kept)
        return F.struct(longer.alias("length"), F.lit(side).alias("side"), F.xxhash64(half).alias("half"))

    own = F.length(word)
    tiles = F.array(*[tile(own + more, side) for more in (0, 1) for side in ("first", "last")])
    return words.select("word", "n", F.explode(tiles).alias("tile")).select("tile.*", "word", "n")


def _tiles(halves: DataFrame) -> DataFrame:
    """Words by tile ``(length, side, half, row, col)`` and the ``block`` they are in there.

    Blocks of a half come from the number of its words; a word goes to every pair of blocks that its
    own is in.
    """
    name = ["length", "side", "half"]
    fits = F.greatest(F.lit(1), F.least(F.lit(TILE_WORDS), F.floor(F.lit(TILE_CELLS) / F.col("length"))))
    sizes = halves.groupBy(*name).agg(F.count(F.lit(1)).alias("words"))
    large = sizes.where(F.col("words") > fits).select(
        *name, F.ceil(F.col("words") / fits).cast("int").alias("blocks")
    )
    cut = lookup_join(halves, large, name, how="left")
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = cut.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "word"), blocks).cast("int"))
    partner = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("partner")
    return dealt.select("*", partner).select(
        *name,
        F.least("block", "partner").alias("row"),
        F.greatest("block", "partner").alias("col"),
        "block",
        "word",
        "n",
    )


def _matrix(words: list[bytes], length: int) -> np.ndarray:
    """Code points, a row per word, padded with zeros at the end."""
    return np.array(words, dtype=f"S{length}").view(np.uint8).reshape(len(words), length)


def _common(rows: np.ndarray, columns: np.ndarray, length: int) -> np.ndarray:
    """Lengths of the common beginnings of every row with every column; padding is never common."""
    alive = np.ones((len(rows), len(columns)), dtype=bool)
    common = np.zeros(alive.shape, dtype=np.int32)
    for k in range(length):
        mine = rows[:, k]
        alive &= (mine[:, None] == columns[:, k][None, :]) & (mine != 0)[:, None]
        if not alive.any():
            break
        common += alive
    return common


def single_edits(
    words: list[str], length: int, tile: np.ndarray, block: np.ndarray, crossed: np.ndarray, last: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of words, sorted by tile, that are one edit apart, the longer of ``length``.

    ``crossed`` tiles compare words of different blocks only; ``last`` ones leave out the pairs that share
    their first half, the others keep only these.
    """
    encoded = [word.encode(ENCODING) for word in words]
    forward, backward = _matrix(encoded, length), _matrix([word[::-1] for word in encoded], length)
    full = np.array([len(word) == length for word in encoded])
    half = length // 2
    found: list[tuple[np.ndarray, np.ndarray]] = []
    ends = np.searchsorted(tile, tile, side="right")
    for begin in range(0, len(words), _BLOCK_ROWS):
        stop = min(begin + _BLOCK_ROWS, len(words))
        for left in range(begin, ends[stop - 1], _BLOCK_COLUMNS):
            right = min(left + _BLOCK_COLUMNS, ends[stop - 1])
            own, others = slice(begin, stop), slice(left, right)
            may = tile[own, None] == tile[None, others]
            may &= np.arange(begin, stop)[:, None] < np.arange(left, right)[None, :]
            may &= full[own, None] | full[None, others]
            may &= ~crossed[own, None] | (block[own, None] != block[None, others])
            if not may.any():
                continue
            before = _common(forward[own], forward[others], length)
            behind = _common(backward[own], backward[others], length)
            may &= before + behind >= length - 1
            may &= last[own, None] == (before < half)
            a, b = np.nonzero(may)
            if len(a):
                found.append((a + begin, b + left))
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _near_in(rows: pa.Table) -> pa.RecordBatch | None:
    """Sums of whole tiles of one length, sorted by tile."""
    names = ("side", "half", "row", "col", "block", "n")
    side, half, row, col, block, n = (rows.column(x).to_numpy() for x in names)
    words = rows.column("word").to_pylist()
    new = np.ones(len(words), dtype=bool)
    new[1:] = (side[1:] != side[:-1]) | (half[1:] != half[:-1]) | (row[1:] != row[:-1]) | (col[1:] != col[:-1])
    tile = np.cumsum(new)
    a, b = single_edits(words, rows.column("length")[0].as_py(), tile, block, row != col, side == "last")
    if not len(a):
        return None
    mine, other = np.concatenate([a, b]), np.concatenate([b, a])
    text = np.array(words, dtype=object)
    # Latin-1 bytes are in the order of code points.
    spelled = np.array([word.encode(ENCODING) for word in words], dtype=object)
    place = np.empty(len(words), dtype=np.int64)
    place[np.argsort(spelled, kind="stable")] = np.arange(len(words))
    order = np.lexsort((place[other], -n[other], mine))
    mine, other = mine[order], other[order]
    at = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
    best = pa.StructArray.from_arrays(
        [pa.array(-n[other[at]], pa.int64()), pa.array(text[other[at]], pa.string())], ["less", "word"]
    )
    return pa.RecordBatch.from_arrays(
        [pa.array(text[mine[at]], pa.string()), pa.array(np.diff(np.append(at, len(mine))), pa.int64()), best],
        ["word", "n_near", "best"],
    )


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles come sorted; the last one of a batch may go on in the next."""
    name = ("length", "side", "half", "row", "col")
    held: pa.Table | None = None

    def cut(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """Tiles of one length together, as many as a bounded matrix holds."""
        columns = [rows.column(x).to_numpy() for x in name]
        changes = np.any([column[1:] != column[:-1] for column in columns], axis=0)
        starts = [0, *(np.flatnonzero(changes) + 1), len(rows)]
        begin = 0
        for here, after in zip(starts[1:-1], starts[2:], strict=True):
            length = columns[0][begin]
            if columns[0][here] != length or (after - begin) * length > 2 * TILE_CELLS:
                found = _near_in(rows.slice(begin, here - begin))
                begin = here
                if found is not None:
                    yield found
        found = _near_in(rows.slice(begin))
        if found is not None:
            yield found

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows]).combine_chunks()
        if not len(rows):
            continue
        open_tile = np.ones(len(rows), dtype=bool)
        for x in name:
            column = rows.column(x).to_numpy()
            open_tile &= column == column[-1]
        begun = int(np.argmax(open_tile))
        held = rows.slice(begun)
        if begun:
            yield from cut(rows.slice(0, begun))
    if held is not None and len(held):
        yield from cut(held)


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n_near, best)`` of the words ``(word, n)`` that have others one edit away.

    ``best.word`` is the most frequent of them, the first in code-point order of equal ones, and
    ``best.less`` its count below zero.
    """
    name = ["length", "side", "half", "row", "col"]
    tiles = _tiles(_halves(words))
    width = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tiles.repartition(width, *name).sortWithinPartitions(*name)
    found = dealt.mapInArrow(_near, _FOUND)
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of words ``(word, form)``; forms have no cycle, as their counts rise.

    Each round doubles the steps taken, so there are few.
    """
    with Scratch(forms.sparkSession) as scratch:
        steps = scratch.keep(forms.select("word", F.col("form").alias("root")))
        while True:
            onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
            moved = scratch.keep(lookup_join(steps, onward, "root", ["word"], "left"))
            if moved.where("next IS NOT NULL").isEmpty():
                return materialize(steps)
            steps = scratch.keep(moved.select("word", F.coalesce("next", "root").alias("root")))


def group_variants(words: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word ``(word, n)``.

    The form is the most frequent near word, if it is ``factor`` times as frequent.
    """
    words = materialize(words)
    near = materialize(near_words(words))
    judged = words.join(near, "word", "left")
    best_n = -F.col("best.less")
    formed = best_n >= factor * F.col("n")
    placed = judged.select(
        "word",
        F.when(formed, F.col("best.word")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, best_n).alias("form_n"),
    )
    placed = materialize(placed)
    roots = _roots(placed.where("form IS NOT NULL").select("word", "form"))
    named = placed.join(roots, "word", "left")
    return named.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
