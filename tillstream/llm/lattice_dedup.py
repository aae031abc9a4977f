"""Near-duplicate embeddings by lattice hashing.

In each of several tables a unit vector is projected at random to 8 dimensions, scaled, and decoded
to the nearest point of the E8 lattice: its home cell. It also probes the neighbouring cells nearest to
it. Two vectors meet if one probes, or has, the home of the other in any table. Vectors that meet
are compared with components rounded to bytes, which no similar pair fails, and those left by their
cosine in double precision.

Vectors are dealt to cells in passes, one after the other, whose shuffle files are removed: each holds a
few tables, or a share of one, and moves no more than a few times the bytes of the vectors. At first
only ids and rounded vectors are dealt; whole vectors follow for those that have one nearby. They are
dealt as one row for all that a batch has for a bucket of cells. A cell with many homes is split into
parts, and pairs of parts are compared as blocks of a matrix product. A block returns counts per vector
and as many links as connect what it found connected, never all its pairs. A pair that meets in several
places counts in the first alone.

Defined results: a vector that is NULL, zero, empty or has a NULL or non-finite component links
with nothing. Equal vectors are compared once and counted as often as they occur. Rows with
the same id are one vector, the least of them by value. Vectors of different length are never
similar. Rows without id link with nothing and have no component. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tillstream.llm.components import components
from tillstream.llm.e8_lattice import around, names
from tillstream.llm.vectors import arrays, distinct_vectors
from tillstream.session import Scratch, materialize, session_options

COSINE = 0.9
TABLES = 8
PROBES = 8
SCALE = 0.7
# Homes of a cell from which on it is split.
PART_ROWS = 1 << 15
# What a pass may move: times the bytes of all vectors, and bytes that any pass may.
PASS_VECTORS = 1.5
PASS_BYTES = 1 << 28
# What a task of a pass reads.
TASK_BYTES = 1 << 25

_SEED = 20
_TILE = 1024
_BUCKETS = 4
_LEAST_BYTES = 1 << 20
_RESIDENT = 128
_MOST_PARTS = (1 << 15) - 1
#: Of the members of a block: their cell, block and place among the cells of a vector, a resident's larger.
_MEMBER = {"cell": "<i8", "block": "<i4", "rank": "u1", "node": "<i8"}
_ROUNDED = {**_MEMBER, "step": "<f4", "data": "i1"}
# Shuffle files go when their job ends, and not when the driver happens to collect its garbage.
_OPTIONS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(1 << 15),
    "spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 23),
}
_WHOLE_OPTIONS = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(1 << 12)}


#: By length and table, cells that are split: their names, number of parts, and homes.
Crowds = Mapping[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Layout:
    """Tables of cells, and the kind of number that vectors are kept as."""

    kind: str
    tables: int
    probes: int
    scale: float

    def projections(self, length: int) -> np.ndarray:
        rng = np.random.default_rng([_SEED, length])
        return rng.standard_normal((self.tables, length, 8)) * self.scale

    @property
    def whole(self) -> dict[str, str]:
        return {**_MEMBER, "copies": "<i8", "data": self.kind, "found": "u1"}


@dataclass(frozen=True)
class Pass:
    """Cells that are dealt together: of some tables, those that a hash puts into one of some shares."""

    tables: tuple[int, ...]
    share: int
    shares: int
    moved: int


@dataclass(frozen=True)
class Block:
    """Members of a cell of one table that are compared: each of the first ``residents`` with each guest
    after them, and in a diagonal block also with each other."""

    table: int
    cell: int
    residents: int
    diagonal: bool
    of: dict[str, np.ndarray]

    def tiles(self) -> Iterator[tuple[slice, slice]]:
        members = len(self.of["node"])
        for j in range(0 if self.diagonal else self.residents, members, _TILE):
            last = min(self.residents, j + 1) if self.diagonal else self.residents
            for i in range(0, last, _TILE):
                yield slice(i, min(i + _TILE, self.residents)), slice(j, min(j + _TILE, members))

    def once(self, close: np.ndarray, x: slice, y: slice) -> np.ndarray:
        """Of a tile on the diagonal the pairs above it."""
        return np.triu(close, 1) if self.diagonal and x.start == y.start else close


def units(vectors: np.ndarray) -> np.ndarray:
    """Scaled by the largest component first, so that no square overflows or vanishes."""
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def rounded(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components as multiples, from -127 to 127, of a step per vector."""
    step = (np.abs(unit).max(1) / 127).astype(np.float32)
    return np.rint(unit / step[:, None]).clip(-127, 127).astype(np.int8), step


def rounding(step: np.ndarray, length: int) -> float:
    """How far vectors can be from what they were rounded to: half a step in each component."""
    return math.sqrt(length) * float(step.max()) / 2


def coded(vectors: DataFrame, kind: str) -> DataFrame:
    """``(id, digest, vector)`` of each vector, its components as bytes of a kind."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, matrix in arrays(batch.column("vector")):
                # Zeros of either sign are the same.
                digests = [
                    hashlib.blake2b(x.tobytes(), digest_size=16).digest()
                    for x in matrix.astype(np.float64) + 0.0
                ]
                columns = [
                    batch.column("id").take(pa.array(places)),
                    pa.array(digests, pa.binary()),
                    pa.array([x.tobytes() for x in matrix.astype(kind)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "digest", "vector"])

    return vectors.mapInArrow(code, "id long, digest binary, vector binary")


def _matrices(column: pa.BinaryArray, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and matrix of the vectors of each length."""
    if not len(column):
        return
    _, offsets, held = column.cast(pa.binary()).buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    flat, size = np.frombuffer(held, np.uint8), np.diff(offsets)
    for length in np.unique(size):
        places = np.flatnonzero(size == length)
        if len(places) == len(column):
            rows = flat[offsets[0] : offsets[-1]].reshape(len(column), length)
        else:
            rows = flat[offsets[places, None] + np.arange(length)]
        yield places, rows.view(kind)


def crowded(nodes: DataFrame, rows: int, layout: Layout) -> Crowds:
    """Cells with more homes than a part, and into how many parts each is split.

    Homes are estimated from vectors that a hash chooses, some 256 of them for a part; all that
    depends on it is how evenly the work is cut.
    """
    part, every = PART_ROWS, max(1, PART_ROWS // 256)
    if rows <= part:
        return {}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, matrix in _matrices(batch.column("vector"), layout.kind):
                unit = units(matrix.astype(np.float64))
                for table, project in enumerate(layout.projections(unit.shape[1])):
                    home = names(around(unit @ project, 1))[:, 0]
                    cell, homes = np.unique(home, return_counts=True)
                    same = [pa.array(np.full(len(cell), x, np.int32)) for x in (unit.shape[1], table)]
                    yield pa.RecordBatch.from_arrays(
                        [*same, pa.array(cell), pa.array(homes)], ["length", "table", "cell", "homes"]
                    )

    chosen = nodes.where(F.pmod(F.xxhash64("node"), F.lit(every)) == 0).select("vector")
    found = chosen.mapInArrow(count, "length int, table int, cell long, homes long")
    found = found.groupBy("length", "table", "cell").agg((F.sum("homes") * every).alias("homes"))
    by_table: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for row in found.where(F.col("homes") > part).sort("cell").collect():
        by_table.setdefault((row.length, row.table), []).append((row.cell, row.homes))
    crowds = {}
    for key, cells in by_table.items():
        cell, homes = np.array(cells).T
        crowds[key] = cell, (-(-homes // part)).clip(max=_MOST_PARTS), homes
    return crowds


def passes(entries: Mapping[int, int], crowds: Crowds, size: int, probes: int, most: int) -> list[Pass]:
    """How entries, so many of each table and so large, are dealt with at most so many bytes at a time."""
    moved = {table: n * size for table, n in entries.items() if n}
    for (_, table), (_, parts, homes) in crowds.items():
        if table in moved:
            moved[table] += int(((parts - 1) * homes).sum()) * (probes + 1) * size
    found: list[Pass] = []
    for table, n in moved.items():
        shares = -(-n // most)
        if shares > 1 or not found or found[-1].shares > 1 or found[-1].moved + n > most:
            found += [Pass((table,), k, shares, n // shares) for k in range(shares)]
        else:
            found[-1] = Pass((*found[-1].tables, table), 0, 1, found[-1].moved + n)
    return found


def _mixed(*numbers: np.ndarray | int) -> np.ndarray:
    """Numbers mixed to one, row by row."""
    mixed = np.zeros(1, np.uint64)
    for number in numbers:
        mixed = (mixed ^ np.asarray(number).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = mixed ^ (mixed >> np.uint64(29))
    return mixed


def _placed(
    cell: np.ndarray, wanted: np.ndarray, node: np.ndarray, crowd: tuple[np.ndarray, ...] | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(row, cell, block, rank)`` of the members that vectors, in rows, become of the blocks of their cells.

    Block ``(i, j)`` has the homes of part i as residents and what is in part j as guests, of its homes
    only those of later parts.
    """
    row, rank = np.nonzero(wanted)
    cell = cell[row, rank]
    block = np.zeros(len(row), np.int32)
    member = np.where(rank == 0, _RESIDENT, rank).astype(np.uint8)
    if crowd is None:
        return row, cell, block, member
    cells, parts, _ = crowd
    at = np.searchsorted(cells, cell).clip(0, len(cells) - 1)
    split = cells[at] == cell
    into = parts[at[split]]
    own = (_mixed(node[row[split]]) >> np.uint64(33)).astype(np.int64) % into
    each = np.repeat(np.arange(len(into)), into)
    other = np.arange(len(each)) - np.repeat(np.cumsum(into) - into, into)
    own, (where,) = own[each], np.nonzero(split)
    home = rank[where[each]] == 0
    guest = ~home | (other < own)
    (alone,) = np.nonzero(~split)
    taken = np.concatenate([alone, where[each[guest]], where[each[home]]])
    block = [block[alone], (other << 16 | own)[guest], (own << 16 | other)[home]]
    member = [member[alone], rank[where[each[guest]]], np.full(home.sum(), _RESIDENT)]
    return row[taken], cell[taken], np.concatenate(block).astype(np.int32), np.concatenate(member).astype(np.uint8)


def dealt(nodes: DataFrame, one: Pass, crowds: Crowds, layout: Layout, fields: Mapping[str, str]) -> DataFrame:
    """A row for all members, as bytes of each field, that a batch has for a bucket of blocks of a table.

    Rows come sorted by bucket. With ``copies`` only the cells in ``places`` are dealt to.
    """
    width = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(-(-one.moved // TASK_BYTES), min(width, -(-one.moved // _LEAST_BYTES)))
    # No more than it takes: a batch has a row for each.
    buckets = max(tasks, -(-one.moved // TASK_BYTES) * _BUCKETS)
    whole = "copies" in fields
    each = layout.probes

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column("node").to_numpy()
            chosen = np.ones((len(node), layout.tables * each), bool)
            if whole:
                places = batch.column("places")
                chosen[:] = False
                chosen[np.repeat(np.arange(len(node)), np.diff(places.offsets)), places.flatten()] = True
            for at, matrix in _matrices(batch.column("vector"), layout.kind):
                length, unit = matrix.shape[1], units(matrix.astype(np.float64))
                project = layout.projections(length)
                own: dict[str, np.ndarray] = {"node": node[at]}
                if whole:
                    found = {t: around(unit @ p, each) for t, p in enumerate(project)}
                    own["found"] = np.concatenate([*found.values()], 1)
                    own["copies"], own["data"] = batch.column("copies").to_numpy()[at], matrix
                else:
                    found = {t: around(unit @ project[t], each) for t in one.tables}
                    own["data"], own["step"] = rounded(unit)
                for table in one.tables:
                    wanted = chosen[at, table * each : (table + 1) * each]
                    row, cell, block, rank = _placed(
                        names(found[table]), wanted, node[at], crowds.get((length, table))
                    )
                    mixed = _mixed(table, length, block, cell)
                    (kept,) = np.nonzero((mixed >> np.uint64(40)) % np.uint64(one.shares) == one.share)
                    bucket = (mixed[kept] % np.uint64(buckets)).astype(np.int32)
                    # Blocks stay together, where names of cells compress.
                    order = np.argsort(bucket.astype(np.uint64) << np.uint64(32) | mixed[kept] >> np.uint64(32))
                    kept, bucket = kept[order], bucket[order]
                    first = np.flatnonzero(np.diff(bucket, prepend=-1))
                    made = {"cell": cell[kept], "block": block[kept], "rank": rank[kept]}
                    made |= {name: values[row[kept]] for name, values in own.items()}
                    columns = [pa.array(bucket[first])]
                    columns += [pa.array(np.full(len(first), x, np.int32)) for x in (length, table)]
                    ends = np.append(first, len(kept))
                    columns += [_bytes(made[name], ends) for name in fields]
                    yield pa.RecordBatch.from_arrays(columns, ["bucket", "length", "table", *fields])

    kind = "bucket int, length int, table int" + "".join(f", {name} binary" for name in fields)
    rows = nodes.mapInArrow(deal, kind).repartition(tasks, "bucket")
    return rows.sortWithinPartitions("bucket", "length", "table")


def _bytes(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of rows from each end to the next."""
    values = np.ascontiguousarray(values)
    size = values.itemsize * math.prod(values.shape[1:])
    offsets = pa.py_buffer((ends * size).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, offsets, pa.py_buffer(values)])


def blocks(batches: Iterator[pa.RecordBatch], fields: Mapping[str, str]) -> Iterator[Block]:
    """Blocks in which something meets; rows of a bucket and table arrive one after the other."""
    key: tuple | None = None
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for k in range(batch.num_rows):
            now = tuple(batch.column(c)[k].as_py() for c in ("bucket", "length", "table"))
            if held and now != key:
                yield from _grouped(held, key[2], fields)
                held = []
            key = now
            held.append({name: batch.column(name)[k].as_buffer() for name in fields})
    if held:
        yield from _grouped(held, key[2], fields)


def _grouped(rows: list[dict[str, pa.Buffer]], table: int, fields: Mapping[str, str]) -> Iterator[Block]:
    of = {name: np.concatenate([np.frombuffer(x[name], kind) for x in rows]) for name, kind in fields.items()}
    rows.clear()
    members = len(of["node"])
    of |= {name: of[name].reshape(members, -1) for name in ("data", "found") if name in of}
    resident = of["rank"] == _RESIDENT
    order = np.lexsort((~resident, of["block"], of["cell"]))
    cell, block, resident = of["cell"][order], of["block"][order], resident[order]
    starts = np.flatnonzero(np.append(True, (np.diff(cell) != 0) | (np.diff(block) != 0)))
    homes = np.add.reduceat(resident, starts, dtype=np.int64)
    sizes = np.diff(np.append(starts, members))
    diagonal = (block[starts] >> 16) == (block[starts] & 0xFFFF)
    for k in np.flatnonzero((homes > 0) & (sizes > np.where(diagonal, 1, homes))):
        places = order[starts[k] : starts[k] + sizes[k]]
        one = {name: values[places] for name, values in of.items()}
        yield Block(table, int(cell[starts[k]]), int(homes[k]), bool(diagonal[k]), one)


def nearby(rows: DataFrame, cosine: float, probes: int) -> DataFrame:
    """``(node, place)`` of the cells in which a vector meets one that may be similar, by rounded vectors."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, _ROUNDED):
            stay = _maybe_similar(block, cosine)
            if stay.any():
                rank = block.of["rank"][stay] % _RESIDENT
                place = (rank + block.table * probes).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.of["node"][stay]), pa.array(place)], ["node", "place"]
                )

    return rows.mapInArrow(compare, "node long, place int")


def _maybe_similar(block: Block, cosine: float) -> np.ndarray:
    """Which members have another one that is as similar as ``cosine``, as far as rounded vectors tell."""
    data, step = block.of["data"], block.of["step"]
    off = rounding(step, data.shape[1])
    # Lower by what rounding changes a product, and the arithmetic of single precision.
    limit = cosine - 2 * off - off * off - 1e-4
    left = data[: block.residents] * step[: block.residents, None]
    stay = np.zeros(len(step), bool)
    at, right = -1, left
    for x, y in block.tiles():
        if y.start != at:
            at, right = y.start, np.ascontiguousarray((data[y] * step[y, None]).T)
        near = left[x] @ right
        if block.diagonal and x.start == y.start:
            np.fill_diagonal(near, -2)
        if near.max() >= limit:
            close = near >= limit
            stay[x] |= close.any(1)
            stay[y] |= close.any(0)
    return stay


def _first_meeting(named_x: np.ndarray, named_y: np.ndarray, table: int, cell: int) -> np.ndarray:
    """Whether this cell of this table is where each pair counts."""
    home_x, home_y = named_x[:, :, 0], named_y[:, :, 0]
    at_x = (named_y == home_x[:, :, None]).any(2)
    at_y = (named_x == home_y[:, :, None]).any(2)
    earlier = (at_x | at_y)[:, :table].any(1)
    # Where either probes the other's home, the pair meets twice in a table.
    twice = at_x[:, table] & at_y[:, table]
    least = np.minimum(home_x[:, table], home_y[:, table])
    return ~earlier & (~twice | (least == cell))


def _probed(named: np.ndarray, homes: np.ndarray) -> np.ndarray:
    """Whether each vector has or probes each home."""
    different, at = np.unique(homes, return_inverse=True)
    return (named[:, None, :] == different[None, :, None]).any(2)[:, at]


def _first_meetings(
    close: np.ndarray, named_x: np.ndarray, named_y: np.ndarray, table: int, cell: int
) -> np.ndarray:
    """Of the close pairs of a tile those that count in this cell; residents, in rows, have it as home."""
    if np.count_nonzero(close) * 64 < close.size:
        x, y = np.nonzero(close)
        for k in range(0, len(x), 1 << 14):
            p, q = x[k : k + (1 << 14)], y[k : k + (1 << 14)]
            close[p, q] = _first_meeting(named_x[p], named_y[q], table, cell)
        return close
    for t in range(table):
        x, y = named_x[:, t], named_y[:, t]
        close &= ~(_probed(x, y[:, 0]) | _probed(y, x[:, 0]).T)
        if not close.any():
            return close
    home = named_y[:, table, 0]
    (lower,) = np.nonzero(home < cell)
    close[:, lower] &= ~_probed(named_x[:, table], home[lower])
    return close


def _connected(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least place that each place of a block is connected to."""
    label = np.arange(count)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _joined(label: np.ndarray, linked: np.ndarray, x: slice, y: slice) -> np.ndarray:
    """Least places connected, with the links of a tile; a row's or column's first one at a time."""
    while True:
        apart = linked & (label[x, None] != label[None, y])
        (rows,) = np.nonzero(apart.any(1))
        if not len(rows):
            return label
        (columns,) = np.nonzero(apart.any(0))
        a = np.append(label[x][rows], label[x][apart[:, columns].argmax(0)])
        b = np.append(label[y][apart[rows].argmax(1)], label[y][columns])
        label = _connected(len(label), a, b)[label]


def block_links(rows: DataFrame, cosine: float, layout: Layout) -> DataFrame:
    """``(a, b, links)``: vectors found similar to ``a`` where ``b`` is NULL, else a link."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, layout.whole):
            node, copies = block.of["node"], block.of["copies"]

            def taken(some: slice, of: dict[str, np.ndarray] = block.of) -> tuple[np.ndarray, np.ndarray]:
                found = of["found"][some]
                return units(of["data"][some].astype(np.float64)), names(
                    found.reshape(len(found), layout.tables, -1)
                )

            left, named = taken(slice(block.residents))
            count, label = np.zeros(len(node), np.int64), np.arange(len(node))
            at, right, named_y = -1, left, named
            for x, y in block.tiles():
                if y.start != at:
                    at, (right, named_y) = y.start, taken(y)
                close = block.once(left[x] @ right.T >= cosine, x, y)
                if not close.any():
                    continue
                new = _first_meetings(close, named[x], named_y, block.table, block.cell)
                count[x] += _times(new, copies[y])
                count[y] += _times(new.T, copies[x])
                label = _joined(label, new, x, y)
            moved = np.flatnonzero(label != np.arange(len(node)))
            counted = np.flatnonzero(count)
            if not len(counted):
                continue
            columns = [
                pa.array(np.concatenate([node[counted], node[moved]])),
                pa.array([None] * len(counted) + node[label[moved]].tolist(), pa.int64()),
                pa.array(np.concatenate([count[counted], np.zeros(len(moved), np.int64)])),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "links"])

    return rows.mapInArrow(compare, "a long, b long, links long")


def _times(links: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """Copies of what each row is linked with."""
    if (copies == 1).all():
        return np.count_nonzero(links, axis=1)
    # Whole numbers are exact, as a table has fewer than 2^53 rows.
    return (links @ copies.astype(np.float64)).astype(np.int64)


def near_duplicates(
    frame: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = COSINE,
    tables: int = TABLES,
    probes: int = PROBES,
    scale: float = SCALE,
) -> DataFrame:
    """``(id, n_links, component)`` per row: vectors linked directly, and the least id reachable."""
    spark = frame.sparkSession
    column = frame.schema[vector_col].dataType
    single = isinstance(column, ArrayType) and isinstance(column.elementType, FloatType)
    layout = Layout("<f4" if single else "<f8", tables, probes, scale)
    with session_options(spark, _OPTIONS), Scratch(spark) as scratch:
        vectors = distinct_vectors(frame, id_col, vector_col, "array<float>" if single else "array<double>")
        codes = scratch.keep(coded(vectors, layout.kind))
        classes = scratch.keep(
            codes.groupBy("digest").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"))
        )
        found = _found(codes, classes, cosine, layout, scratch)
        counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
        connected = components(found.where("b IS NOT NULL").select("a", "b"))
        result = (
            classes.join(counts, "node", "left")
            .join(connected, "node", "left")
            .select(
                "digest",
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "node").alias("component"),
            )
        )
        by_id = materialize(codes.select("id", "digest").join(result, "digest").drop("digest"))
    rows = frame.select(F.col(id_col).cast("long").alias("id"))
    return rows.join(by_id, "id", "left").select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component"),
    )


def _found(
    codes: DataFrame, classes: DataFrame, cosine: float, layout: Layout, scratch: Scratch
) -> DataFrame:
    """``(a, b, links)`` of all blocks of all passes."""
    same = classes.where("copies > 1").withColumnRenamed("node", "least")
    others = scratch.keep(codes.select("id", "digest").join(same, "digest").where("id <> least").select("id"))
    if not others.isEmpty():
        codes = scratch.keep(codes.join(others, "id", "left_anti"))
    nodes = codes.select(F.col("id").alias("node"), "vector")
    rows, size, longest = nodes.agg(
        F.count(F.lit(1)), F.sum(F.length("vector")), F.max(F.length("vector"))
    ).first()
    most = max(PASS_BYTES, int(PASS_VECTORS * (size or 0)))
    numbers = (longest or 0) // np.dtype(layout.kind).itemsize
    crowds = crowded(nodes, rows, layout)
    entries = dict.fromkeys(range(layout.tables), rows * layout.probes)
    left = [
        scratch.keep(nearby(dealt(nodes, one, crowds, layout, _ROUNDED), cosine, layout.probes))
        for one in passes(entries, crowds, _size(_ROUNDED) + numbers, layout.probes, most)
    ]
    if not left:
        return scratch.keep(_nothing(codes))
    left = reduce(DataFrame.union, left)
    table = F.floor(F.col("place") / layout.probes).cast("int").alias("table")
    entries = {row.table: row["count"] for row in left.groupBy(table).count().sort("table").collect()}
    near = left.groupBy("node").agg(F.collect_set("place").alias("places"))
    copies = classes.select("node", "copies")
    near = scratch.keep(nodes.join(near, "node").join(copies, "node"))
    crowds = crowded(near, near.count(), layout)
    each = _size(layout.whole) + longest + layout.tables * (7 + layout.probes)
    with session_options(codes.sparkSession, _WHOLE_OPTIONS):
        links = [
            scratch.keep(block_links(dealt(near, one, crowds, layout, layout.whole), cosine, layout))
            for one in passes(entries, crowds, each, layout.probes, most)
        ]
    return reduce(DataFrame.union, links) if links else scratch.keep(_nothing(codes))


def _size(fields: Mapping[str, str]) -> int:
    """Bytes of a member without its arrays."""
    return sum(np.dtype(kind).itemsize for name, kind in fields.items() if name not in ("data", "found"))


def _nothing(codes: DataFrame) -> DataFrame:
    kinds = {"a": "long", "b": "long", "links": "long"}
    return codes.limit(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()])
