"""Approximate nearest neighbours by inner product: NN-descent and greedy graph search.

Equal vectors form a class; the graph is over classes, and a found class stands for its
members with the smallest ids, so that ties come out whole and large groups of copies
cost one node.

Nodes are numbered so that near ones are mostly together, and lie in parts of a fixed
number of nodes. A part keeps its vectors and lists as arrays and sends other parts
whole arrays, one row of the shuffle for each pair of parts instead of one for each vector
or edge; a part compares many nodes at once in numpy. A part asks for every vector its
lists name once, which is at most a fixed number of vectors a node.

The graph starts from the best of some small blocks of vectors on the same sides of random
planes. Then, in each iteration, every node meets its neighbours and a sample of the nodes
that have it as a neighbour; pairs of which one is new are compared, and better ones
replace the worst of both ends. It ends when few entries are new. A query starts with its
own list and expands the best nodes of its pool that it has not expanded yet, until there
is none; it is compared where the candidates lie, so that the query's vector travels and
not theirs.

Graph and search compare vectors of 16-bit whole numbers, fractions of their own largest
component, each with a scale in single precision; sums are in single precision. The pools
found are compared again in double precision on the original vectors.
The sizes below belong to the method and are the same for every table; vectors of more
than 64 components come in accordingly smaller parts. Lists and blocks leave candidates
out, so the result is approximate; tests measure recall against brute force.

Vectors that are null, zero, or hold null or non-finite components take no part, neither do
those of another length than the most frequent (of equally frequent ones, the smallest) nor
rows without an id. Rows that repeat an id count once with each different vector. An empty
table gives an empty result. Extra columns are not touched.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.tables import keep

# Neighbours of a node, and sampled nodes that have it as a neighbour.
NEIGHBOURS, REVERSE = 50, 30
# Vectors of a starting block, different sets of planes over all nodes, and sets inside each of their cells.
BLOCK, STARTS, INSIDE = 256, 4, 4
# Nodes of a part, for up to 64 components, queries of one, and nodes compared at once.
PART, QUERY_PART, BATCH = 8192, 1024, 64
# Share of new list entries below which the descent ends.
SETTLED = 0.02
# Pool of a query, and nodes it expands in a round.
POOL, EXPAND = 90, 20
# Sampled vectors of a cell, for the middles at which planes part them.
SAMPLED = 64
# Groups side by side when a hot key's rows are thinned out.
_SALTS = 16
# Pairs held before they are thinned, and bytes of a batch sent on.
_HELD, _BATCH_BYTES = 2_000_000, 16_000_000
# Bytes of a row, and bits for its place among those that one part sends another.
_ROW_BYTES, _CHUNKS = 250_000, 12
# Bits of the hash that draws a sample, and of a score that order a list.
_DRAW, _SCORE_BITS = 20, 24

# Rows that parts send: to a node part, or to a query part from ``_QUERIES`` on; four arrays as bytes.
_MESSAGE = "part bigint, kind int, origin bigint, a binary, b binary, c binary, d binary, x double"
_SCHEMA = pa.schema([("part", pa.int64()), ("kind", pa.int32()), ("origin", pa.int64()), *((n, pa.binary()) for n in "abcd"), ("x", pa.float64())])
_QUERIES = 1 << 40
# What the arrays are (indices are 32-bit):
_ROW = 0  # one batch's piece of a part: index, vectors as given, ids
_EXACT = 1  # a part's ids, vectors as given
_LIGHT = 2  # its 16-bit vectors, scales, indices
_CELL = 3  # index, 16-bit vectors, scales of nodes in a cell
_BETTER = 4  # source, neighbour, score
_STATE = 5  # a part's lists: neighbours (-1: none), scores, fresh; x: sum of the shares of fresh entries
_EDGE = 6  # node, one that has it as a neighbour, fresh
_LEAST = 7  # the score that would enter each list of a part
_MEET = 8  # nodes of a part that meet, as places in the sorted indices it asked for (-1: none), and which are new
_ASK = 9  # indices of vectors that the origin wants
_ANSWER = 10  # these vectors, their scales and least scores
_LINKS = 11  # a part's neighbours and sampled reverse ones (-1: none)
_QUERY = 12  # indices of nodes that are queries
_POOL = 13  # a query part's queries: index, vector, pool (-1: none), scores
_DONE = 14  # which of the pool are expanded; x: how many to expand now
_EXPAND = 15  # indices of nodes to expand, query of the origin
_LINKED = 16  # links of nodes (-1: none), query
_SCORE = 17  # indices to compare, place of the query in the next, vectors, queries and least scores
_SCORED = 18  # index, query, score
_VECTOR = 19  # vectors as given of the queries of a query part
_PAIR = 20  # indices, place of the query in the next, vectors as given, queries
_PAIRED = 21  # index, query, score in double precision, id


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Values and row offsets of a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    sizes = np.asarray(column.value_lengths().fill_null(0))
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _matrix(column, kind=np.float32) -> np.ndarray:
    """Vectors of a binary column; all are equally long."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1) if rows else np.zeros((0, 0), kind)


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys start."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Place of each entry in its run of equal keys."""
    starts = _starts(keys)
    return np.arange(len(keys)) - np.repeat(starts, np.diff(np.append(starts, len(keys))))


def _order(*keys: tuple[np.ndarray, int]) -> np.ndarray:
    """Stable order by keys of so many bits, the first one first."""
    n = len(keys[0][0])
    places = n.bit_length()
    if sum(bits for _, bits in keys) + places > 64:
        return np.lexsort([key for key, _ in reversed(keys)])
    packed = np.zeros(n, np.uint64)
    for key, bits in keys:
        packed <<= np.uint64(bits)
        packed |= key.astype(np.uint64)
    packed <<= np.uint64(places)
    packed |= np.arange(n, dtype=np.uint64)
    # Sorting values is several times as fast as sorting places by them.
    packed.sort()
    packed &= np.uint64((1 << places) - 1)
    return packed.view(np.int64)


def _falling(score: np.ndarray) -> np.ndarray:
    """32-bit numbers, as 64-bit ones, that grow as single-precision scores fall."""
    bits = np.ascontiguousarray(score, np.float32).view(np.int32)
    return (np.int64(0x7FFFFFFF) - (bits ^ ((bits >> 31) & np.int32(0x7FFFFFFF)))).astype(np.uint64)


def _draw(source: np.ndarray, node: np.ndarray, turn: int) -> np.ndarray:
    """A hash of ``_DRAW`` bits of each edge, another one each turn."""
    x = (source.astype(np.uint64) << np.uint64(32) | node.astype(np.uint64)) + np.uint64((0x9E3779B97F4A7C15 * (turn + 2)) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(64 - _DRAW)


class _Rows:
    """The messages of one part: arrays of each kind, each read once."""

    def __init__(self, batches):
        self.rows = defaultdict(list)
        for batch in batches:
            kinds, origins = batch.column("kind").to_pylist(), batch.column("origin").to_pylist()
            columns = [batch.column(n) for n in "abcd"]
            for i, kind in enumerate(kinds):
                self.rows[kind].append((origins[i], *(None if not c[i].is_valid else c[i].as_buffer() for c in columns)))

    def of(self, kind: int, *types) -> list[tuple]:
        """``(origin, arrays)`` of the rows of a kind, in order of origin."""
        rows = sorted(self.rows.pop(kind, []), key=lambda r: r[0])
        return [(r[0] >> _CHUNKS, *(np.frombuffer(x, t) for x, t in zip(r[1:], types))) for r in rows]

    def all(self, kind: int, *types) -> list[np.ndarray]:
        """The arrays of all rows of a kind, one after the other."""
        rows = self.of(kind, *types)
        return [np.concatenate([r[i + 1] for r in rows]) if rows else np.zeros(0, t) for i, t in enumerate(types)]


def _row(part: int, kind: int, *arrays: np.ndarray, origin: int = 0, x: float | None = None) -> tuple:
    return (part, kind, origin << _CHUNKS, *(np.ascontiguousarray(a).tobytes() for a in arrays), *([None] * (4 - len(arrays))), x)


def _rows(part: int, kind: int, *arrays: np.ndarray, origin: int = 0, x: float | None = None) -> Iterator[tuple]:
    """Equally long arrays in rows of few enough bytes for the JVM to move them with ease."""
    n = len(arrays[0])
    step = max(1, _ROW_BYTES * n // max(1, sum(a.nbytes for a in arrays)), -(-n // (1 << _CHUNKS)))
    for chunk, i in enumerate(range(0, max(1, n), step)):
        to, kind, first, *rest, _ = _row(part, kind, *(a[i : i + step] for a in arrays), origin=origin)
        yield (to, kind, first | chunk, *rest, None if chunk else x)


def _batches(rows) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row[3:7] if x)
        if size > _BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _SCHEMA)], schema=_SCHEMA)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _SCHEMA)], schema=_SCHEMA)


def _meet(messages: DataFrame, work: Callable[[int, _Rows], Iterator[tuple]]) -> DataFrame:
    """The rows that ``work`` makes of the messages of each part."""

    def step(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(work(key[0].as_py(), _Rows(batches)))

    return messages.groupBy("part").applyInArrow(step, _MESSAGE)


def _only(messages: DataFrame, *kinds: int) -> DataFrame:
    return messages.where(F.col("kind").isin(*kinds))


_KINDS = {np.float32: "float", np.float64: "double"}


def _kind(vectors: DataFrame, column: str):
    """The type whose bytes stand for a component: single precision where the column has no more."""
    return np.float32 if vectors.select(column).schema[0].dataType.simpleString() == "array<float>" else np.float64


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``(id, vec)`` of the rows that take part; vectors as the bytes of their floats or doubles."""

    def pack(batches):
        for batch in batches:
            values, ends = _flat(batch.column("vec"))
            values = values + values.dtype.type(0)  # one form of zero
            rows = [values[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, pa.binary())], ["id", "vec"])

    v = F.col("vec")
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).cast(f"array<{_KINDS[_kind(vectors, vector_column)]}>").alias("vec"))
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull()).where(good)
    sizes = rows.groupBy(F.size("vec").alias("size")).count()
    length = sizes.orderBy(F.desc("count"), "size").first()
    rows = rows.where(F.size("vec") == (length["size"] if length else 0))
    return rows.mapInArrow(pack, "id bigint, vec binary").distinct()



def _peak(nodes: DataFrame, kind) -> float:
    """The largest component of all vectors."""

    def peaks(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([float(np.abs(_matrix(batch.column("vec"), kind)).max(initial=0))])], ["peak"])

    return nodes.select("vec").mapInArrow(peaks, "peak double").agg(F.max("peak")).first()[0] or 1.0


def _directions(seed: int, levels: int, width: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(width, levels)).astype(np.float32)


def _sided(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in single precision."""
    scaled = vectors.astype(np.float64) / np.abs(vectors).max(axis=1, keepdims=True)
    return (scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))).astype(np.float32)


def _splits(sample: np.ndarray, levels: int) -> list[list[np.ndarray]]:
    """For each set of planes and level the middle of every cell's sampled projections."""
    out = []
    for seed in range(STARTS):
        places, cell, middles = sample @ _directions(seed, levels, sample.shape[1]), np.zeros(len(sample), np.int64), []
        for level in range(levels):
            order = np.lexsort((places[:, level], cell))
            ends = np.searchsorted(cell[order], np.arange((1 << level) + 1))
            halves = np.minimum((ends[:-1] + ends[1:]) // 2, len(order) - 1)
            middle = np.where(ends[1:] > ends[:-1], places[order[halves], level], 0).astype(np.float32)
            middles.append(middle)
            cell = cell * 2 + (places[:, level] >= middle[cell])
        out.append(middles)
    return out


def _cells(sided: np.ndarray, seed: int, middles: list[np.ndarray]) -> np.ndarray:
    """Cell of each unit vector in one set of planes; near cells have near numbers."""
    cell = np.zeros(len(sided), np.int64)
    places = sided @ _directions(seed, len(middles), sided.shape[1])
    for level, middle in enumerate(middles):
        cell = cell * 2 + (places[:, level] >= middle[cell])
    return cell


def _by_part(index: np.ndarray, size: int):
    """``(part, start, end)`` of the runs of a sorted ``index``."""
    owner = index // size
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
    for start, end in zip(starts.tolist(), np.append(starts[1:], len(owner)).tolist()):
        yield int(owner[start]), start, end


class Shape(NamedTuple):
    """Numbers of nodes, components and nodes of a part; middles of the planes of each set."""

    count: int
    width: int
    size: int
    planes: list

    def of(self, part: int) -> int:
        """Nodes of a part."""
        return min(self.size, self.count - part * self.size)


class Nodes:
    """The nodes ``(id, vec, copies)`` numbered and in parts: their ``shape``, ``index``, and the stored parts."""

    def __init__(self, nodes: DataFrame, kind=np.float64):
        count, first = nodes.count(), nodes.select(F.octet_length("vec")).first()
        width, peak = first[0] // np.dtype(kind).itemsize if first else 1, _peak(nodes, kind)
        size = max(1, min(PART, PART * 64 // width))
        levels = max(0, math.ceil(math.log2(max(1, count / size))))
        share = min(1.0, SAMPLED * 2**levels / max(1, count))
        few = nodes.where(F.pmod(F.xxhash64(F.lit("middles"), "vec"), F.lit(1 << 30)) < int((1 << 30) * share))
        sample = [r[0] for r in few.select("vec").collect()] if levels else []
        sided = _sided(np.frombuffer(b"".join(sample), kind).reshape(len(sample), -1)) if sample else np.zeros((0, width), np.float32)
        planes = _splits(sided, levels) if len(sided) else [[np.zeros(1 << i, np.float32) for i in range(levels)]] * STARTS
        self.kind, self.shape = kind, Shape(count, width, size, planes)

        def places(batches):
            for batch in batches:
                vectors = _matrix(batch.column("vec"), kind)
                cell = _cells(_sided(vectors), 0, planes[0]) if len(vectors) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], ["id", "vec", "copies", "cell"])

        def number(batches):
            begun, file = 0, TaskContext.get().partitionId()
            for batch in batches:
                rows = batch.num_rows
                columns = [*(batch.column(n) for n in ("id", "vec", "copies")), pa.array(np.full(rows, file)), pa.array(np.arange(begun, begun + rows))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "vec", "copies", "file", "place"])
                begun += rows

        celled = nodes.select("id", "vec", "copies").mapInArrow(places, "id bigint, vec binary, copies bigint, cell bigint")
        order = "cell", F.xxhash64("id", "vec")
        ranged = celled.repartitionByRange(*order).sortWithinPartitions(*order)
        rows = keep(ranged.mapInArrow(number, "id bigint, vec binary, copies bigint, file bigint, place bigint"))
        counts = dict(rows.groupBy("file").count().collect())
        begins, begun = {}, 0
        for file in sorted(counts):
            begins[file], begun = begun, begun + counts[file]

        begin = F.element_at(F.create_map(*(F.lit(x) for pair in begins.items() for x in pair)), F.col("file")) if begins else F.lit(0)
        self.index = rows.select("vec", "id", "copies", (begin + F.col("place")).alias("node"))

        def pieces(batches):
            for batch in batches:
                index = batch.column("node").to_numpy()
                order = np.argsort(index)
                index, vectors, ids = index[order], _matrix(batch.column("vec"), kind)[order], batch.column("id").to_numpy()[order]
                for p, a, b in _by_part(index, size):
                    yield from _batches(_rows(p, _ROW, index[a:b].astype(np.uint32), vectors[a:b], ids[a:b], origin=int(index[a])))

        def pack(part: int, rows: _Rows):
            index, vectors, ids = rows.all(_ROW, np.uint32, kind, np.int64)
            order = np.argsort(index)
            vectors, ids = vectors.reshape(len(index), width)[order], ids[order]
            yield from _rows(part, _EXACT, ids, vectors)
            small = vectors.astype(np.float64) / peak
            scales = np.maximum(np.abs(small).max(axis=1) / 32767, np.finfo(np.float32).tiny)
            yield from _rows(part, _LIGHT, np.rint(small / scales[:, None]).astype(np.int16), scales.astype(np.float32), index[order])

        self.table = keep(_meet(self.index.select("vec", "id", "node").mapInArrow(pieces, _MESSAGE), pack))

    def exact(self) -> DataFrame:
        return _only(self.table, _EXACT)

    def light(self) -> DataFrame:
        return _only(self.table, _LIGHT)


def _start(nodes: Nodes) -> DataFrame:
    """The best neighbours of each node inside a block, for each set of planes."""
    shape = nodes.shape

    def cells(part: int, rows: _Rows):
        short, scales, index = rows.all(_LIGHT, np.int16, np.float32, np.uint32)
        short = short.reshape(len(index), shape.width)
        sided = _sided(short.astype(np.float32))
        for seed, middles in enumerate(shape.planes):
            cell = _cells(sided, seed, middles)
            order = np.argsort(cell, kind="stable")
            for c, a, b in _by_part(cell[order], 1):
                some = order[a:b]
                yield from _rows(c * STARTS + seed, _CELL, index[some], short[some], scales[some], origin=part)

    def blocks(cell: int, rows: _Rows):
        index, short, scales = rows.all(_CELL, np.uint32, np.int16, np.float32)
        vectors = short.reshape(len(index), shape.width).astype(np.float32)
        sided, vectors = _sided(vectors), vectors * scales[:, None]
        found = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]]
        levels = max(0, math.ceil(math.log2(max(1, len(index) / BLOCK))))
        for inside in range(INSIDE):
            places = sided @ _directions(1_000_000 + cell * INSIDE + inside, levels, shape.width)
            segments = [np.arange(len(index))]
            for level in range(levels):
                halves = []
                for s in segments:
                    order = s[np.argsort(places[s, level], kind="stable")]
                    halves += [order[: len(order) // 2], order[len(order) // 2 :]]
                segments = halves
            for s in segments:
                most = min(NEIGHBOURS, len(s) - 1)
                if most < 1:
                    continue
                near = vectors[s] @ vectors[s].T
                np.fill_diagonal(near, -np.inf)
                # Scores with the column as their last bits.
                last = np.uint32((1 << (len(s) - 1).bit_length()) - 1)
                key = _falling(near).astype(np.uint32) & ~last | np.arange(len(s), dtype=np.uint32)
                top = np.partition(key, most - 1, axis=1)[:, :most] & last
                for x, values in zip(found, (np.repeat(s, most), s[top].ravel(), np.take_along_axis(near, top, 1).ravel())):
                    x.append(values)
        source, near, score = (np.concatenate(x) for x in found)
        bits = len(index).bit_length()
        order = _order((source, bits), (near, bits))
        order = order[_starts(source[order] << 32 | near[order])]
        order = order[_order((source[order], bits), (_falling(score[order]) >> np.uint64(32 - _SCORE_BITS), _SCORE_BITS))]
        order = order[_ranks(source[order]) < NEIGHBOURS]
        yield from _better(index[source[order]], index[near[order]], score[order], shape.size, cell)

    empty = nodes.light().select("part", F.lit(_BETTER).alias("kind"), "origin", *(F.lit(b"").alias(n) for n in "abcd"), F.lit(None).cast("double").alias("x"))
    return _meet(_meet(nodes.light(), cells), blocks).unionAll(empty)


def _better(source: np.ndarray, near: np.ndarray, score: np.ndarray, size: int, origin: int) -> Iterator[tuple]:
    """Found pairs as messages to the parts of their sources."""
    order = np.argsort(source, kind="stable")
    source, near, score = source[order], near[order], score[order]
    for part, a, b in _by_part(source, size):
        yield from _rows(part, _BETTER, source[a:b].astype(np.uint32), near[a:b].astype(np.uint32), score[a:b].astype(np.float32), origin=origin)


def _merge(messages: DataFrame, shape: Shape, turn: int) -> DataFrame:
    """The lists of each part with what was found, and their edges to the parts of the neighbours."""

    bits, own_bits = shape.count.bit_length(), shape.size.bit_length()

    def best(part: int, rows: _Rows):
        n, begin = shape.of(part), part * shape.size
        source, near, score = rows.all(_BETTER, np.uint32, np.int32, np.float32)
        found = [[(source - np.uint32(begin)).astype(np.int32)], [near], [score], [np.ones(len(source), bool)]]
        near, score = rows.all(_STATE, np.int32, np.float32)
        have = np.flatnonzero(near >= 0)
        # What was there before this iteration has been compared and is not new any more.
        for x, values in zip(found, ((have // NEIGHBOURS).astype(np.int32), near[have], score[have], np.zeros(len(have), bool))):
            x.insert(0, values)
        source, near, score, fresh = (np.concatenate(x) for x in found)
        found.clear()
        # Of a pair's rows the first, which is not fresh, wins.
        order = _order((source, own_bits), (near, bits))
        order = order[np.concatenate([[True], (source[order[1:]] != source[order[:-1]]) | (near[order[1:]] != near[order[:-1]])])] if len(order) else order
        order = order[_order((source[order], own_bits), (_falling(score[order]) >> np.uint64(32 - _SCORE_BITS), _SCORE_BITS))]
        rank = _ranks(source[order])
        order, rank = order[rank < NEIGHBOURS], rank[rank < NEIGHBOURS]
        source, near, score, fresh = (x[order] for x in (source, near, score, fresh))
        lists = np.full((n, NEIGHBOURS), -1, np.int32), np.full((n, NEIGHBOURS), -np.inf, np.float32), np.zeros((n, NEIGHBOURS), bool)
        for matrix, values in zip(lists, (near, score, fresh)):
            matrix[source, rank] = values
        share = (lists[2].sum(axis=1) / np.maximum(1, (lists[0] >= 0).sum(axis=1))).sum()
        yield from _rows(part, _STATE, *lists, x=float(share))
        # Popular nodes are thinned out before they meet: the sample of samples is that of all.
        order = _order((near, bits), (_draw(source + begin, near, turn), _DRAW))
        order = order[_ranks(near[order]) < REVERSE]
        for to, a, b in _by_part(near[order].astype(np.int64), shape.size):
            yield from _rows(to, _EDGE, near[order[a:b]].astype(np.uint32), (source[order[a:b]] + begin).astype(np.uint32), fresh[order[a:b]], origin=part)

    return _meet(messages, best)


def _reverse(rows: _Rows, n: int, begin: int, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """A sample of the nodes that have each node of a part as a neighbour (-1: none), another one each ``turn``; which are fresh."""
    node, source, fresh = rows.all(_EDGE, np.uint32, np.uint32, bool)
    order = _order((node - np.uint32(begin), n.bit_length()), (_draw(source, node, turn), _DRAW))
    rank = _ranks(node[order])
    order, rank = order[rank < REVERSE], rank[rank < REVERSE]
    lists, met = np.full((n, REVERSE), -1, np.int32), np.zeros((n, REVERSE), bool)
    own = node[order].astype(np.int64) - begin
    lists[own, rank], met[own, rank] = source[order], fresh[order]
    return lists, met


def _once(lists: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows without repeated entries, flagged ones first, none (-1) last; of repeated ones a flagged one stays."""
    key = np.where(lists < 0, np.int64(1) << 40, lists.astype(np.int64) << 1 | ~flags)
    key.sort(axis=1)
    repeated = np.zeros(key.shape, bool)
    repeated[:, 1:] = key[:, 1:] >> 1 == key[:, :-1] >> 1
    old = key & 1
    key = np.where(repeated | (key >= 1 << 40), np.int64(1) << 50, old << 40 | key)
    key.sort(axis=1)
    none = key >= 1 << 50
    return np.where(none, -1, (key & ((1 << 40) - 1)) >> 1).astype(np.int32), ~none & (key >> 40 == 0)


def _ask(messages: DataFrame, shape: Shape, turn: int) -> DataFrame:
    """What the nodes of each part meet with, and whose vectors the part wants for that."""

    def lists(part: int, rows: _Rows):
        n, begin = shape.of(part), part * shape.size
        near, score, fresh = (x.reshape(n, NEIGHBOURS) for x in rows.all(_STATE, np.int32, np.float32, bool))
        share = fresh.sum(axis=1) / np.maximum(1, (near >= 0).sum(axis=1))
        yield from _rows(part, _STATE, near, score, fresh, x=float(share.sum()))
        yield _row(part, _LEAST, score[:, -1])
        sampled, met = _reverse(rows, n, begin, turn)
        meet, new = _once(np.hstack([near, sampled]), np.hstack([fresh, met]))
        new, meet = new[(some := new.any(axis=1))], meet[some]
        if not len(meet):
            return
        have = np.flatnonzero(meet >= 0)
        order = _order((meet.ravel()[have], shape.count.bit_length()))
        have, first = have[order], np.zeros(len(have), bool)
        first[_starts(meet.ravel()[have])] = True
        wanted, place = meet.ravel()[have[first]], np.full(meet.shape, -1, np.int32)
        place.ravel()[have] = np.cumsum(first) - 1
        yield from _rows(part, _MEET, place, new)
        for to, a, b in _by_part(wanted.astype(np.int64), shape.size):
            yield _row(to, _ASK, wanted[a:b].astype(np.uint32), origin=part)

    return _meet(messages, lists)


def _compare(messages: DataFrame, nodes: Nodes) -> DataFrame:
    """Pairs of nodes that meet and may enter a list: the parts ask for vectors and compare them."""
    shape = nodes.shape

    def answer(part: int, rows: _Rows):
        begin = part * shape.size
        vectors, scales = rows.all(_LIGHT, np.int16, np.float32)
        vectors, (least,) = vectors.reshape(len(scales), shape.width), rows.all(_LEAST, np.float32)
        for to, wanted in rows.of(_ASK, np.uint32):
            own = wanted.astype(np.int64) - begin
            yield from _rows(to, _ANSWER, wanted, vectors[own], scales[own], least[own], origin=part)

    def compare(part: int, rows: _Rows):
        meet, new = (x.reshape(-1, NEIGHBOURS + REVERSE) for x in rows.all(_MEET, np.int32, bool))
        if not len(meet):
            return
        ids, vectors, scales, least = rows.all(_ANSWER, np.uint32, np.int16, np.float32, np.float32)
        vectors = vectors.reshape(len(ids), shape.width)
        news, sizes = new.sum(axis=1), (meet >= 0).sum(axis=1)
        order = np.lexsort((sizes, news))
        found, held = [[np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [np.zeros(0, np.float32)]], 0

        def settle() -> None:
            """Keep only what could still enter a list."""
            source, near, score = (np.concatenate(x) for x in found)
            # Rows of one pair differ in the last bits of the score at most, so that they come together.
            key = source.astype(np.uint64) << np.uint64(32) | _falling(score) & np.uint64(0xFFFFFF00) | near.astype(np.uint64) & np.uint64(0xFF)
            order = np.argsort(key)
            source, near, score = source[order], near[order], score[order]
            first = np.ones(len(source), bool)
            first[1:] = (source[1:] != source[:-1]) | (near[1:] != near[:-1])
            source, near, score = source[first], near[first], score[first]
            stay = _ranks(source) < NEIGHBOURS
            found[:] = [[source[stay]], [near[stay]], [score[stay]]]

        for i in range(0, len(order), BATCH):
            some = order[i : i + BATCH]
            most, wide = int(news[some].max()), int(sizes[some].max())
            own, fresh = meet[some, :wide], new[some, :wide]
            none = own < 0
            there = vectors[own].astype(np.float32)
            there *= scales[own][:, :, None]
            near = there[:, :most] @ there.transpose(0, 2, 1)
            near.transpose(0, 2, 1)[none] = -np.inf
            both = np.arange(most)
            near[:, both, both] = -np.inf
            # Rows beyond a node's new entries are old ones, which do not meet old ones.
            near[~fresh[:, :most]] = -np.inf
            enter = least[own]
            left = np.flatnonzero(near > enter[:, :most, None])
            # Two new ones have a row each; an old one has none.
            right = np.flatnonzero(near > np.where(fresh, np.inf, enter)[:, None, :])
            flat = near.ravel()
            for hits, turned in ((left, False), (right, True)):
                row, column = np.divmod(hits, wide)
                node = row // most
                pair = own[node, row % most], own[node, column]
                for x, values in zip(found, (pair[turned], pair[not turned], flat[hits])):
                    x.append(values)
                held += len(hits)
            if held > _HELD:
                settle()
                held = len(found[0][0])
        settle()
        (source,), (near,), (score,) = found
        yield from _better(ids[source], ids[near], score, shape.size, part)

    answers = _meet(nodes.light().unionAll(_only(messages, _LEAST, _ASK)), answer)
    return _meet(answers.unionAll(_only(messages, _MEET)), compare)


def build_graph(nodes: Nodes) -> DataFrame:
    """The lists of every part of the nodes, and their edges."""
    shape, turn = nodes.shape, 0
    messages = keep(_ask(_merge(_start(nodes), shape, turn), shape, turn))
    while shape.count > 1:
        fresh = _only(messages, _STATE).agg(F.sum("x")).first()[0] / shape.count
        if fresh <= SETTLED:
            break
        better, turn = _compare(messages, nodes), turn + 1
        messages = keep(_ask(_merge(better.unionAll(_only(messages, _STATE)), shape, turn), shape, turn))
    return _only(messages, _STATE)


def _query_parts(part: int, nodes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Query parts of the queries among a node part's nodes."""
    nodes = np.unique(nodes)
    for i in range(0, len(nodes), QUERY_PART):
        yield _QUERIES + (part << 20) + i // QUERY_PART, nodes[i : i + QUERY_PART]


def search_graph(graph: DataFrame, nodes: Nodes, asked: DataFrame) -> DataFrame:
    """The pools of every query part with nothing left to expand; ``asked`` names the query nodes."""
    shape = nodes.shape
    links, width = NEIGHBOURS + REVERSE, shape.width

    def link(part: int, rows: _Rows):
        n, begin = shape.of(part), part * shape.size
        sampled, _ = _reverse(rows, n, begin, -1)
        both = np.hstack([rows.all(_STATE, np.int32)[0].reshape(n, NEIGHBOURS), sampled])
        yield from _rows(part, _LINKS, _once(both, np.zeros(both.shape, bool))[0])

    def begin(part: int, rows: _Rows):
        n, first = shape.of(part), part * shape.size
        near, score = (x.reshape(n, NEIGHBOURS) for x in rows.all(_STATE, np.int32, np.float32))
        short, scales = rows.all(_LIGHT, np.int16, np.float32)
        short = short.reshape(n, width)
        for to, index in _query_parts(part, rows.all(_QUERY, np.uint32)[0]):
            own = index.astype(np.int64) - first
            pool, scores = np.full((len(own), POOL), -1, np.int32), np.full((len(own), POOL), -np.inf, np.float32)
            pool[:, 0], scores[:, 0] = index, np.inf
            pool[:, 1 : NEIGHBOURS + 1], scores[:, 1 : NEIGHBOURS + 1] = near[own], score[own]
            # Scores of a query are compared with each other only, so that its scale does not matter.
            yield from _rows(to, _POOL, index, short[own], pool, scores / scales[own][:, None])
            yield _row(to, _DONE, pool < 0)

    def advance(part: int, rows: _Rows):
        index, vectors, pool, scores = rows.all(_POOL, np.uint32, np.int16, np.int32, np.float32)
        done, = rows.all(_DONE, bool)
        n, have = len(index), np.flatnonzero(pool >= 0)
        more, query, score = rows.all(_SCORED, np.uint32, np.int32, np.float32)
        query, node = np.concatenate([have // POOL, query]), np.concatenate([pool[have], more]).astype(np.int64)
        score, done = np.concatenate([scores[have], score]), np.concatenate([done[have], np.zeros(len(more), bool)])
        # Of a node's rows the first, which is the pool's, stays.
        order = _order((query, n.bit_length()), (node, shape.count.bit_length()))
        order = order[_starts(query[order] << 32 | node[order])]
        order = order[np.argsort(query[order].astype(np.uint64) << np.uint64(32) | _falling(score[order]), kind="stable")]
        rank = _ranks(query[order])
        order, rank = order[rank < POOL], rank[rank < POOL]
        query, node, score, done = query[order], node[order], score[order], done[order]
        open_ = np.flatnonzero(~done)
        front = open_[_ranks(query[open_]) < EXPAND]
        done[front] = True
        lists = np.full((n, POOL), -1, np.int32), np.full((n, POOL), -np.inf, np.float32), np.ones((n, POOL), bool)
        for matrix, values in zip(lists, (node, score, done)):
            matrix[query, rank] = values
        yield from _rows(part, _POOL, index, vectors.reshape(n, width), *lists[:2])
        yield _row(part, _DONE, lists[2], x=float(len(front)))
        front = front[np.argsort(node[front], kind="stable")]
        for to, a, b in _by_part(node[front], shape.size):
            yield from _rows(to, _EXPAND, node[front[a:b]].astype(np.uint32), query[front[a:b]].astype(np.int32), origin=part)

    def expand(part: int, rows: _Rows):
        known = rows.all(_LINKS, np.int32)[0].reshape(-1, links)
        for to, node, query in rows.of(_EXPAND, np.uint32, np.int32):
            yield from _rows(to, _LINKED, known[node.astype(np.int64) - part * shape.size], query, origin=part)

    def choose(part: int, rows: _Rows):
        index, vectors, pool, scores = rows.all(_POOL, np.uint32, np.int16, np.int32, np.float32)
        found, query = rows.all(_LINKED, np.int32, np.int32)
        query, have = np.repeat(query, links)[found >= 0], np.flatnonzero(pool >= 0)
        # Each node once, and none that is in the pool: last bit 0.
        key = (query.astype(np.int64) << 32 | found[found >= 0].astype(np.int64)) << 1 | 1
        key = np.sort(np.concatenate([key, ((have // POOL).astype(np.int64) << 32 | pool[have].astype(np.int64)) << 1]))
        key = key[_starts(key >> 1)]
        key = key[key & 1 == 1] >> 1
        node, query = key & 0xFFFFFFFF, key >> 32
        order = _order((node, shape.count.bit_length()))
        node, query, vectors, least = node[order], query[order], vectors.reshape(len(index), width), scores.reshape(len(index), POOL)[:, -1]
        for to, a, b in _by_part(node, shape.size):
            some, place = np.unique(query[a:b], return_inverse=True)
            numbers = np.concatenate([some.astype(np.int32), least[some].view(np.int32)])
            yield _row(to, _SCORE, node[a:b].astype(np.uint32), place.astype(np.int32), vectors[some], numbers, origin=part)

    def rate(part: int, rows: _Rows):
        short, scales = rows.all(_LIGHT, np.int16, np.float32)
        known = short.reshape(len(scales), width).astype(np.float32) * scales[:, None]
        for to, node, place, vectors, numbers in rows.of(_SCORE, np.uint32, np.int32, np.int16, np.int32):
            query, least = numbers[: len(numbers) // 2], numbers[len(numbers) // 2 :].view(np.float32)
            own, vectors = node.astype(np.int64) - part * shape.size, vectors.reshape(len(query), width).astype(np.float32)
            score = np.concatenate([np.zeros(0, np.float32)] + [
                np.einsum("ij,ij->i", known[own[i : i + 4096]], vectors[place[i : i + 4096]]) for i in range(0, len(own), 4096)
            ])
            # What is below the whole pool stays there.
            stay = score >= least[place]
            if stay.any():
                yield from _rows(to, _SCORED, node[stay], query[place[stay]], score[stay].astype(np.float32), origin=part)

    edges = _merge(graph, shape, -1)
    known = keep(_meet(edges, link))
    state = keep(_meet(_meet(graph.unionAll(nodes.light()).unionAll(asked), begin), advance))
    while _only(state, _DONE).agg(F.sum("x")).first()[0]:
        linked = _meet(_only(state, _EXPAND).unionAll(known), expand)
        chosen = _meet(linked.unionAll(_only(state, _POOL)), choose)
        scored = _meet(chosen.unionAll(nodes.light()), rate)
        state = keep(_meet(scored.unionAll(_only(state, _POOL, _DONE)), advance))
    return _only(state, _POOL)


def _exact(pools: DataFrame, nodes: Nodes, asked: DataFrame, most: int) -> DataFrame:
    """``(query, node, score)``: the ``most`` best of every pool, in double precision on the vectors of ``nodes``.

    Of equal scores the node with the smallest id comes first.
    """
    shape, kind = nodes.shape, nodes.kind

    def own(part: int, rows: _Rows):
        _, vectors = rows.all(_EXACT, np.int64, kind)
        for to, index in _query_parts(part, rows.all(_QUERY, np.uint32)[0]):
            yield from _rows(to, _VECTOR, vectors.reshape(-1, shape.width)[index.astype(np.int64) - part * shape.size])

    def ask(part: int, rows: _Rows):
        _, _, pool = rows.all(_POOL, np.uint32, np.int16, np.int32)
        vectors, = rows.all(_VECTOR, kind)
        have = np.flatnonzero(pool >= 0)
        have = have[np.argsort(pool[have], kind="stable")]
        node, query = pool[have].astype(np.int64), have // POOL
        for to, a, b in _by_part(node, shape.size):
            some, place = np.unique(query[a:b], return_inverse=True)
            asked = vectors.reshape(-1, shape.width)[some]
            yield _row(to, _PAIR, node[a:b].astype(np.uint32), place.astype(np.int32), asked, some.astype(np.int32), origin=part)

    def score(part: int, rows: _Rows):
        ids, known = rows.all(_EXACT, np.int64, kind)
        known = known.reshape(-1, shape.width).astype(np.float64)
        for to, node, place, vectors, query in rows.of(_PAIR, np.uint32, np.int32, kind, np.int32):
            index, vectors = node.astype(np.int64) - part * shape.size, vectors.reshape(-1, shape.width)
            scores = np.concatenate([np.zeros(0)] + [(known[index[i : i + 4096]] * vectors[place[i : i + 4096]]).sum(axis=1) for i in range(0, len(index), 4096)])
            yield from _rows(to, _PAIRED, node, query[place], scores, ids[index], origin=part)

    def best(part: int, rows: _Rows):
        index, = rows.all(_POOL, np.uint32)
        node, query, score, ids = rows.all(_PAIRED, np.uint32, np.int32, np.float64, np.int64)
        order = np.lexsort((ids, -score, query))
        order = order[_ranks(query[order]) < most]
        yield _row(part, _PAIRED, node[order], index[query[order]], score[order])

    def unpack(batches):
        for batch in batches:
            for row in zip(*(batch.column(n) for n in "bac")):
                query, node, score = (np.frombuffer(x.as_buffer(), t) for x, t in zip(row, (np.uint32, np.uint32, np.float64)))
                yield pa.RecordBatch.from_arrays([pa.array(query.astype(np.int64)), pa.array(node.astype(np.int64)), pa.array(score)], ["query", "node", "score"])

    pairs = _meet(_meet(nodes.exact().unionAll(asked), own).unionAll(pools), ask)
    scored = _meet(pairs.unionAll(nodes.exact()), score)
    return _meet(scored.unionAll(pools), best).mapInArrow(unpack, "query bigint, node bigint, score double")


def _asked(queries: DataFrame, size: int) -> DataFrame:
    """The nodes ``(node)`` as messages to their parts."""

    def pieces(batches):
        for batch in batches:
            index = np.unique(batch.column("node").to_numpy())
            yield from _batches(_row(p, _QUERY, index[a:b].astype(np.uint32)) for p, a, b in _by_part(index, size))

    return queries.select("node").mapInArrow(pieces, _MESSAGE)


def nearest(vectors: DataFrame, id_column: str, vector_column: str, is_query: Column, k: int = 20) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest other rows of every query row.

    ``is_query`` is a condition on the column ``id``. Equal scores go to the smaller id.
    """
    rows = keep(usable(vectors, id_column, vector_column))
    classes = rows.groupBy("vec").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    nodes = Nodes(keep(classes), _kind(vectors, vector_column))
    # A vector that occurs once need not be looked up by its value.
    alone = F.col("copies") == 1
    copied = rows.join(nodes.index.where(~alone).select("vec", "node"), "vec").select("node", "id", F.lit(False).alias("alone"))
    members = keep(nodes.index.where(alone).select("node", "id", F.lit(True).alias("alone")).unionAll(copied))
    queries = members.where(is_query)
    asked = keep(_asked(queries, nodes.shape.size))
    pools = search_graph(build_graph(nodes), nodes, asked)
    # Of equal vectors only the k + 1 smallest ids can be in a result.
    few = members.where(~F.col("alone"))
    for group in (["node", F.pmod(F.xxhash64("id"), F.lit(_SALTS))], ["node"]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy("id"))
        few = few.withColumn("rank", rank).where(F.col("rank") <= k + 1).drop("rank")
    few = few.unionAll(members.where("alone")).select("node", "id")
    # Every node has a row, so that those in a result are among the k + 1 best nodes.
    found = _exact(pools, nodes, asked, k + 1)
    # Queries with equal vectors share a pool, and each leaves itself out.
    ranked = found.join(few, "node").select("query", "id", "score")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    ranked = ranked.withColumn("rank", rank).where(F.col("rank") <= k + 1)
    lists = ranked.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("best"))
    own = queries.select(F.col("node").alias("query"), F.col("id").alias("query_id")).join(lists, "query")
    others = F.slice(F.filter("best", lambda x: x["id"] != F.col("query_id")), 1, k)
    return own.select("query_id", F.posexplode(others).alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score")
    )
