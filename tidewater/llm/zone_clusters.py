"""Clustering around moving centroids, with the vectors stored in the order of a Hilbert curve.

Vectors become whole numbers. A Hilbert curve through their dimensions of greatest variance
orders them; runs of them become blocks, each with a box (least and greatest entry of every
dimension), its sum and its size. In a round, a centroid is out for a block when, even at the
corner of the box that suits it best, the centroid nearest to the middle of the box is nearer.
A block with one centroid left goes to it whole, by its stored sum; the vectors of the others
are compared exactly with the centroids that are left. Bounds and distances are whole numbers,
so the result is that of plain comparison with every centroid.

A round reads the blocks once and shuffles sums per centroid and dimension only, of which
the driver sees the totals. Ordering ranks equal vectors by their row, so a vector that holds
a large part of all rows spreads over tasks.

Vectors that are null, of another length, or hold null or non-finite entries take no part.
Rows that repeat an id or a vector all stay; of rows that share an id the one with the smaller
vector starts first. Rows without an id take part but start no cluster. With fewer vectors than
clusters there is one cluster for each start. An empty table gives no rows. Entries must stay
within 2**26 as whole numbers, beyond which a squared distance may leave 64 bits; larger ones
fail. Extra columns are not touched.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.exact import cells, finite, matrix, scaled, sums
from tidewater.llm.tables import keep

# Dimensions of the curve and bits of each: the key fits a bigint.
CURVE, BITS = 8, 7
# Vectors of a block, and of a task that makes blocks.
BLOCK, PART = 256, 65536
LIMIT = 1 << 26
_EXACT = 1 << 53

_BLOCKS = "ids array<{kind}>, vectors binary, low binary, high binary, total binary"
# Second index of the sums that are not of a dimension.
_COUNT, _DISTANCE = -1, -2


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Position of each row of whole numbers below ``2**bits`` along the Hilbert curve (Skilling's transform)."""
    x = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(len(x)):
            inverted = (x[i] >> bit) & 1 == 1
            swapped = np.where(inverted, 0, (x[0] ^ x[i]) & low)
            x[0] = x[0] ^ np.where(inverted, low, swapped)
            x[i] = x[i] ^ swapped if i else x[0]
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flips = np.zeros(len(points), np.int64)
    for bit in range(bits - 1, 0, -1):
        flips ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    key = np.zeros(len(points), np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | ((axis ^ flips) >> bit & 1)
    return key


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to some point of the box, ties included."""
    middle = low + high - 2 * centroids
    near = int(np.argmin((middle * middle).sum(axis=1)))
    towards = centroids - centroids[near]
    corner = np.where(towards > 0, high, low)
    own, its = corner - centroids, corner - centroids[near]
    behind = (own * own).sum(axis=1) - (its * its).sum(axis=1)
    numbers = np.arange(len(centroids))
    return np.flatnonzero((behind < 0) | ((behind == 0) & (numbers <= near)))


def nearest(vectors: np.ndarray, centroids: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to the nearest allowed centroid; ties to the smaller number."""
    chosen = centroids[allowed]
    size = max(int(np.abs(vectors).max(initial=0)), int(np.abs(chosen).max(initial=0)))
    kind = np.float64 if 8 * size * size * vectors.shape[1] < _EXACT else np.int64
    v, c = vectors.astype(kind), chosen.astype(kind)
    distance = (v * v).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * (v @ c.T)
    best = np.argmin(distance, axis=1)
    return allowed[best], distance[np.arange(len(best)), best].astype(np.int64)


def usable(vectors: DataFrame, id_column: str, vector_column: str, length: int, scale: int) -> DataFrame:
    v = F.col("v")
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    return rows.where((F.size(v) == length) & finite(v)).select("id", scaled(v, scale).alias("x"))


def blocks(rows: DataFrame, length: int) -> DataFrame:
    """Vectors ``(id, x, row)`` in runs along the curve, each with its box and sum."""
    kind = rows.schema["id"].dataType

    def spread(batches):
        n, parts = 0, []
        for batch in batches:
            x = matrix(batch.column("x"))
            if not len(x):
                continue
            if np.abs(x).max() > LIMIT:
                raise ValueError(f"entries beyond {LIMIT} as whole numbers")
            parts.append((len(x), x.sum(axis=0), (x.astype(np.float64) ** 2).sum(axis=0), x.min(axis=0), x.max(axis=0)))
        for n, total, squares, low, high in parts:
            columns = [np.arange(length), np.full(length, float(n)), total.astype(float), squares, low, high]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["dim", "n", "total", "squares", "low", "high"])

    stats = rows.mapInArrow(spread, "dim bigint, n double, total double, squares double, low bigint, high bigint").groupBy("dim")
    stats = stats.agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"), F.min("low").alias("low"), F.max("high").alias("high")).collect()
    # Where the curve runs decides how well boxes fit, never what comes out.
    widest = sorted(stats, key=lambda s: (-(s["squares"] / s["n"] - (s["total"] / s["n"]) ** 2), s["dim"]))[:CURVE]
    dims = np.array([s["dim"] for s in widest], int)
    low, high = (np.array([s[c] for s in widest], np.int64) for c in ("low", "high"))

    def order(batches):
        for batch in batches:
            x = matrix(batch.column("x"))
            key = hilbert((x[:, dims] - low) * (1 << BITS) // (high - low + 1), BITS) if len(x) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("x"), batch.column("row"), pa.array(key)], ["id", "x", "row", "key"])

    def cut(batches):
        for batch in batches:
            x, ids = matrix(batch.column("x")), batch.column("id")
            starts = range(0, len(x), BLOCK)
            runs = [x[i : i + BLOCK] for i in starts]
            ends = pa.array([*starts, len(x)], pa.int32())
            columns = [pa.ListArray.from_arrays(ends, ids)] + [
                pa.array([f(r).tobytes() for r in runs], pa.binary())
                for f in (lambda r: r.astype(np.int32), lambda r: r.min(axis=0), lambda r: r.max(axis=0), lambda r: r.sum(axis=0))
            ]
            yield pa.RecordBatch.from_arrays(columns, ["ids", "vectors", "low", "high", "total"])

    n = stats[0]["n"] if stats else 0
    keyed = keep(rows.mapInArrow(order, f"id {kind.simpleString()}, x array<bigint>, row bigint, key bigint"))
    along = keyed.repartitionByRange(max(1, math.ceil(n / PART)), "key", "row").sortWithinPartitions("key", "row")
    return keep(along.mapInArrow(cut, _BLOCKS.format(kind=kind.simpleString())))


def _unpacked(batch: pa.RecordBatch, length: int):
    """Blocks of a batch: ids, vectors, low, high, total."""
    for i in range(batch.num_rows):
        raw = [batch.column(c)[i].as_py() for c in ("vectors", "low", "high", "total")]
        vectors = np.frombuffer(raw[0], np.int32).reshape(-1, length).astype(np.int64)
        yield batch.column("ids")[i].values, vectors, *(np.frombuffer(r, np.int64) for r in raw[1:])


def assign(stored: DataFrame, centroids: np.ndarray, distances: bool = False) -> dict[tuple[int, int], int]:
    """Sums of every dimension, counts, and distances if asked for, by centroid."""
    k, length = centroids.shape

    def partial(batches):
        total = np.zeros((k, length), object)
        count, away = [0] * k, [0] * k
        for batch in batches:
            for _, vectors, low, high, whole in _unpacked(batch, length):
                allowed = candidates(low, high, centroids)
                if len(allowed) == 1 and not distances:
                    total[allowed[0]] += whole
                    count[allowed[0]] += len(vectors)
                    continue
                number, distance = nearest(vectors, centroids, allowed)
                for c in np.unique(number):
                    own = number == c
                    total[c] += vectors[own].sum(axis=0)
                    count[c] += int(own.sum())
                    away[c] += int(distance[own].sum())
        found = {}
        for c in range(k):
            if count[c]:
                found |= {(c, d): total[c, d] for d in range(length)} | {(c, _COUNT): count[c], (c, _DISTANCE): away[c]}
        yield cells(found)

    return sums(stored, partial)


def cluster(
    vectors: DataFrame, id_column: str, vector_column: str, length: int = 64, scale: int = 1024, clusters: int = 8, rounds: int = 10, seed: str = "3:"
) -> DataFrame:
    """``(id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every vector that takes part."""
    rows = keep(usable(vectors, id_column, vector_column, length, scale).withColumn("row", F.monotonically_increasing_id()))
    kind = rows.schema["id"].dataType.simpleString()
    draw = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    first = rows.where(F.col("id").isNotNull()).select(draw.alias("draw"), "x").orderBy("draw", "x").limit(clusters).collect()
    centroids = np.array([r["x"] for r in first], np.int64).reshape(len(first), length)
    if not first:
        none = rows.where("false").select("id", F.lit(0).alias("cluster"), *[F.lit(0).cast("bigint").alias(c) for c in ("distance", "cluster_inertia", "inertia")])
        return none.withColumn("centroid_sha256", F.lit("")).withColumnRenamed("id", id_column)
    stored = blocks(rows, length)
    for _ in range(rounds):
        found, before = assign(stored, centroids), centroids
        centroids = np.array(
            [[found[c, d] // found[c, _COUNT] for d in range(length)] if (c, _COUNT) in found else before[c] for c in range(len(before))], np.int64
        )
        if (centroids == before).all():
            # Further rounds would repeat this one.
            break
    found = assign(stored, centroids, distances=True)
    inertia = {c: found.get((c, _DISTANCE), 0) for c in range(len(centroids))}
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def label(batches):
        for batch in batches:
            for ids, vectors, low, high, _ in _unpacked(batch, length):
                number, distance = nearest(vectors, centroids, candidates(low, high, centroids))
                yield pa.RecordBatch.from_arrays([ids, pa.array(number, pa.int32()), pa.array(distance)], ["id", "cluster", "distance"])

    of = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("cluster") + 1)
    return stored.mapInArrow(label, f"id {kind}, cluster int, distance bigint").select(
        F.col("id").alias(id_column),
        "cluster",
        "distance",
        of([inertia[c] for c in range(len(centroids))]).cast("bigint").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
        of(hashes).alias("centroid_sha256"),
    )
