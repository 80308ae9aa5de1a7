"""Embedding whitening: principal components of a distributed covariance, refined in mixed precision.

The covariance of whole-number vectors is summed exactly in tasks, centred first: entries
are taken from the whole part of the mean, and what the fraction of the mean adds is put
right in rational numbers. Only sums per pair of dimensions reach the driver.

Eigenvectors start from a float32 decomposition. Ogita-Aishima steps, which consist of
matrix products, correct all of them at once in extended precision, quadratically. Where
eigenvalues lie too close for a step to tell apart, the step only restores orthogonality;
the matrix, reduced to that cluster and shifted by its mean, is decomposed on its own, and
the steps go on with the parts that are now apart. ``numpy.longdouble`` is the extended
precision; on machines where it is a plain double, so is the result's last digit.

Vectors that are null, hold null or non-finite entries, or are empty take no part, neither
do those of another length than the most frequent (of equally frequent ones, the smallest).
Repeated rows and rows without an id stay, each with its values; each distinct vector counts
once in the fit. Components without variance are left out, so vectors that are all equal, or
an empty table, give no rows. ``deviation`` is null where it does not fit a bigint. Extra
columns are not touched.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.exact import cells, finite, gram, matrix, scaled, sums
from tidewater.llm.tables import keep

# Steps after which the refinement gives up; it settles in three to eight.
STEPS = 40
_WIDE = np.longdouble
_MOST = (1 << 63) - 1


def _wide(x: Fraction) -> np.longdouble:
    """A rational number in extended precision."""
    high = float(x)
    return _WIDE(high) + _WIDE(float(x - Fraction(high)))


def _norm(m: np.ndarray) -> np.longdouble:
    """Frobenius norm: a bound of the spectral one."""
    return np.sqrt(np.sum(m * m))


def _clusters(values: np.ndarray, apart) -> list[slice]:
    """Runs of descending values whose neighbours are not further apart than ``apart``."""
    ends = [i + 1 for i in range(len(values)) if i + 1 == len(values) or values[i] - values[i + 1] > apart]
    return [slice(a, b) for a, b in zip([0, *ends], ends) if b - a > 1]


def step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.longdouble, np.longdouble]:
    """One Ogita-Aishima step: eigenvalues, corrected vectors, size of the correction, and what counts as apart."""
    r = np.eye(len(a), dtype=_WIDE) - x.T @ x
    s = x.T @ (a @ x)
    s = (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    apart = 2 * (_norm(s - np.diag(values)) + _norm(a) * _norm(r))
    gap = values[None, :] - values[:, None]
    told = np.abs(gap) > apart
    e = np.where(told, (s + values[None, :] * r) / np.where(told, gap, 1), r / 2)
    return values, x + x @ e, np.abs(e).max(), apart


def refined_eigh(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns of a symmetric matrix, in extended precision."""
    a = a.astype(_WIDE)
    size = np.abs(a).max()
    if not size:
        return np.zeros(len(a), _WIDE), np.eye(len(a), dtype=_WIDE)
    a = a / size
    x = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1].astype(_WIDE)
    least = 4 * np.finfo(_WIDE).eps * len(a)
    best = np.inf
    for _ in range(STEPS):
        values, x, moved, apart = step(a, x)
        order = np.argsort(-values, kind="stable")
        values, x = values[order], x[:, order]
        if moved <= least or (moved >= best and moved < 1e-15):
            break
        best = min(best, moved)
        for near in _clusters(values, apart):
            own = x[:, near]
            inner = own.T @ (a @ own) - np.eye(own.shape[1], dtype=_WIDE) * values[near].mean()
            spread = np.abs(inner).max()
            if spread > least:
                x[:, near] = own @ np.linalg.eigh(((inner + inner.T) / (2 * spread)).astype(np.float64))[1][:, ::-1].astype(_WIDE)
    # Over small gaps rounding turns vectors a little; make them orthogonal again, of unit length, and
    # take the values as Rayleigh quotients.
    for _ in range(2):
        x = x + x @ (np.eye(len(a), dtype=_WIDE) - x.T @ x) / 2
    x = x / np.sqrt(np.sum(x * x, axis=0))
    values = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-values, kind="stable")
    return values[order] * size, x[:, order]


def usable(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """``(id, x)`` of the rows that take part, vectors as whole numbers."""
    v = F.col("v")
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    rows = rows.where(finite(v) & (F.size(v) > 0))
    length = rows.groupBy(F.size(v).alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size(v) == (length["size"] if length else 0)).select("id", scaled(v, scale).alias("x"))


def fit(rows: DataFrame) -> dict:
    """Size, sums, and refined components of the distinct vectors ``x``."""
    distinct = keep(rows.select("x").distinct())

    def first(batches):
        total, n = None, 0
        for batch in batches:
            x = matrix(batch.column("x"))
            if len(x):
                n += len(x)
                part = x.sum(axis=0) if np.abs(x).max() < 1 << 40 else x.astype(object).sum(axis=0)
                total = part.astype(object) + (0 if total is None else total)
        if n:
            yield cells({(-1, -1): n} | {(i, -1): s for i, s in enumerate(total)})

    found = sums(distinct, first)
    n = found.pop((-1, -1), 0)
    if not n:
        return {"n": 0}
    total = [found[i, -1] for i in range(len(found))]
    centre = [s // n for s in total]
    base = np.array(centre, np.int64)

    def second(batches):
        products = None
        for batch in batches:
            y = matrix(batch.column("x")) - base
            if len(y):
                products = gram(y) + (0 if products is None else products)
        if products is not None:
            yield cells({(i, j): products[i, j] for i in range(len(base)) for j in range(i, len(base))})

    found = sums(distinct, second)
    rest = [s - n * c for s, c in zip(total, centre)]
    covariance = np.zeros((len(base), len(base)), _WIDE)
    for (i, j), value in found.items():
        covariance[i, j] = covariance[j, i] = _wide(Fraction(value * n - rest[i] * rest[j], n * n))
    values, components = refined_eigh(covariance)
    trace = np.trace(covariance)
    positive = int((values > trace * np.finfo(np.float64).eps * len(base)).sum()) if trace > 0 else 0
    return {"n": n, "distinct": distinct, "centre": base, "rest": rest, "trace": trace, "values": values[:positive], "components": components[:, :positive]}


def project(y: np.ndarray, model: dict, k: int) -> np.ndarray:
    """Whitened coordinates of rows given from the whole part of the mean.

    Summed dimension by dimension, so that a row's values do not depend on its batch.
    """
    n, scale = model["n"], np.sqrt(model["values"][:k])
    axes = (model["components"][:, :k] / scale).astype(np.float64)
    out = np.zeros((len(y), k))
    for i, r in enumerate(model["rest"]):
        out += np.subtract(y[:, i], r / n, dtype=np.float64)[:, None] * axes[i]
    return out


def deviations(y: np.ndarray, n: int, rest: list[int]) -> list[int | None]:
    """Exact sums of squares of n * x - S; None beyond 64 bits."""
    most = n * (int(np.abs(y).max(initial=0)) + 1)
    kind = np.int64 if most * most * len(rest) <= _MOST else object
    away = y.astype(kind) * n - np.array(rest, kind)
    return [int(s) if s <= _MOST else None for s in (away * away).sum(axis=1)]


def _identity_error(model: dict, k: int) -> float:
    """Largest entry of the whitened vectors' covariance less the identity, over the fit list."""
    base = model["centre"]
    plain = {key: value for key, value in model.items() if key != "distinct"}

    def moments(batches):
        total, n = np.zeros((k + 1, k + 1)), 0
        for batch in batches:
            w = project(matrix(batch.column("x")) - base, plain, k)
            if len(w):
                w = np.hstack([w, np.ones((len(w), 1))])
                total += w.T @ w
                n += len(w)
        if n:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["a", "b", "value"])

    totals = model["distinct"].mapInArrow(moments, "a int, b int, value double").groupBy("a", "b").agg(F.sum("value").alias("value"))
    m = np.zeros((k + 1, k + 1))
    for r in totals.collect():
        m[r["a"], r["b"]] = r["value"] / model["n"]
    return float(np.abs(m[:k, :k] - np.outer(m[k, :k], m[k, :k]) - np.eye(k)).max())


def whiten(vectors: DataFrame, id_column: str, vector_column: str, scale: int = 256, components: int = 4) -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)``, a row for each vector and component."""
    rows = keep(usable(vectors, id_column, vector_column, scale))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n bigint, deviation bigint, whitened double"
    model = fit(rows)
    k = min(components, len(model.get("values", ())))
    if not k:
        out = rows.where("false").select("id", F.lit(1).alias("component"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("deviation"))
        doubles = [F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")]
        return out.select("*", *doubles).withColumnRenamed("id", id_column)
    base, n = model["centre"], model["n"]
    plain = {key: value for key, value in model.items() if key != "distinct"}

    def score(batches):
        for batch in batches:
            y = matrix(batch.column("x")) - base if batch.num_rows else np.zeros((0, len(base)), np.int64)
            each = np.repeat(np.arange(len(y)), k)
            columns = [
                batch.column("id").take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))),
                pa.array(np.full(len(each), n)),
                pa.array(deviations(y, n, plain["rest"]), pa.int64()).take(pa.array(each)),
                pa.array(project(y, plain, k).ravel()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "component", "n", "deviation", "whitened"])

    shares = F.array(*[F.lit(float(e / model["trace"])) for e in model["values"][:k]])
    return rows.mapInArrow(score, schema).select(
        F.col("id").alias(id_column),
        "component",
        "n",
        "deviation",
        "whitened",
        F.element_at(shares, F.col("component")).alias("explained"),
        F.lit(_identity_error(model, k)).alias("identity_error"),
    )
