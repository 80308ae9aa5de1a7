"""Vectors as whole numbers, and sums over them that lose nothing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Below this size the products of two entries add up exactly in doubles over ``_CHUNK`` rows.
_SMALL, _CHUNK = 1 << 20, 4096

_CELL = "a int, b int, value decimal(38,0)"


def finite(v: Column) -> Column:
    """Whether an array of doubles is there and holds neither null nor non-finite entries."""
    return v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


def scaled(v: Column, scale: int) -> Column:
    """floor(scale * entry) of every entry, as bigint."""
    return F.transform(v, lambda c: F.floor(c * F.lit(float(scale))).cast("bigint"))


def matrix(column) -> np.ndarray:
    """A list column of equally long rows as a matrix of int64."""
    values = pa.array([], pa.int64()) if not len(column) else column.flatten()
    values = values.to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def gram(y: np.ndarray) -> np.ndarray:
    """Exact sums of products of the columns, as Python integers."""
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for i in range(0, len(y), _CHUNK):
        part = y[i : i + _CHUNK]
        if np.abs(part).max(initial=0) < _SMALL:
            part = part.astype(np.float64)
            total += (part.T @ part).astype(np.int64)
        else:
            part = part.astype(object)
            total += part.T @ part
    return total


def cells(values: dict[tuple[int, int], int]) -> pa.RecordBatch:
    """Partial sums, each with its two indices."""
    keys = list(values)
    numbers = pa.array([int(values[k]) for k in keys], pa.decimal128(38, 0))
    return pa.RecordBatch.from_arrays([pa.array([k[i] for k in keys], pa.int32()) for i in (0, 1)] + [numbers], ["a", "b", "value"])


def sums(df: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> dict[tuple[int, int], int]:
    """Totals of the :func:`cells` that tasks make of their part; as many as there are different indices."""
    totals = df.mapInArrow(partial, _CELL).groupBy("a", "b").agg(F.sum("value").alias("value"))
    return {(r["a"], r["b"]): int(r["value"]) for r in totals.collect()}
