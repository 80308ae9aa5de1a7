"""Counts of character runs inside words, gathered over a whole corpus by Spark."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.text import CharGrams, gram_codes, sign_matrix

# Distinct words a task holds before it turns them into runs.
FLUSH_WORDS = 100_000


def gram_counts(df: DataFrame, order: int, classes: int, words: Callable[[object], list[bytes]]) -> DataFrame:
    """``(gram, n_0 … n_k)``: weight of every run of ``order`` signs by class.

    ``df`` has ``text`` and ``class`` (0 to ``classes - 1``; null: in no class, skipped).
    ``words`` parts one text. Tasks count words, turn distinct words into runs and add
    up equal runs before the shuffle, which Spark then sums; no key can be hot after that.
    """
    schema = "gram string, " + ", ".join(f"n_{c} bigint" for c in range(classes))

    def runs(counters: list[Counter]) -> pa.RecordBatch:
        distinct = list(set().union(*counters))
        grams = CharGrams([w.decode("utf-8", "replace") for w in distinct], order)
        _, first, inverse = np.unique(grams.codes(order), return_index=True, return_inverse=True)
        columns = [pa.array(grams.runs(order, first), pa.string())]
        for counter in counters:
            weight = np.fromiter((counter[w] for w in distinct), np.float64, len(distinct))[grams.word]
            columns.append(pa.array(np.bincount(inverse, weight, len(first)).astype(np.int64)))
        return pa.RecordBatch.from_arrays(columns, ["gram", *(f"n_{c}" for c in range(classes))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = [Counter() for _ in range(classes)]
        for batch in batches:
            for text, cls in zip(batch.column("text").to_pylist(), batch.column("class").to_pylist()):
                if cls is not None:
                    counters[cls].update(words(text))
                    if sum(map(len, counters)) > FLUSH_WORDS:
                        yield runs(counters)
                        counters = [Counter() for _ in range(classes)]
        if any(counters):
            yield runs(counters)

    counted = df.select("text", F.col("class").cast("int").alias("class")).mapInArrow(count, schema)
    return counted.groupBy("gram").agg(*(F.sum(f"n_{c}").alias(f"n_{c}") for c in range(classes)))


def coded(df: DataFrame, length: int) -> DataFrame:
    """``(code, …)``: ``df`` with the 64-bit codes of its grams; all grams are distinct and have ``length`` signs."""
    names = [c for c in df.columns if c != "gram"]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = gram_codes(sign_matrix(batch.column("gram").to_pylist(), length))
            yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), *(batch.column(c) for c in names)], ["code", *names])

    numbers = df.select("gram", *(F.col(c).cast("bigint").alias(c) for c in names))
    return numbers.mapInArrow(code, "code bigint, " + ", ".join(f"{c} bigint" for c in names))


class RunTable:
    """Numbers of each run by its 64-bit code, as many rows as there are runs; runs it lacks have zeros.

    Tables of several lengths may share one, since codes hold the length.
    """

    def __init__(self, parts: list[dict[str, np.ndarray]]):
        codes = np.concatenate([p["code"] for p in parts]).astype(np.int64).view(np.uint64)
        order = np.argsort(codes)
        self.codes = codes[order]
        self._numbers = {c: np.append(np.concatenate([p[c] for p in parts])[order].astype(np.float64), 0) for c in parts[0] if c != "code"}

    def at(self, codes: np.ndarray) -> np.ndarray:
        """Row of every code."""
        rows = np.searchsorted(self.codes, codes)
        found = np.append(self.codes, np.uint64(0))[rows] == codes
        return np.where(found, rows, len(self.codes))

    def __getitem__(self, column: str) -> np.ndarray:
        return self._numbers[column]


def fetch(table: DataFrame) -> dict[str, np.ndarray]:
    """Columns of a table as arrays on the driver; has a row for each distinct run (see ``coded``)."""
    arrow = table.toArrow()
    return {c: arrow.column(c).to_numpy(zero_copy_only=False) for c in arrow.column_names}
