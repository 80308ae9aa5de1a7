"""Benchmark items inside documents by size-partitioned MinHash containment search.

Items are sets of word shingles, partitioned by size. For the partition with sizes up to
``u``, documents are looked at in windows of ``2 u`` shingles that start every ``u``, so
that a copy lies whole in one of them and containment of an item bounds the Jaccard
similarity with that window from below by a known value; SuperMinHash signatures with one
slot a band are long enough to miss that similarity less than once in a million. Items
that share a band with a window are verified by exact shingle containment in the document.
A window that holds no shingle of any item cannot share a band with one, so a bitmap of the
item shingles says which windows need a signature.

The items are taken in blocks of bounded size, each broadcast with its bands; documents
are scanned once a block, without a shuffle, and a passage that many of them hold costs
each of them the same.

Words are lower-cased runs of letters and digits (``WORDS``); fewer words than a shingle
make one shingle, which only an equally short document can hold. Null or empty items match
nothing, null or empty documents hold nothing. Repeated items and documents give a row
each; a null id is kept in the result. Extra columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.superminhash import signature, slot_keys
from tidewater.llm.text import WordCodes, shingle_codes, small_batches, utf8

WIDTH = 5
# Share of an item's shingles, in hundredths, that a document must hold.
PERCENT = 80
SLOTS = 64
# Bounds of a block of items.
BLOCK_ITEMS = 20_000
BLOCK_SHINGLES = 2_000_000
# Size of the shingle bitmap.
_BITS = 24
# What parts words: every ASCII sign that is no letter or digit.
_PARTS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def _shingles(codes: WordCodes, text: bytes | None) -> np.ndarray:
    return shingle_codes(codes.of(text.translate(_PARTS) if text else None), WIDTH)


class ItemIndex:
    """Bands, shingles and bitmap of one block of items."""

    def __init__(self, ids: list, sets: list[np.ndarray]):
        self.ids, self.sets = ids, sets
        every = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
        self.shingles = every
        self.bitmap = np.zeros(1 << _BITS, bool)
        self.bitmap[(every >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        parts: dict[int, list[int]] = {}
        for i, s in enumerate(sets):
            parts.setdefault((len(s) - 1).bit_length(), []).append(i)
        #: Upper size of a partition: sorted band keys and the item of each.
        self.partitions = {}
        for power, members in parts.items():
            keys = np.concatenate([slot_keys(signature(sets[i], SLOTS), 1) for i in members])
            items = np.repeat(members, SLOTS)
            order = np.argsort(keys, kind="stable")
            self.partitions[1 << power] = (keys[order], items[order])

    def find(self, shingles: np.ndarray) -> list[tuple[int, int]]:
        """Items that one document holds, and how many of their shingles."""
        near = np.flatnonzero(self.bitmap[(shingles >> np.uint64(64 - _BITS)).astype(np.int64)])
        if not len(near):
            return []
        at = np.searchsorted(self.shingles, shingles[near])
        near = near[self.shingles[np.minimum(at, len(self.shingles) - 1)] == shingles[near]]
        if not len(near):
            return []
        candidates: set[int] = set()
        for upper, (keys, items) in self.partitions.items():
            step = near // upper
            for window in np.unique(np.concatenate([step, np.maximum(step - 1, 0)])):
                own = np.unique(shingles[window * upper : (window + 2) * upper])
                bands = slot_keys(signature(own, SLOTS), 1)
                low, high = np.searchsorted(keys, bands, "left"), np.searchsorted(keys, bands, "right")
                for a, b in zip(low, high):
                    candidates.update(items[a:b].tolist())
        held = np.unique(shingles[near])
        out = []
        for i in sorted(candidates):
            shared = int(np.isin(self.sets[i], held, assume_unique=True).sum())
            if 100 * shared >= PERCENT * len(self.sets[i]):
                out.append((i, shared))
        return out


def indexes(items: DataFrame) -> Iterator[ItemIndex]:
    """Blocks of ``items`` (item_id, text). Shingles are made by tasks and come block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in small_batches(batches):
            sets = [np.unique(_shingles(codes, t)).view(np.int64) for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(sets, pa.list_(pa.int64()))], ["item_id", "shingles"])

    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").mapInArrow(run, "item_id bigint, shingles array<bigint>")
    ids, sets, size = [], [], 0
    for row in rows.where("size(shingles) > 0").toLocalIterator():
        ids.append(row["item_id"])
        sets.append(np.array(row["shingles"], np.int64).view(np.uint64))
        size += len(sets[-1])
        if len(ids) >= BLOCK_ITEMS or size >= BLOCK_SHINGLES:
            yield ItemIndex(ids, sets)
            ids, sets, size = [], [], 0
    if ids:
        yield ItemIndex(ids, sets)


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc_id, item_id, item_shingles, shared, containment)`` for every item that a document holds."""
    spark: SparkSession = docs.sparkSession
    schema = "doc_id bigint, item_id bigint, item_shingles bigint, shared bigint, containment double"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def scan(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index, codes = shared.value, WordCodes()
            for batch in small_batches(batches):
                found = []
                for doc, text in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text"))):
                    for i, n in index.find(_shingles(codes, text)):
                        size = len(index.sets[i])
                        found.append((doc, index.ids[i], size, n, n / size))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                columns = list(zip(*found)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        return run

    names = ["doc_id", "item_id", "item_shingles", "shared", "containment"]
    out = None
    for index in indexes(items):
        part = rows.mapInArrow(scan(spark.sparkContext.broadcast(index)), schema)
        out = part if out is None else out.unionAll(part)
    return spark.createDataFrame([], schema) if out is None else out


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item."""

    def scan(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index, codes = shared.value, WordCodes()
            for batch in small_batches(batches):
                clean = [not index.find(_shingles(codes, t)) for t in utf8(batch.column("text"))]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return run

    for index in indexes(items):
        docs = docs.mapInArrow(scan(docs.sparkSession.sparkContext.broadcast(index)), docs.schema)
    return docs
