"""Importance resampling by hashed n-gram models.

Two bag-of-n-grams models over the same hash buckets, one of target text (documents
labelled good) and one of all raw text, give every document a log weight: the mean
log ratio of its words and word pairs, taken ``SPAN`` times so that long and short
documents compare. Gumbel noise from a hash of the row is added and the ``k`` largest
sums stay, which is sampling without replacement in proportion to the weights.

Texts that are null or have no word get a null weight and never stay. Rows with equal
keys stand and fall together at the threshold, repeated rows with them. Labels that are
null or repeat count as good if one of them is. Without target text all weights are 0.
Extra columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.tables import bounded, keep
from tidewater.llm.text import WordCodes, mix64, small_batches, utf8

# Hash buckets of both models.
BITS = 16
# n-grams that every document's mean log ratio is scaled to.
SPAN = 50
# Good rows that make the target: all, or a sample by hash of about so many. Their ids are broadcast.
TARGET_ROWS = 200_000
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def _buckets(words: np.ndarray) -> np.ndarray:
    """Buckets of the words and word pairs of one text."""
    pairs = mix64(words[:-1] * _PAIR + words[1:])
    return (np.concatenate([mix64(words), pairs]) >> np.uint64(64 - BITS)).astype(np.int64)


def train(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Log ratio of target to raw probability by bucket, counted over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, sums = WordCodes(), np.zeros((2, 1 << BITS))
        for batch in batches:
            good = batch.column("good").to_pylist()
            for text, is_good in zip(utf8(batch.column("text")), good):
                own = np.bincount(_buckets(codes.of(text)), minlength=1 << BITS) if text else 0
                sums[0] += own
                if is_good:
                    sums[1] += own
        at = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_pydict(
            {"bucket": pa.array(at.astype(np.int32)), **{c: pa.array(s[at].astype(np.int64)) for c, s in zip(("raw", "target"), sums)}}
        )

    good = keep(labels.where("doc_id is not null").groupBy("doc_id").agg((F.max("quality") > 0).alias("good")).where("good"))
    good = F.broadcast(bounded(good, "doc_id", TARGET_ROWS))
    texts = docs.select("doc_id", "text").where("text is not null").join(good, "doc_id", "left").select("text", "good")
    sums = texts.mapInArrow(count, "bucket int, raw bigint, target bigint")
    table = sums.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    at = table.column("bucket").to_numpy()
    raw, target = np.full(1 << BITS, 0.5), np.full(1 << BITS, 0.5)
    raw[at] += table.column("raw").to_numpy()
    target[at] += table.column("target").to_numpy()
    if target.sum() == 0.5 * (1 << BITS):
        return np.zeros(1 << BITS)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weigh(docs: DataFrame, ratio: np.ndarray, seed: int = 17) -> DataFrame:
    """``(doc_id, log_weight, gumbel_key, sort_key)`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in small_batches(batches):
            weights = np.full(batch.num_rows, np.nan)
            for i, text in enumerate(utf8(batch.column("text"))):
                words = codes.of(text)
                if len(words):
                    weights[i] = SPAN * shared.value[_buckets(words)].mean()
            uniform = (mix64(batch.column("noise").to_numpy().view(np.uint64)) >> np.uint64(11)).astype(float)
            keys = weights - np.log(-np.log((uniform + 0.5) / 2.0**53))
            bits = keys.view(np.int64)
            order = np.where(bits >= 0, bits, bits ^ np.int64(0x7FFFFFFFFFFFFFFF))
            none = np.isnan(weights)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, mask=none) for x in (weights, keys, order))],
                ["doc_id", "log_weight", "gumbel_key", "sort_key"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64(F.lit(seed), "doc_id", "text").alias("noise"))
    return rows.mapInArrow(run, "doc_id bigint, log_weight double, gumbel_key double, sort_key bigint")


def kth_largest(rows: DataFrame, column: str, k: int) -> int | None:
    """The ``k``-th largest value of a bigint column, by counting 16 bits of it at a time.

    Each pass returns at most 65,536 counts to the driver. None when there are fewer rows.
    """
    prefix = None
    for shift in (48, 32, 16, 0):
        digit = F.shiftright(column, shift)
        within = rows.where(F.col(column).isNotNull())
        if prefix is not None:
            within = within.where(F.shiftright(column, shift + 16) == prefix)
        counts = sorted(within.groupBy(digit.alias("digit")).count().collect(), key=lambda r: -r["digit"])
        for row in counts:
            if k <= row["count"]:
                prefix = row["digit"]
                break
            k -= row["count"]
        else:
            return None
    return prefix


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = 17) -> DataFrame:
    """Every row with its weight and whether it is drawn: ``(doc_id, log_weight, gumbel_key, kept)``.

    ``share`` of the rows is drawn; by default the share of good ones among the labels.
    """
    if share is None:
        seen = labels.where("doc_id is not null").agg(F.avg((F.col("quality") > 0).cast("double")).alias("share")).first()
        share = seen["share"] if seen["share"] is not None else 1.0
    rows = keep(weigh(docs, train(docs, labels), seed))
    least = kth_largest(rows, "sort_key", max(1, round(share * rows.count())))
    kept = F.col("sort_key").isNotNull() if least is None else F.coalesce(F.col("sort_key") >= least, F.lit(False))
    return rows.select("doc_id", "log_weight", "gumbel_key", kept.alias("kept"))
