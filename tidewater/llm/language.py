"""Language of texts by multinomial naive Bayes over hashed character runs.

Null ``lang`` values teach nothing. A text that is null or has no letter is ``und`` with
score 0; so is every text when nothing could be learned. A row is judged by its text
alone, so null ids, repeated rows and extra columns change nothing. Equal scores go to
the language first in order. Texts are scored whole.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.tables import fold
from tidewater.llm.text import CharGrams, WordScores, letter_words, segment_sum, small_batches

ORDERS = (1, 2, 3, 4)
# Hash buckets of the character runs: the model has this many numbers a language.
BITS = 15
UNKNOWN = "und"
# Likeness that a text needs in the pipeline, and what a text of one run may fall short of it.
LIKE, SHORT = 0.62, 2.0
_FLUSH_WORDS = 100_000


def _buckets(runs: CharGrams, order: int) -> np.ndarray:
    return (runs.codes(order) >> np.uint64(64 - BITS)).astype(np.int64)


def train(docs: DataFrame) -> dict:
    """Log-probability matrix (language x bucket) and priors.

    From text and non-null lang of the rows in folds 1 to 4. Each task adds up what it
    reads and sends one row a language and bucket; the sums have a bounded number of rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = defaultdict(Counter)
        sums: dict[str, np.ndarray] = {}
        rows: Counter = Counter()

        def flush() -> None:
            for lang, counter in words.items():
                runs = CharGrams([w.decode("utf-8", "replace") for w in counter], max(ORDERS))
                weight = np.fromiter(counter.values(), float, len(counter))[runs.word]
                for order in ORDERS:
                    at = _buckets(runs, order)
                    sums[lang] = sums.get(lang, 0) + np.bincount(at, weight, 1 << BITS)
            words.clear()

        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                rows[lang] += 1
                words[lang].update(letter_words(text))
                if sum(map(len, words.values())) > _FLUSH_WORDS:
                    flush()
        flush()
        for lang in rows:
            total = sums.get(lang, np.zeros(1 << BITS))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": [lang] * (len(at) + 1),
                    "bucket": pa.array([-1, *at.tolist()], pa.int32()),
                    "n": pa.array([rows[lang], *total[at].astype(np.int64).tolist()], pa.int64()),
                }
            )

    labelled = docs.where("lang is not null and text is not null").where(F.coalesce(fold() != 0, F.lit(False)))
    sums = labelled.select("text", "lang").mapInArrow(count, "lang string, bucket int, n bigint")
    table = sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(table.column("lang").to_pylist()))
    at = {lang: i for i, lang in enumerate(langs)}
    matrix, prior = np.zeros((len(langs), 1 << BITS)), np.zeros(len(langs))
    which = np.array([at[x] for x in table.column("lang").to_pylist()], int)
    bucket, n = table.column("bucket").to_numpy(), table.column("n").to_numpy()
    counts = bucket >= 0
    matrix[which[counts], bucket[counts]] = n[counts]
    prior[which[~counts]] = n[~counts]
    matrix = np.log((matrix + 0.5) / (matrix.sum(1, keepdims=True) + 0.5 * (1 << BITS)))
    return {"langs": langs, "matrix": matrix.T.astype(np.float32), "prior": np.log(prior / max(1, prior.sum()))}


def likeness(model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Of each language, the mean log-probability of a run of its own texts and of a run drawn at random."""
    matrix = model["matrix"].astype(float)
    return (np.exp(matrix) * matrix).sum(0), matrix.mean(0)


def _judge(model: dict):
    """Function from texts to language indexes (-1: unknown), scores, and likeness.

    The posterior compares the learned languages only and is near 1 for any text. Likeness says
    whether the best of them fits at all: the text's mean log-probability a run, 1 where it is
    that of the language's own texts and 0 where it is that of random runs.
    """
    matrix, prior = model["matrix"], model["prior"]
    width = len(model["langs"])

    def words(new: list[bytes]) -> np.ndarray:
        runs = CharGrams([w.decode("utf-8", "replace") for w in new], max(ORDERS))
        gained = sum(matrix[_buckets(runs, order)].astype(float) for order in ORDERS)
        places = np.full((len(gained), 1), float(len(ORDERS)))
        return segment_sum(np.hstack([gained, places]), runs.first)

    scorer = WordScores(words, width + 1)
    own, random = likeness(model) if width else (0, 0)

    def judge(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        heard = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts], bool)
        if not width:
            return np.full(len(texts), -1), np.zeros(len(texts)), np.zeros((len(texts), 2))
        rows, ends = scorer.rows([letter_words(t) for t in texts])
        summed = segment_sum(rows, ends)
        total, runs = summed[:, :width] + prior, summed[:, width]
        best = total.argmax(1)
        share = 1 / np.exp(np.minimum(total - total.max(1, keepdims=True), 0)).sum(1)
        mean = summed[np.arange(len(best)), best] / np.maximum(runs, 1)
        like = (mean - random[best]) / (own - random)[best]
        return np.where(heard, best, -1), np.where(heard, share, 0.0), np.stack([like, runs], 1)

    return judge


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row; score is the posterior."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge, names = _judge(shared.value), [*shared.value["langs"], UNKNOWN]
        for batch in small_batches(batches):
            best, share, _ = judge(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([names[i] for i in best], pa.string()), pa.array(share)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, model: dict, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is found with a score of ``least`` or more, and fits.

    A text fits if its likeness is at least ``LIKE``, or less for short ones, whose mean varies.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(shared.value)
        for batch in small_batches(batches):
            best, share, fit = judge(batch.column("text").to_pylist())
            fits = fit[:, 0] >= LIKE - SHORT / np.sqrt(np.maximum(fit[:, 1], 1))
            yield batch.filter(pa.array((best >= 0) & (share >= least) & fits))

    return docs.mapInArrow(run, docs.schema)
