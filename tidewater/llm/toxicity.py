"""Toxicity by class-conditional Kneser-Ney models of characters.

Two models of order ``ORDER`` over the signs inside words, one of toxic and one of
ordinary labelled text, share all lower orders: continuation counts over every document,
labelled or not. A rare expression that neither class has seen thus gets the same
probability from both and counts for nothing. A document is judged by its length-normalised
log-likelihood difference and by the same difference of its most toxic words, through a
logistic calibration on labelled rows that the models have not counted.

Null and empty texts have no words and score as the calibration has it for no evidence;
null ids and repeated rows are scored like any other row, since each row is judged by its
text alone; labels that repeat a doc_id count as toxic if one of them is; null labels and
labels without a document are ignored. Without usable labels every score is close to 0.
Very long texts are scored whole. Extra columns are not touched.

The model holds every distinct run of the corpus by its own 64-bit code, so it is equally
exact at every size and grows with the number of distinct runs, not of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm import logistic
from tidewater.llm.charlm import RunTable, coded, fetch, gram_counts
from tidewater.llm.tables import bounded, fold, keep
from tidewater.llm.text import CharGrams, WordScores, letter_words, segment_sum, small_batches

ORDER = 5
# Labelled rows that the class models count and that calibrate the score: all, or a sample by
# hash of about so many. Their ids and labels are broadcast, so that no text is shuffled.
LABELLED_ROWS, CALIBRATION_ROWS = 200_000, 20_000
# Most toxic words of a document whose mean difference is looked at.
TOP = 3
# Discount of continuation counts, and the probability under all of them.
_DISCOUNT, _FLOOR = 0.75, 1 / 5000
TOXIC, ORDINARY, OTHER = 0, 1, 2


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """Model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    Labels count only in folds 1 to 4 of the ids: 1 to 3 for the counts, 4 for calibration.
    Every document counts in the shared lower orders.
    """
    known = keep(
        labels.where("doc_id is not null and toxic is not null")
        .where(fold() != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    texts = docs.select("doc_id", "text").where("text is not null")
    counted = bounded(known.where(fold() != 4), "doc_id", LABELLED_ROWS)
    counted = counted.select("doc_id", F.when(F.col("toxic") > 0, TOXIC).otherwise(ORDINARY).alias("class"))
    grams = keep(
        gram_counts(
            texts.join(F.broadcast(counted), "doc_id", "left").select("text", F.coalesce("class", F.lit(OTHER)).alias("class")),
            ORDER,
            3,
            letter_words,
        )
    )
    model = _tables(grams)
    sample = bounded(known.where(fold() == 4), "doc_id", CALIBRATION_ROWS)
    sample = texts.where(fold() == 4).join(F.broadcast(sample), "doc_id")
    seen = _features(sample, model, ["toxic"]).toArrow()
    features = np.array(seen.column("features").to_pylist(), float).reshape(-1, 4)
    model["calibration"] = logistic.fit(features, (seen.column("toxic").to_numpy() > 0).astype(float))
    return model


def _tables(grams: DataFrame) -> dict:
    labelled = grams.where("n_0 + n_1 > 0")
    context = labelled.groupBy(F.expr(f"substring(gram, 1, {ORDER - 1})").alias("gram")).agg(
        F.sum("n_0").alias("n_0"),
        F.sum("n_1").alias("n_1"),
        F.count_if(F.col("n_0") > 0).alias("t_0"),
        F.count_if(F.col("n_1") > 0).alias("t_1"),
    )
    ones = grams.agg(*(F.count_if(F.col(f"n_{c}") == k).alias(f"m_{c}_{k}") for c in (0, 1) for k in (1, 2))).first()
    model = {
        "gram": RunTable([fetch(coded(labelled.select("gram", "n_0", "n_1"), ORDER))]),
        "context": RunTable([fetch(coded(context, ORDER - 1))]),
        "discount": [ones[f"m_{c}_1"] / max(1, ones[f"m_{c}_1"] + 2 * ones[f"m_{c}_2"]) or 0.5 for c in (0, 1)],
    }
    own, contexts = [], []
    low = grams.select("gram")
    for length in range(ORDER - 1, 0, -1):
        # How many different signs precede each shorter run: the next order's own runs.
        low = low.groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("n"))
        rest = low.groupBy(F.expr(f"substring(gram, 1, {length - 1})").alias("gram")).agg(
            F.sum("n").alias("n"), F.count("*").alias("t")
        )
        own.append(fetch(coded(low, length)))
        contexts.append(fetch(coded(rest, length - 1)))
    return model | {"low": RunTable(own), "low_context": RunTable(contexts)}


def _word_scorer(model: dict) -> WordScores:
    """Log-likelihood difference and number of signs of each word."""
    gram, context, low, low_context = (model[k] for k in ("gram", "context", "low", "low_context"))

    def score(words: list[bytes]) -> np.ndarray:
        runs = CharGrams([w.decode("utf-8", "replace") for w in words], ORDER)
        p = np.full(len(runs.at), _FLOOR)
        for length in range(1, ORDER):
            rest, own = low_context.at(runs.codes(length - 1, 1)), low.at(runs.codes(length))
            seen = low_context["n"][rest]
            held = np.maximum(low["n"][own] - _DISCOUNT, 0) + _DISCOUNT * low_context["t"][rest] * p
            p = np.where(seen > 0, held / np.maximum(seen, 1), p)
        rest, own, logs = context.at(runs.codes(ORDER - 1, 1)), gram.at(runs.codes(ORDER)), []
        for c in (0, 1):
            seen, d = context[f"n_{c}"][rest], model["discount"][c]
            held = np.maximum(gram[f"n_{c}"][own] - d, 0) + d * context[f"t_{c}"][rest] * p
            logs.append(np.log(np.maximum(np.where(seen > 0, held / np.maximum(seen, 1), p), 1e-30)))
        signs = np.bincount(runs.word, minlength=len(words))
        return np.column_stack([np.bincount(runs.word, logs[0] - logs[1], len(words)), signs])

    return WordScores(score, 2)


def _evidence(scorer: WordScores, texts: list[str | None]) -> np.ndarray:
    """Four features of each text: normalised difference, top words by mean and by sum, length."""
    rows, ends = scorer.rows([letter_words(t) for t in texts])
    whole = segment_sum(rows, ends)
    out = np.zeros((len(texts), 4))
    out[:, 0] = whole[:, 0] / np.maximum(whole[:, 1], 1)
    mean = rows[:, 0] / np.maximum(rows[:, 1], 1)
    for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        for k, values in ((1, mean), (2, rows[:, 0])):
            own = values[a:b]
            out[i, k] = (np.partition(own, len(own) - TOP)[-TOP:] if len(own) > TOP else own).sum() / TOP
    out[:, 3] = np.log1p(np.diff(ends))
    return out


def _features(docs: DataFrame, model: dict, also: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _word_scorer(shared.value)
        for batch in small_batches(batches):
            found = _evidence(scorer, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in also), pa.array(found.tolist(), pa.list_(pa.float64()))], [*also, "features"]
            )

    kinds = dict(docs.dtypes)
    return docs.select(*also, "text").mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in also) + ", features array<double>")


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _word_scorer(shared.value)
        for batch in small_batches(batches):
            p = logistic.predict(shared.value["calibration"], _evidence(scorer, batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def keep_ordinary(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _word_scorer(shared.value)
        for batch in small_batches(batches):
            found = _evidence(scorer, batch.column("text").to_pylist())
            yield batch.filter(pa.array(logistic.predict(shared.value["calibration"], found) < 0.5))

    return docs.mapInArrow(run, docs.schema)
