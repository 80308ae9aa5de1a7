"""URL filter: rules first, then character models of accepted and rejected URLs.

The models are variable-order Markov chains over the signs of host and path: each order
up to ``ORDER`` is mixed with the next shorter one by the number of different signs seen
after its context (Witten-Bell). They are counted over all URLs that a rule decides, and
the difference of their log-likelihoods, divided by the URL's length, is calibrated on a
part of those URLs that the counts leave out. The models hold every distinct run by its own
64-bit code: equally exact at every size, they grow with the number of distinct runs. A URL that no rule decides is allowed if the
calibrated share is at least a half.

A null URL, or one without ``://``, has an empty host and path; no rule fits it. Repeated
rows are judged alike. Without decided URLs of both kinds the more frequent kind holds,
and without any everything is allowed. Extra columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm import logistic
from tidewater.llm.charlm import RunTable, coded, fetch, gram_counts
from tidewater.llm.tables import keep
from tidewater.llm.text import CharGrams, small_batches

ORDER = 6
# Decided URLs that calibrate the difference; the sample is that of the smallest hashes.
CALIBRATION_ROWS = 20_000
_FLOOR = 1 / 256
ALLOW, BLOCK = "allow", "block"


def split_urls(pages: DataFrame) -> DataFrame:
    """``(page_id, host, path)`` of every row."""
    after = F.expr("substring(url, instr(url, '://') + 3)")
    rest = F.when(F.instr("url", "://") > 0, F.regexp_extract(after, r"(?s)^([^?#]*)", 1)).otherwise(F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), rest.alias("rest"))
    host = F.substring_index("rest", "/", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return rows.select("page_id", lower.alias("host"), F.substr("rest", F.length(host) + 1).alias("path"))


def ruled(urls: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """``urls`` with ``rule`` and ``decided`` (the rule's verdict), null where none fits.

    Rules are ``(verdict, host + path)``; they become one expression, so a list should have
    hundreds of them at most. The longest wins, at equal length the first in order.
    """
    rule = decided = None
    for verdict, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        decided = F.when(fits, verdict) if decided is None else decided.when(fits, verdict)
    none = F.lit(None).cast("string")
    return urls.withColumn("rule", none if rule is None else rule).withColumn("decided", none if decided is None else decided)


def _split_rows(decided: DataFrame) -> DataFrame:
    """Text and class of the decided URLs, and whether they are kept for calibration."""
    text = F.concat("host", "path")
    return decided.where("decided is not null").select(
        text.alias("text"), F.when(F.col("decided") == ALLOW, 0).otherwise(1).alias("class"), (F.pmod(F.xxhash64(text), F.lit(5)) == 0).alias("apart")
    )


def train(decided: DataFrame) -> dict:
    """Model from rows with host, path and the verdict a rule gave them."""
    rows = _split_rows(decided)
    grams = keep(gram_counts(rows.where("not apart"), ORDER, 2, lambda t: [t.encode("utf-8", "replace")]))
    runs, contexts = [], []
    for length in range(ORDER, 0, -1):
        own = grams.groupBy(F.expr(f"right(gram, {length})").alias("gram")).agg(F.sum("n_0").alias("n_0"), F.sum("n_1").alias("n_1"))
        context = own.groupBy(F.expr(f"left(gram, {length - 1})").alias("gram")).agg(
            F.sum("n_0").alias("n_0"),
            F.sum("n_1").alias("n_1"),
            F.count_if(F.col("n_0") > 0).alias("t_0"),
            F.count_if(F.col("n_1") > 0).alias("t_1"),
        )
        runs.append(fetch(coded(own, length)))
        contexts.append(fetch(coded(context, length - 1)))
    model: dict = {"runs": RunTable(runs), "contexts": RunTable(contexts)}
    sample = rows.where("apart").orderBy(F.xxhash64("text"), "text").limit(CALIBRATION_ROWS).repartition(F.xxhash64("text"))
    seen = _differences(sample, model, ["class"]).toArrow()
    accepted = (seen.column("class").to_numpy() == 0).astype(float)
    if len(accepted) == 0:
        model["calibration"] = (np.zeros(1), np.ones(1), np.array([0.0, 1.0]))
    else:
        mean, scale, w = logistic.fit(seen.column("difference").to_numpy().reshape(-1, 1), accepted)
        if 0 < accepted.sum() < len(accepted):  # how many of each kind rules decide says nothing about the rest
            w[-1] -= np.log(accepted.sum() / (len(accepted) - accepted.sum()))
        model["calibration"] = (mean, scale, w)
    return model


def _scorer(model: dict):
    """Function from URLs to length-normalised log-likelihood differences, accepted less rejected."""
    held, contexts = model["runs"], model["contexts"]

    def score(urls: list[str]) -> np.ndarray:
        runs = CharGrams(urls, ORDER)
        p = [np.full(len(runs.at), _FLOOR) for _ in (0, 1)]
        for length in range(1, ORDER + 1):
            own, context = held.at(runs.codes(length)), contexts.at(runs.codes(length - 1, 1))
            for c in (0, 1):
                seen, kinds = contexts[f"n_{c}"][context], contexts[f"t_{c}"][context]
                mixed = (held[f"n_{c}"][own] + kinds * p[c]) / np.maximum(seen + kinds, 1)
                p[c] = np.where(seen > 0, mixed, p[c])
        gained = np.log(p[0]) - np.log(p[1])
        return np.bincount(runs.word, gained, len(urls)) / np.bincount(runs.word, minlength=len(urls))

    return score


def _differences(urls: DataFrame, model: dict, also: list[str]) -> DataFrame:
    """``also`` columns of rows with ``text``, and the difference of each."""
    shared = urls.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(shared.value)
        for batch in small_batches(batches, 4096):
            found = score(batch.column("text").to_pylist()) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in also), pa.array(found)], [*also, "difference"])

    kinds = dict(urls.dtypes)
    return urls.select(*also, "text").mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in also) + ", difference double")


def judge(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """``(page_id, host, path, rule, verdict, difference)`` of every row."""
    urls = ruled(split_urls(pages), rules)
    model = train(urls)
    mean, scale, w = (x.tolist() for x in model["calibration"])
    names = ["page_id", "host", "path", "rule", "decided"]
    rows = _differences(urls.withColumn("text", F.concat("host", "path")), model, names)
    accepted = (F.col("difference") - mean[0]) / scale[0] * w[0] + w[1] >= 0
    verdict = F.coalesce("decided", F.when(accepted, ALLOW).otherwise(BLOCK))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "difference")
