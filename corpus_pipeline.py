"""The corpus pipeline: toxic and unreadable documents, near copies and leaked benchmark items go; the rest is packed.

Every stage takes ``(spark, docs, sf_dir)``. All but the last return the rows of ``docs``
that stay, with all their columns; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import decontaminate, language, neardup, packing, toxicity
from tidewater.llm.tables import keep, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_ordinary(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_known(docs, language.train(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_leaked),
    ("packing", pack),
]

# No SQL expresses the trained models, the signatures or the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each on the stored result of the one before."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir))
    return docs
