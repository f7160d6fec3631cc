"""A corpus from documents to packed training sequences, each stage writing what it keeps."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm import decontaminate, dedup, language, packing, pii
from tenura.llm.common import bound_batches, table
from tenura.llm.queries import BYTE_BPE, pii_key
from tenura.session import fresh_path

#: Fewer than for packing alone: the processes also hold what earlier stages left.
KEPT_WORDS = 100_000
#: A language is taken as known from this mean probability on.
LEAST_SCORE = 0.3
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def lean(stage: Stage) -> Stage:
    """The stage with rows sent to Python in small batches: executors still hold memory of the stages before.

    What a stage returns is computed later, so the setting stays in the session.
    """

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


@lean
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows; it learns from those of their labels it may see."""
    return language.keep_known(docs, LEAST_SCORE)


@lean
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least doc_id."""
    return dedup.keep_one(docs)


@lean
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


@lean
def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data; n_chars follows the new text."""
    new = pii.pseudonymise(docs, pii_key(spark))
    if "n_chars" not in docs.columns:
        return new
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return new.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))


@lean
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, a row for each piece of a document."""
    return packing.pack(docs, public_tokenizers.path(BYTE_BPE), kept_words=KEPT_WORDS)


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("near duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("personal data", without_personal_data),
    ("packing", packed),
]

#: SQL cannot train a network or encode tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
