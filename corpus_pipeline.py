"""A training corpus from ``documents``, stage by stage.

Each stage is one operator of ``storylens.llm`` over all that the stage before
kept. Stages return the columns of ``documents``; the last one returns token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storylens.llm import bpe, langid, mixing, simhash, toxicity
from storylens.llm.common import table, unused, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents of this score or more are toxic.
TOXIC = 0.7


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that could be learned; those without a letter go."""
    lang, score = unused(docs, "_lang", "_score")
    found = langid.predict(docs, langid.learn(docs), pred_col=lang, score_col=score)
    return found.where(F.col(lang) != langid.UNDETERMINED).select(*docs.columns)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    fitted = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score, = unused(docs, "_score")
    return toxicity.score(docs, fitted, score_col=score).where(F.col(score) < TOXIC).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a row for each round through a source that takes of a document."""
    return mixing.documents_of(mixing.mix(docs), docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, packed as little-endian unsigned 32-bit integers."""
    return bpe.encode(docs.select("doc_id", "lang", "source", "text")).select(
        "doc_id", "lang", "source", F.expr("length(ids) div 4").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("toxicity", clean),
    ("simhash_near_dedup", near_dedup),
    ("mixing", mix),
    ("byte_bpe", byte_bpe),
]

#: The models of several stages can't be expressed in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
