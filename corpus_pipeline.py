"""Preparing documents for training, stage by stage.

Toxic documents go, lines that many documents hold are kept once, one document of each group of near copies stays, the
sources are mixed, and the texts are encoded. Each stage works on all that the one before kept. The mixture is the
order of the rows that the mixing stage writes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, line_dedup, mixing, ngram_join, toxicity
from tidemark.llm.common import delete_path, fresh_path, read_documents, scratch_scope

_before: list[str] = []


def _stage(work):
    """A stage; when it begins, the result of the one before is written, and what that needed is deleted."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for path in _before:
            delete_path(spark, path)
        with scratch_scope() as paths:
            result = work(spark, docs, sf_dir)
        _before[:] = paths
        return result

    run_stage.__name__, run_stage.__doc__ = work.__name__, work.__doc__
    return run_stage


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic."""
    judged = toxicity.judge(docs, read_documents(spark, sf_dir, "labels"))
    return judged.where(~F.col(judged.columns[-1])).select(*docs.columns)


@_stage
def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that three or more hold but for one of them; n_chars follows the text."""
    cut = line_dedup.drop_repeated_lines(docs).select(*docs.columns)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose shingles of five words are similar to 0.8 or more."""
    return ngram_join.keep_one(docs, width=5, percent=80)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture of sources by the square root of their sizes."""
    scheduled = mixing.schedule(docs, mixing.smoothed_weights(docs))
    return mixing.mixed(scheduled, docs.columns)


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, with their number and the digest of what they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]
# Classifiers and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again by the next."""
    docs = read_documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        path = fresh_path(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
