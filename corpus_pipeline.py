"""Corpus pipeline: stages over ``documents``, each stored as Parquet before the next.

Every stage calls one operator of ``visitflow.llm`` on all rows its
predecessor kept; all but the last return the columns of documents. Null or
empty texts, null ids, repeated rows, empty tables and extra columns follow
the operators' docstrings.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitflow.llm import bpe, line_dedup, mixing, simhash, toxicity
from visitflow.llm.common import Scratch, documents, table

# target shares go with (tokens of the value) ** exponent: a mild evening out
MIX_EXPONENTS = {"source": 0.9, "lang": 0.9, "topic": 1.0}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the noisy-channel toxicity score rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each class of similar lines stays; documents without any line of their own go.

    ``n_chars``, where there is one, follows the shortened text.
    """
    out = line_dedup.dedup_lines(docs, width=line_dedup.NEAR_SHINGLE)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else out


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (four-word shingles, four bits)."""
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by probabilities raked to source, language and topic targets."""
    return mixing.sampled_documents(docs, MIX_EXPONENTS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents, and the texts' token ids, their number, and digests of ids and decoded bytes."""
    v = bpe.load_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.encode(docs, v, digests=True)


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("simhash", drop_near_copies),
          ("mixing", mix_sources), ("bpe", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = documents(spark, sf_dir), Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
