"""The corpus pipeline on ``documents``: reject toxic texts, keep one of each
group of near-duplicates, mask personal data, mix the sources, encode to tokens.

A stage takes (spark, docs, sf_dir) and works on all rows that the one before
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, mixing, pii, simhash, toxicity
from quarry.llm.common import Scratch, table
from quarry.llm.queries import VOCABULARY


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the ordinal model, learnt from ``labels``, does not reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), Scratch(spark, "toxicity"))
    return toxicity.clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of SimHash links, that of the smallest id."""
    return simhash.dedup(docs, Scratch(spark, "simhash"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span masked; ``n_chars`` follows the text."""
    return pii.masked(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mixture draws it, for a budget of all tokens."""
    return mixing.mixed(docs, Scratch(spark, "mixing"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every drawn row."""
    return bpe.digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("byte_level_bpe", encode),
]

ORACLE_SQL = None  # a fitted model, fingerprints and token ids are beyond SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each one's rows written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, scratch.write(stage(spark, docs, sf_dir), name)
        scratch.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
