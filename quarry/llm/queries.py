"""The registered queries ``opN_<name>`` of the operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import align, bpe, hnsw, lattice, mixing, pii, quality, simhash, sketch, tokens, toxicity, turns, warczip
from quarry.llm.common import Scratch, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"), Scratch(spark, "op4"))
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


@query("op2_document_fingerprints")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.edited_fingerprints(table(spark, sf_dir, "documents"))


VOCABULARY = "byte_bpe_multi_50k.tiktoken"


@query("op7_byte_level_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


@query("op10_token_files")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op10")
    return tokens.read(tokens.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), scratch))


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.with_severity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), Scratch(spark, "op1")))


@query("op3_source_mixing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), Scratch(spark, "op3"))


@query("op5_pii")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op6_warc_packages", """
    WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
    t AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS top FROM p)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
    FROM t""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warczip.read(warczip.write(table(spark, sf_dir, "pages"), Scratch(spark, "op6"))).drop("url")


@query("op8_quality_classifier")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), Scratch(spark, "op8"))


@query("op9_embedding_near_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"), Scratch(spark, "op9"))


@query("op13_conversation_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turns.damage(table(spark, sf_dir, "conversations"))
    return turns.digests(rows, turns.reports(rows))


@query("op12_tokenizer_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align.alignments(table(spark, sf_dir, "documents"), a, b, Scratch(spark, "op12"))


@query("op11_nearest_neighbours")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return hnsw.nearest(rows, rows.where("vec_id % 20 = 0"), Scratch(spark, "op11"))
