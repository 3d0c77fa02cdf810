"""Bounded samples of labelled documents to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, text_of

FOLDS = 5


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text is a multiple of FOLDS; a null id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, size: int, scratch: Scratch) -> DataFrame:
    """(doc_id, label, weight, text) of at most ``size`` labelled documents that
    are not held out, the first of each class in order of a hash of the id, up
    to half of ``size`` each. ``weight`` is the number of labelled rows of the
    class that one stands for.

    A document with several labels has the largest, null labels and ids count
    for nothing, of several texts with one id the one of smallest hash is used.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    first = [known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size // 2) for k in (0, 1)]
    picked = scratch.write(first[0].union(first[1]), "picked")
    totals = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    used = {r[0]: r[1] for r in picked.groupBy("label").count().collect()}
    weight = F.lit(1.0)
    for k, n in used.items():
        weight = F.when(F.col("label") == k, totals[k] / n).otherwise(weight)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(F.broadcast(picked), "doc_id")  # at most ``size`` ids
    rows = rows.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return scratch.write(rows.select("doc_id", "label", weight.alias("weight"), "text"), "sample")
