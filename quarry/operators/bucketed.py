"""Partitioning by key that lasts: bucketed tables joined without a shuffle.

A table is written once into a fixed number of buckets of its key. Joins and
aggregates on that key then read bucket with bucket: no exchange on either side.
A bucket is read by one task, so a key that fills several tasks must not be in
one: ``write_bucketed`` counts rows by key and keeps the rows of hot keys (over
``1 / (HOT_SHARE * buckets)`` of all, so fewer than ``HOT_SHARE * buckets`` keys) in
a plain table beside the buckets. ``join_unique`` joins those by broadcasting the
other side's rows of the same few keys, of which each key has at most one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import materialize, scratch_path

HOT_SHARE = 2


@dataclass
class Bucketed:
    """``cold`` rows in buckets of ``key``, ``hot`` rows in a plain table; the keys of
    the latter, at most ``HOT_SHARE * buckets``."""

    spark: SparkSession
    name: str
    key: str
    buckets: int
    hot_keys: list
    hot: DataFrame | None

    @property
    def cold(self) -> DataFrame:
        return self.spark.table(self.name)

    def rows(self) -> DataFrame:
        return self.cold if self.hot is None else self.cold.unionByName(self.hot)

    def drop(self) -> None:
        """Remove the catalog entry; frames made from it go on reading the files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _hot_keys(rows: DataFrame, key: str, buckets: int) -> list:
    """Keys with more than their share of the rows: counts are partial sums."""
    counts = materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "key-counts")
    most = (counts.agg(F.sum("n")).first()[0] or 0) / (HOT_SHARE * buckets)
    return [r[0] for r in counts.where((F.col("n") > most) & (F.col("n") > 1) & F.col(key).isNotNull()).select(key).collect()]


def write_bucketed(rows: DataFrame, key: str, buckets: int, name: str | None = None, unique: bool = False) -> Bucketed:
    """Write ``rows`` in ``buckets`` files of ``key``, sorted by it, as a catalog table
    under the shared folder. ``unique`` says that a key has one row at most, so
    that none is hot. Null keys are dropped: no join on the key meets them."""
    spark = rows.sparkSession
    name = name or f"bucketed_{uuid.uuid4().hex}"
    rows = rows.where(F.col(key).isNotNull())
    hot_keys = [] if unique else _hot_keys(rows, key, buckets)
    hot = materialize(rows.where(F.col(key).isin(hot_keys)), "hot-keys") if hot_keys else None
    cold = rows.where(~F.col(key).isin(hot_keys)) if hot_keys else rows
    by = cold.repartition(buckets, key)  # one file a bucket
    by.write.bucketBy(buckets, key).sortBy(key).option("path", scratch_path(spark, name)).mode("overwrite").saveAsTable(name)
    return Bucketed(spark, name, key, buckets, hot_keys, hot)


def join_unique(facts: Bucketed, entities: Bucketed, columns: Sequence[str]) -> DataFrame:
    """Inner join on the key, where ``entities`` has one row a key. Buckets are
    joined where they lie; hot keys of ``facts`` meet the few rows they can meet."""
    if facts.buckets != entities.buckets:
        raise ValueError("the tables have different numbers of buckets")
    e = entities.cold.withColumnRenamed(entities.key, "_key")
    out = facts.cold.join(e.hint("merge"), F.col(facts.key) == F.col("_key")).select(*columns)
    if facts.hot is not None:
        few = e.where(F.col("_key").isin(facts.hot_keys))
        out = out.unionByName(facts.hot.join(F.broadcast(few), F.col(facts.key) == F.col("_key")).select(*columns))
    return out
