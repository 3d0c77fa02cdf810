"""Dealing rows to partitions by ranges of an integer id.

Unlike ``repartitionByRange`` this samples nothing but the id column, so the
texts are read and shuffled once, and each partition knows its number.

An id (or the lack of one) that would fill several ranges is cut into as many,
by ranges of a tie-breaking hash, in the order in which its rows are sorted.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_part(rows: DataFrame, key: str, tie: Column, nulls_first: bool = False, ties_down: bool = False) -> tuple[DataFrame, int]:
    """``rows`` with ``part``, the number of the range that (``key``, ``tie``) is in,
    and the number of ranges; they rise with the id. Null ids have the last
    ranges, or the first. ``tie`` is a hash of 64 bits; its ranges rise with it, or
    fall. Rows equal in both share a range."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at, known, total = rows.agg(F.percentile_approx(key, [i / n for i in range(1, n)] or [0.5], 10 * n), F.count(key), F.count(F.lit(1))).first()
    times = Counter(float(x) for x in at or [])
    splits = [-np.inf, *(sorted(times) or [0.0]), np.inf]
    nothing = max(1, round(n * (total - known) / total)) if total > known else 0
    first, cuts, next_ = [], [], nothing if nulls_first else 0  # of each bucket: its first range, and into how many its least id is cut
    for low in splits[:-1]:
        k = times[low] if times.get(low, 0) > 1 else 0
        first.append(next_)
        cuts.append(k)
        next_ += k + 1
    cut = Bucketizer(splits=splits, inputCol="__value", outputCol="__bucket", handleInvalid="keep")
    out = cut.transform(rows.withColumn("__value", F.col(key).cast("double")))

    def of(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("__bucket").cast("int") + 1)

    def among(k: Column) -> Column:
        place = F.least(F.floor((tie / F.lit(2.0**64) + 0.5) * k).cast("int"), k - 1)
        return k - 1 - place if ties_down else place

    k = of(cuts, "int")
    hot = (k > 0) & (F.col("__value") == of([0.0 if np.isinf(x) else x for x in splits[:-1]], "double"))
    part = F.when(F.col(key).isNull(), F.lit(0 if nulls_first else next_) + among(F.lit(max(nothing, 1))))
    part = part.otherwise(of(first, "int") + F.when(hot, among(k)).otherwise(k))
    return out.withColumn("part", part.cast("int")).drop("__value", "__bucket"), next_ + (0 if nulls_first else max(nothing, 1))


def dealt_by_id(rows: DataFrame, key: str, tie: Column) -> DataFrame:
    """``rows`` with ``part``, each part in the partition of that number."""
    out, n = with_part(rows, key, tie)
    return out.repartitionById(n, F.col("part"))
