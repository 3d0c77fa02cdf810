"""Sorted results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import materialize


def with_position(df: DataFrame, *order: Column | str, alias: str = "position") -> DataFrame:
    """Rows with their 1-based place in a global order.

    One range shuffle: each task sorts its range and writes it as one file, in
    which a row's place is its number there plus the rows of the ranges before,
    of which only the counts are added up. ``order`` should be total for the
    places to be repeatable; rows that tie on it are dealt by a hash of all their
    columns, so that many of them do not meet in one task.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    ties = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    sorted_ = df.withColumn("_tie", ties).repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    rows = materialize(sorted_.withColumn("_p", F.spark_partition_id()), "sorted")
    rows = rows.select("*", F.col("_metadata.row_index").alias("_i"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    offsets = rows.groupBy("_p").count().select("_p", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_o"))
    return rows.join(offsets, "_p").withColumn(alias, F.col("_i") + F.col("_o") + 1).drop("_p", "_o", "_i")
