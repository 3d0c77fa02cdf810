"""Keyed-table operations on DataFrames: upsert (latest wins per column),
latest row per key, composite-key de-duplication, key lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.common import as_list

SET_COLUMNS = "_set"


def change_rows(df: DataFrame, columns: Sequence[str], seq: Column) -> DataFrame:
    """Turn rows into change rows that set ``columns``, ordered by ``seq``."""
    return df.withColumn(SET_COLUMNS, F.array(*[F.lit(c) for c in columns])).withColumn("_seq", seq)


def upsert(base: DataFrame, changes: DataFrame, key: str | Sequence[str], value_columns: Sequence[str]) -> DataFrame:
    """Apply change rows to a keyed table: per key and per column, the value
    from the latest row (``_seq``) that *set* that column; a column a change
    does not name keeps its older value.  Base rows rank below all changes.

    One hash aggregate with ``max_by`` per column: partial aggregation keeps
    a hot key to one buffer row per task, never a list of its changes.
    """
    keys = as_list(key)
    seq_type = changes.schema["_seq"].dataType
    base_rows = base.select(
        *keys,
        *value_columns,
        F.array(*[F.lit(c) for c in value_columns]).alias(SET_COLUMNS),
        F.struct(F.lit(0).alias("tier"), F.lit(None).cast(seq_type).alias("order")).alias("_seq"),
    )
    change = changes.select(
        *keys,
        *value_columns,
        SET_COLUMNS,
        F.struct(F.lit(1).alias("tier"), F.col("_seq").alias("order")).alias("_seq"),
    )
    allrows = base_rows.unionByName(change)
    aggs = [
        F.max_by(F.col(c), F.when(F.array_contains(SET_COLUMNS, c), F.col("_seq"))).alias(c) for c in value_columns
    ]
    return allrows.groupBy(*keys).agg(*aggs)


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The row with the largest ``order`` tuple per key (ties broken by the
    later order columns).  ``max_by`` over a struct: one aggregate, no sort of
    a whole key."""
    keys = as_list(key)
    ordering = F.struct(*[F.col(c) for c in order])
    payload = F.struct(*[F.col(c) for c in columns])
    return df.groupBy(*keys).agg(F.max_by(payload, ordering).alias("_row")).select(*keys, "_row.*")


def first_per_key(df: DataFrame, key: str | Sequence[str], *order: Column | str) -> DataFrame:
    """The first row of each key in an order, whole, by ``row_number``.

    Spark turns the filter on the rank into a limit of a group, which every
    task applies before the shuffle: a hot key sends one row a task. Cheaper
    where few columns are kept: ``latest_per_key``, which does not sort.
    """
    rank = F.row_number().over(Window.partitionBy(*as_list(key)).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= 1).drop("_rank")


def dedupe_on_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows differing in any key column all stay; of those with one key the
    row with the largest ``order`` tuple, the latest arrival, stays."""
    rest = [c for c in df.columns if c not in key]
    return latest_per_key(df, key, [*order, *[c for c in rest if c not in order]], rest).select(*df.columns)


def create_table_if_absent(spark, name: str, schema, location: str, fmt: str = "parquet"):
    """``CREATE TABLE IF NOT EXISTS name (...) USING fmt LOCATION ...``.

    The declared key is not enforced by the table; ``upsert`` and
    ``dedupe_on_key`` enforce it when rows are written.
    """
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {fmt} LOCATION '{location}'")
    return spark.table(name)
