"""Joins: size-guarded broadcast, join-back, relative score, day offset,
two-value pivot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.common import as_list
from quarry.session import materialize

MAX_BROADCAST_BYTES = 64 << 20


ROW_BYTES = 32  # of a row in memory, beside its values


def memory_size(written: DataFrame) -> int:
    """About the bytes that the rows take in memory, by their number and the
    measured width of their values (nested ones as JSON), whatever the files
    compress them to."""
    def width(f: T.StructField) -> Column:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.octet_length(col) + 16
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.octet_length(F.to_json(F.struct(col))) + 16
        return F.lit(16 if isinstance(f.dataType, T.DecimalType) else 8)

    total = F.lit(ROW_BYTES)
    for f in written.schema.fields:
        total = total + F.coalesce(width(f), F.lit(8))
    return int(written.agg(F.coalesce(F.sum(total.cast("bigint")), F.lit(0))).first()[0])


def fits_broadcast(written: DataFrame, max_bytes: int) -> bool:
    """Whether a written table takes at most ``max_bytes`` in memory."""
    return memory_size(written) <= max_bytes


def join_small(
    big: DataFrame,
    small: DataFrame,
    on: str | Sequence[str] | Column,
    how: str = "inner",
    strategy: str = "auto",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join a large frame with a side expected to be small.

    ``auto``      -- no hint; AQE re-plans with measured sizes and broadcasts
                     only what is actually under the threshold.
    ``broadcast`` -- the side is written to the shared folder and measured there
                     (rows and the width of their values), and broadcast if
                     that is at most ``max_broadcast_bytes``; above, the choice
                     is AQE's.
    ``merge``     -- force sort-merge (what auto-broadcast-off gives).
    """
    if strategy == "broadcast":
        small = materialize(small, "join-side")
        if fits_broadcast(small, max_broadcast_bytes):
            small = F.broadcast(small)
    elif strategy == "merge":
        small = small.hint("merge")
    elif strategy != "auto":
        raise ValueError(f"unknown join strategy {strategy!r}")
    on_ = as_list(on) if isinstance(on, (str, list, tuple)) else on
    return big.join(small, on_, how)


def relative_score(
    comments: DataFrame,
    group: str = "subreddit",
    score: str = "score",
    author: str = "author",
    drop_empty_group: bool = False,
    strategy: str = "auto",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    materialize_input: bool = False,
) -> DataFrame:
    """``(rel, author, group)``: each score divided by its group's average,
    for groups whose average is positive.

    The averages are one aggregate (partial + final) joined back on the
    group; a window average would shuffle and sort every row of a hot group
    into one task.  The input is read twice (aggregate, then probe); with
    ``materialize_input`` the parsed rows are written once to the shared
    folder and both sides read that copy (for expensive inputs such as raw
    JSON text).
    """
    if materialize_input:
        comments = materialize(comments.select(group, score, author), "relative-input")
    rows = comments.where(F.col(group).isNotNull())
    if drop_empty_group:
        rows = rows.where(F.col(group) != "")
    avgs = rows.groupBy(group).agg(F.avg(score).alias("_avg")).where(F.col("_avg") > 0)
    joined = join_small(rows, avgs, group, "inner", strategy, max_broadcast_bytes)
    return joined.select((F.col(score) / F.col("_avg")).alias("rel"), F.col(author).alias("author"), F.col(group))


def with_previous_day(
    df: DataFrame,
    key: str | Sequence[str],
    date: str,
    value: str,
    alias: str,
    days: int = 1,
) -> DataFrame:
    """Each row with the value of the same key ``days`` earlier (inner join:
    a missing day gives no row).  An equi-join on ``(key, date - days)``, not
    ``lag``: ``lag`` would pair non-adjacent days and sort whole keys."""
    keys = as_list(key)
    prev = df.select(
        *keys, F.date_add(F.col(date), days).alias(date), F.col(value).alias(alias)
    )
    return df.join(prev, keys + [date], "inner")


def two_value_pivot(
    df: DataFrame, key: str | Sequence[str], label: str, value: str, first: str, second: str,
    first_alias: str | None = None, second_alias: str | None = None,
) -> DataFrame:
    """Rows of ``label == first`` side by side with ``label == second`` on the
    key (self-join of two filtered halves; duplicates multiply, m x n)."""
    keys = as_list(key)
    a = df.where(F.col(label) == first).select(*keys, F.col(value).alias(first_alias or first))
    b = df.where(F.col(label) == second).select(*keys, F.col(value).alias(second_alias or second))
    return a.join(b, keys, "inner")
