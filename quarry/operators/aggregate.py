"""Grouped aggregates.

All of these are hash aggregates with a partial (map-side) step, so a hot key
is pre-reduced inside every task before the shuffle and never has to fit in
one task.  The one aggregate that Spark would otherwise evaluate by buffering
a whole group -- the exact median -- is computed here over range-partitioned
counts instead (see ``exact_median``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators.common import as_list, null_safe_join
from quarry.operators.join import MAX_BROADCAST_BYTES, join_small
from quarry.session import materialize


# --- counting -----------------------------------------------------------------
def word_count(lines: DataFrame, text: str = "value", keep_empty: bool = False, unicode_space: bool = False) -> DataFrame:
    """``(word, n)``: lower-cased tokens split on punctuation/whitespace.

    ``keep_empty=True`` also counts the empty strings produced by leading or
    trailing separators.
    """
    words = lines.select(F.explode(T.tokens(text, keep_empty=True, unicode_space=unicode_space)).alias("word"))
    if not keep_empty:
        words = words.where(F.col("word") != "")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_in_lines(lines: DataFrame, text: str = "value", keep_empty: bool = False) -> DataFrame:
    """``word_count`` that counts inside each line first: a line gives a row for
    each distinct word, with its count, instead of one for each word. Then the
    tasks' partial sums, then one shuffle. Pays for long lines of few words."""
    words = T.evaluate_once(lines, F.array_sort(T.tokens(text, keep_empty=keep_empty)), "words")
    once = T.evaluate_once(words, T.counted(F.col("words")), "counts")
    return once.select(F.explode("counts").alias("c")).groupBy("c.word").agg(F.sum("c.n").alias("n"))


def numeric_token_sums(lines: DataFrame, text: str = "value") -> DataFrame:
    """Per distinct number found in the text: ``(number, n, subtotal)`` with
    ``subtotal = number * n`` (exact count, one multiplication: independent
    of the order rows arrive in)."""
    nums = lines.select(F.explode(T.number_tokens(text)).alias("number")).where(F.col("number").isNotNull())
    counted = nums.groupBy("number").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("number", "n", (F.col("number") * F.col("n")).alias("subtotal"))


def numeric_token_total(lines: DataFrame, text: str = "value") -> DataFrame:
    """One row: ``(n_numbers, total)`` = count and sum of all numeric tokens."""
    nums = lines.select(F.explode(T.number_tokens(text)).alias("number")).where(F.col("number").isNotNull())
    return nums.agg(F.count(F.lit(1)).alias("n_numbers"), F.sum("number").alias("total"))


# --- averages, extremes ----------------------------------------------------------
def average_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    value: str,
    alias: str = "average_score",
    drop_null_key: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Average of ``value`` per key; rows with a NULL key (and NULL values) drop.

    ``partitions`` hash-partitions the result by key, for a caller who goes
    on keyed the same way.  Rows are pre-reduced in their tasks first: a hot
    key never shuffles its rows.
    """
    keys = as_list(key)
    if drop_null_key:
        for k in keys:
            df = df.where(F.col(k).isNotNull())
    df = df.where(F.col(value).isNotNull())
    out = df.groupBy(*keys).agg(F.avg(value).alias(alias))
    return out.repartition(partitions, *keys) if partitions else out


def argmax_one(df: DataFrame, key: str | Sequence[str], by: str, payload: str) -> DataFrame:
    """One winner per key: the row with the largest ``by``; on a tie the
    largest ``payload``.  ``max(struct(by, payload))`` is a single partial +
    final aggregate, so it is deterministic and skew-proof."""
    best = F.max(F.struct(F.col(by).alias("b"), F.col(payload).alias("p")))
    return df.groupBy(*as_list(key)).agg(best.alias("_best")).select(
        *as_list(key), F.col("_best.b").alias(by), F.col("_best.p").alias(payload)
    )


def argmax_ties(
    df: DataFrame,
    key: str | Sequence[str],
    by: str,
    strategy: str = "auto",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    materialize_input: bool = False,
) -> DataFrame:
    """All rows that reach the per-key maximum of ``by`` (ties kept).

    Aggregate the maximum per key (partial aggregation: cheap even for a hot
    key), then join it back on ``(key, by)``.  The aggregate has one row per
    key; ``strategy`` picks how it meets the big side:

    * ``auto``: plain join; AQE turns it into a broadcast at run time when
      the measured aggregate is under the broadcast threshold.
    * ``broadcast``: explicit hint, behind a guard of its written size (no
      hint above ``max_broadcast_bytes``).
    * ``merge``: force a sort-merge join.

    The join form reads its input twice (aggregate, then probe).  With
    ``materialize_input`` the input is written once to the shared folder and
    both sides read that copy -- worth it when the input is expensive to
    produce (parsed raw text) and narrow after projection.
    """
    keys = as_list(key)
    if materialize_input:
        df = materialize(df, "argmax-input")
    best = df.groupBy(*keys).agg(F.max(by).alias(by))
    return join_small(df, best, keys + [by], how="inner", strategy=strategy, max_broadcast_bytes=max_broadcast_bytes)


# --- exact median -------------------------------------------------------------------
def exact_median(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    alias: str = "median",
    extra: dict[str, Column] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Exact, interpolated median per group (same value as Spark ``median``).

    One path for every size, and no group ever goes through one buffer:

    1. the rows are counted per (key, value), a partial + final aggregate;
    2. the counts are range-partitioned by (key, value) and written, each row
       with its partition: a group may span any number of partitions;
    3. totals per (key, partition) say which partition holds the two middle
       ranks ``floor((n-1)/2)`` and ``ceil((n-1)/2)``;
    4. only there are the counts added up in order, and the value at each
       rank is read off.

    NaN orders above infinity, as in Spark's sort; -0.0 and 0.0 are equal.

    ``extra`` names further aggregates (over ``carry`` columns and the
    value) returned next to the median, e.g. ``{"n": F.count("id"), "avg":
    F.avg("amount")}``; the narrow rows are then written once, and both
    passes read that copy.
    """
    keys = as_list(keys)
    columns = list(dict.fromkeys([*keys, value, *carry]))
    rows = df.select(*columns)
    if extra:
        rows = materialize(rows, "median-rows")
    values = rows.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    counts = values.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    counts = materialize(counts.repartitionByRange(*keys, "_v").withColumn("_p", F.spark_partition_id()), "median-counts")

    parts = counts.groupBy(*keys, "_p").agg(F.sum("_c").alias("_c"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns({"_n": F.sum("_c").over(whole), "_before": F.coalesce(F.sum("_c").over(before), F.lit(0))})
    middle = F.array(F.floor((F.col("_n") - 1) / 2).cast("bigint"), F.ceil((F.col("_n") - 1) / 2).cast("bigint"))
    wanted = parts.withColumn("_ranks", F.filter(middle, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_c"))))
    wanted = wanted.where(F.size("_ranks") > 0).select(*keys, "_p", "_n", "_before", "_ranks")

    here = null_safe_join(counts, wanted, [*keys, "_p"])
    upto = Window.partitionBy(*keys, "_p").orderBy("_v")
    here = here.withColumn("_to", F.col("_before") + F.sum("_c").over(upto))
    hits = here.select(*keys, "_v", "_n", F.explode(F.filter("_ranks", lambda r: (r >= F.col("_to") - F.col("_c")) & (r < F.col("_to")))).alias("_r"))
    low = F.max(F.when(F.col("_r") == F.floor((F.col("_n") - 1) / 2), F.col("_v")))
    high = F.max(F.when(F.col("_r") == F.ceil((F.col("_n") - 1) / 2), F.col("_v")))
    median = hits.groupBy(*keys).agg(F.when(low == high, low).otherwise(F.lit(0.5) * low + F.lit(0.5) * high).alias(alias))
    if not extra:
        return median
    stats = rows.groupBy(*keys).agg(*[e.alias(name) for name, e in extra.items()])
    return null_safe_join(stats, median, keys, "left")
