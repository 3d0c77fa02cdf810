"""Mixing sources to target weights by temperature.

A source's weight is its share of the corpus' tokens to the power ``exponent``
(the inverse temperature), normalised. The exponent, from 1 (as they come) to 0
(all alike), is bisected: the largest one whose weights reach the target entropy,
unless some source would then repeat more often than the limit; then the
smallest one that keeps the limit.

A source gets weight x budget tokens, as passes over its documents. Each pass is
a seeded permutation, cut into ``BLOCKS`` blocks by the leading bits of its sort
key; whole passes come first, the last one stops where its budget is spent. A
block's place in the stream keeps the sources at their weights in every prefix.

Tokens are counted as words. Sums are taken by source, then by source and
block, so a source with a third of all rows is spread over all tasks; only the
distinct keys of one block a source are ever sorted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import SEED, Scratch, text_of

ENTROPY = 0.95  # of the greatest possible, the logarithm of the number of sources
REPEATS = 4.0
BLOCKS_BITS = 12
BLOCKS = 1 << BLOCKS_BITS
LEVELS, STEPS = 6, 3  # bisection levels settled by one pass; passes
GRID = 1 << (LEVELS * STEPS)


def tokens_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def permutation_key(epoch: Column, seed: int = SEED) -> Column:
    """Sort key of a row in a pass; equal rows have equal keys."""
    return F.xxhash64(F.lit(seed), epoch.cast("int"), F.col("doc_id"), F.xxhash64(text_of()))


def _order(key: Column) -> Column:
    """The key, to be compared as an unsigned number."""
    return key.bitwiseXOR(F.lit(-(1 << 63)))


def _block(key: Column) -> Column:
    return F.shiftrightunsigned(key, 64 - BLOCKS_BITS).cast("int")


def exponent(sources: DataFrame, budget: int, entropy: float = ENTROPY, repeats: float = REPEATS) -> float:
    """The bisected exponent for ``sources(tokens)``, a multiple of 1 / GRID.

    A pass evaluates the midpoints of the next LEVELS levels together, as sums
    over the sources; nothing but these sums reaches the driver.
    """
    live = sources.where("tokens > 0")
    row = live.agg(F.sum("tokens"), F.count("*"), F.min("tokens")).first()
    if not row[1]:
        return 1.0
    total, count, least = row
    target, p0 = entropy * math.log(count), least / total

    def measure(grid: list[int]) -> dict[int, tuple[float, float]]:
        """Entropy and greatest number of repeats at each exponent."""
        p, power = F.col("tokens") / F.lit(float(total)), F.pow("p", F.col("g") / GRID)
        at = live.select(p.alias("p"), F.explode(F.lit(grid)).alias("g"))
        got = at.groupBy("g").agg(F.sum(power), F.sum(power * F.ln("p"))).collect()
        return {g: (math.log(z) - g / GRID * zl / z, p0 ** (g / GRID - 1) / z * budget / total) for g, z, zl in got}

    def bisect(holds) -> int:
        """The largest step for which ``holds``, which turns false once; 0 if none."""
        low, high = 0, GRID
        if holds(*measure([GRID])[GRID]):
            return GRID
        while high - low > 1:
            step = max(1, (high - low) >> LEVELS)
            at = measure(list(range(low + step, high, step)))
            for _ in range(LEVELS):
                middle = (low + high) // 2
                if middle not in at:
                    break
                low, high = (middle, high) if holds(*at[middle]) else (low, middle)
        return low

    flat = bisect(lambda h, r: h >= target - 1e-12)
    if measure([flat])[flat][1] <= repeats:
        return flat / GRID
    return min(GRID, bisect(lambda h, r: r > repeats) + 1) / GRID


def plan(docs: DataFrame, scratch: Scratch, budget: int | None = None, entropy: float = ENTROPY, repeats: float = REPEATS, seed: int = SEED) -> DataFrame:
    """A row for each source: tokens, weight, passes (real), whole passes and
    ``cut``, the last key of the pass that is left off. ``budget`` is the
    corpus' tokens if not given. A source without tokens has weight 0 and is
    passed over once; a null source is one of its own."""
    rows = scratch.write(docs.select("doc_id", "source", tokens_of(text_of()).alias("tokens"), F.xxhash64(text_of()).alias("text_key")), "counted")
    sources = scratch.write(rows.groupBy("source").agg(F.sum("tokens").alias("tokens")), "sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    budget = total if budget is None else budget
    power = exponent(sources, budget, entropy, repeats)
    share = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(power))).otherwise(0.0)
    norm = sources.agg(F.sum(share)).first()[0] or 1.0
    weight = share / F.lit(norm)
    passes = F.when(F.col("tokens") > 0, F.round(weight * F.lit(float(budget)) / F.col("tokens"), 9)).otherwise(1.0)
    weights = sources.withColumn("weight", weight).withColumn("passes", passes).withColumn("whole", F.floor("passes").cast("int"))
    left = F.floor((F.col("passes") - F.col("whole")) * F.col("tokens")).cast("long")
    weights = scratch.write(weights.withColumn("left", left), "weights")

    key = F.xxhash64(F.lit(seed), F.col("whole"), F.col("doc_id"), F.col("text_key"))
    slim = weights.select(F.col("source").alias("src"), "whole", "left")
    last = rows.join(slim, F.col("source").eqNullSafe(F.col("src"))).select("source", "left", "tokens", key.alias("key")).withColumn("block", _block(F.col("key")))
    blocks = last.groupBy("source", "left", "block").agg(F.sum("tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.partitionBy("source").orderBy("block")) - F.col("tokens")
    edge = blocks.withColumn("before", before).where((F.col("before") <= F.col("left")) & (F.col("before") + F.col("tokens") > F.col("left")))
    edge = scratch.write(edge.select(F.col("source").alias("src"), F.col("block").alias("cut_block"), "before"), "edge")
    # of the block in which the budget ends: the first key that no longer fits
    near = last.join(edge, F.col("source").eqNullSafe(F.col("src")) & (F.col("block") == F.col("cut_block")))
    near = near.groupBy("source", "left", "before", "key").agg(F.sum("tokens").alias("tokens"))
    run = F.sum("tokens").over(Window.partitionBy("source").orderBy(_order(F.col("key"))))
    cut = near.withColumn("to", F.col("before") + run).where(F.col("to") > F.col("left")).groupBy("source").agg(F.min(_order(F.col("key"))).alias("cut"))
    out = weights.join(cut.withColumnRenamed("source", "src"), F.col("source").eqNullSafe(F.col("src")), "left").drop("src", "left")
    out = scratch.write(out, "plan")
    scratch.drop(rows, sources, weights, edge)
    return out


def copies(plan_: DataFrame, docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with its source's ``__weight``, ``__passes`` and ``__copies``, how
    often a row is drawn: once for each whole pass, and once more if its key in
    the last pass comes before the cut (or the pass is not cut short)."""
    names = {"source": "__source", "weight": "__weight", "passes": "__passes", "whole": "__whole", "cut": "__cut"}
    slim = plan_.select(*[F.col(a).alias(b) for a, b in names.items()])
    rows = docs.join(slim, F.col("source").eqNullSafe(F.col("__source")))
    spent = (F.col("__passes") == F.col("__whole")) | (_order(permutation_key(F.col("__whole"), seed)) >= F.col("__cut"))
    return rows.withColumn("__copies", F.col("__whole") + F.when(spent, 0).otherwise(1)).drop("__source", "__cut")


def mixture(docs: DataFrame, scratch: Scratch, budget: int | None = None, entropy: float = ENTROPY, repeats: float = REPEATS, seed: int = SEED) -> DataFrame:
    """A row for each drawn document: its source's weight, the pass ``epoch``,
    the ``block`` of that pass, ``sort_key`` within the block and ``stream_at``
    (0 to 1), the block's place in the stream.

    A null or empty text has no tokens and is drawn as its source is. Null ids
    and repeated rows are rows like others; equal rows are drawn together. An
    empty table gives no rows; columns but doc_id, source and text are ignored.
    """
    docs = docs.select("doc_id", "source", "text")
    drawn = copies(plan(docs, scratch, budget, entropy, repeats, seed), docs, seed).where("__copies > 0")
    rows = drawn.select("doc_id", "source", tokens_of(text_of()).alias("n_tokens"), F.xxhash64(text_of()).alias("text_key"), F.col("__weight").alias("weight"),
                        F.col("__passes").alias("passes"), F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)).alias("epoch"))
    key = F.xxhash64(F.lit(seed), F.col("epoch"), F.col("doc_id"), F.col("text_key"))
    rows = rows.withColumn("sort_key", key).withColumn("block", _block(F.col("sort_key")))
    at = (F.col("epoch") + (F.col("block") + 0.5) / BLOCKS) / F.greatest("passes", F.col("epoch") + (F.col("block") + 0.5) / BLOCKS)
    return rows.select("doc_id", "source", "n_tokens", "weight", "epoch", "block", "sort_key", at.alias("stream_at"))


def mixed(docs: DataFrame, scratch: Scratch, budget: int | None = None, entropy: float = ENTROPY, repeats: float = REPEATS, seed: int = SEED) -> DataFrame:
    """``docs``, each row as often as it is drawn; columns as they were."""
    rows = copies(plan(docs, scratch, budget, entropy, repeats, seed), docs, seed).where("__copies > 0")
    rows = rows.withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)))
    return rows.select(*[f"`{c}`" for c in docs.columns])
