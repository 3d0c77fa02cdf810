"""A lookup table held by every task: one value that an aggregate builds.

The small side becomes a single row, an array of maps indexed by a hash of the
key, so that a row's look-up goes through one short map. It reaches the tasks as
a scalar subquery: nothing is collected to the driver by hand and no join is
planned. A side that is too large is refused, by rows and by the bytes that its
keys and values take in memory, rather than broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize

MAX_KEYS, MAX_BYTES = 50_000, 32 << 20
ENTRY_BYTES = 48  # an entry's array slots and string header
SLOTS = 1024


class LookupTooLarge(ValueError):
    """The side meant for a lookup has too many keys or takes too much memory."""


def measured(small: DataFrame, key: str, value: str) -> tuple[int, int]:
    """Keys of a lookup and the bytes they take in memory, about."""
    size = F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0)) + F.coalesce(F.octet_length(F.col(value).cast("string")), F.lit(0))
    n, total = small.agg(F.count(F.lit(1)), F.coalesce(F.sum(size + F.lit(ENTRY_BYTES)), F.lit(0))).first()
    return int(n), int(total)


def with_lookup(df: DataFrame, small: DataFrame, on: str, value: str, alias: str, max_keys: int = MAX_KEYS, max_bytes: int = MAX_BYTES,
                slots: int = SLOTS) -> DataFrame:
    """``df`` with ``alias``, the ``value`` that ``small`` has for ``on`` (null: none).

    ``small`` has one row a key; null keys are never found. Raises
    ``LookupTooLarge`` above ``max_keys`` keys or ``max_bytes`` bytes, before ``df`` is
    read.
    """
    small = materialize(small.where(F.col(on).isNotNull()).select(F.col(on).alias("k"), F.col(value).alias("v")), "lookup")
    n, size = measured(small, "k", "v")
    if n > max_keys or size > max_bytes:
        raise LookupTooLarge(f"{n} keys of about {size} bytes; at most {max_keys} keys and {max_bytes} bytes are looked up")
    maps = small.groupBy(F.pmod(F.xxhash64("k"), F.lit(slots)).alias("slot")).agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("m"))
    every = df.sparkSession.range(slots).select(F.col("id").alias("slot")).join(maps, "slot", "left")
    built = materialize(every.agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "m")), lambda a, b: (a["slot"] - b["slot"]).cast("int")), lambda x: x["m"]).alias("maps")), "lookup-maps")
    slot = F.pmod(F.xxhash64(F.col(on)), F.lit(slots)).cast("int")
    return df.withColumn(alias, F.get(built.scalar(), slot)[F.col(on)])
