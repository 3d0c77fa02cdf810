"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_list(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", hint: str | None = None
) -> DataFrame:
    """Join on ``keys`` treating NULL = NULL as a match (a NULL group is a
    group).  The right side's key columns are dropped from the output."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    if hint:
        renamed = renamed.hint(hint)
    cond: Column = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys])
    out = left.join(renamed, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti"):
        return out
    return out.drop(*[f"__r_{k}" for k in keys])
