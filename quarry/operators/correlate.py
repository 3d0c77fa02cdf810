"""Correlation of per-key request counts and byte totals; linear regression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.stats import correlation, regression


def per_key_count_sum(df: DataFrame, key: str, measure: str) -> DataFrame:
    """``(key, x = number of rows, y = sum of measure)``: one aggregate."""
    return df.groupBy(key).agg(F.count(F.lit(1)).cast("double").alias("x"), F.sum(measure).cast("double").alias("y"))


def correlate(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """One row ``(r, r2)``: all sums in a single global aggregate."""
    r = points.agg(correlation(x, y).alias("r"))
    return r.select("r", F.pow("r", 2).alias("r2"))


def linear_fit(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """One row ``(n, slope, intercept)`` of least squares y on x."""
    return points.agg(*regression(x, y))
