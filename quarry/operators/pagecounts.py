"""Page-view counts: parse count lines, filter, maximum / most viewed per hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators.aggregate import argmax_one, argmax_ties


def parse_counts5(lines: DataFrame, value: str = "value") -> DataFrame:
    """``ts lang title views bytes`` (whitespace separated, the last field
    keeps the rest) -> ``(hour, lang, title, views)``; short lines and
    non-integer counts drop."""
    f = T.whitespace_fields(value, 5)
    return (
        T.evaluate_once(lines, f, "f")
        .where(F.size("f") == 5)
        .select(
            F.get("f", 0).alias("hour"),
            F.get("f", 1).alias("lang"),
            F.get("f", 2).alias("title"),
            T.tolerant_long(F.get("f", 3)).alias("views"),
        )
        .where(F.col("views").isNotNull())
    )


def parse_counts4(lines: DataFrame, value: str = "value", file_name: str = "file_name") -> DataFrame:
    """``lang title views bytes`` with the hour in the file name
    (``pagecounts-YYYYMMDD-HHMMSS*``) -> ``(hour, lang, title, views)``.
    Exactly four fields are required; a file name that does not match gives
    a NULL hour and the row drops."""
    f = T.whitespace_fields(value)
    return (
        T.evaluate_once(lines, f, "f", [T.hour_from_file_name(file_name).alias("hour")])
        .where((F.size("f") == 4) & F.col("hour").isNotNull())
        .select(
            "hour",
            F.get("f", 0).alias("lang"),
            F.get("f", 1).alias("title"),
            T.tolerant_long(F.get("f", 2)).alias("views"),
        )
        .where(F.col("views").isNotNull())
    )


def wanted_pages(counts: DataFrame, lang: str = "en", exclude_title: str = "Main_Page", exclude_prefix: str = "Special:") -> DataFrame:
    return counts.where(
        (F.col("lang") == lang)
        & (F.col("title") != exclude_title)
        & ~F.col("title").startswith(exclude_prefix)
    )


def max_views_per_hour(counts: DataFrame) -> DataFrame:
    """``(hour, max_views)``."""
    return counts.groupBy("hour").agg(F.max("views").alias("max_views"))


def top_page_per_hour(counts: DataFrame) -> DataFrame:
    """One row per hour: ``(hour, views, title)``, a tie goes to the larger title."""
    return argmax_one(counts, "hour", "views", "title")


def top_pages_per_hour(
    counts: DataFrame, strategy: str = "auto", materialize_input: bool = False
) -> DataFrame:
    """All pages at the hour's maximum: ``(hour, title, views)``, ties kept.
    Hours are few and large, so the default is aggregate + join-back."""
    return argmax_ties(counts.select("hour", "title", "views"), "hour", "views", strategy=strategy,
                       materialize_input=materialize_input).select("hour", "title", "views")
