"""Tolerant JSON-line parsing with VARIANT.

``try_parse_json`` gives NULL for a bad line; ``variant_get`` without a type
distinguishes a *missing* field (SQL NULL) from a JSON ``null`` (a variant
null), which is what Python's ``dict.get(key, default)`` does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import evaluate_once


def parse(value: Column | str = "value") -> Column:
    col = F.col(value) if isinstance(value, str) else value
    return F.try_parse_json(col)


def _path(field: str) -> str:
    return "$." + field


def present(v: Column, field: str) -> Column:
    """True when the key exists in the object (even if its value is null)."""
    return F.variant_get(v, _path(field), "variant").isNotNull()


def get(v: Column, field: str, type_: str) -> Column:
    """Field cast to ``type_``; NULL when missing, null or not castable."""
    return F.try_variant_get(v, _path(field), type_)


def get_or_default(v: Column, field: str, type_: str, default) -> Column:
    """``obj.get(field, default)`` then a cast: missing -> default; present
    but null or not castable -> NULL (the caller drops such rows)."""
    return F.when(~present(v, field), F.lit(default).cast(type_)).otherwise(get(v, field, type_))


def pick_comments(lines: DataFrame, score_type: str = "bigint", value: str = "value") -> DataFrame:
    """JSON comment lines -> ``(subreddit, score, author)``.

    * bad JSON, non-objects and a missing/null/empty ``subreddit`` -> dropped
    * ``score`` missing -> 0; present but not convertible -> row dropped
    * ``author`` missing -> ``'unknown'``
    """
    parsed = evaluate_once(lines, parse(value), "v").select(
        get(F.col("v"), "subreddit", "string").alias("subreddit"),
        get_or_default(F.col("v"), "score", score_type, 0).alias("score"),
        F.when(~present(F.col("v"), "author"), F.lit("unknown"))
        .otherwise(get(F.col("v"), "author", "string"))
        .alias("author"),
    )
    return parsed.where((F.coalesce(F.col("subreddit"), F.lit("")) != "") & F.col("score").isNotNull())


def parse_objects(lines: DataFrame, value: str = "value") -> DataFrame:
    """Keep every line that parses as JSON, as a ``v VARIANT`` column."""
    return evaluate_once(lines, parse(value), "v").where(F.col("v").isNotNull())


def path_text(json_text: Column | str, path: str) -> Column:
    """A nested field of a JSON string as text (``tags.cuisine::varchar``)."""
    col = F.col(json_text) if isinstance(json_text, str) else json_text
    return F.get_json_object(col, path)
