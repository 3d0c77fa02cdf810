"""Line parsing as column expressions (no Python per row).

Each builder returns a ``Column`` (or a small DataFrame transform) that runs
inside whole-stage codegen.  Patterns are Java regular expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Word separators: runs of ASCII punctuation (Java \p{Punct} is exactly the 32
# ASCII punctuation characters) or whitespace.
WORD_SEPARATORS = r"[\p{Punct}\s]+"
# Python's str.split/\s also treats these Unicode spaces as whitespace.
UNICODE_SPACES = "\u00a0\u0085\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Numbers inside free text: optional sign, digits, optional fraction.
NUMBER_TOKEN = r"[+-]?\d+(\.\d+)?"
# Common-log-format line: host, timestamp (zone dropped), path, byte count.
ACCESS_LOG = r'^(\S+) - - \[(\S+) [+-]\d+\] "[A-Z]+ (\S+) HTTP/\d\.\d" \d+ (\d+)$'
ACCESS_LOG_TIME = "dd/MMM/yyyy:HH:mm:ss"
# Page-count file names: pagecounts-YYYYMMDD-HHMMSS...; the hour is YYYYMMDD-HH.
PAGECOUNT_HOUR = r"pagecounts-(\d{8}-\d{2})\d{4}"
# Adjacency line "n: a b c" (spaces allowed before the colon).
ADJACENCY = r"^\s*(\d+)\s*:\s*(.*)$"
# Python int() accepts surrounding blanks, a sign and digit groups joined by _.
INTEGER_TEXT = r"^\s*[+-]?\d+(_\d+)*\s*$"
# ---------------------------------------------------------------------------


def evaluate_once(df: DataFrame, expr: Column, name: str, keep=()) -> DataFrame:
    """``df`` with ``expr`` computed once per row as column ``name``.

    Catalyst pushes filters below projections by inlining aliased
    expressions, so a parsed value used by several predicates would be
    re-parsed (a regex split, a JSON parse) once per predicate.  A
    one-element ``explode`` is a barrier the optimizer does not inline
    through; it costs nothing else (no shuffle, stays in codegen).
    """
    return df.select(*keep, F.explode(F.array(expr)).alias(name))


def word_separator(unicode_space: bool = False) -> str:
    if not unicode_space:
        return WORD_SEPARATORS
    return r"[\p{Punct}\s" + UNICODE_SPACES + r"]+"


def tokens(text: Column | str, keep_empty: bool = False, unicode_space: bool = False) -> Column:
    """Lower-cased word tokens of a line (array).

    Splitting keeps leading and trailing empty strings, as Python's
    ``re.split`` does; ``keep_empty=False`` filters them out inside the array.
    """
    parts = F.split(F.lower(F.col(text) if isinstance(text, str) else text), word_separator(unicode_space))
    if keep_empty:
        return parts
    return F.filter(parts, lambda w: w != F.lit(""))


def counted(words: Column) -> Column:
    """The distinct elements of an array of words with their counts, as an array
    of (word, n). Sorted runs, so n log n in a line's words; name the array as a
    column first (``evaluate_once``), or it is computed several times."""
    first = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)))
    first = F.when(F.size(words) > 0, first).otherwise(F.array().cast("array<int>"))
    ends = F.slice(F.concat(first, F.array(F.size(words))), 2, F.greatest(F.size(first), F.lit(0)))
    return F.zip_with(first, ends, lambda a, b: F.struct(F.get(words, a).alias("word"), (b - a).cast("bigint").alias("n")))


def number_tokens(text: Column | str) -> Column:
    """Numeric tokens of a text, as an array of doubles."""
    col = F.col(text) if isinstance(text, str) else text
    return F.transform(F.regexp_extract_all(col, F.lit(NUMBER_TOKEN), 0), lambda t: t.try_cast("double"))


def whitespace_fields(text: Column | str, limit: int = -1) -> Column:
    """Fields split on runs of whitespace; with ``limit`` the last field keeps
    the rest of the line (Python ``maxsplit = limit - 1``)."""
    col = F.col(text) if isinstance(text, str) else text
    return F.split(col, r"\s+", limit)


def tolerant_long(text: Column | str) -> Column:
    """Integer parse that yields NULL instead of failing (Python ``int()``
    rules: blanks around, optional sign, ``_`` between digit groups)."""
    col = F.col(text) if isinstance(text, str) else text
    return F.when(col.rlike(INTEGER_TEXT), F.regexp_replace(F.trim(col), "_", "").try_cast("bigint"))


def hour_from_file_name(file_name: Column | str) -> Column:
    """``pagecounts-20160801-120000.gz`` -> ``20160801-12``; NULL on no match."""
    col = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.nullif(F.regexp_extract(col, PAGECOUNT_HOUR, 1), F.lit(""))


def parse_access_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """Web access-log lines -> ``(host, datetime, path, bytes)``.

    Lines that do not match (e.g. a ``-`` byte count) are dropped.  The zone
    offset is matched and discarded, so ``datetime`` is wall-clock NTZ.
    """
    v = F.col(value)
    keep = [c for c in lines.columns if c != value]
    groups = F.struct(*[F.regexp_extract(v, ACCESS_LOG, i).alias(f"g{i}") for i in range(1, 5)])
    parts = evaluate_once(lines, groups, "g", keep)
    parsed = parts.where(F.col("g.g1") != "").select(
        *keep,
        F.col("g.g1").alias("host"),
        F.try_to_timestamp(F.col("g.g2"), F.lit(ACCESS_LOG_TIME)).cast("timestamp_ntz").alias("datetime"),
        F.col("g.g3").alias("path"),
        F.col("g.g4").try_cast("bigint").alias("bytes"),
    )
    return parsed.where(F.col("datetime").isNotNull() & F.col("bytes").isNotNull())


def request_id(*cols: Column | str) -> Column:
    """Content hash id (replaces a time-based uuid): a retried task yields the
    same id.  Callers include a deterministic position column so that
    identical lines get distinct ids."""
    return F.sha2(F.concat_ws("\u0001", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]), 256)


def parse_adjacency(lines: DataFrame, value: str = "value", weight: float = 1.0) -> DataFrame:
    """``n: a b c`` -> edges ``(src, dst, weight)``; ``5:`` gives no edge."""
    v = F.col(value)
    return (
        lines.where(v.rlike(ADJACENCY))
        .select(
            F.regexp_extract(v, ADJACENCY, 1).try_cast("bigint").alias("src"),
            F.explode(F.split(F.trim(F.regexp_extract(v, ADJACENCY, 2)), r"\s+")).alias("dst_text"),
        )
        .where(F.col("dst_text") != "")
        .select(
            "src",
            F.col("dst_text").try_cast("bigint").alias("dst"),
            F.lit(float(weight)).alias("weight"),
        )
        .where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    )


def parse_points(lines: DataFrame, value: str = "value") -> DataFrame:
    """``x y`` lines -> ``(x DOUBLE, y DOUBLE)``; malformed lines are dropped."""
    parts = evaluate_once(lines, F.split(F.trim(F.col(value)), r"\s+"), "p")
    return (
        parts.select(
            F.get("p", 0).try_cast("double").alias("x"),
            F.get("p", 1).try_cast("double").alias("y"),
        )
        .where(F.col("x").isNotNull() & F.col("y").isNotNull())
    )
