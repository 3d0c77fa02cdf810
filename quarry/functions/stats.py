"""Aggregate expressions for correlation and simple linear regression.

Centred aggregates (``covar_pop``, ``stddev_pop``, ``regr_*``) are used
instead of sums-of-products formulas: they are numerically stable, mergeable
(partial + final aggregation) and NULL-safe on constant input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def correlation(x: Column | str, y: Column | str) -> Column:
    """Pearson r; NULL (not an error) when either side is constant.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI on a constant column, even
    inside a CASE, so the ratio is formed with ``try_divide``.
    """
    return F.try_divide(F.covar_pop(_c(x), _c(y)), F.stddev_pop(_c(x)) * F.stddev_pop(_c(y)))


def regression(x: Column | str, y: Column | str) -> list[Column]:
    """Least-squares ``slope``, ``intercept`` and point count ``n`` of y on x.

    NULL slope/intercept on fewer than two points or constant x.
    """
    return [
        F.count(F.when(_c(x).isNotNull() & _c(y).isNotNull(), 1)).alias("n"),
        F.regr_slope(_c(y), _c(x)).alias("slope"),
        F.regr_intercept(_c(y), _c(x)).alias("intercept"),
    ]


def round_significant(x: Column | str, digits: int = 12) -> Column:
    """``x`` rounded to ``digits`` significant digits.

    A floating sum over many rows depends on the order of addition in its
    last bits; reports that must agree across runs and engines round it to
    significant digits (decimal places do not help at large magnitudes).
    """
    col = _c(x)
    scale = F.lit(digits - 1) - F.floor(F.log10(F.abs(col)))
    # scale by an exact power of ten (10^k, k >= 0), never by a fraction
    up = F.pow(F.lit(10.0), scale)
    down = F.pow(F.lit(10.0), -scale)
    return (
        F.when(col == 0, F.lit(0.0))
        .when(scale >= 0, F.round(col * up) / up)
        .otherwise(F.round(col / down) * down)
    )
