"""RGB -> CIE LAB (D65) and RGB -> HSV as plain column expressions.

The whole conversion is one projection: it stays inside whole-stage codegen
and adds no exchange.  Inputs are 0..255 channel columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (sRGB companding, sRGB->XYZ matrix, D65 white point, CIE f) ---
SRGB_THRESHOLD = 0.04045
SRGB_OFFSET = 0.055
SRGB_SCALE = 1.055
SRGB_GAMMA = 2.4
SRGB_LINEAR_SLOPE = 12.92
RGB_TO_X = (0.412453, 0.357580, 0.180423)
RGB_TO_Y = (0.212671, 0.715160, 0.072169)
RGB_TO_Z = (0.019334, 0.119193, 0.950227)
WHITE_X = 0.95047
WHITE_Z = 1.08883
CIE_EPSILON = 0.008856
CIE_KAPPA_SLOPE = 7.787
CIE_OFFSET = 16.0 / 116.0
# ---------------------------------------------------------------------------------


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _linear(channel: Column) -> Column:
    c = channel.cast("double") / F.lit(255.0)
    return F.when(c > SRGB_THRESHOLD, F.pow((c + SRGB_OFFSET) / SRGB_SCALE, SRGB_GAMMA)).otherwise(
        c / SRGB_LINEAR_SLOPE
    )


def _f(t: Column) -> Column:
    return F.when(t > CIE_EPSILON, F.pow(t, F.lit(1.0 / 3.0))).otherwise(CIE_KAPPA_SLOPE * t + F.lit(CIE_OFFSET))


def rgb_to_lab(r: Column | str, g: Column | str, b: Column | str) -> tuple[Column, Column, Column]:
    """(L, a, b) columns for 0..255 RGB channels, in double."""
    lr, lg, lb = _linear(_c(r)), _linear(_c(g)), _linear(_c(b))
    x = (lr * RGB_TO_X[0] + lg * RGB_TO_X[1] + lb * RGB_TO_X[2]) / WHITE_X
    y = lr * RGB_TO_Y[0] + lg * RGB_TO_Y[1] + lb * RGB_TO_Y[2]
    z = (lr * RGB_TO_Z[0] + lg * RGB_TO_Z[1] + lb * RGB_TO_Z[2]) / WHITE_Z
    fx, fy, fz = _f(x), _f(y), _f(z)
    return (F.lit(116.0) * fy - 16.0, F.lit(500.0) * (fx - fy), F.lit(200.0) * (fy - fz))


def rgb_to_hsv(r: Column | str, g: Column | str, b: Column | str) -> tuple[Column, Column, Column]:
    """(h, s, v) in [0, 1] for 0..255 RGB channels.

    h: 0 for grey; red strictly largest -> (g-b)/d; else green >= blue ->
    2+(b-r)/d; else 4+(r-g)/d; divided by 6 and wrapped into [0, 1).
    """
    rr, gg, bb = (_c(x).cast("double") / F.lit(255.0) for x in (r, g, b))
    mx = F.greatest(rr, gg, bb)
    mn = F.least(rr, gg, bb)
    d = mx - mn
    raw = (
        F.when(d == 0, F.lit(0.0))
        .when((rr > gg) & (rr > bb), (gg - bb) / d)
        .when(gg > bb, F.lit(2.0) + (bb - rr) / d)
        .otherwise(F.lit(4.0) + (rr - gg) / d)
    ) / F.lit(6.0)
    h = F.when(raw < 0, raw + F.lit(1.0)).otherwise(raw)
    s = F.when(mx == 0, F.lit(0.0)).otherwise(d / mx)
    s = F.when(d == 0, F.lit(0.0)).otherwise(s)
    return h, s, mx
