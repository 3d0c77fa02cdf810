"""Q27, Q28: colour-space conversion of RGB triples derived from `lineitem`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.colour import rgb_to_hsv, rgb_to_lab
from quarry.plans.registry import query
from quarry.sources import table


def rgb_rows(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    return li.select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_partkey") % 256).alias("r"),
        (F.col("l_suppkey") % 256).alias("g"),
        ((F.col("l_linenumber") * 36) % 256).alias("b"),
    )


_RGB_SQL = """
    c AS (SELECT l_orderkey, l_linenumber, l_partkey % 256 AS r, l_suppkey % 256 AS g,
                 (l_linenumber * 36) % 256 AS b FROM lineitem),
    d AS (SELECT *, CAST(r AS DOUBLE) / 255 AS rr, CAST(g AS DOUBLE) / 255 AS gg, CAST(b AS DOUBLE) / 255 AS bb FROM c)
"""

_LAB_SQL = f"""
WITH {_RGB_SQL},
lin AS (SELECT *,
  CASE WHEN rr > 0.04045 THEN pow((rr + 0.055) / 1.055, 2.4) ELSE rr / 12.92 END AS lr,
  CASE WHEN gg > 0.04045 THEN pow((gg + 0.055) / 1.055, 2.4) ELSE gg / 12.92 END AS lg,
  CASE WHEN bb > 0.04045 THEN pow((bb + 0.055) / 1.055, 2.4) ELSE bb / 12.92 END AS lb FROM d),
xyz AS (SELECT *,
  (lr * 0.412453 + lg * 0.357580 + lb * 0.180423) / 0.95047 AS x,
  lr * 0.212671 + lg * 0.715160 + lb * 0.072169 AS y,
  (lr * 0.019334 + lg * 0.119193 + lb * 0.950227) / 1.08883 AS z FROM lin),
f AS (SELECT *,
  CASE WHEN x > 0.008856 THEN pow(x, CAST(1 AS DOUBLE) / 3) ELSE 7.787 * x + CAST(16 AS DOUBLE) / 116 END AS fx,
  CASE WHEN y > 0.008856 THEN pow(y, CAST(1 AS DOUBLE) / 3) ELSE 7.787 * y + CAST(16 AS DOUBLE) / 116 END AS fy,
  CASE WHEN z > 0.008856 THEN pow(z, CAST(1 AS DOUBLE) / 3) ELSE 7.787 * z + CAST(16 AS DOUBLE) / 116 END AS fz FROM xyz)
SELECT l_orderkey, l_linenumber, r, g, b,
  round(116 * fy - 16, 6) AS lab_l, round(500 * (fx - fy), 6) AS lab_a, round(200 * (fy - fz), 6) AS lab_b
FROM f
"""


@query("q27_rgb_to_lab", _LAB_SQL)
def q27_rgb_to_lab(spark: SparkSession, sf: str) -> DataFrame:
    rgb = rgb_rows(spark, sf)
    l_, a_, b_ = rgb_to_lab("r", "g", "b")
    return rgb.select(
        "l_orderkey", "l_linenumber", "r", "g", "b",
        F.round(l_, 6).alias("lab_l"), F.round(a_, 6).alias("lab_a"), F.round(b_, 6).alias("lab_b"),
    )


_HSV_SQL = f"""
WITH {_RGB_SQL},
m AS (SELECT *, greatest(rr, gg, bb) AS mx, greatest(rr, gg, bb) - least(rr, gg, bb) AS dd FROM d),
-- the sextant begins at the greatest channel (the later one on a tie) and is turned by the other two
h AS (SELECT *, coalesce(CASE mx WHEN bb THEN 4 + (rr - gg) / nullif(dd, 0) WHEN gg THEN 2 + (bb - rr) / nullif(dd, 0)
                                 ELSE (gg - bb) / nullif(dd, 0) END, 0) / 6 AS raw FROM m)
SELECT l_orderkey, l_linenumber, r, g, b,
  round(CASE WHEN raw < 0 THEN raw + 1 ELSE raw END, 6) AS hsv_h,
  round(CASE WHEN dd = 0 THEN 0 ELSE dd / mx END, 6) AS hsv_s,
  round(mx, 6) AS hsv_v
FROM h
"""


@query("q28_rgb_to_hsv", _HSV_SQL)
def q28_rgb_to_hsv(spark: SparkSession, sf: str) -> DataFrame:
    rgb = rgb_rows(spark, sf)
    h, s, v = rgb_to_hsv("r", "g", "b")
    return rgb.select(
        "l_orderkey", "l_linenumber", "r", "g", "b",
        F.round(h, 6).alias("hsv_h"), F.round(s, 6).alias("hsv_s"), F.round(v, 6).alias("hsv_v"),
    )
