"""Q16-Q18, Q20: correlation, totals and regression."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.correlate import correlate, linear_fit, per_key_count_sum
from quarry.plans.registry import query
from quarry.sources import read_table, table

_CORR_SQL = """
    WITH h AS (SELECT o_custkey, CAST(count(*) AS DOUBLE) AS x, CAST(sum(o_totalprice) AS DOUBLE) AS y
               FROM orders GROUP BY o_custkey),
         c AS (SELECT covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0) AS r FROM h)
    SELECT round(r, 6) AS r, round(r * r, 6) AS r2 FROM c
"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(F.round("r", 6).alias("r"), F.round("r2", 6).alias("r2"))


@query("q16_correlate_logs", _CORR_SQL)
def q16_correlate_logs(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders", ["o_custkey", "o_totalprice"])
    return _rounded(correlate(per_key_count_sum(o, "o_custkey", "o_totalprice")))


@query("q17_correlate_table", _CORR_SQL)
def q17_correlate_table(spark: SparkSession, sf: str) -> DataFrame:
    """Same as Q16 through the generic table reader with a column subset
    (a wide-column connector in production; Parquet here)."""
    o = read_table(spark, "parquet", {"path": f"{sf}/orders.parquet"}, columns=["o_custkey", "o_totalprice"])
    return _rounded(correlate(per_key_count_sum(o, "o_custkey", "o_totalprice")))


@query("q18_total_bytes", "SELECT round(sum(l_quantity), 4) AS total_bytes FROM lineitem")
def q18_total_bytes(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem", ["l_quantity"])
    return li.agg(F.round(F.sum("l_quantity"), 4).alias("total_bytes"))


@query(
    "q20_batch_regression",
    """
    SELECT CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n,
           round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
           round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept
    FROM lineitem
    """,
)
def q20_batch_regression(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem", ["l_quantity", "l_extendedprice"])
    fit = linear_fit(li.select(F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y")))
    return fit.select("n", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))
