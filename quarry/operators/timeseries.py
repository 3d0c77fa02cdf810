"""Readings over time: observation ETL, daily range, sensor features."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators.join import join_small, two_value_pivot


def quality_ok(qflag: str = "qflag"):
    """Quality flag NULL or empty (CSV reads an empty field as NULL)."""
    return F.coalesce(F.col(qflag), F.lit("")) == ""


def observation_etl(obs: DataFrame, station_prefix: str = "CA", observation: str = "TMAX") -> DataFrame:
    """``(station, date, tmax)`` for good-quality readings of one observation
    type at stations with a prefix; tenths of a degree -> degrees (double)."""
    return obs.where(
        quality_ok() & F.col("station").startswith(station_prefix) & (F.col("observation") == observation)
    ).select("station", "date", (F.col("value") / F.lit(10.0)).alias("tmax"))


def temperature_range(obs: DataFrame, high: str = "TMAX", low: str = "TMIN") -> DataFrame:
    """``(date, station, range)``: (high - low) / 10 per station-day.

    Each half is a scan of its own, filtered on the observation; they meet
    in an equi-join on ``(date, station)``, so duplicate readings multiply
    (m x n rows).
    """
    good = obs.where(quality_ok()).select("date", "station", "observation", "value")
    both = two_value_pivot(good, ["date", "station"], "observation", "value", high, low, "tmax", "tmin")
    return both.select("date", "station", ((F.col("tmax") - F.col("tmin")) / F.lit(10.0)).alias("range"))


def temperature_range_sql(spark: SparkSession, obs: DataFrame, view: str = "weather", high: str = "TMAX", low: str = "TMIN") -> DataFrame:
    """``temperature_range`` written as SQL over temp views (same plan). The views
    have names of this call and are dropped once the result is resolved."""
    view = f"{view}_{uuid.uuid4().hex}"
    obs.createOrReplaceTempView(view)
    spark.sql(f"SELECT * FROM {view} WHERE qflag IS NULL OR qflag = ''").createOrReplaceTempView(f"{view}_good")
    spark.sql(
        f"SELECT date, station, value AS tmax FROM {view}_good WHERE observation = :high", {"high": high}
    ).createOrReplaceTempView(f"{view}_tmax")
    spark.sql(
        f"SELECT date, station, value AS tmin FROM {view}_good WHERE observation = :low", {"low": low}
    ).createOrReplaceTempView(f"{view}_tmin")
    out = spark.sql(
        f"""
        SELECT x.date, x.station, CAST((x.tmax - n.tmin) / 10.0 AS DOUBLE) AS range
        FROM {view}_tmax x JOIN {view}_tmin n ON x.date = n.date AND x.station = n.station
        """
    )
    for name in (view, f"{view}_good", f"{view}_tmax", f"{view}_tmin"):
        spark.catalog.dropTempView(name)
    return out


def paired_averages(
    df: DataFrame, key: str, label: str, value: str, first: str, second: str,
    first_alias: str | None = None, second_alias: str | None = None,
) -> DataFrame:
    """Per key, the average of ``value`` for ``label == first`` next to the
    average for ``label == second``; keys lacking either side (or whose
    values on a side are all NULL) drop.

    Equal to averaging per (key, label) and joining the two halves on the
    key, but done as one aggregate with conditional averages: one scan and
    one shuffle, with partial aggregation, instead of two scans, two
    aggregates and a join.
    """
    a = F.avg(F.when(F.col(label) == first, F.col(value))).alias(first_alias or first)
    b = F.avg(F.when(F.col(label) == second, F.col(value))).alias(second_alias or second)
    out = df.where(F.col(label).isin(first, second)).groupBy(key).agg(a, b)
    return out.where(F.col(first_alias or first).isNotNull() & F.col(second_alias or second).isNotNull())


def sensor_features(readings: DataFrame, holidays: DataFrame) -> DataFrame:
    """``(timestamp, sensor, temp, temp_F, is_weekend, is_holiday)``.

    Holidays is a fixed calendar table (tens of rows); it is joined with a
    guarded broadcast.  Weekend = Sunday (1) or Saturday (7).
    """
    day = F.to_date("timestamp")
    hol = holidays.select(F.to_date("date").alias("_hdate"), "holiday").dropDuplicates(["_hdate"])
    joined = join_small(readings.withColumn("_day", day), hol, F.col("_day") == F.col("_hdate"), "left", strategy="broadcast")
    return joined.select(
        "timestamp",
        "sensor",
        "temp",
        (F.col("temp") * 9 / 5 + 32).alias("temp_F"),
        F.dayofweek("_day").isin(1, 7).alias("is_weekend"),
        F.col("holiday").isNotNull().alias("is_holiday"),
    )


def weekly_max(features: DataFrame) -> DataFrame:
    """Per sensor the ISO week(s) with the highest average temperature,
    holidays excluded; ties kept.  One aggregate; the maximum is taken over
    a sensor's weeks, at most 53 rows, and never computed twice."""
    weekly = (
        features.where(~F.col("is_holiday"))
        .groupBy("sensor", F.weekofyear(F.to_date("timestamp")).alias("week"))
        .agg(F.avg("temp").alias("max_avg_temp"))
    )
    best = F.max("max_avg_temp").over(Window.partitionBy("sensor"))
    return weekly.withColumn("_best", best).where(F.col("max_avg_temp") == F.col("_best")).select("sensor", "week", "max_avg_temp")
