"""Q12-Q14, Q29-Q31: observation ETL, daily range, sensors, yesterday's value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import timeseries as TS
from quarry.operators.join import with_previous_day
from quarry.plans.registry import query
from quarry.sources import rows, table
from quarry.sources.schemas import HOLIDAYS


def part_observations(spark: SparkSession, sf: str) -> DataFrame:
    """`part` in the observation shape: station = p_type, date = part key,
    observation = p_brand, value = p_retailprice, no quality flag."""
    p = table(spark, sf, "part", ["p_type", "p_partkey", "p_brand", "p_retailprice"])
    return p.select(
        F.col("p_type").alias("station"),
        F.col("p_partkey").cast("string").alias("date"),
        F.col("p_brand").alias("observation"),
        F.col("p_retailprice").alias("value"),
        F.lit(None).cast("string").alias("qflag"),
    )


# The observation types as the table's return flags, so that a filter on the
# type is a filter on the stored column and reaches the scan.
HIGH, LOW = "R", "A"


def lineitem_observations(spark: SparkSession, sf: str) -> DataFrame:
    """`lineitem` in the observation shape: station = order key, date = line
    number, observation = return flag (R the high, A the low), value = quantity."""
    li = table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"])
    return li.select(
        F.col("l_orderkey").cast("string").alias("station"),
        F.col("l_linenumber").cast("string").alias("date"),
        F.col("l_returnflag").alias("observation"),
        F.col("l_quantity").alias("value"),
        F.lit(None).cast("string").alias("qflag"),
    )


@query(
    "q12_observation_etl",
    """
    SELECT p_type AS station, CAST(p_partkey AS VARCHAR) AS date, round(p_retailprice / 10.0, 6) AS tmax
    FROM part WHERE starts_with(p_type, 'S') AND p_brand = 'Brand#2'
    """,
)
def q12_observation_etl(spark: SparkSession, sf: str) -> DataFrame:
    out = TS.observation_etl(part_observations(spark, sf), station_prefix="S", observation="Brand#2")
    return out.select("station", "date", F.round("tmax", 6).alias("tmax"))


_RANGE_SQL = """
    WITH o AS (SELECT CAST(l_orderkey AS VARCHAR) AS station, CAST(l_linenumber AS VARCHAR) AS date,
                      l_returnflag AS f, l_quantity AS value FROM lineitem),
         mx AS (SELECT date, station, value AS tmax FROM o WHERE f = 'R'),
         mn AS (SELECT date, station, value AS tmin FROM o WHERE f = 'A')
    SELECT mx.date, mx.station, round((tmax - tmin) / 10.0, 6) AS "range"
    FROM mx JOIN mn ON mx.date = mn.date AND mx.station = mn.station
"""


@query("q13_temp_range", _RANGE_SQL)
def q13_temp_range(spark: SparkSession, sf: str) -> DataFrame:
    out = TS.temperature_range(lineitem_observations(spark, sf), HIGH, LOW)
    return out.select("date", "station", F.round("range", 6).alias("range"))


@query("q14_temp_range_sql", _RANGE_SQL)
def q14_temp_range_sql(spark: SparkSession, sf: str) -> DataFrame:
    out = TS.temperature_range_sql(spark, lineitem_observations(spark, sf), view="q14_weather", high=HIGH, low=LOW)
    return out.select("date", "station", F.round("range", 6).alias("range"))


@query(
    "q29_two_sensors",
    """
    WITH r AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS timestamp, event_type AS sensor, avg(value) AS temp
               FROM events GROUP BY 1, 2)
    SELECT a.timestamp, round(a.temp, 6) AS click, round(b.temp, 6) AS view
    FROM r a JOIN r b ON a.timestamp = b.timestamp WHERE a.sensor = 'click' AND b.sensor = 'view'
    """,
)
def q29_two_sensors(spark: SparkSession, sf: str) -> DataFrame:
    """Daily click and view averages side by side (one aggregate)."""
    out = TS.paired_averages(event_readings(spark, sf), "timestamp", "sensor", "temp", "click", "view")
    return out.select("timestamp", F.round("click", 6).alias("click"), F.round("view", 6).alias("view"))


# --- fixed values: the holiday calendar used with `events` (January 2024) ---
HOLIDAY_ROWS = [("2024-01-01", "New Year's Day"), ("2024-01-15", "Winter Holiday")]


def event_readings(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events", ["ts", "event_type", "value"])
    return e.select(
        F.to_date("ts").cast("string").alias("timestamp"), F.col("event_type").alias("sensor"), F.col("value").alias("temp")
    )


_HOLIDAYS_SQL = "(VALUES ('2024-01-01', 'New Year''s Day'), ('2024-01-15', 'Winter Holiday')) AS h(date, holiday)"


@query(
    "q30_sensor_features",
    f"""
    SELECT CAST(CAST(e.ts AS DATE) AS VARCHAR) AS timestamp, e.event_type AS sensor, e.value AS temp,
           round(e.value * 9 / 5 + 32, 6) AS temp_F,
           dayofweek(CAST(e.ts AS DATE)) IN (0, 6) AS is_weekend,
           h.holiday IS NOT NULL AS is_holiday
    FROM events e LEFT JOIN {_HOLIDAYS_SQL} ON CAST(h.date AS DATE) = CAST(e.ts AS DATE)
    """,
)
def q30_sensor_features(spark: SparkSession, sf: str) -> DataFrame:
    feats = TS.sensor_features(event_readings(spark, sf), rows(spark, HOLIDAY_ROWS, HOLIDAYS))
    return feats.withColumn("temp_F", F.round("temp_F", 6))


@query(
    "q30_weekly_max",
    f"""
    WITH f AS (SELECT e.event_type AS sensor, CAST(e.ts AS DATE) AS d, e.value AS temp, h.holiday
               FROM events e LEFT JOIN {_HOLIDAYS_SQL} ON CAST(h.date AS DATE) = CAST(e.ts AS DATE)),
         w AS (SELECT sensor, weekofyear(d) AS week, avg(temp) AS a FROM f WHERE holiday IS NULL GROUP BY 1, 2),
         m AS (SELECT sensor, max(a) AS a FROM w GROUP BY 1)
    SELECT w.sensor, CAST(w.week AS INTEGER) AS week, round(w.a, 6) AS max_avg_temp
    FROM w JOIN m ON w.sensor = m.sensor AND w.a = m.a
    """,
)
def q30_weekly_max(spark: SparkSession, sf: str) -> DataFrame:
    feats = TS.sensor_features(event_readings(spark, sf), rows(spark, HOLIDAY_ROWS, HOLIDAYS))
    out = TS.weekly_max(feats)
    return out.select("sensor", "week", F.round("max_avg_temp", 6).alias("max_avg_temp"))


@query(
    "q31_yesterday",
    """
    WITH d AS (SELECT user_id AS station, CAST(ts AS DATE) AS date, max(value) AS tmax FROM events GROUP BY 1, 2)
    SELECT t.station, t.date, t.tmax, y.tmax AS yesterday_tmax
    FROM d t JOIN d y ON t.station = y.station AND y.date = t.date - 1
    """,
)
def q31_yesterday(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events", ["user_id", "ts", "value"])
    daily = e.groupBy(F.col("user_id").alias("station"), F.to_date("ts").alias("date")).agg(F.max("value").alias("tmax"))
    return with_previous_day(daily, "station", "date", "tmax", "yesterday_tmax").select(
        "station", "date", "tmax", "yesterday_tmax"
    )
