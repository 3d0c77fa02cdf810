"""Two-value pivot, temperature range, yesterday, sensors, join strategies
(FIXTURES B7, B9, B13)."""

import datetime

from pyspark.sql import functions as F

from quarry.operators import timeseries as TS
from quarry.operators.join import fits_broadcast, join_small, with_previous_day
from quarry.sources import rows
from quarry.sources.schemas import HOLIDAYS, OBSERVATION, READINGS


def obs(spark, data):
    full = [(s, d, o, v, None, q, None, None) for s, d, o, v, q in data]
    return spark.createDataFrame(full, OBSERVATION)


def test_temperature_range_edges(spark):
    df = obs(spark, [
        ("S1", "20240101", "TMAX", 251, None), ("S1", "20240101", "TMAX", 200, ""), ("S1", "20240101", "TMIN", 113, None),
        ("S2", "20240101", "TMAX", 100, "X"), ("S2", "20240101", "TMIN", 50, None),
        ("S3", "20240101", "TMAX", 100, None),
    ])
    got = sorted((r.station, round(r.range, 6)) for r in TS.temperature_range(df).collect())
    assert got == [("S1", 8.7), ("S1", 13.8)]
    sql = sorted((r.station, round(r.range, 6)) for r in TS.temperature_range_sql(spark, df, "t_weather").collect())
    assert sql == got


def test_observation_etl(spark):
    df = obs(spark, [("CA1", "d", "TMAX", 215, None), ("CA2", "d", "TMAX", 1, "Q"), ("US1", "d", "TMAX", 1, None), ("CA3", "d", "TMIN", 1, None)])
    assert [tuple(r) for r in TS.observation_etl(df).collect()] == [("CA1", "d", 21.5)]


def test_yesterday_needs_adjacent_day(spark):
    d = datetime.date
    df = spark.createDataFrame([("s", d(2024, 1, 1), 1.0), ("s", d(2024, 1, 2), 2.0), ("s", d(2024, 1, 4), 4.0)],
                               "station string, date date, tmax double")
    got = [tuple(r) for r in with_previous_day(df, "station", "date", "tmax", "y").collect()]
    assert got == [("s", d(2024, 1, 2), 2.0, 1.0)]


def test_sensors(spark):
    readings = rows(spark, [
        ("2025-10-01", "North", 17.5), ("2025-10-01", "South", 18.9),
        ("2025-10-02", "North", 16.0), ("2025-10-02", "South", 17.2),
        ("2025-10-04", "North", 10.0), ("2025-10-05", "North", 30.0),
    ], READINGS)
    from quarry.operators.join import two_value_pivot

    pair = sorted(tuple(r) for r in two_value_pivot(readings, "timestamp", "sensor", "temp", "North", "South", "north", "south").collect())
    assert pair == [("2025-10-01", 17.5, 18.9), ("2025-10-02", 16.0, 17.2)]
    feats = TS.sensor_features(readings, rows(spark, [], HOLIDAYS))
    f = {(r.timestamp, r.sensor): r for r in feats.collect()}
    assert f[("2025-10-01", "North")].temp_F == 63.5
    assert f[("2025-10-04", "North")].is_weekend and f[("2025-10-05", "North")].is_weekend
    assert not f[("2025-10-01", "North")].is_weekend
    hol = rows(spark, [("2025-10-05", "x")], HOLIDAYS)
    weekly = sorted((r.sensor, r.week, round(r.max_avg_temp, 9)) for r in TS.weekly_max(TS.sensor_features(readings, hol)).collect())
    assert weekly == [("North", 40, 14.5), ("South", 40, 18.05)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


def test_join_strategies_in_plan(spark):
    big = spark.range(0, 20000).select((F.col("id") % 100).alias("k"), F.col("id").alias("v"))
    small = spark.range(0, 100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    bc = join_small(big, small, "k", strategy="broadcast")
    bc.explain()
    assert "BroadcastHashJoin" in bc._jdf.queryExecution().executedPlan().toString() or "broadcast" in _plan(bc).lower()
    bc.count()
    assert "BroadcastHashJoin" in bc._jdf.queryExecution().executedPlan().toString()
    mg = join_small(big, small, "k", strategy="merge")
    mg.count()
    assert "SortMergeJoin" in mg._jdf.queryExecution().executedPlan().toString()
    assert bc.count() == mg.count() == 20000


def test_broadcast_guard_goes_by_written_size(spark):
    from quarry.session import materialize, release

    big = spark.range(0, 1000).select(F.col("id").alias("k"))
    small = spark.range(0, 50).select(F.col("id").alias("k"))
    written = materialize(small, "t")
    assert fits_broadcast(written, 1 << 20) and not fits_broadcast(written, 10)
    release(written)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for limit, node in ((1 << 20, "BroadcastHashJoin"), (10, "SortMergeJoin")):
            out = join_small(big, small, "k", strategy="broadcast", max_broadcast_bytes=limit)
            assert out.count() == 50
            assert node in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_query_leaves_a_cached_frame(spark):
    from quarry.plans import QUERIES

    for name in ("q06_top_pages_broadcast", "q11_relative_score_broadcast", "q24_spend_by_region", "q30_sensor_features"):
        QUERIES[name](spark, "/root/testdata/sf0.001").count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_weekly_max_keeps_ties_and_reads_its_input_once(spark):
    rows_ = [("2025-10-06", "A", 10.0), ("2025-10-07", "A", 20.0), ("2025-10-13", "A", 15.0), ("2025-10-20", "A", 3.0)]
    readings = spark.createDataFrame([(t, s, v, False) for t, s, v in rows_], "timestamp string, sensor string, temp double, is_holiday boolean")
    out = TS.weekly_max(readings)
    assert sorted((r.week, r.max_avg_temp) for r in out.collect()) == [(41, 15.0), (42, 15.0)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_paired_averages_equals_join_of_halves(spark):
    from pyspark.sql import functions as F

    from quarry.operators.join import two_value_pivot

    rows_ = [("d1", "a", 1.0), ("d1", "a", 3.0), ("d1", "b", 5.0), ("d2", "a", 2.0), ("d3", "b", 7.0), ("d3", "c", 1.0)]
    df = spark.createDataFrame(rows_, "k string, s string, v double")
    daily = df.groupBy("k", "s").agg(F.avg("v").alias("v"))
    joined = sorted(tuple(r) for r in two_value_pivot(daily, "k", "s", "v", "a", "b").collect())
    paired = sorted(tuple(r) for r in TS.paired_averages(df, "k", "s", "v", "a", "b").collect())
    assert joined == paired == [("d1", 2.0, 5.0)]
