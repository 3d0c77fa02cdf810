"""Explicit schemas for every input shape the queries read.

Schema inference is avoided everywhere: it costs a pass over the data, and it
fails on all-NULL columns and on empty inputs.
"""

from pyspark.sql import types as T

# GHCN-style daily observation, CSV without header.
OBSERVATION = T.StructType(
    [
        T.StructField("station", T.StringType()),
        T.StructField("date", T.StringType()),  # yyyymmdd
        T.StructField("observation", T.StringType()),
        T.StructField("value", T.IntegerType()),  # tenths of a degree
        T.StructField("mflag", T.StringType()),
        T.StructField("qflag", T.StringType()),
        T.StructField("sflag", T.StringType()),
        T.StructField("obstime", T.StringType()),
    ]
)

# Parsed web-access-log row.
LOG_ROW = T.StructType(
    [
        T.StructField("host", T.StringType(), False),
        T.StructField("datetime", T.TimestampNTZType(), False),
        T.StructField("path", T.StringType(), False),
        T.StructField("bytes", T.LongType(), False),
        T.StructField("req_id", T.StringType(), False),
    ]
)

# Comment / submission JSON lines: only the fields the queries use.
COMMENT = T.StructType(
    [
        T.StructField("subreddit", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("score", T.LongType()),
    ]
)

# Daily maximum temperature per station (CSV).
TMAX = T.StructType(
    [
        T.StructField("station", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("latitude", T.FloatType()),
        T.StructField("longitude", T.FloatType()),
        T.StructField("elevation", T.FloatType()),
        T.StructField("tmax", T.FloatType()),
    ]
)

# Colour words (CSV).
COLOUR_WORDS = T.StructType(
    [
        T.StructField("R", T.IntegerType(), False),
        T.StructField("G", T.IntegerType(), False),
        T.StructField("B", T.IntegerType(), False),
        T.StructField("word", T.StringType(), False),
        T.StructField("confidence", T.StringType(), False),
    ]
)

# Graph edges and the shortest-path state.
EDGES = T.StructType(
    [
        T.StructField("src", T.LongType(), False),
        T.StructField("dst", T.LongType(), False),
        T.StructField("weight", T.DoubleType(), False),
    ]
)
PATH_STATE = T.StructType(
    [
        T.StructField("node", T.LongType(), False),
        T.StructField("dist", T.DoubleType(), False),
        T.StructField("prev", T.LongType(), True),
    ]
)

# Two-column points for the regression.
POINTS = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])

# Sensor readings and holidays.
READINGS = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("sensor", T.StringType()),
        T.StructField("temp", T.DoubleType()),
    ]
)
HOLIDAYS = T.StructType([T.StructField("date", T.StringType()), T.StructField("holiday", T.StringType())])

# Key/value table with a primary key.
KEY_VALUE = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("data", T.StringType())])
