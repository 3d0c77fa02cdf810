"""Streams: a message queue (S8, S9), several restarted batches (T4, T5, K9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.plans.registry import query
from quarry.session import scratch_path
from quarry.sources import queue, read_stream, table
from quarry.streaming.regression import fit_by_slice, message_text, start_fit


def event_messages(spark: SparkSession, sf: str) -> DataFrame:
    """`events` as messages: the key is the user, the value an ``x y`` line in
    UTF-8 (x = user_id, y = value)."""
    e = table(spark, sf, "events", ["event_id", "ts", "user_id", "value"])
    line = F.concat_ws(" ", F.col("user_id").cast("string"), F.col("value").cast("string"))
    return e.select("event_id", F.encode(F.col("user_id").cast("string"), "UTF-8").alias("key"), F.encode(line, "UTF-8").alias("value"), F.col("ts").alias("timestamp"))


@query(
    "q19_queue_regression",
    """
    SELECT CAST(regr_count(value, user_id) AS BIGINT) AS n,
           round(regr_slope(value, user_id), 6) AS slope,
           round(regr_intercept(value, user_id), 6) AS intercept
    FROM events
    """,
)
def q19_queue_regression(spark: SparkSession, sf: str) -> DataFrame:
    """The streaming fit from a message queue: half of the events are published
    and read, the query stops, the other half is published, and a second query
    goes on from the checkpoint. Each epoch overwrites the published fit."""
    topic, state, out = (scratch_path(spark, f"q19_{n}") for n in ("topic", "queue_state", "queue_fit"))
    messages = event_messages(spark, sf)
    even = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    keep(spark.createDataFrame([(0, None, None)], "n bigint, slope double, intercept double"), -1)
    for part in (messages.where(even), messages.where(~even)):
        queue.publish(part, topic)
        stream = read_stream(spark, queue.register(spark), {"path": topic})
        start_fit(message_text(stream), state, sink="foreach", on_batch=keep, available_now=True).awaitTermination()
    return spark.read.parquet(out).select("n", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


@query(
    "q19_queue_messages",
    """
    SELECT CAST(user_id AS VARCHAR) AS key, CAST(count(*) AS BIGINT) AS messages, CAST(count(DISTINCT event_id) AS BIGINT) AS positions,
           CAST(count(*) AS BIGINT) AS parsed, true AS one_partition, epoch_us(min(ts)) AS first_us
    FROM events WHERE user_id IS NOT NULL GROUP BY user_id
    """,
)
def q19_queue_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Every message once: the queue copied by a stream in three publications and
    two queries into files, counted by key with its distinct positions."""
    topic, state, out = (scratch_path(spark, f"q19_{n}") for n in ("copied", "copy_state", "copy"))
    messages = event_messages(spark, sf).where("key IS NOT NULL")
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))

    def copy() -> None:
        stream = read_stream(spark, queue.register(spark), {"path": topic})
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        q.awaitTermination()

    queue.publish(messages.where(third == 0), topic)
    copy()
    queue.publish(messages.where(third == 1), topic)
    queue.publish(messages.where(third == 2), topic)
    copy()
    rows = spark.read.schema(queue.MESSAGE).parquet(out)
    position = F.struct("partition", "offset")
    text = F.decode("value", "UTF-8")
    return rows.groupBy(F.decode("key", "UTF-8").alias("key")).agg(
        F.count(F.lit(1)).alias("messages"), F.count_distinct(position).alias("positions"),
        F.count(F.when(F.split_part(text, F.lit(" "), F.lit(1)) == F.decode("key", "UTF-8"), 1)).alias("parsed"),
        (F.min("partition") == F.max("partition")).alias("one_partition"), F.unix_micros(F.min("timestamp")).alias("first_us"))


SLICES = 6


@query(
    "q19_stream_epochs",
    """
    SELECT CAST(s.i AS INTEGER) AS slice, CAST(regr_count(value, user_id) AS BIGINT) AS n,
           round(regr_slope(value, user_id), 6) AS slope, round(regr_intercept(value, user_id), 6) AS intercept
    FROM generate_series(0, 5) AS s(i) LEFT JOIN events ON hour(ts) // 4 <= s.i GROUP BY s.i
    """,
)
def q19_stream_epochs(spark: SparkSession, sf: str) -> DataFrame:
    """Events arriving in six slices of the day: a trigger takes two files, the
    query stops after the third slice and another one goes on."""
    e = table(spark, sf, "events", ["ts", "user_id", "value"])
    line = F.concat_ws(" ", F.col("user_id").cast("string"), F.col("value").cast("string")).alias("value")
    slices = [e.where(F.floor(F.hour("ts") / 4) == k).select(line).repartition(3) for k in range(SLICES)]
    folder, state, out = (scratch_path(spark, f"q19_{n}") for n in ("slices", "slices_state", "slices_fit"))
    spark.createDataFrame([], "value string").write.text(folder)
    fits = fit_by_slice(slices, folder, state, out, files_per_trigger=2, stop_after={2})
    return fits.select("slice", "n", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))
