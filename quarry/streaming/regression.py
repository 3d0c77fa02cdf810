"""Streaming least-squares regression over an unbounded stream of points.

One global aggregate (``regr_slope``, ``regr_intercept``, count) is kept in
the state store; the output mode is ``complete`` (every trigger emits the
current fit over all points seen so far), and the checkpoint location makes
the state survive a restart.  The same expressions serve the batch form.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.functions.text import parse_points
from quarry.operators.correlate import linear_fit


def fit_points(lines: DataFrame, value: str = "value") -> DataFrame:
    """``x y`` text lines (batch or stream) -> one row ``(n, slope, intercept)``.
    Malformed lines are dropped."""
    return linear_fit(parse_points(lines, value))


def message_text(messages: DataFrame) -> DataFrame:
    """A message-queue stream's ``value`` bytes as a text column."""
    return messages.select(F.col("value").cast("string").alias("value"))


def start_fit(
    lines: DataFrame,
    checkpoint: str,
    sink: str = "memory",
    name: str | None = None,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the streaming fit.

    ``sink='memory'`` (tests, queryable as table ``name``), ``'console'``, or
    ``'foreach'`` with ``on_batch(df, epoch)`` (e.g. overwrite a Parquet
    summary: the production form).  ``available_now`` processes what is
    there and stops.
    """
    fit = fit_points(lines)
    w = fit.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
    if sink == "foreach":
        if on_batch is None:
            raise ValueError("foreach sink needs on_batch")
        w = w.foreachBatch(on_batch)
    else:
        w = w.format(sink)
        if name:
            w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def fit_by_slice(
    slices: Sequence[DataFrame],
    folder: str,
    checkpoint: str,
    out: str,
    files_per_trigger: int = 1,
    stop_after: Collection[int] = (),
) -> DataFrame:
    """Feed text ``slices`` one after the other to a running fit and give its
    state after each: ``(slice, n, slope, intercept)``.

    A slice is appended to ``folder``, which the query watches; a trigger takes
    at most ``files_per_trigger`` files, so that a slice is several epochs, each
    of which publishes the complete result. The query runs until all of a slice
    is read; after the slices in ``stop_after`` it is stopped, and a new query goes
    on from ``checkpoint``. ``out`` gets the latest fit (``fit``), the epochs and
    their counts (``epochs``), and the fit after each slice (``slices``).
    """
    spark = slices[0].sparkSession
    none = spark.createDataFrame([(0, None, None)], "n bigint, slope double, intercept double")
    none.write.mode("overwrite").parquet(f"{out}/fit")

    def publish(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/fit")
        batch.select("n").write.mode("overwrite").parquet(f"{out}/epochs/epoch={epoch}")  # again after a restart: the same

    query = None
    try:
        for k, lines in enumerate(slices):
            lines.write.mode("append").text(folder)
            if query is None:
                stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", files_per_trigger).text(folder)
                query = start_fit(stream, checkpoint, sink="foreach", on_batch=publish)
            query.processAllAvailable()
            spark.read.schema(none.schema).parquet(f"{out}/fit").write.mode("overwrite").parquet(f"{out}/slices/slice={k}")
            if k in stop_after:
                query.stop()
                query.awaitTermination()
                query = None
    finally:
        if query is not None:
            query.stop()
    return spark.read.schema("n bigint, slope double, intercept double, slice int").parquet(f"{out}/slices").select("slice", "n", "slope", "intercept")
