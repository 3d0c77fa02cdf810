"""A message queue as a Spark data source: topics of partitioned, numbered
messages in the shared store.

A message is (key, value, timestamp) with binary key and value. Each of a
topic's partitions numbers its messages from 0 without gaps; a key always goes
to the same partition, in order of time within one publication. The columns are
those of the usual queue connectors: ``key, value, topic, partition, offset,
timestamp``.

``publish`` adds the rows of a frame. They are sorted by ranges of (partition,
timestamp) and written by Spark, so that a hot key is shared by many files; the
numbers follow from where a row stands in its file, so that they are neither
stored nor computed by a second shuffle. An entry of the topic's log then names
the runs of rows of each file (a row for each file and partition) and makes
them visible, all at once.

``MessageQueue`` reads a topic as a stream (``spark.readStream``) or whole
(``spark.read``). Offsets are the next number of every partition; a task reads a
bounded run of one file, and a batch that is replayed after a restart reads the
very same messages. Parquet row groups outside a run are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from quarry.sources import transactions

FORMAT = "quarry_queue"
MESSAGE = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
MESSAGE_ARROW = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()),
                           ("timestamp", pa.timestamp("us", tz="UTC"))])
RUN = 200_000  # messages a task reads at most


def partition_of(key: Column, partitions: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")


def publish(messages: DataFrame, topic: str, partitions: int = 4, files: int | None = None) -> dict[str, int]:
    """Add the rows (key, value, timestamp) to the topic in folder ``topic`` and
    return its end: the next number of each partition. ``partitions`` holds for
    the topic's first publication and is kept afterwards. Rows without a key go
    to a partition by their value. No row, no entry.
    """
    spark = messages.sparkSession
    known = transactions.entries(f"{topic}/log")
    number, last = known[-1] if known else (0, {"partitions": partitions, "ends": {}})
    partitions, ends = last["partitions"], {int(k): v for k, v in last["ends"].items()}
    rows = messages.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), F.col("timestamp").cast("timestamp").alias("timestamp"))
    rows = rows.withColumn("p", partition_of(F.coalesce("key", "value"), partitions))
    order = ["p", "timestamp", F.xxhash64("key", "value")]
    rows = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    folder = f"{topic}/messages/{number + 1:08d}"
    rows.withColumn("part", F.spark_partition_id()).sortWithinPartitions(*order).write.mode("overwrite").parquet(folder)
    written = spark.read.schema("p int, part int").parquet(folder).select("p", "part", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("i"))
    runs = written.groupBy("file", "part", "p").agg(F.min("i").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("p").orderBy("part", "first").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    runs = runs.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    found = [{"file": r.file, "partition": r.p, "first": r.first, "n": r.n, "offset": r.offset + ends.get(r.p, 0)} for r in runs.collect()]
    for run in found:
        ends[run["partition"]] = max(ends.get(run["partition"], 0), run["offset"] + run["n"])
    if found:
        transactions.add(spark, f"{topic}/log", number + 1, {"partitions": partitions, "ends": ends, "runs": found})
    return {str(p): ends.get(p, 0) for p in range(partitions)}


class Run(InputPartition):
    """Rows ``first`` to ``first + n`` of a file: messages from ``offset`` on."""

    def __init__(self, file: str, partition: int, first: int, n: int, offset: int):
        self.file, self.partition, self.first, self.n, self.offset = file, partition, first, n, offset


class _Reader:
    def __init__(self, options: dict):
        self.topic = options["path"]
        self.run = int(options.get("messagespertask", RUN))
        self.known: list[dict] = []
        self.at = 0
        self.ends: dict[str, int] = {}

    def refresh(self) -> None:
        for number, entry in transactions.entries(f"{self.topic}/log", self.at):
            self.known += entry["runs"]
            self.at = number
            self.ends = {str(p): int(entry["ends"].get(str(p), 0)) for p in range(entry["partitions"])}

    def runs(self, start: dict, end: dict) -> list[Run]:
        """Runs of at most ``run`` messages from ``start`` up to ``end``."""
        self.refresh()
        out = []
        for r in sorted(self.known, key=lambda r: (r["partition"], r["offset"])):
            p = str(r["partition"])
            low, high = max(r["offset"], start.get(p, 0)), min(r["offset"] + r["n"], end.get(p, 0))
            for at in range(low, high, self.run):
                out.append(Run(r["file"], r["partition"], r["first"] + at - r["offset"], min(self.run, high - at), at))
        return out

    def read(self, run: Run | None) -> Iterator[pa.RecordBatch]:
        if run is None:  # what Spark passes if there are no partitions
            return
        system, path = transactions.locate(run.file)
        with system.open_input_file(path) as f:
            file = pq.ParquetFile(f)
            at, first, stop = 0, run.first, run.first + run.n
            groups = []
            for g in range(file.metadata.num_row_groups):
                n = file.metadata.row_group(g).num_rows
                if at < stop and at + n > first:
                    groups.append((at, g))
                at += n
            at = groups[0][0] if groups else 0
            for batch in file.iter_batches(8192, row_groups=[g for _, g in groups], columns=["key", "value", "timestamp"]):
                low, high = max(first - at, 0), min(stop - at, len(batch))
                if low < high:
                    part = batch.slice(low, high - low)
                    n, offset = len(part), run.offset + at + low - first
                    columns = [part.column("key"), part.column("value"), pa.array([self.topic] * n), pa.array([run.partition] * n, pa.int32()),
                               pa.array(range(offset, offset + n), pa.int64()), part.column("timestamp").cast(MESSAGE_ARROW.field("timestamp").type)]
                    yield pa.RecordBatch.from_arrays(columns, schema=MESSAGE_ARROW)
                at += len(batch)


class QueueReader(_Reader, DataSourceReader):
    def partitions(self) -> list[Run]:
        self.refresh()
        return self.runs({}, self.ends)


class QueueStreamReader(_Reader, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"": 0}  # every partition from its first message

    def latestOffset(self) -> dict:
        self.refresh()
        return {"": 0, **self.ends}

    def partitions(self, start: dict, end: dict) -> list[Run]:
        return self.runs(start, end)

    def commit(self, end: dict) -> None:
        """Nothing to release: a topic keeps its messages."""


class MessageQueue(DataSource):
    """Options: ``path``, the topic's folder as a URI or absolute path, and
    ``messagesPerTask``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return MESSAGE

    def reader(self, schema) -> QueueReader:
        return QueueReader(self.options)

    def streamReader(self, schema) -> QueueStreamReader:
        return QueueStreamReader(self.options)


def register(spark: SparkSession) -> str:
    """Make the format known to the session; returns its name."""
    spark.dataSource.register(MessageQueue)
    return FORMAT
