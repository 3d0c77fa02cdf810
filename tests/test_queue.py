"""The message queue: numbering, runs, replay after a restart, appends."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from quarry.sources import queue, read_stream, transactions
from quarry.streaming.regression import message_text, start_fit

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def messages(spark, n, first=0, hot=3):
    """A third of the messages has one key; some keys and values are null."""
    rows = [(None if i % 50 == 0 else b"hot" if i % hot == 0 else f"k{i % 17}".encode(), None if i % 91 == 0 else f"{i} {2 * i + 1}".encode(), START + dt.timedelta(seconds=i))
            for i in range(first, first + n)]
    return spark.createDataFrame(rows, "key binary, value binary, timestamp timestamp").repartition(5)


def batch(spark, topic, **options):
    return spark.read.format(queue.register(spark)).options(path=topic, **options).load()


def test_numbers_have_no_gaps_and_keys_keep_their_partition_and_order(spark, tmp_path):
    topic = str(tmp_path / "t")
    assert queue.publish(messages(spark, 0), topic) == {"0": 0, "1": 0, "2": 0, "3": 0}
    assert batch(spark, topic).count() == 0
    first = queue.publish(messages(spark, 700), topic, partitions=4, files=6)
    second = queue.publish(messages(spark, 500, 700), topic, partitions=9)
    assert sum(first.values()) == 700 and sum(second.values()) == 1200 and set(second) == {"0", "1", "2", "3"}
    rows = batch(spark, topic, messagesPerTask=70).collect()
    assert len(rows) == 1200 and {r.topic for r in rows} == {topic}
    where, by = {}, {}
    for r in rows:
        by.setdefault(r.partition, []).append(r)
        if r.key is not None:
            assert where.setdefault(bytes(r.key), r.partition) == r.partition
    for p, mine in by.items():
        mine.sort(key=lambda r: r.offset)
        assert [r.offset for r in mine] == list(range(second[str(p)]))
        cut = first[str(p)]
        assert [r.timestamp for r in mine[:cut]] == sorted(r.timestamp for r in mine[:cut])
    want = sorted(map(repr, ((r.key, r.value, r.timestamp) for r in messages(spark, 1200).collect())))
    assert sorted(map(repr, ((r.key, r.value, r.timestamp) for r in rows))) == want


def test_a_task_reads_a_bounded_run(spark, tmp_path):
    topic = str(tmp_path / "t")
    queue.publish(messages(spark, 1000), topic, partitions=2, files=3)
    assert batch(spark, topic, messagesPerTask=100).rdd.getNumPartitions() >= 10
    reader = queue.QueueStreamReader({"path": topic, "messagespertask": "64"})
    end = reader.latestOffset()
    runs = reader.partitions(reader.initialOffset(), end)
    assert all(0 < r.n <= 64 for r in runs) and sum(r.n for r in runs) == 1000
    some = reader.partitions({"": 0, "0": 33}, {"": 0, "0": 40, "1": 5})
    got = sorted((b.column("partition")[i].as_py(), b.column("offset")[i].as_py()) for r in some for b in reader.read(r) for i in range(len(b)))
    assert got == [(0, i) for i in range(33, 40)] + [(1, i) for i in range(5)]
    assert reader.partitions(end, end) == []


def test_stream_goes_on_after_a_restart_and_replays_a_lost_batch(spark, tmp_path):
    topic, state, out = (str(tmp_path / n) for n in ("t", "state", "out"))
    stored = []

    def copy(fail=False):
        def keep(rows, epoch):
            if fail:
                raise RuntimeError("lost")
            rows.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
            stored.append(epoch)

        q = read_stream(spark, queue.register(spark), {"path": topic}).writeStream.foreachBatch(keep).option("checkpointLocation", state).trigger(availableNow=True).start()
        q.awaitTermination()

    queue.publish(messages(spark, 300), topic)
    copy()
    queue.publish(messages(spark, 200, 300), topic)
    with pytest.raises(Exception, match="lost"):
        copy(fail=True)
    queue.publish(messages(spark, 100, 500), topic)  # not part of the batch that is replayed
    copy()
    copy()
    sizes = {r.epoch: r.n for r in spark.read.parquet(out).groupBy("epoch").agg(F.count("*").alias("n")).collect()}
    assert sizes == {0: 300, 1: 200, 2: 100} and stored == [0, 1, 2]
    assert spark.read.parquet(out).select("partition", "offset").distinct().count() == 600


def test_fit_from_messages_over_two_queries(spark, tmp_path):
    topic, state = str(tmp_path / "t"), str(tmp_path / "state")
    fits = []
    for first in (0, 100):
        queue.publish(messages(spark, 100, first), topic)
        lines = message_text(read_stream(spark, queue.register(spark), {"path": topic}))
        start_fit(lines, state, sink="foreach", on_batch=lambda b, e: fits.append(b.first()), available_now=True).awaitTermination()
    assert [f.n for f in fits] == [98, 197]  # null values are no points
    assert fits[-1].slope == pytest.approx(2) and fits[-1].intercept == pytest.approx(1)


def test_two_writers_never_share_a_number(spark, tmp_path):
    folder = str(tmp_path / "log")
    transactions.add(spark, folder, 1, {"a": 1})
    with pytest.raises(FileExistsError):
        transactions.add(spark, folder, 1, {"a": 2})
    transactions.append(folder, {"a": 3})
    assert transactions.entries(folder) == [(1, {"a": 1}), (2, {"a": 3})] and transactions.entries(folder, 1) == [(2, {"a": 3})]
    assert json.load(open(f"{folder}/00000001.json")) == {"a": 1} and not [f for f in os.listdir(folder) if f.endswith("json.tmp")]
    assert transactions.entries(str(tmp_path / "none")) == []
