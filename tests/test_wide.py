"""The wide-column table: commits, lost attempts, key ranges, column subsets."""

import datetime as dt
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual
from pyspark.sql.pandas.types import to_arrow_schema

from quarry.sources import read_table, transactions, wide

SCHEMA = "host string, at timestamp_ntz, bytes bigint"


def rows(spark, n, host=lambda i: f"h{i % 40:02d}"):
    data = [(host(i), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), i) for i in range(n)]
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def files(folder):
    return sorted(os.listdir(f"{folder}/data")) if os.path.isdir(f"{folder}/data") else []


def test_appends_are_read_back_by_columns(spark, tmp_path):
    options = {"root": str(tmp_path), "keyspace": "k", "table": "t", "key": "host"}
    wide.append(rows(spark, 500), options)
    wide.append(rows(spark, 300), options)
    got = read_table(spark, wide.FORMAT, options, columns=["bytes"])
    assert got.columns == ["bytes"] and sorted(r.bytes for r in got.collect()) == sorted([*range(500), *range(300)])
    whole = read_table(spark, wide.FORMAT, options)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, rows(spark, 500).union(rows(spark, 300)).collect()))
    wide.append(rows(spark, 10), options, mode="overwrite")
    assert read_table(spark, wide.FORMAT, options).count() == 10
    wide.append(rows(spark, 0), options, mode="overwrite")
    assert read_table(spark, wide.FORMAT, options).count() == 0
    with pytest.raises(Exception, match="another schema"):
        wide.append(rows(spark, 1).select("host", "bytes"), options)
    with pytest.raises(Exception, match="not a column"):
        rows(spark, 1).write.format(wide.FORMAT).options(path=str(tmp_path / "other"), key="none").mode("append").save()


def test_a_job_that_fails_leaves_nothing(spark, tmp_path):
    options = {"path": str(tmp_path / "t"), "key": "host"}
    wide.append(rows(spark, 100), options)
    before = files(options["path"])

    def broken(batches):
        for b in batches:
            if 77 in b.column(2).to_pylist():
                raise RuntimeError("lost executor")
            yield b

    with pytest.raises(Exception, match="lost executor"):
        wide.append(rows(spark, 100).mapInArrow(broken, SCHEMA), options)
    late = rows(spark, 400).repartition(4, "host").sortWithinPartitions("host").mapInArrow(broken, SCHEMA)
    with pytest.raises(Exception, match="lost executor"):  # fails while the sink's tasks write
        late.write.format(wide.register(spark)).options(**options).mode("append").save()
    assert files(options["path"]) == before and read_table(spark, wide.FORMAT, options).count() == 100


def batches(n, first=0):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    return schema, [pa.RecordBatch.from_arrays([pa.array(range(first + i, first + i + 10)), pa.array(["x"] * 10)], schema=to_arrow_schema(schema)) for i in range(0, n, 10)]


def test_of_two_attempts_only_the_committed_one_counts(tmp_path):
    schema, data = batches(100)
    writer = wide.WideWriter({"path": str(tmp_path / "t"), "key": "k"}, schema, False)
    first, second = writer.write(iter(data)), writer.write(iter(data))
    killed = iter([*data, None])
    with pytest.raises(TypeError):
        writer.write(killed)
    assert len(files(tmp_path / "t")) == 2
    writer.commit([second, None, writer.write(iter([]))])
    reader = wide.WideReader({"path": str(tmp_path / "t")}, schema)
    assert [list(p.groups) for p in reader.partitions()] == [[second.file]] and second.file != first.file
    writer.abort([first, None])
    assert len(files(tmp_path / "t")) == 1
    got = [v for p in reader.partitions() for b in reader.read(p) for v in b.column(0).to_pylist()]
    assert sorted(got) == list(range(100))
    assert len(transactions.entries(f"{tmp_path}/t/log")) == 1


def test_ranges_leave_out_groups_and_a_hot_key_is_split(tmp_path, monkeypatch):
    monkeypatch.setattr(wide, "GROUP", 20)
    schema, data = batches(400)
    options = {"path": str(tmp_path / "t"), "key": "k", "rowspertask": "50"}
    writer = wide.WideWriter(options, schema, False)
    hot = pa.RecordBatch.from_arrays([pa.array([1000] * 10), pa.array(["hot"] * 10)], schema=data[0].schema)
    nulls = pa.RecordBatch.from_arrays([pa.nulls(20, pa.int64()), pa.array(["none"] * 20)], schema=data[0].schema)
    writer.commit([writer.write(iter(data)), writer.write(iter([hot] * 30)), writer.write(iter([nulls]))])

    def read(*filters):
        reader = wide.WideReader(options, schema)
        assert list(reader.pushFilters(list(filters))) == list(filters)  # Spark applies them again
        return reader.partitions()

    every = read()
    assert sum(p.rows for p in every) == 720 and all(p.rows <= 60 for p in every)
    assert sum(p.low == 1000 for p in every) >= 5
    assert sum(p.rows for p in read(EqualTo(("k",), 25))) == 20
    assert sum(p.rows for p in read(GreaterThan(("k",), 100), LessThanOrEqual(("k",), 139))) == 40
    assert sum(p.rows for p in read(In(("k",), (5, 45, None)))) == 60
    assert sum(p.rows for p in read(EqualTo(("v",), "hot"))) == 720
    assert read(EqualTo(("k",), 10**9)) == []


def test_filters_of_a_query_reach_the_table(spark, tmp_path, monkeypatch):
    options = {"path": str(tmp_path / "t"), "key": "at"}
    wide.append(rows(spark, 400), options)
    got = read_table(spark, wide.FORMAT, {**options, "rowsPerTask": "10"})
    late = got.where(F.col("at") >= F.lit(dt.datetime(2024, 1, 1, 0, 5)).cast("timestamp_ntz"))
    assert sorted(r.bytes for r in late.collect()) == list(range(300, 400))
    host = {"path": str(tmp_path / "h"), "key": "host"}
    for low, high in (("h00", "h20"), ("h20", "h99")):
        wide.append(rows(spark, 400).where((F.col("host") >= low) & (F.col("host") < high)), host)
    every = read_table(spark, wide.FORMAT, {**host, "rowsPerTask": "10"})
    few = read_table(spark, wide.FORMAT, {**host, "rowsPerTask": "10"}).where("host = 'h07'")
    assert few.count() == 10 and every.count() == 400 and (few.rdd.getNumPartitions(), every.rdd.getNumPartitions()) == (1, 2)


def test_missing_table_says_so(spark, tmp_path):
    wide.register(spark)
    with pytest.raises(Exception, match="no table"):
        read_table(spark, wide.FORMAT, {"path": str(tmp_path / "none")}).count()
