"""Readers on written files: text with file names, CSV and JSON with explicit
schemas, gzip, table reader, the pre-partitioned average."""

import gzip
import os

from pyspark.sql import functions as F

from quarry.operators import aggregate as A
from quarry.operators import pagecounts as P
from quarry.operators import timeseries as TS
from quarry.sources import read_csv, read_json, read_lines, read_table
from quarry.sources.schemas import COMMENT, OBSERVATION


def test_pagecounts_hour_from_written_file_names(spark, tmp_path):
    d = tmp_path / "pc"
    d.mkdir()
    (d / "pagecounts-20160801-120000").write_text("en A 10 1\nen B 10 1\nen Special:X 99 1\nen C x 1\n")
    with gzip.open(d / "pagecounts-20160801-130000.gz", "wt") as f:
        f.write("en D 5 1\nfr E 50 1\nen Main_Page 70 1\n")
    (d / "other-file").write_text("en Z 999 1\n")
    lines = read_lines(spark, str(d), with_file=True)
    counts = P.wanted_pages(P.parse_counts4(lines))
    got = sorted(tuple(r) for r in P.top_pages_per_hour(counts).collect())
    assert got == [("20160801-12", "A", 10), ("20160801-12", "B", 10), ("20160801-13", "D", 5)]


def test_csv_with_schema(spark, tmp_path):
    path = str(tmp_path / "obs.csv")
    with open(path, "w") as f:
        f.write("CA001,20240101,TMAX,251,,,S,\nCA001,20240101,TMIN,113,,,S,\nCA002,20240101,TMAX,x,,,S,\n"
                "CA003,20240101,TMAX,100,,Q,S,\nUS001,20240101,TMAX,300,,,S,\n")
    obs = read_csv(spark, path, OBSERVATION)
    rows = {(r.station, r.observation): r for r in obs.collect()}
    assert rows[("CA001", "TMAX")].value == 251 and rows[("CA001", "TMAX")].qflag is None
    assert rows[("CA002", "TMAX")].value is None
    etl = sorted(tuple(r) for r in TS.observation_etl(obs).collect())
    assert etl == [("CA001", "20240101", 25.1), ("CA002", "20240101", None)]
    rng = [tuple(r) for r in TS.temperature_range(obs).collect()]
    assert [(d, s, round(x, 6)) for d, s, x in rng] == [("20240101", "CA001", 13.8)]


def test_json_with_schema_and_table_reader(spark, tmp_path):
    path = str(tmp_path / "c.json")
    with open(path, "w") as f:
        f.write('{"subreddit": "a", "author": "x", "score": 3}\n{"subreddit": "a", "score": "oops"}\n'
                '{"subreddit": "b", "score": 5, "extra": 1}\nnot json\n')
    df = read_json(spark, path, COMMENT)
    assert df.columns == ["subreddit", "author", "score"]
    got = sorted(tuple(r) for r in A.average_per_key(df, "subreddit", "score").collect())
    assert got == [("a", 3.0), ("b", 5.0)]
    pre = sorted(tuple(r) for r in A.average_per_key(df, "subreddit", "score", partitions=4).collect())
    assert pre == got
    out = str(tmp_path / "t")
    df.write.parquet(out)
    t = read_table(spark, "parquet", {"path": out}, columns=["subreddit"])
    assert t.columns == ["subreddit"] and t.count() == 4
    assert "ReadSchema: struct<subreddit:string>" in t._jdf.queryExecution().executedPlan().toString()
    assert os.path.isdir(out)


def test_clustered_layout(spark, tmp_path):
    from quarry.operators.sinks import write_clustered

    df = spark.createDataFrame([("h1", 3, "c"), ("h2", 1, "a"), ("h1", 1, "a"), ("h1", 2, "b")], "host string, t int, r string")
    out = str(tmp_path / "clustered")
    write_clustered(df, out, ["host"], ["t"], partitions=2)
    back = spark.read.parquet(out)
    per_file = back.withColumn("f", F.input_file_name()).groupBy("f").agg(F.collect_list("host").alias("hosts"),
                                                                         F.collect_list("t").alias("ts")).collect()
    for row in per_file:
        pairs = list(zip(row.hosts, row.ts))
        assert pairs == sorted(pairs)
    assert back.count() == 4
