"""Keyed tables changed in place: only touched buckets are written."""

import os
import random

from pyspark.sql import functions as F

from quarry.operators.keyed import change_rows
from quarry.operators.stored import BUCKET, KeyedTable, create_view
from quarry.plans import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "k bigint, a string, b double"


def files(path):
    return {f"{d[len(path):]}/{f}" for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def state(t):
    return {r.k: (r.a, r.b) for r in t.read().collect()}


def changes(spark, rows, columns, seq=None):
    return change_rows(spark.createDataFrame(rows, SCHEMA), columns, F.lit(1) if seq is None else seq)


def test_untouched_files_keep_their_names(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, "k", buckets=16)
    assert t.read().count() == 0 and t.apply(changes(spark, [], ["a"])) == []
    t.insert(spark.range(200).select(F.col("id").alias("k"), F.lit("x").alias("a"), F.col("id").cast("double").alias("b")))
    before = files(t.path)
    touched = t.apply(changes(spark, [(5, "new", None), (1000, "more", None)], ["a"]))
    after = files(t.path)
    folders = {f"/{BUCKET}={b}" for b in touched}
    assert 1 <= len(touched) <= 2 and {os.path.dirname(f) for f in before ^ after} == folders
    assert {f for f in before if os.path.dirname(f) not in folders} <= after
    got = state(t)
    assert got[5] == ("new", 5.0) and got[1000] == ("more", None) and got[6] == ("x", 6.0) and len(got) == 201


def test_lookup_reads_one_bucket(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, "k", buckets=16)
    t.insert(spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("a"), F.lit(1.5).alias("b")))
    row = t.lookup(42)
    assert [tuple(r) for r in row.collect()] == [(42, "x", 1.5)] and t.lookup(1000).count() == 0
    plan = row._jdf.queryExecution().executedPlan().toString()
    assert f"{BUCKET}" in plan and "PartitionFilters: [isnotnull(_bucket" in plan


def test_truncate_and_composite_and_null_keys(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), "x bigint, y string, v int", ["x", "y"], buckets=4)
    rows = [(1, "a", 1), (1, None, 2), (None, None, 3), (1, "a", 4)]
    t.insert(spark.createDataFrame(rows, "x bigint, y string, v int"))
    assert sorted(map(tuple, t.read().collect()), key=repr) == sorted([(1, "a", 4), (1, None, 2), (None, None, 3)], key=repr)
    assert t.lookup(1, None).first().v == 2 and t.lookup(None, None).first().v == 3
    t.truncate()
    assert t.read().count() == 0 and t.read().columns == ["x", "y", "v"]
    t.insert(spark.createDataFrame(rows[:1], "x bigint, y string, v int"))
    assert t.read().count() == 1


def test_batches_against_a_dictionary(spark, tmp_path):
    rng = random.Random(4)
    t, want = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, "k", buckets=8), {}
    for _ in range(3):
        rows = [(0 if rng.random() < 0.3 else rng.randrange(30), f"a{rng.randrange(99)}", float(i)) for i in range(60)]  # one key has a third
        columns = rng.choice([["a"], ["b"], ["a", "b"]])
        batch = changes(spark, rows, columns, F.col("b"))
        t.apply(batch)
        state_once = state(t)
        t.apply(batch)  # as after a restart
        for k, a, b in rows:
            old = want.get(k, (None, None))
            want[k] = (a if "a" in columns else old[0], b if "b" in columns else old[1])
        assert state(t) == state_once == want


def test_view_and_table_names_leave_the_catalog(spark):
    before = {x.name for x in spark.catalog.listTables()}
    assert QUERIES["q36_view_with_flag"](spark, SF_SMALL).count() > 0
    assert {x.name for x in spark.catalog.listTables()} == before
    create_view(spark.range(4), "flags", F.col("id") > 2, "big")
    assert spark.table("flags").where("big").count() == 1
    spark.catalog.dropTempView("flags")
