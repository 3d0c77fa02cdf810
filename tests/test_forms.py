"""Second forms: rank and keep one, inferred JSON, buckets, lookups, counts in lines."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import counted
from quarry.operators.aggregate import word_count, word_count_in_lines
from quarry.operators.bucketed import HOT_SHARE, join_unique, write_bucketed
from quarry.operators.keyed import first_per_key
from quarry.operators.lookup import LookupTooLarge, with_lookup
from quarry.plans import QUERIES
from quarry.sources import json_schema, read_json_inferred
from tests.conftest import SF_SMALL, lines_df


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rank_limits_groups_before_the_shuffle(spark):
    plan = plan_text(QUERIES["q35_first_by_rank"](spark, SF_SMALL))
    places = [plan.index(x) for x in ("WindowGroupLimit", "Exchange hashpartitioning", "Partial")]
    assert "Final" in plan and places[0] < places[1] < places[2]  # a limit after, the shuffle, a limit before it
    rows = [(1, 5, "a"), (1, 3, "b"), (1, 3, "c"), (None, 9, "d"), (None, 8, None), (2, None, "e")]
    got = first_per_key(spark.createDataFrame(rows, "k int, d int, v string"), "k", F.col("d").asc_nulls_last(), "v").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, 3, "b"), (None, 8, None), (2, None, "e")], key=repr)


def test_schema_of_lines_with_gaps_and_differences(spark, tmp_path):
    lines = ['{"a": 1, "b": "x", "n": {"k": 1}, "l": [1, 2]}', '{"a": 2.5, "c": null, "n": {"m": true}}', '{"a": 3, "b": 7, "odd `name`": 1, "OBJECT<": 2}',
             "[1]", "{broken", "null", "", '{"big": 123456789012345678901234567890, "l": [0.5]}', '{"c": null}']
    schema = json_schema(lines_df(spark, lines))
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    assert kinds["a"] == "double" and kinds["b"] == "string" and kinds["c"] == "string" and kinds["l"] == "array<double>"
    assert kinds["n"] == "struct<k:bigint,m:boolean>" and kinds["odd `name`"] == "bigint" and kinds["OBJECT<"] == "bigint" and kinds["big"] == "decimal(30,0)"
    lines_df(spark, lines).write.text(str(tmp_path / "j"))
    rows = read_json_inferred(spark, str(tmp_path / "j"))
    got = sorted((r.a, r.b, r.n.k if r.n else None) for r in rows.where("a IS NOT NULL").collect())
    assert got == [(1.0, "x", 1), (2.5, None, None), (3.0, "7", None)]
    theirs = {f.name: f.dataType.simpleString() for f in spark.read.json(str(tmp_path / "j")).schema.fields if f.name in kinds}
    assert {k: v for k, v in theirs.items() if k not in ("big",)} == {k: v for k, v in kinds.items() if k in theirs and k != "big"}
    for none in ([], ["1", "x"], ["{}"]):
        assert json_schema(lines_df(spark, none)) == T.StructType([])


def test_buckets_join_without_an_exchange(spark):
    o = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 400).cast("bigint").alias("k"), "id")
    c = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    facts, entities = write_bucketed(o, "k", 8), write_bucketed(c, "k", 8, unique=True)
    assert facts.hot_keys == [7] and len(facts.hot_keys) < HOT_SHARE * 8 and facts.hot.count() > 1600 and facts.rows().count() == 5000
    cold = facts.cold.join(entities.cold.withColumnRenamed("k", "_key").hint("merge"), F.col("k") == F.col("_key"))
    assert "Exchange" not in plan_text(cold) and "SortMergeJoin" in plan_text(cold) and "Bucketed: true" in plan_text(cold)
    joined = join_unique(facts, entities, ["id", "v"])
    assert sum("Exchange" in line for line in plan_text(joined).split("\n")) == 1 and "BroadcastExchange" in plan_text(joined)  # the hot keys' few rows
    want = sorted((r.id, r.v) for r in o.join(c, "k").collect())
    facts.drop()
    entities.drop()
    assert sorted((r.id, r.v) for r in joined.collect()) == want


def test_lookup_by_a_map_and_its_guard(spark):
    small = spark.createDataFrame([("a", 1.5), ("b", None), (None, 9.0), ("é", 2.0)], "g string, average double")
    rows = spark.createDataFrame([("a",), ("b",), (None,), ("z",), ("é",), ("a",)], "g string")
    found = with_lookup(rows, small, "g", "average", "average")
    assert "Join" not in plan_text(found) and "Subquery" in plan_text(found)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([("a", 1.5), ("b", None), (None, None), ("z", None), ("é", 2.0), ("a", 1.5)], key=repr)
    many = spark.range(300).select(F.col("id").cast("string").alias("g"), F.col("id").cast("double").alias("average"))
    with pytest.raises(LookupTooLarge, match="300 keys"):
        with_lookup(rows, many, "g", "average", "average", max_keys=299)
    long = many.select("g", F.repeat(F.lit("x"), 10_000).alias("average"))  # few bytes in compressed files, many in memory
    with pytest.raises(LookupTooLarge, match="bytes"):
        with_lookup(rows, long, "g", "average", "average", max_bytes=1 << 20)
    assert {r.average for r in with_lookup(many.select("g"), many, "g", "average", "average", slots=7).collect()} == set(map(float, range(300)))


def test_counting_inside_lines(spark):
    lines = lines_df(spark, ["a b a. A", "", "b", "b", " x " * 50, "éa a"])
    for keep in (False, True):
        assert sorted(map(tuple, word_count_in_lines(lines, keep_empty=keep).collect())) == sorted(map(tuple, word_count(lines, keep_empty=keep).collect()))
    words = spark.createDataFrame([(["a", "a", "b"],), ([],), (["c"],)], "w array<string>").select(counted(F.col("w")).alias("c")).collect()
    assert [[tuple(x) for x in r.c] for r in words] == [[("a", 2), ("b", 1)], [], [("c", 1)]]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(F.col("text").alias("value"))
    fewer = sum(len(Counter(w for w in re.split(r"\s+", r.value or "") if w)) for r in docs.collect())
    every = sum(len([w for w in re.split(r"\s+", r.value or "") if w]) for r in docs.collect())
    assert fewer < 0.8 * every  # rows that enter the partial sums
