"""Stores that are not plain files: a wide-column table (S7, K8), keyed tables
changed in place (C1-C3, C6), catalog tables and views (C5, C7)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.correlate import correlate, per_key_count_sum
from quarry.operators.logs import host_totals, log_rows
from quarry.operators.keyed import change_rows, create_table_if_absent
from quarry.operators.stored import KeyedTable, create_view
from quarry.plans.q_iterative import page_log_lines
from quarry.plans.q_stats import _CORR_SQL
from quarry.plans.q_warehouse import SPLIT_TS, UPSERT_SQL, event_changes
from quarry.plans.registry import query
from quarry.session import scratch_path
from quarry.sources import read_table, table, wide


@query(
    "q15_wide_load",
    r"""
    WITH p AS (SELECT regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1) AS host, CAST(strlen(html) AS BIGINT) AS bytes FROM pages)
    SELECT host, CAST(count(*) AS BIGINT) AS requests, CAST(sum(bytes) AS BIGINT) AS bytes FROM p WHERE host <> '' GROUP BY host
    """,
)
def q15_wide_load(spark: SparkSession, sf: str) -> DataFrame:
    """Access-log rows appended to a wide-column table keyed by host in two
    jobs, and read back by two of its columns."""
    rows = log_rows(page_log_lines(spark, sf), position="page_id")
    options = {"root": scratch_path(spark, "wide"), "keyspace": "logs", "table": "requests", "key": "host"}
    early = F.pmod(F.xxhash64("req_id"), F.lit(2)) == 0
    wide.append(rows.where(early), options, mode="overwrite")
    wide.append(rows.where(~early), options)
    return host_totals(read_table(spark, wide.FORMAT, options, columns=["host", "bytes"]))


@query("q17_wide_correlate", _CORR_SQL)
def q17_wide_correlate(spark: SparkSession, sf: str) -> DataFrame:
    """Q16 from a wide-column table, by a column subset."""
    options = {"path": scratch_path(spark, "wide_orders"), "key": "o_custkey"}
    wide.append(table(spark, sf, "orders"), options, mode="overwrite")
    o = read_table(spark, wide.FORMAT, options, columns=["o_custkey", "o_totalprice"])
    return correlate(per_key_count_sum(o, "o_custkey", "o_totalprice")).select(F.round("r", 6).alias("r"), F.round("r2", 6).alias("r2"))


@query(
    "q36_wide_key_range",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders WHERE o_custkey BETWEEN 40 AND 70 AND o_totalprice > 1000",
)
def q36_wide_key_range(spark: SparkSession, sf: str) -> DataFrame:
    """A range of keys: only row groups that can hold them are read."""
    options = {"path": scratch_path(spark, "wide_range"), "key": "o_custkey"}
    wide.append(table(spark, sf, "orders"), options, mode="overwrite")
    o = read_table(spark, wide.FORMAT, options, columns=["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"])
    return o.where(F.col("o_custkey").between(40, 70) & (F.col("o_totalprice") > 1000))


@query("q35_stored_upsert", UPSERT_SQL)
def q35_stored_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Q35 on a stored table: the first half of the month as its base, then two
    batches of changes, each into the buckets that it touches."""
    e = table(spark, sf, "events", ["user_id", "event_type", "value", "ts", "event_id"])
    stored = KeyedTable(spark, scratch_path(spark, "keyed"), "user_id bigint, event_type string, value double", "user_id", buckets=16)
    split = F.lit(SPLIT_TS).cast("timestamp_ntz")
    late = F.lit(SPLIT_TS).cast("timestamp_ntz") + F.expr("INTERVAL 5 DAYS")
    for part in (e.where(F.col("ts") < split), e.where((F.col("ts") >= split) & (F.col("ts") < late)), e.where(F.col("ts") >= late)):
        stored.apply(event_changes(part))
    return stored.read()


@query(
    "q35_truncate_reload",
    "SELECT s_suppkey, s_name, CASE WHEN s_suppkey <= 5 THEN 0.0 ELSE s_acctbal END AS s_acctbal FROM supplier",
)
def q35_truncate_reload(spark: SparkSession, sf: str) -> DataFrame:
    """A batch of rows inserted, all removed, inserted again, and one column
    updated by key."""
    s = table(spark, sf, "supplier", ["s_suppkey", "s_name", "s_acctbal"])
    stored = KeyedTable(spark, scratch_path(spark, "suppliers"), "s_suppkey bigint, s_name string, s_acctbal double", "s_suppkey", buckets=8)
    stored.insert(s.withColumn("s_name", F.lit("old")).withColumn("s_suppkey", -F.col("s_suppkey")))
    stored.truncate()
    stored.insert(s)
    some = s.where("s_suppkey <= 5").select("s_suppkey", F.lit(None).cast("string").alias("s_name"), F.lit(0.0).alias("s_acctbal"))
    stored.apply(change_rows(some, ["s_acctbal"], F.lit(1)))
    return stored.read()


@query(
    "q36_view_with_flag",
    """
    SELECT c_nationkey, in_debt, CAST(count(*) AS BIGINT) AS customers
    FROM (SELECT c_nationkey, c_acctbal < 0 AS in_debt FROM customer) GROUP BY c_nationkey, in_debt
    """,
)
def q36_view_with_flag(spark: SparkSession, sf: str) -> DataFrame:
    """A table created if absent (twice; the second time it is there), filled,
    and read through a view with a derived flag. Names are of this run only and
    leave the catalog again; the files stay for the result to read."""
    name = f"q36_{uuid.uuid4().hex}"
    schema = T.StructType.fromDDL("c_custkey bigint, c_nationkey int, c_acctbal double")
    location = scratch_path(spark, "customers")
    for _ in range(2):
        create_table_if_absent(spark, name, schema, location)
    table(spark, sf, "customer", schema.names).write.insertInto(name)
    create_view(spark.table(name), f"{name}_view", F.col("c_acctbal") < 0, "in_debt")
    out = spark.sql(f"SELECT c_nationkey, in_debt, count(*) AS customers FROM {name}_view GROUP BY c_nationkey, in_debt")
    spark.catalog.dropTempView(f"{name}_view")
    spark.sql(f"DROP TABLE {name}")
    return out
