"""Sorted reports, file layouts and table names: entries for operators whose
result is an order, a set of files or a catalog entry. Files are written from
all rows of a table, then read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import json as J
from quarry.functions.text import hour_from_file_name
from quarry.operators import aggregate as A
from quarry.operators import sinks as K
from quarry.operators.keyed import dedupe_on_key
from quarry.operators.order import with_position
from quarry.plans.q_text import customer_json_lines
from quarry.plans.registry import query
from quarry.session import scratch_path
from quarry.sources import read_catalog_table, read_lines, register_tables, table


@query(
    "q01_word_count_empties",
    r"""
    SELECT word, CAST(count(*) AS BIGINT) AS n
    FROM (SELECT unnest(regexp_split_to_array(lower(text), '[[:punct:]\s]+')) AS word FROM documents)
    GROUP BY word
    """,
)
def q01_word_count_empties(spark: SparkSession, sf: str) -> DataFrame:
    """Word count that keeps the empty strings at the ends of a text."""
    return A.word_count(table(spark, sf, "documents", ["text"]), "text", keep_empty=True)


@query(
    "q39_sorted_by_key",
    "SELECT row_number() OVER (ORDER BY o_orderkey) AS position, o_orderkey, o_totalprice FROM orders",
)
def q39_sorted_by_key(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    return with_position(o, "o_orderkey").select("position", "o_orderkey", "o_totalprice")


@query(
    "q39_sorted_descending",
    "SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_custkey, o_orderkey) AS position, o_orderkey, o_custkey, o_totalprice FROM orders",
)
def q39_sorted_descending(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    out = with_position(o, F.desc("o_totalprice"), "o_custkey", "o_orderkey")
    return out.select("position", "o_orderkey", "o_custkey", "o_totalprice")


@query(
    "q39_sorted_by_aggregate",
    """
    SELECT row_number() OVER (ORDER BY count(*) DESC, upper(c_mktsegment), c_nationkey) AS position,
           c_mktsegment, c_nationkey, CAST(count(*) AS BIGINT) AS n
    FROM customer GROUP BY c_mktsegment, c_nationkey
    """,
)
def q39_sorted_by_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    """Order by an aggregate, then by an expression."""
    n = table(spark, sf, "customer", ["c_mktsegment", "c_nationkey"]).groupBy("c_mktsegment", "c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return with_position(n, F.desc("n"), F.upper("c_mktsegment"), "c_nationkey").select("position", "c_mktsegment", "c_nationkey", "n")


@query(
    "q05_hours_of_files",
    "SELECT '20240101-' || strftime(ts, '%H') AS hour, CAST(count(*) AS BIGINT) AS n, CAST(sum(user_id) AS BIGINT) AS total FROM events GROUP BY 1",
)
def q05_hours_of_files(spark: SparkSession, sf: str) -> DataFrame:
    """Page-count files, named by the hour as the original ones are; the hour
    of a line comes from the name of the file it is read from."""
    e = table(spark, sf, "events", ["ts", "user_id"])
    path = scratch_path(spark, "hour_files")
    K.write_ranged(e.select(F.col("user_id").cast("string").alias("value"), F.date_format("ts", "HH").alias("hh")), path, "hh")
    files = K.name_files(spark, path, lambda folder, k: f"pagecounts-20240101-{folder.removeprefix('hh=')}0000-{k}.txt")
    lines = read_lines(spark, files, with_file=True)
    hour = hour_from_file_name("file_name")
    return lines.groupBy(hour.alias("hour")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("bigint")).alias("total"))


@query(
    "q09_etl_outputs",
    """
    SELECT c_mktsegment AS subreddit, CAST(trunc(c_acctbal) AS BIGINT) AS score, c_name AS author,
           CASE WHEN trunc(c_acctbal) > 0 THEN 'positive' ELSE 'negative' END AS output
    FROM customer
    WHERE c_mktsegment IS NOT NULL AND c_mktsegment <> '' AND contains(c_mktsegment, 'E')
    """,
)
def q09_etl_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """The two outputs of the split, written in one job and read back each by itself."""
    comments = J.pick_comments(customer_json_lines(spark, sf), score_type="bigint").where(F.col("subreddit").contains("E"))
    path = scratch_path(spark, "etl_outputs")
    K.write_split(K.with_split(comments, F.col("score") > 0, "positive", "negative"), path)
    schema = "subreddit string, score bigint, author string"
    names = ("positive", "negative")
    # a side without rows has no folder; all files are listed, then told apart
    both = spark.read.schema(f"{schema}, bucket string").json(path)
    sides = [both.where(F.col("bucket") == n).select("subreddit", "score", "author", F.lit(n).alias("output")) for n in names]
    return sides[0].unionByName(sides[1])


@query(
    "q35_composite_key",
    """
    SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_quantity FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_quantity DESC) AS k FROM lineitem)
    WHERE k = 1
    """,
)
def q35_composite_key(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a table keyed by two columns: the latest of each key stays."""
    li = table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_quantity"])
    return dedupe_on_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query(
    "q35_clustered_layout",
    "SELECT user_id, CAST(count(*) AS BIGINT) AS n, true AS in_order FROM events GROUP BY user_id",
)
def q35_clustered_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Events written clustered by user and time; in every file each user's
    rows must lie together, in order of time."""
    path = scratch_path(spark, "clustered")
    K.write_clustered(table(spark, sf, "events", ["user_id", "ts", "event_id"]), path, ["user_id"], ["ts"])
    rows = spark.read.parquet(path).select("user_id", "ts", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("i"))
    w = Window.partitionBy("user_id", "file").orderBy("i")
    ok = F.coalesce((F.lag("ts").over(w) <= F.col("ts")) & (F.lag("i").over(w) == F.col("i") - 1), F.lit(True))
    return rows.select("user_id", ok.alias("ok")).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.min("ok").alias("in_order"))


@query(
    "q36_catalog_tables",
    "SELECT n_name, CAST(count(*) AS BIGINT) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name",
)
def q36_catalog_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Tables read by their catalog names, which are of this run only."""
    prefix = f"q36_{uuid.uuid4().hex}_"
    register_tables(spark, sf, ["supplier", "nation"], prefix=prefix)
    s = read_catalog_table(spark, f"{prefix}supplier", ["s_nationkey"])
    n = read_catalog_table(spark, f"{prefix}nation", ["n_nationkey", "n_name"])
    for name in ("supplier", "nation"):
        spark.catalog.dropTempView(f"{prefix}{name}")
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count(F.lit(1)).alias("suppliers"))
