"""Second forms of operators: rank and keep one (W1), inferred JSON (S5),
buckets (R2, R4), a looked-up map (J5, J6), counting inside a line (P2, A20)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import aggregate as A
from quarry.operators.bucketed import join_unique, write_bucketed
from quarry.operators.keyed import first_per_key
from quarry.operators.lookup import with_lookup
from quarry.operators.sinks import write_text
from quarry.plans.q_text import _REL_SQL, _comments_any
from quarry.plans.registry import ORACLE, query
from quarry.session import materialize, scratch_path
from quarry.sources import read_json_inferred, table


@query(
    "q35_first_by_rank",
    """
    SELECT l_partkey, l_orderkey, l_linenumber, l_extendedprice FROM (
        SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice, l_orderkey, l_linenumber) AS k FROM lineitem)
    WHERE k = 1
    """,
)
def q35_first_by_rank(spark: SparkSession, sf: str) -> DataFrame:
    """The cheapest line of each part, by rank; ties to the first line."""
    li = table(spark, sf, "lineitem", ["l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice"])
    return first_per_key(li, "l_partkey", "l_extendedprice", "l_orderkey", "l_linenumber")


@query(
    "q07_inferred_json",
    """
    SELECT c_mktsegment AS segment, CAST(count(*) AS BIGINT) AS customers, CAST(count(*) FILTER (c_custkey % 3 = 0) AS BIGINT) AS notes,
           CAST(sum(c_custkey) AS BIGINT) AS keys, round(avg(CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END), 6) AS average,
           CAST(sum(c_nationkey) AS BIGINT) AS nations
    FROM customer GROUP BY c_mktsegment
    """,
)
def q07_inferred_json(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines without a declared schema: every tenth balance is a text, a note
    is often missing, a nation is nested, some lines are no objects."""
    c = table(spark, sf, "customer", ["c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey"])
    balance = F.when(F.col("c_custkey") % 10 == 0, '"none"').otherwise(F.col("c_acctbal").cast("string"))
    note = F.when(F.col("c_custkey") % 3 == 0, F.lit(', "note": "n"')).otherwise("")
    segment = F.concat(F.lit('"'), F.replace(F.col("c_mktsegment"), F.lit('"'), F.lit('\\"')), F.lit('"'))
    line = F.format_string('{"id": %d, "segment": %s, "balance": %s, "at": {"nation": %d}%s}', "c_custkey", segment, balance, "c_nationkey", note)
    path = scratch_path(spark, "inferred")
    write_text(c.select(F.explode(F.when(F.col("c_custkey") % 100 == 1, F.array(line, F.lit("[1, 2]"), F.lit("{broken"))).otherwise(F.array(line))).alias("value")), path)
    rows = read_json_inferred(spark, path).where("id IS NOT NULL")
    return rows.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"), F.count("note").alias("notes"), F.sum("id").alias("keys"),
        F.round(F.avg(F.col("balance").try_cast("double")), 6).alias("average"), F.sum("at.nation").alias("nations"))


@query(
    "q10_bucketed_join",
    """
    SELECT c_mktsegment, c_nationkey, CAST(count(*) AS BIGINT) AS orders, round(avg(o_totalprice), 6) AS average
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
    """,
)
def q10_bucketed_join(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and customers in buckets of the customer, joined where they lie."""
    o = write_bucketed(table(spark, sf, "orders", ["o_custkey", "o_totalprice"]), "o_custkey", 16)
    c = write_bucketed(table(spark, sf, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"]), "c_custkey", 16, unique=True)
    joined = join_unique(o, c, ["c_mktsegment", "c_nationkey", "o_totalprice"])
    o.drop()
    c.drop()
    return joined.groupBy("c_mktsegment", "c_nationkey").agg(F.count(F.lit(1)).alias("orders"), F.round(F.avg("o_totalprice"), 6).alias("average"))


@query("q11_relative_score_lookup", _REL_SQL.format(extra="AND c_mktsegment <> ''"))
def q11_relative_score_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Q11 with the averages as a looked-up map, refused above 50,000 groups."""
    rows = materialize(_comments_any(spark, sf).where("subreddit <> ''"), "lookup-input")
    averages = rows.groupBy("subreddit").agg(F.avg("score").alias("average")).where("average > 0")
    found = with_lookup(rows, averages, "subreddit", "average", "average").where("average IS NOT NULL")
    return found.select(F.round(F.col("score") / F.col("average"), 6).alias("rel"), "author", "subreddit")


@query("q01_word_count_in_lines", ORACLE["q01_word_count"])
def q01_word_count_in_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Q1 with the words of a text counted inside it first."""
    return A.word_count_in_lines(table(spark, sf, "documents", ["text"]), "text")
