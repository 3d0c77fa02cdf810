"""Q1-Q11: text, page counts and JSON-line queries over the driver tables.

Where the original input is text lines (page counts, JSON comments), the
lines are *derived by Spark from the driver tables* and then parsed by the
same operators a user would run on raw files, so the parsing path is part of
the measured work.  Floating results are rounded for the cross-engine check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import json as J
from quarry.functions.stats import round_significant
from quarry.operators import aggregate as A
from quarry.operators import pagecounts as P
from quarry.operators.join import relative_score
from quarry.plans.registry import query
from quarry.sources import table

# Mapping of the page-count roles onto `events`: language = event_type,
# title = user_id (text), views = value in cents, bytes = event_id.
LANG = "view"
EXCLUDE_TITLE = "0"
EXCLUDE_PREFIX = "14"


def count_lines5(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events", ["ts", "event_type", "user_id", "value", "event_id"])
    return e.select(
        F.concat_ws(
            " ",
            F.concat(F.date_format("ts", "yyyyMMdd-HH"), F.lit("0000")),
            "event_type",
            F.col("user_id").cast("string"),
            F.round(F.col("value") * 100).cast("bigint").cast("string"),
            F.col("event_id").cast("string"),
        ).alias("value")
    )


def count_lines4(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events", ["ts", "event_type", "user_id", "value", "event_id"])
    return e.select(
        F.concat_ws(
            " ",
            "event_type",
            F.col("user_id").cast("string"),
            F.round(F.col("value") * 100).cast("bigint").cast("string"),
            F.col("event_id").cast("string"),
        ).alias("value"),
        F.concat(F.lit("pagecounts-"), F.date_format("ts", "yyyyMMdd-HHmmss")).alias("file_name"),
    )


_VIEWS_SQL = """
  SELECT {hour} AS hour, CAST(user_id AS VARCHAR) AS title,
         CAST(round(value * 100) AS BIGINT) AS views
  FROM events
  WHERE event_type = 'view' AND CAST(user_id AS VARCHAR) <> '0'
    AND NOT starts_with(CAST(user_id AS VARCHAR), '14')
"""
_V5 = _VIEWS_SQL.format(hour="strftime(ts, '%Y%m%d-%H') || '0000'")
_V4 = _VIEWS_SQL.format(hour="strftime(ts, '%Y%m%d-%H')")


@query(
    "q01_word_count",
    r"""
    SELECT word, CAST(count(*) AS BIGINT) AS n
    FROM (SELECT unnest(regexp_split_to_array(lower(text), '[[:punct:]\s]+')) AS word FROM documents)
    WHERE word <> ''
    GROUP BY word
    """,
)
def q01_word_count(spark: SparkSession, sf: str) -> DataFrame:
    return A.word_count(table(spark, sf, "documents", ["text"]), "text")


@query(
    "q02_numeric_tokens",
    r"""
    SELECT number, CAST(count(*) AS BIGINT) AS n, number * count(*) AS subtotal
    FROM (SELECT TRY_CAST(unnest(regexp_extract_all(text, '[+-]?\d+(\.\d+)?', 0)) AS DOUBLE) AS number
          FROM documents)
    WHERE number IS NOT NULL
    GROUP BY number
    """,
)
def q02_numeric_tokens(spark: SparkSession, sf: str) -> DataFrame:
    out = A.numeric_token_sums(table(spark, sf, "documents", ["text"]), "text")
    return out.select("number", "n", "subtotal")


@query(
    "q02_numeric_total",
    r"""
    WITH s AS (SELECT CAST(count(*) AS BIGINT) AS n_numbers, sum(number) AS t
               FROM (SELECT TRY_CAST(unnest(regexp_extract_all(text, '[+-]?\d+(\.\d+)?', 0)) AS DOUBLE) AS number
                     FROM documents)
               WHERE number IS NOT NULL)
    SELECT n_numbers,
           CASE WHEN t = 0 THEN 0.0
                WHEN 11 - floor(log10(abs(t))) >= 0
                  THEN round(t * pow(10.0, 11 - floor(log10(abs(t))))) / pow(10.0, 11 - floor(log10(abs(t))))
                ELSE round(t / pow(10.0, floor(log10(abs(t))) - 11)) * pow(10.0, floor(log10(abs(t))) - 11) END AS total
    FROM s
    """,
)
def q02_numeric_total(spark: SparkSession, sf: str) -> DataFrame:
    out = A.numeric_token_total(table(spark, sf, "documents", ["text"]), "text")
    return out.select("n_numbers", round_significant("total", 12).alias("total"))


@query("q03_max_views_per_hour", f"SELECT hour, max(views) AS max_views FROM ({_V5}) GROUP BY hour")
def q03_max_views_per_hour(spark: SparkSession, sf: str) -> DataFrame:
    counts = P.wanted_pages(P.parse_counts5(count_lines5(spark, sf)), LANG, EXCLUDE_TITLE, EXCLUDE_PREFIX)
    return P.max_views_per_hour(counts)


@query(
    "q04_top_page_per_hour",
    f"""
    WITH v AS ({_V5}), m AS (SELECT hour, max(views) AS views FROM v GROUP BY hour)
    SELECT m.hour, m.views, max(v.title) AS title
    FROM m JOIN v ON v.hour = m.hour AND v.views = m.views
    GROUP BY m.hour, m.views
    """,
)
def q04_top_page_per_hour(spark: SparkSession, sf: str) -> DataFrame:
    counts = P.wanted_pages(P.parse_counts5(count_lines5(spark, sf)), LANG, EXCLUDE_TITLE, EXCLUDE_PREFIX)
    return P.top_page_per_hour(counts)


_TIES_SQL = f"""
    WITH v AS ({_V4}), m AS (SELECT hour, max(views) AS views FROM v GROUP BY hour)
    SELECT v.hour, v.title, v.views FROM v JOIN m ON v.hour = m.hour AND v.views = m.views
"""


def _top_pages(spark: SparkSession, sf: str, strategy: str) -> DataFrame:
    # other languages' lines go before the split; the parsed rows are written
    # once, and both the maximum and the join back read that copy
    lines = count_lines4(spark, sf).where(F.col("value").startswith(f"{LANG} "))
    counts = P.wanted_pages(P.parse_counts4(lines), LANG, EXCLUDE_TITLE, EXCLUDE_PREFIX)
    return P.top_pages_per_hour(counts, strategy=strategy, materialize_input=True)


@query("q05_top_pages_ties", _TIES_SQL)
def q05_top_pages_ties(spark: SparkSession, sf: str) -> DataFrame:
    return _top_pages(spark, sf, "auto")


@query("q06_top_pages_broadcast", _TIES_SQL)
def q06_top_pages_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    return _top_pages(spark, sf, "broadcast")


@query("q06_top_pages_merge", _TIES_SQL)
def q06_top_pages_merge(spark: SparkSession, sf: str) -> DataFrame:
    return _top_pages(spark, sf, "merge")


def event_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events", ["event_type", "value", "user_id"])
    return e.select(
        F.to_json(
            F.struct(
                F.col("event_type").alias("subreddit"),
                F.col("value").alias("score"),
                F.col("user_id").cast("string").alias("author"),
            )
        ).alias("value")
    )


def customer_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer", ["c_mktsegment", "c_acctbal", "c_name"])
    return c.select(
        F.to_json(
            F.struct(
                F.col("c_mktsegment").alias("subreddit"),
                F.col("c_acctbal").alias("score"),
                F.col("c_name").alias("author"),
            )
        ).alias("value")
    )


@query(
    "q07_average_from_json",
    "SELECT event_type AS subreddit, round(avg(value), 6) AS average FROM events GROUP BY event_type",
)
def q07_average_from_json(spark: SparkSession, sf: str) -> DataFrame:
    comments = J.pick_comments(event_json_lines(spark, sf), score_type="double")
    out = A.average_per_key(comments, "subreddit", "score", alias="average")
    return out.select("subreddit", F.round("average", 6).alias("average"))


@query(
    "q08_average_score",
    """
    SELECT o_orderpriority, round(avg(o_totalprice), 6) AS average_score
    FROM orders WHERE o_orderpriority IS NOT NULL AND o_totalprice IS NOT NULL
    GROUP BY o_orderpriority
    """,
)
def q08_average_score(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders", ["o_orderpriority", "o_totalprice"])
    out = A.average_per_key(o, "o_orderpriority", "o_totalprice", alias="average_score")
    return out.select("o_orderpriority", F.round("average_score", 6).alias("average_score"))


@query(
    "q08_average_score_json",
    """
    SELECT o_orderpriority AS subreddit, round(avg(o_totalprice), 6) AS average_score
    FROM orders GROUP BY o_orderpriority
    """,
)
def q08_average_score_json(spark: SparkSession, sf: str) -> DataFrame:
    """Typed JSON lines (explicit schema; wrong-typed fields become NULL and
    drop), as a JSON-lines scan with a declared schema does."""
    from pyspark.sql import types as T

    typed_schema = T.StructType([T.StructField("subreddit", T.StringType()), T.StructField("score", T.DoubleType())])
    o = table(spark, sf, "orders", ["o_orderpriority", "o_totalprice"])
    lines = o.select(
        F.to_json(F.struct(F.col("o_orderpriority").alias("subreddit"), F.col("o_totalprice").alias("score"))).alias("value")
    )
    typed = lines.select(F.from_json("value", typed_schema).alias("j")).select("j.*")
    out = A.average_per_key(typed, "subreddit", "score", alias="average_score")
    return out.select("subreddit", F.round("average_score", 6).alias("average_score"))


@query(
    "q09_etl_split",
    """
    SELECT c_mktsegment AS subreddit, CAST(trunc(c_acctbal) AS BIGINT) AS score, c_name AS author,
           CASE WHEN trunc(c_acctbal) > 0 THEN 'positive' ELSE 'negative' END AS bucket
    FROM customer
    WHERE c_mktsegment IS NOT NULL AND c_mktsegment <> '' AND contains(c_mktsegment, 'E')
    """,
)
def q09_etl_split(spark: SparkSession, sf: str) -> DataFrame:
    from quarry.operators.sinks import with_split

    comments = J.pick_comments(customer_json_lines(spark, sf), score_type="bigint")
    chosen = comments.where(F.col("subreddit").contains("E"))
    return with_split(chosen, F.col("score") > 0, "positive", "negative")


_REL_SQL = """
    WITH c AS (SELECT c_mktsegment AS subreddit, c_acctbal AS score, c_name AS author FROM customer
               WHERE c_mktsegment IS NOT NULL {extra}),
         a AS (SELECT subreddit, avg(score) AS av FROM c GROUP BY subreddit HAVING avg(score) > 0)
    SELECT round(c.score / a.av, 6) AS rel, c.author, c.subreddit FROM c JOIN a ON c.subreddit = a.subreddit
"""


def _comments_any(spark: SparkSession, sf: str) -> DataFrame:
    v = J.parse_objects(customer_json_lines(spark, sf))
    obj = F.col("v")
    return v.select(
        J.get(obj, "subreddit", "string").alias("subreddit"),
        J.get_or_default(obj, "score", "double", 0.0).alias("score"),
        F.when(~J.present(obj, "author"), F.lit("unknown")).otherwise(J.get(obj, "author", "string")).alias("author"),
    ).where(F.col("score").isNotNull())


@query("q10_relative_score", _REL_SQL.format(extra=""))
def q10_relative_score(spark: SparkSession, sf: str) -> DataFrame:
    out = relative_score(_comments_any(spark, sf), "subreddit", "score", "author", materialize_input=True)
    return out.select(F.round("rel", 6).alias("rel"), "author", "subreddit")


@query("q11_relative_score_broadcast", _REL_SQL.format(extra="AND c_mktsegment <> ''"))
def q11_relative_score_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    out = relative_score(
        _comments_any(spark, sf), "subreddit", "score", "author", drop_empty_group=True, strategy="broadcast", materialize_input=True
    )
    return out.select(F.round("rel", 6).alias("rel"), "author", "subreddit")
