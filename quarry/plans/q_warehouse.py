"""Q23-Q26 (warehouse SQL), Q35-Q38 (keyed operations, layout, sinks)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.json import path_text
from quarry.operators import warehouse as W
from quarry.operators.keyed import latest_per_key, upsert
from quarry.plans.registry import query
from quarry.session import scratch_path
from quarry.sources import read_csv, read_json, read_lines, table

# Roles on the driver tables: purchases = orders (custid = o_custkey,
# amount = o_totalprice); province = the customer's region name; payment
# method = market segment; postal prefix = characters 17-18 of c_name;
# area prefixes = two-digit nation keys.
HOME_PROVINCE = "AMERICA"
# --- fixed values: region labels of the spend report ---
IN_AREA, HOME_NOT_AREA, OUTSIDE_HOME = "From_Van", "From_BC_non_Van", "From_out_BC"


def customers(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    n = table(spark, sf, "nation", ["n_nationkey", "n_regionkey"])
    r = table(spark, sf, "region", ["r_regionkey", "r_name"])
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, F.col("n_regionkey") == r.r_regionkey)
        .select(
            F.col("c_custkey").alias("custid"),
            F.col("r_name").alias("province"),
            F.col("c_name").alias("postalcode"),
            F.col("c_mktsegment").alias("mtype"),
        )
    )


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders", ["o_custkey", "o_totalprice", "o_orderdate"])
    return o.select(F.col("o_custkey").alias("custid"), F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("pdate"))


def area_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation", ["n_nationkey"]).select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("pcprefix")
    )


def area_customers(spark: SparkSession, sf: str) -> DataFrame:
    """The area-flag view: ``(custid, in_area)``."""
    cust = table(spark, sf, "customer", ["c_custkey", "c_name"]).select(
        F.col("c_custkey").alias("custid"), F.col("c_name").alias("postalcode")
    )
    return W.area_flags(cust, area_prefixes(spark, sf), F.substring("postalcode", 17, 2))


_AREA_SQL = """
    area_prefix AS (SELECT DISTINCT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS two FROM nation),
    customer_area AS (SELECT c_custkey, CAST(two IS NOT NULL AS INTEGER) AS in_area
                      FROM customer LEFT JOIN area_prefix ON two = substring(c_name, 17, 2))
"""


@query(
    "q23_payment_average",
    """
    SELECT c.c_mktsegment AS payment_method, round(avg(o.o_totalprice), 6) AS average_amount
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
    WHERE r.r_name = 'AMERICA'
    GROUP BY c.c_mktsegment
    """,
)
def q23_payment_average(spark: SparkSession, sf: str) -> DataFrame:
    # Customers of the province first (small), then the big purchases join.
    local = customers(spark, sf).where(F.col("province") == HOME_PROVINCE).select("custid", "mtype")
    out = purchases(spark, sf).join(local, "custid").groupBy(F.col("mtype").alias("payment_method")).agg(
        F.avg("amount").alias("average_amount")
    )
    return out.select("payment_method", F.round("average_amount", 6).alias("average_amount"))


@query(
    "q24_spend_by_region",
    f"""
    WITH {_AREA_SQL},
    cust AS (SELECT c.c_custkey AS custid, r.r_name AS province FROM customer c
             JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)
    SELECT CASE WHEN customer_area.in_area = 1 THEN '{IN_AREA}'
                WHEN customer_area.in_area = 0 AND cust.province = '{HOME_PROVINCE}' THEN '{HOME_NOT_AREA}'
                WHEN cust.province <> '{HOME_PROVINCE}' THEN '{OUTSIDE_HOME}' END AS region,
           CAST(count(o.o_custkey) AS BIGINT) AS number_of_purchases,
           round(avg(o.o_totalprice), 4) AS average_of_purchase,
           round(median(o.o_totalprice), 4) AS median_of_purchase
    FROM cust JOIN orders o ON cust.custid = o.o_custkey JOIN customer_area ON cust.custid = customer_area.c_custkey
    GROUP BY 1
    """,
)
def q24_spend_by_region(spark: SparkSession, sf: str) -> DataFrame:
    # one customer scan: region and area flag together
    cust = W.area_flags(
        customers(spark, sf), area_prefixes(spark, sf), F.substring("postalcode", 17, 2), keep=["province"]
    )
    label = (
        F.when(F.col("in_area") == 1, IN_AREA)
        .when((F.col("in_area") == 0) & (F.col("province") == HOME_PROVINCE), HOME_NOT_AREA)
        .when(F.col("province") != HOME_PROVINCE, OUTSIDE_HOME)
    )
    out = W.spend_by_label(purchases(spark, sf).join(cust, "custid"), label)
    return out.select(
        "region",
        "number_of_purchases",
        F.round("average_of_purchase", 4).alias("average_of_purchase"),
        F.round("median_of_purchase", 4).alias("median_of_purchase"),
    )


# --- fixed values: the item selection standing in for "restaurant serving sushi" ---
ITEM_TYPE = "PROMO"
ITEM_PATTERNS = ["%ring%", "%gear%", "%bolt%"]

_ITEMS_SQL = """
    items AS (SELECT p_partkey AS amenid FROM part WHERE p_type = 'PROMO'
              AND (lower(p_name) LIKE '%ring%' OR lower(p_name) LIKE '%gear%' OR lower(p_name) LIKE '%bolt%'))
"""
_CATEGORY_SQL = f"""
    WITH {_AREA_SQL}, {_ITEMS_SQL}
    SELECT customer_area.in_area, round(avg(l.l_extendedprice), 6) AS average_amount
    FROM lineitem l JOIN items ON l.l_partkey = items.amenid
    JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer_area ON customer_area.c_custkey = o.o_custkey
    GROUP BY customer_area.in_area
"""


def selected_items(spark: SparkSession, sf: str) -> DataFrame:
    """Items as amenities with a JSON ``tags`` column; select by type and by
    patterns on the nested ``tags.cuisine`` field."""
    p = table(spark, sf, "part", ["p_partkey", "p_type", "p_name"])
    amen = p.select(
        F.col("p_partkey").alias("amenid"),
        F.col("p_type").alias("amenity"),
        F.to_json(F.struct(F.col("p_name").alias("cuisine"))).alias("tags"),
    )
    return amen.where((F.col("amenity") == ITEM_TYPE) & W.like_any(path_text("tags", "$.cuisine"), ITEM_PATTERNS))


def _category(spark: SparkSession, sf: str, form: str) -> DataFrame:
    li = table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_extendedprice"]).select(
        "l_orderkey", F.col("l_partkey").alias("amenid"), F.col("l_extendedprice").alias("amount")
    )
    orders = table(spark, sf, "orders", ["o_orderkey", "o_custkey"]).select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("custid")
    )
    out = W.category_spend(li, area_customers(spark, sf), selected_items(spark, sf), form=form, link=orders, link_on="l_orderkey")
    return out.select("in_area", F.round("average_amount", 6).alias("average_amount"))


@query("q25_category_spend", _CATEGORY_SQL)
def q25_category_spend(spark: SparkSession, sf: str) -> DataFrame:
    return _category(spark, sf, "join")


@query("q25_category_spend_distinct", _CATEGORY_SQL)
def q25_category_spend_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return _category(spark, sf, "distinct")


@query(
    "q26_average_per_day",
    """
    SELECT CAST(o_orderdate AS DATE) AS pdate, round(avg(o_totalprice), 6) AS average_amount
    FROM orders WHERE month(o_orderdate) = 8 AND day(o_orderdate) BETWEEN 1 AND 5
    GROUP BY 1
    """,
)
def q26_average_per_day(spark: SparkSession, sf: str) -> DataFrame:
    out = W.average_per_day(purchases(spark, sf), "pdate", "amount", month=8, first_day=1, last_day=5)
    return out.select("pdate", F.round("average_amount", 6).alias("average_amount"))


# --- Q35: keyed upsert -------------------------------------------------------------
# Change rows from `events`: a click sets only `value`; any other event sets
# both `event_type` and `value`.  Order = (ts, event_id).
SPLIT_TS = "2024-01-16 00:00:00"


def event_changes(events: DataFrame) -> DataFrame:
    sets = F.when(F.col("event_type") == "click", F.array(F.lit("value"))).otherwise(
        F.array(F.lit("event_type"), F.lit("value"))
    )
    return events.select(
        "user_id",
        "event_type",
        "value",
        sets.alias("_set"),
        F.struct("ts", "event_id").alias("_seq"),
    )


UPSERT_SQL = """
    WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events),
         typed AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
                   FROM events WHERE event_type <> 'click')
    SELECT r.user_id, t.event_type, r.value
    FROM ranked r LEFT JOIN typed t ON r.user_id = t.user_id AND t.rn = 1
    WHERE r.rn = 1
    """


@query("q35_upsert", UPSERT_SQL)
def q35_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """State after the first half of the month, then the second half applied
    as an upsert: equal to applying all changes at once."""
    e = table(spark, sf, "events", ["user_id", "event_type", "value", "ts", "event_id"])
    first = event_changes(e.where(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz")))
    second = event_changes(e.where(F.col("ts") >= F.lit(SPLIT_TS).cast("timestamp_ntz")))
    empty = spark.createDataFrame([], first.select("user_id", "event_type", "value").schema)
    base = upsert(empty, first, "user_id", ["event_type", "value"])
    return upsert(base, second, "user_id", ["event_type", "value"])


@query(
    "q35_latest_event",
    """
    SELECT user_id, event_type, value, ts, event_id FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1
    """,
)
def q35_latest_event(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events", ["user_id", "event_type", "value", "ts", "event_id"])
    return latest_per_key(e, "user_id", ["ts", "event_id"], ["event_type", "value", "ts", "event_id"])


_ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@query("q36_key_lookup", f"SELECT {_ORDER_COLS} FROM orders WHERE o_orderkey IN (1, 2, 3, 5, 8, 13)")
def q36_key_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").where(F.col("o_orderkey").isin(1, 2, 3, 5, 8, 13)).select(*_ORDER_COLS.split(", "))


@query(
    "q36_nonkey_filter",
    f"SELECT {_ORDER_COLS} FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'",
)
def q36_nonkey_filter(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")).select(
        *_ORDER_COLS.split(", ")
    )


# --- Q37: partition-pruned layout -------------------------------------------------
def write_partitioned_events(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "events_by_type")
    table(spark, sf, "events").write.mode("overwrite").partitionBy("event_type").parquet(path)
    return path


@query(
    "q37_partition_pruned",
    "SELECT event_id, ts, user_id, value, props, event_type FROM events WHERE event_type = 'click'",
)
def q37_partition_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """Write `events` partitioned by type, then scan one type: the plan
    carries ``PartitionFilters`` and only that directory is read."""
    path = write_partitioned_events(spark, sf)
    return spark.read.parquet(path).where(F.col("event_type") == "click").select(
        "event_id", "ts", "user_id", "value", "props", "event_type"
    )


# --- Q38: sink round trips --------------------------------------------------------
@query("q38_json_gzip_roundtrip", f"SELECT {_ORDER_COLS} FROM orders")
def q38_json_gzip_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    from quarry.operators.sinks import write_json

    o = table(spark, sf, "orders").select(*_ORDER_COLS.split(", "))
    path = scratch_path(spark, "orders_json")
    write_json(o, path, compression="gzip")
    return read_json(spark, path, o.schema)


@query("q38_csv_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q38_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    from quarry.operators.sinks import write_csv

    c = table(spark, sf, "customer")
    path = scratch_path(spark, "customer_csv")
    write_csv(c, path, header=True)
    return read_csv(spark, path, c.schema, header=True)


@query("q38_text_roundtrip", "SELECT CAST(c_custkey AS VARCHAR) || chr(9) || c_name AS value FROM customer")
def q38_text_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    from quarry.operators.sinks import delimited_lines, write_text

    c = table(spark, sf, "customer", ["c_custkey", "c_name"])
    path = scratch_path(spark, "customer_text")
    write_text(delimited_lines(c, ["c_custkey", "c_name"]), path)
    return read_lines(spark, path)
