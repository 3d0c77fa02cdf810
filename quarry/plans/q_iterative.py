"""Q15 (log load), Q19 (streaming regression), Q21-Q22 (shortest paths)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.text import parse_adjacency
from quarry.operators.graph import resumable_paths, shortest_path, shortest_paths
from quarry.operators.logs import log_rows
from quarry.operators.sinks import append_table, iteration_writer, write_text
from quarry.plans.registry import query
from quarry.session import scratch_path
from quarry.sources import read_lines, read_table, table
from quarry.streaming.regression import start_fit

# --- Q15: access-log lines derived from `pages` -------------------------------
URL_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)"
URL_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^#\s]*)"
LOG_EPOCH = "1995-08-01 00:00:00"


def page_log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One GET line per page: host and path from the URL, time = epoch +
    page_id seconds, bytes = the page's size in bytes."""
    p = table(spark, sf, "pages", ["page_id", "url", "html"])
    path = F.regexp_extract("url", URL_PATH, 1)
    ts = F.expr(f"timestampadd(SECOND, page_id, TIMESTAMP_NTZ'{LOG_EPOCH}')")
    line = F.concat(
        F.regexp_extract("url", URL_HOST, 1),
        F.lit(" - - ["),
        F.date_format(ts, "dd/MMM/yyyy:HH:mm:ss"),
        F.lit(' -0400] "GET '),
        F.when(path == "", F.lit("/")).otherwise(path),
        F.lit(' HTTP/1.0" 200 '),
        F.octet_length("html").cast("string"),
    )
    return p.select("page_id", line.alias("value"))


@query(
    "q15_log_load",
    r"""
    WITH p AS (SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1) AS host,
                      regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^#\s]*)', 1) AS path0,
                      TIMESTAMP '1995-08-01 00:00:00' + to_seconds(page_id) AS datetime,
                      CAST(strlen(html) AS BIGINT) AS bytes FROM pages),
         q AS (SELECT *, CASE WHEN path0 = '' THEN '/' ELSE path0 END AS path FROM p WHERE host <> '')
    SELECT host, datetime, path, bytes,
           sha256(concat_ws(chr(1), host, strftime(datetime, '%Y-%m-%d %H:%M:%S'), path,
                            CAST(bytes AS VARCHAR), CAST(page_id AS VARCHAR))) AS req_id
    FROM q
    """,
)
def q15_log_load(spark: SparkSession, sf: str) -> DataFrame:
    """Parse, append to a table from the tasks that parsed, and read the table
    back. A file sink needs no repartitioning."""
    rows = log_rows(page_log_lines(spark, sf), position="page_id")
    path = scratch_path(spark, "access_log_table")
    append_table(rows, "parquet", {"path": path})
    return read_table(spark, "parquet", {"path": path})


@query(
    "q15_log_occurrences",
    r"""
    WITH p AS (SELECT lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)) AS host,
                      TIMESTAMP '1995-08-01 00:00:00' AS datetime, '/' AS path,
                      CAST(strlen(html) // 500 AS BIGINT) AS bytes FROM pages),
         q AS (SELECT *, row_number() OVER (PARTITION BY host, bytes) AS k FROM p WHERE host <> '')
    SELECT host, datetime, path, bytes,
           sha256(concat_ws(chr(1), host, '1995-08-01 00:00:00', path, CAST(bytes AS VARCHAR), CAST(k AS VARCHAR))) AS req_id
    FROM q
    """,
)
def q15_log_occurrences(spark: SparkSession, sf: str) -> DataFrame:
    """Request ids without a position: many pages give the same line (host,
    one time, one path, size in half kilobytes), told apart by occurrence."""
    p = table(spark, sf, "pages", ["url", "html"])
    size = F.floor(F.octet_length("html") / 500).cast("string")
    line = F.concat(F.lower(F.regexp_extract("url", URL_HOST, 1)), F.lit(' - - [01/Aug/1995:00:00:00 -0400] "GET / HTTP/1.0" 200 '), size)
    return log_rows(p.select(line.alias("value")))


# --- Q19: streaming regression over `events` -----------------------------------
@query(
    "q19_stream_regression",
    """
    SELECT CAST(regr_count(value, user_id) AS BIGINT) AS n,
           round(regr_slope(value, user_id), 6) AS slope,
           round(regr_intercept(value, user_id), 6) AS intercept
    FROM events
    """,
)
def q19_stream_regression(spark: SparkSession, sf: str) -> DataFrame:
    """`events` read as a file stream; each row becomes an ``x y`` line
    (x = user_id, y = value); the fit runs as a stateful streaming
    aggregate with a checkpoint, and every epoch overwrites a Parquet
    summary (the cluster-safe sink), which is returned."""
    schema = table(spark, sf, "events").schema
    stream = (
        # a glob, so that the table may be one file or a folder of part files
        spark.readStream.schema(schema).parquet(f"{sf.rstrip('/')}/events.parque[t]")
        .select(F.concat_ws(" ", F.col("user_id").cast("string"), F.col("value").cast("string")).alias("value"))
    )
    out = scratch_path(spark, "q19_fit")

    def publish(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    # the fit of no points, in case no batch ever runs
    publish(spark.createDataFrame([(0, None, None)], "n bigint, slope double, intercept double"), -1)

    q = start_fit(stream, scratch_path(spark, "q19_state"), sink="foreach", on_batch=publish, available_now=True)
    q.awaitTermination()
    fit = spark.read.parquet(out)
    return fit.select("n", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


# --- Q21-Q22: shortest paths over a part graph ------------------------------------
# Edge a -> b when part b is on the line right after part a's line in one order.
SOURCE_PART = 1


def part_edges(spark: SparkSession, sf: str) -> DataFrame:
    """One scan and one shuffle: the parts on an order's next line by a range
    window over the few lines an order has."""
    li = table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey"])
    following = Window.partitionBy("l_orderkey").orderBy("l_linenumber").rangeBetween(1, 1)
    after = F.collect_set("l_partkey").over(following)
    pairs = li.select(F.col("l_partkey").alias("src"), after.alias("after")).select("src", F.explode("after").alias("dst"))
    return pairs.distinct().withColumn("weight", F.lit(1.0))


_GRAPH_SQL = """
    edges AS (SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst
              FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1),
    best(node, dist) USING KEY (node) AS (
        SELECT CAST(1 AS BIGINT), 0
        UNION
        SELECT e.dst, min(r.dist) + 1 FROM best r JOIN edges e ON e.src = r.node
        WHERE e.dst NOT IN (SELECT node FROM recurring.best) GROUP BY e.dst),
    prevs AS (SELECT b.node, b.dist, min(e.src) AS prev
              FROM best b LEFT JOIN (edges e JOIN best p ON p.node = e.src) ON e.dst = b.node AND p.dist = b.dist - 1
              GROUP BY b.node, b.dist)
"""


def part_distances(spark: SparkSession, sf: str) -> DataFrame:
    return shortest_paths(part_edges(spark, sf), SOURCE_PART)


@query(
    "q21_shortest_distances",
    f"WITH RECURSIVE {_GRAPH_SQL} SELECT node, CAST(dist AS DOUBLE) AS dist, prev FROM prevs",
)
def q21_shortest_distances(spark: SparkSession, sf: str) -> DataFrame:
    return part_distances(spark, sf).select("node", "dist", "prev")


@query(
    "q22_shortest_path",
    f"""
    WITH RECURSIVE {_GRAPH_SQL},
    tgt AS (SELECT min(node) AS node FROM best WHERE dist = (SELECT max(dist) FROM best)),
    walk(node, prev, k) AS (SELECT p.node, p.prev, 0 FROM prevs p JOIN tgt ON p.node = tgt.node
                            UNION ALL SELECT p.node, p.prev, w.k + 1 FROM walk w JOIN prevs p ON p.node = w.prev)
    SELECT CAST((SELECT max(k) FROM walk) - k AS BIGINT) AS step, node FROM walk
    """,
)
def q22_shortest_path(spark: SparkSession, sf: str) -> DataFrame:
    """Path to the farthest reached part (smallest id among the farthest)."""
    dist = part_distances(spark, sf)
    far = dist.agg(F.max(F.struct(F.col("dist"), (-F.col("node")).alias("neg"))).alias("m")).select(
        (-F.col("m.neg")).alias("node")
    )
    return shortest_path(dist, far)


@query(
    "q21_adjacency_text",
    """
    SELECT l_partkey AS src, CAST(l_suppkey AS BIGINT) AS dst, CAST(1 AS DOUBLE) AS weight, CAST(count(*) AS BIGINT) AS n
    FROM lineitem GROUP BY 1, 2
    """,
)
def q21_adjacency_text(spark: SparkSession, sf: str) -> DataFrame:
    """Adjacency files: a ``part: supplier supplier ...`` line for each order and
    part, with and without a blank before the colon, written and parsed back."""
    li = table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey"])
    by = li.groupBy("l_orderkey", "l_partkey").agg(F.collect_list(F.col("l_suppkey").cast("string")).alias("to"))
    colon = F.when(F.col("l_orderkey") % 2 == 0, ": ").otherwise(" : ")
    path = scratch_path(spark, "adjacency")
    write_text(by.select(F.concat(F.col("l_partkey").cast("string"), colon, F.array_join("to", " ")).alias("value")), path)
    return parse_adjacency(read_lines(spark, path)).groupBy("src", "dst", "weight").agg(F.count(F.lit(1)).alias("n"))


# --- G3, G5, K5: the capped search with a file set for each iteration -----------
CAP = 6


def capped_search(spark: SparkSession, sf: str, cap: int = CAP, trace: str | None = None) -> DataFrame:
    """Half of the passes by one call, the others by a second one that finds the
    first one's folders, as a new driver would."""
    folder, edges = scratch_path(spark, "capped"), part_edges(spark, sf)
    write = iteration_writer(trace, ["node", "dist", "prev"]) if trace else None
    resumable_paths(edges, SOURCE_PART, folder, cap // 2, write)
    return resumable_paths(edges, SOURCE_PART, folder, cap, write)


_CAPPED_SQL = _GRAPH_SQL.replace("WHERE e.dst NOT IN", "WHERE r.dist < {cap} AND e.dst NOT IN")


@query(
    "q21_capped_search",
    f"WITH RECURSIVE {_CAPPED_SQL.format(cap=CAP)} SELECT node, CAST(dist AS DOUBLE) AS dist, prev, dist = {CAP} AS open FROM prevs",
)
def q21_capped_search(spark: SparkSession, sf: str) -> DataFrame:
    """At most six passes; nodes of the last one are open."""
    return capped_search(spark, sf).select("node", "dist", "prev", "open")


@query(
    "q21_iteration_files",
    f"""
    WITH RECURSIVE {_CAPPED_SQL.format(cap=CAP)}
    SELECT CAST(i AS INTEGER) AS iter, node, CAST(dist AS DOUBLE) AS dist, coalesce(prev, -1) AS prev
    FROM prevs, generate_series(0, (SELECT max(dist) FROM prevs)) AS s(i) WHERE dist <= i
    """,
)
def q21_iteration_files(spark: SparkSession, sf: str) -> DataFrame:
    """The state after every pass as CSV files (no value: -1), read back with the
    number of their folder."""
    trace = scratch_path(spark, "iterations")
    capped_search(spark, sf, trace=trace)
    state = spark.read.schema("node bigint, dist double, prev bigint").csv(f"{trace}/iter-*")
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/iter-(\d+)/", 1).cast("int")
    return state.select(number.alias("iter"), "node", "dist", "prev")


@query(
    "q22_capped_paths",
    f"""
    WITH RECURSIVE {_CAPPED_SQL.format(cap=2)},
    tgt AS (SELECT min(node) AS node FROM best WHERE dist = (SELECT max(dist) FROM best)),
    walk(node, prev, k) AS (SELECT p.node, p.prev, 0 FROM prevs p JOIN tgt ON p.node = tgt.node
                            UNION ALL SELECT p.node, p.prev, w.k + 1 FROM walk w JOIN prevs p ON p.node = w.prev)
    SELECT 'reached' AS target, CAST((SELECT max(k) FROM walk) - k AS BIGINT) AS step, node FROM walk
    """,
)
def q22_capped_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Paths after two passes: to the farthest node reached, and to the smallest
    part that is not reached, which has no rows."""
    dist = capped_search(spark, sf, cap=2)
    far = dist.agg(F.max(F.struct(F.col("dist"), (-F.col("node")).alias("neg"))).alias("m")).select((-F.col("m.neg")).alias("node"))
    parts = table(spark, sf, "part", ["p_partkey"]).select(F.col("p_partkey").alias("node"))
    none = parts.join(dist, "node", "left_anti").agg(F.min("node").alias("node")).where("node IS NOT NULL")
    paths = [shortest_path(dist, t).select(F.lit(name).alias("target"), "step", "node") for name, t in (("reached", far), ("not reached", none))]
    return paths[0].unionByName(paths[1])
