"""Single-source shortest paths by repeated relaxation (iterated joins), and
path reconstruction by joins along the ``prev`` links.

Nothing about the graph passes through the driver: the loop only asks
whether a pass improved anything.  A pass writes the improved rows only, as
Parquet in the shared checkpoint folder: the lineage is cut and they survive
the loss of executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import materialize, release
from quarry.sources.schemas import PATH_STATE

STATE = T.StructType(
    PATH_STATE.fields
    + [T.StructField("hops", T.IntegerType(), False), T.StructField("open", T.BooleanType(), False)]
)
COMPACT_EVERY = 8


def _best(passes: list[DataFrame]) -> DataFrame:
    """The shortest row of each node.  A later pass holds a node only if it
    is strictly shorter there, so the least distance is the latest row."""
    rows = passes[0]
    for p in passes[1:]:
        rows = rows.unionByName(p)
    best = rows.groupBy("node").agg(F.min(F.struct("dist", "prev", "hops")).alias("b"))
    return best.select("node", "b.dist", "b.prev", "b.hops")


def _improved(frontier: DataFrame, e: DataFrame, known: DataFrame) -> DataFrame:
    """Neighbours of the frontier that are new or strictly shorter than known,
    each with its shortest candidate and, on a tie, the smallest predecessor."""
    cand = frontier.join(e, frontier["node"] == e["src"]).select(
        e["dst"].alias("node"),
        (frontier["dist"] + e["weight"]).alias("dist"),
        frontier["node"].alias("prev"),
        (frontier["hops"] + 1).alias("hops"),
    )
    best = cand.groupBy("node").agg(F.min(F.struct("dist", "prev", "hops")).alias("b"))
    better = best.join(known.select("node", F.col("dist").alias("old")), "node", "left")
    better = better.where(F.col("old").isNull() | (F.col("b.dist") < F.col("old")))
    return better.select("node", "b.dist", "b.prev", "b.hops")


def shortest_paths(
    edges: DataFrame,
    source: int,
    max_iters: int | None = None,
    trace=None,
) -> DataFrame:
    """``(node, dist, prev, hops, open)`` for every node reached from ``source``.

    * a pass joins the frontier (nodes improved in the previous pass) with
      the edges on ``src``, keeps per node ``min(struct(dist, prev))`` -- the
      shortest candidate, the smallest predecessor on a tie -- and keeps the
      candidates that are new or strictly shorter: the next frontier;
    * the search ends when a pass improves nothing;
    * ``prev`` is NULL for the source;
    * ``max_iters`` cuts the search after so many passes.  Nodes on the last
      frontier are then ``open``: their neighbours were not looked at.  If no
      row is open, the result is complete.

    The edges are written once, in no fixed buckets: a small frontier is
    broadcast by AQE and never shuffles them, and a hub's edges are split by
    its skew join otherwise.  Candidates are pre-reduced in every task.

    ``trace`` (optional) is called with ``(pass_number, state)`` after each
    pass, e.g. to write the state per iteration.
    """
    spark: SparkSession = edges.sparkSession
    e = materialize(
        edges.select(F.col("src").cast("bigint"), F.col("dst").cast("bigint"), F.col("weight").cast("double")), "sssp-edges"
    )
    frontier = spark.createDataFrame([(int(source), 0.0, None, 0, True)], STATE).drop("open")
    passes = [frontier]
    if trace is not None:
        trace(0, frontier)
    i = 0
    while max_iters is None or i < max_iters:
        i += 1
        frontier = materialize(_improved(frontier, e, _best(passes)), f"sssp-pass-{i}")
        if frontier.isEmpty():
            release(frontier)
            frontier = None
            break
        passes.append(frontier)
        if len(passes) > COMPACT_EVERY:  # so that the plan of a pass stays small
            kept = materialize(_best(passes), "sssp-state")
            for p in passes[:-1]:
                release(p)
            passes = [kept, frontier]
        if trace is not None:
            trace(i, _best(passes))
    out = _best(passes)
    if frontier is None:
        out = out.withColumn("open", F.lit(False))
    else:
        last = frontier.select("node", "dist", F.lit(True).alias("open"))
        out = out.join(last, ["node", "dist"], "left").withColumn("open", F.coalesce("open", F.lit(False)))
    out = materialize(out.select("node", "dist", "prev", "hops", "open"), "sssp-distances")
    for p in [*passes, e]:
        release(p)
    return out


def _written(spark: SparkSession, path: str) -> bool:
    """Whether a job wrote this folder to its end."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def resumable_paths(edges: DataFrame, source: int, folder: str, max_iters: int | None = None, trace=None) -> DataFrame:
    """``shortest_paths`` whose passes stay in numbered folders below ``folder``
    (``edges``, ``pass-00000``, ``pass-00001``, ...), for searches that a driver may not
    live to the end of.

    A pass counts once Spark's committer has closed its folder. Called again
    with the same folder, by this or another driver, the search goes on after
    the last pass that counts; the edges are then those written first. A higher
    ``max_iters`` goes on from a capped search. A pass without rows ends it.
    Nothing is deleted; the caller owns the folder. ``trace`` is called for
    the passes that this call makes (and for pass 0 if it begins the search).
    """
    spark: SparkSession = edges.sparkSession
    rows = T.StructType([f for f in STATE.fields if f.name != "open"])

    def path(i: int) -> str:
        return f"{folder}/pass-{i:05d}"

    def written(i: int) -> DataFrame:
        return spark.read.schema(rows).parquet(path(i))

    if not _written(spark, f"{folder}/edges"):
        plain = edges.select(F.col("src").cast("bigint"), F.col("dst").cast("bigint"), F.col("weight").cast("double"))
        plain.write.mode("overwrite").parquet(f"{folder}/edges")
    e = spark.read.schema("src bigint, dst bigint, weight double").parquet(f"{folder}/edges")
    done = 0
    if not _written(spark, path(0)):
        spark.createDataFrame([(int(source), 0.0, None, 0)], rows).write.mode("overwrite").parquet(path(0))
        if trace is not None:
            trace(0, written(0))
    while _written(spark, path(done + 1)):
        done += 1
    ended = done > 0 and written(done).isEmpty()
    while not ended and (max_iters is None or done < max_iters):
        known = _best([spark.read.schema(rows).parquet(*[path(i) for i in range(done + 1)])])
        _improved(written(done), e, known).write.mode("overwrite").parquet(path(done + 1))
        done += 1
        ended = written(done).isEmpty()
        if trace is not None and not ended:
            trace(done, _best([spark.read.schema(rows).parquet(*[path(i) for i in range(done + 1)])]))
    out = _best([spark.read.schema(rows).parquet(*[path(i) for i in range(done + 1)])])
    if ended:
        return out.withColumn("open", F.lit(False))
    last = written(done).select("node", "dist", F.lit(True).alias("open"))
    return out.join(last, ["node", "dist"], "left").withColumn("open", F.coalesce("open", F.lit(False))).select("node", "dist", "prev", "hops", "open")


def shortest_path(dist: DataFrame, target: int | DataFrame) -> DataFrame:
    """``(step, node)`` along the path from the source to ``target``
    (``step`` 0 = the source).  Empty when the target was not reached.

    The walk follows ``prev`` back to the source, one hop per join with one
    row; every 8 hops that row is written out, which keeps the plans small
    and tells whether the source was reached.  ``target`` is a node id or a
    one-column DataFrame of at most one row.
    """
    spark = dist.sparkSession
    if isinstance(target, DataFrame):
        tgt = materialize(target.select(F.col(target.columns[0]).cast("bigint").alias("node")).limit(2), "sssp-target")
        if tgt.count() > 1:
            raise ValueError("the target must be one node")
    else:
        tgt = spark.range(1).select(F.lit(int(target)).cast("bigint").alias("node"))
    d = dist.select("node", "prev", "hops")
    parts = []
    while True:
        walk = cur = d.join(F.broadcast(tgt), "node")  # one row, as are the steps below
        for _ in range(7):
            cur = d.join(F.broadcast(cur.select(F.col("prev").alias("node")).where(F.col("node").isNotNull())), "node")
            walk = walk.unionByName(cur)
        walk = materialize(walk, "sssp-walk")
        parts.append(walk)
        tgt = walk.orderBy("hops").limit(1).select(F.col("prev").alias("node")).where(F.col("node").isNotNull())
        if tgt.isEmpty():
            break
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.col("hops").cast("bigint").alias("step"), "node")
