"""Session settings and the shared scratch location.

Library code never invents a machine-local folder on a cluster: scratch data
(checkpoints, written layouts, streaming state) goes under the directory the
cluster names in ``spark.checkpoint.dir``.  Only when that setting is absent
*and* the master is local (tests, laptops) do we create one under /tmp.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(
    app: str = "quarry",
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local SparkSession configured like the tests and the bench expect.

    ANSI mode stays on (the Spark 4 default); time zone is pinned to UTC so
    results agree with DuckDB; the web UI is off.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root, setting one only for local runs."""
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; on a cluster it must name a shared folder"
            )
        root = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root, deleted when
    the driver's JVM ends; ``delete_path`` deletes it sooner."""
    root = ensure_checkpoint_dir(spark)
    # getCheckpointDir() appends a per-application uuid folder; keep scratch
    # next to it so that all of a run's data lives in one shared place.
    path = os.path.join(root.rstrip("/"), "scratch", f"{name}-{uuid.uuid4().hex[:12]}")
    where, fs = _hadoop(spark, path)
    fs.deleteOnExit(where)
    return path


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store through Hadoop's file systems."""
    where, fs = _hadoop(spark, path)
    fs.delete(where, True)


def release(df) -> None:
    """Delete the files behind a table that ``materialize`` returned and that
    nothing reads any more."""
    path = getattr(df, "_quarry_path", None)
    if path:
        delete_path(df.sparkSession, path)


def materialize(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint root and read it
    back: one job, a reliable copy that survives lost executors, and a plan
    whose lineage starts at the written files (for iterative jobs)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._quarry_path = path
    return out
