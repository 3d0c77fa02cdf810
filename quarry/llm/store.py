"""Files that tasks write and range-read in the shared folder.

Spark has no sink for plain binary files, so tasks open them through Arrow's
file systems by the URI of the shared folder (local mounts, HDFS, object
stores). A file gets a name of its own attempt; the manifest, written by
Spark's committer, lists only those of tasks that succeeded. A task that ran
twice, or whose executor was lost half-way, leaves a file nobody reads.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` as a URI or absolute path."""
    uri = scratch_path(spark, name)
    system, path = locate(uri)
    system.create_dir(path, recursive=True)
    return uri


def new_file(folder: str, stem: str, suffix: str) -> str:
    return f"{folder}/{stem}-{uuid.uuid4().hex[:12]}{suffix}"


def spread(manifest: DataFrame) -> DataFrame:
    """The files of a manifest, a task each as far as partitions go."""
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartitionById(n, F.pmod(F.col("part"), F.lit(n)).cast("int"))
