"""Sinks: formatted text lines, JSON (optionally gzip), CSV with header,
split output, appends to external tables, per-iteration traces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_split(df: DataFrame, condition: Column, when_true: str, when_false: str, column: str = "bucket") -> DataFrame:
    """Tag each row with one of two bucket names (e.g. positive/negative)."""
    return df.withColumn(column, F.when(condition, F.lit(when_true)).otherwise(F.lit(when_false)))


def write_split(df: DataFrame, path: str, column: str = "bucket", fmt: str = "json", mode: str = "overwrite") -> None:
    """Two (or more) outputs in one job: ``path/bucket=positive/...`` etc.
    One scan and one write instead of a cached input read twice."""
    df.write.mode(mode).partitionBy(column).format(fmt).save(path)


def format_lines(df: DataFrame, template: str, columns: Sequence[str]) -> DataFrame:
    """``value`` lines made with ``format_string`` (e.g. ``'%s %d'``)."""
    return df.select(F.format_string(template, *[F.col(c) for c in columns]).alias("value"))


def delimited_lines(df: DataFrame, columns: Sequence[str], sep: str = "\t", null_as: str = "-1") -> DataFrame:
    """``value`` lines joining columns with a separator; NULL written as ``null_as``."""
    return df.select(
        F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit(null_as)) for c in columns]).alias("value")
    )


def write_text(lines: DataFrame, path: str, mode: str = "errorifexists", compression: str | None = None) -> None:
    """Text sink of a single string column.  Default mode fails when the path
    exists, like ``saveAsTextFile``."""
    w = lines.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    df.write.mode(mode).option("header", header).csv(path)


def write_ranged(df: DataFrame, path: str, folder: str, fmt: str = "text", mode: str = "errorifexists") -> None:
    """One folder for each value of the column ``folder``. Tasks get ranges of it
    (and of a hash of the row, so that a hot value is shared), so that a task
    writes few folders and a folder has few files."""
    rest = F.xxhash64(*[F.col(c) for c in df.columns])
    df.repartitionByRange(folder, rest).write.mode(mode).partitionBy(folder).format(fmt).save(path)


def name_files(spark, path: str, name) -> list[str]:
    """Rename the data files below ``path`` to ``name(folder, k)``, k counting
    a folder's files, and return the new paths.  For layouts whose file names
    mean something; the driver renames, so write ranges of the folder's column
    (``write_ranged``): then there are no more files than folders and tasks."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for folder in fs.listStatus(root):
        if folder.isDirectory():
            at = folder.getPath()
            parts = [f.getPath() for f in fs.listStatus(at) if f.getPath().getName().startswith("part-")]
            for k, part in enumerate(parts):
                new = spark._jvm.org.apache.hadoop.fs.Path(at, name(at.getName(), k))
                fs.rename(part, new)
                out.append(new.toString())
    return out


def write_single_file(df: DataFrame, path: str, fmt: str = "text", mode: str = "overwrite") -> None:
    """One output file: only for results known to be tiny (a path, a
    summary row).  Never for data that grows with the input."""
    df.coalesce(1).write.mode(mode).format(fmt).save(path)


def append_table(df: DataFrame, fmt: str, options: dict[str, str], spread: int | None = None) -> None:
    """Append to an external table through a data-source format.

    ``spread`` deals the rows round-robin to so many writers first, for a
    store that wants a certain number of connections; never by a key, which
    would put a hot one on a single writer.
    """
    if spread:
        df = df.repartition(spread)
    df.write.format(fmt).options(**options).mode("append").save()


def write_clustered(df: DataFrame, path: str, partition_key: Sequence[str], order: Sequence[str], fmt: str = "parquet",
                    mode: str = "overwrite", partitions: int | None = None) -> None:
    """Layout like a wide-column table: rows of one partition key together,
    sorted by the clustering columns.  Files hold ranges of (key, clustering
    columns), so a hot key is shared by several writers in order."""
    by = [*partition_key, *order]
    out = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    out.sortWithinPartitions(*by).write.mode(mode).format(fmt).save(path)


def iteration_writer(path: str, columns: Sequence[str], fmt: str = "csv"):
    """A ``trace`` callback for iterative jobs: writes the state of pass ``i``
    to ``path/iter-i`` (NULLs written as -1 in text formats)."""

    def write(i: int, state: DataFrame) -> None:
        out = state.select(*[F.coalesce(F.col(c).cast("string"), F.lit("-1")).alias(c) for c in columns])
        out.write.mode("overwrite").format(fmt).save(f"{path}/iter-{i}")

    return write
