"""Keyed tables in the shared store, changed in place by buckets of the key.

A table is a folder of Parquet files partitioned by ``_bucket``, a hash of the
key. Applying changes reads and writes the buckets they touch and no others:
Spark overwrites just those partitions (dynamic overwrite), so the files of all
other buckets stay as they are. A change is (key, the columns it sets, order);
the rules are those of ``keyed.upsert``.

The new buckets are first written to the shared scratch folder, then moved in by
Spark's committer, bucket by bucket. A driver that is lost in between leaves
some buckets old and some new; applying the same changes again, from the
caller's own copy of them, sets the same values and ends in the same table.

A hot key is one row of the table; its changes are reduced in every task before
they meet. Buckets bound what a change costs: choose them so that one is read
and written in a few seconds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.common import as_list
from quarry.operators.keyed import change_rows, upsert
from quarry.session import delete_path, materialize, release

BUCKET = "_bucket"
BUCKETS = 64


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


class KeyedTable:
    """A keyed table in folder ``path``: one row for each value of ``key``.

    ``schema`` holds the key and value columns; it and ``buckets`` have to be the
    same each time the table is opened. A folder without files is an empty table.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, key: str | Sequence[str], buckets: int = BUCKETS):
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), as_list(key), buckets
        self.columns = schema.names
        self.values = [c for c in self.columns if c not in self.key]
        self.stored = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])

    def _exists(self) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def read(self, buckets: Sequence[int] | None = None, where: Column | None = None) -> DataFrame:
        """The rows, of some buckets only if given (partitions pruned). The frame
        reads the files as they are now; read again after a change."""
        if not self._exists():
            return self.spark.createDataFrame([], self.stored).select(self.columns)
        rows = self.spark.read.schema(self.stored).parquet(self.path)
        if buckets is not None:
            rows = rows.where(F.col(BUCKET).isin(list(buckets)))
        if where is not None:
            rows = rows.where(where)
        return rows.select(self.columns)

    def lookup(self, *values) -> DataFrame:
        """The row of one key: a single bucket is read."""
        lits = [F.lit(v).cast(self.stored[k].dataType) for k, v in zip(self.key, values)]
        rows = self.read(where=F.col(BUCKET) == F.pmod(F.xxhash64(*lits), F.lit(self.buckets)))  # a constant: partitions are pruned
        for k, v in zip(self.key, lits):
            rows = rows.where(F.col(k).eqNullSafe(v))
        return rows

    def _write(self, rows: DataFrame) -> None:
        """Overwrite the buckets that ``rows`` has; a bucket is one sorted file,
        or several if it is large."""
        rows = rows.withColumn(BUCKET, bucket_of(self.key, self.buckets))
        rows = rows.repartitionByRange(BUCKET, *self.key).sortWithinPartitions(BUCKET, *self.key)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)

    def apply(self, changes: DataFrame) -> list[int]:
        """Insert and update by the change rows of ``keyed.change_rows``; returns
        the buckets that were rewritten (at most ``buckets`` numbers)."""
        changes = materialize(changes, "changes")
        touched = sorted(r[0] for r in changes.select(bucket_of(self.key, self.buckets)).distinct().collect())
        if touched:
            merged = materialize(upsert(self.read(touched), changes, self.key, self.values).select(self.columns), "merged")
            self._write(merged)
            release(merged)
        release(changes)
        return touched

    def insert(self, rows: DataFrame) -> list[int]:
        """Whole rows; an existing key is replaced. Of rows with one key that with
        the greatest values stays, whatever order they arrive in."""
        return self.apply(change_rows(rows.select(self.columns), self.values, F.struct(*self.values) if self.values else F.lit(0)))

    def truncate(self) -> None:
        """Remove all rows; the table stays."""
        if self._exists():
            delete_path(self.spark, self.path)
        self.spark.createDataFrame([], self.stored).select(self.columns).write.parquet(self.path)


def create_view(table: DataFrame, name: str, flag: Column, alias: str) -> None:
    """``CREATE OR REPLACE`` a temporary view of the table with a derived flag."""
    table.withColumn(alias, flag).createOrReplaceTempView(name)
