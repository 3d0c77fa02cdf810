"""Readers.  All but ``read_json_inferred`` take an explicit schema."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One of the driver's Parquet tables, optionally projected: a plain
    pruned scan, the same plan at every size.

    Projection is declared up front so the Parquet ``ReadSchema`` holds only
    the needed columns even before Catalyst prunes.
    """
    raw = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return raw.select(*columns) if columns else raw


def register_tables(spark: SparkSession, sf_dir: str, names: Sequence[str] = DRIVER_TABLES, prefix: str = "") -> None:
    """Register the driver tables as temp views (for queries by table name)."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(f"{prefix}{name}")


def read_lines(
    spark: SparkSession, path: str | Sequence[str], with_file: bool = False, partitions: int | None = None
) -> DataFrame:
    """Text lines as ``value STRING`` (gzip is read transparently, unsplittable).

    ``partitions`` spreads the lines round-robin, for a caller who knows that
    few large unsplittable files would leave most of the cluster idle.
    ``with_file`` adds ``file_name`` (base name) from the hidden ``_metadata``
    column, which is free: no Python per row.
    """
    df = spark.read.text(path)
    if with_file:
        df = df.select("value", F.col("_metadata.file_name").alias("file_name"))
    return df.repartition(partitions) if partitions else df


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, header: bool = False) -> DataFrame:
    """CSV with a declared schema; empty and malformed fields read as NULL."""
    return spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(path)


def read_json(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """JSON lines with a declared schema; wrong-typed fields become NULL."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def _inferred(kind: T.DataType) -> T.DataType:
    """A variant's type as a column: what differs between rows becomes text."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _inferred(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_inferred(kind.elementType), True)
    if isinstance(kind, T.DecimalType):
        return T.DoubleType() if kind.scale else T.DecimalType(kind.precision, 0)
    return T.StringType() if isinstance(kind, (T.VariantType, T.NullType)) else kind


def json_schema(lines: DataFrame, value: str = "value") -> T.StructType:
    """The schema of JSON lines: all fields of all objects, each of the one type
    that its values have. Integers and fractions together are doubles; other
    differences, and fields that are always null, are text. Lines that are no
    object do not count; none at all give no fields.

    One aggregate over the parsed lines, merged in every task: only a schema
    reaches the driver.
    """
    v = F.try_parse_json(F.col(value))
    objects = lines.select(F.when(F.schema_of_variant(v).startswith("OBJECT<"), v).alias("v")).where(F.col("v").isNotNull())
    found = objects.agg(F.schema_of_variant_agg("v")).first()[0]
    if not found.startswith("OBJECT<"):
        return T.StructType([])
    names = re.split(r"(`(?:[^`]|``)*`)", found)  # quoted names stand at odd places
    ddl = "".join(part if i % 2 else re.sub(r"\bOBJECT<", "STRUCT<", part) for i, part in enumerate(names))
    if re.fullmatch(r"STRUCT<\s*>", ddl):
        return T.StructType([])
    return _inferred(T.StructType.fromDDL(f"root {ddl}")["root"].dataType)


def read_json_inferred(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """JSON lines by the schema that they have: one pass infers it, one typed
    read follows. Lines that are no object are rows of nulls."""
    return read_json(spark, path, json_schema(spark.read.text(path)))


def read_table(
    spark: SparkSession,
    fmt: str,
    options: dict[str, str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """A stored table through any data-source format (``parquet``, ``orc``,
    ``jdbc``, a wide-column connector ...), with a column subset.

    The connector jar must be on the classpath for non-file formats; the
    column subset is pushed into the scan, for a source that Spark cannot
    prune by the option ``columns``.
    """
    if columns:
        options = {**options, "columns": ",".join(columns)}
    df = spark.read.format(fmt).options(**options).load()
    return df.select(*columns) if columns else df


def read_catalog_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A table or view by its catalog name, with a column subset."""
    df = spark.table(name)
    return df.select(*columns) if columns else df


def read_stream(
    spark: SparkSession,
    fmt: str,
    options: dict[str, str],
    schema: T.StructType | None = None,
    path: str | None = None,
) -> DataFrame:
    """A streaming source: ``kafka`` in production, files in tests.

    File sources need a schema; a Kafka source yields ``value`` bytes which
    callers turn into text with ``F.col('value').cast('string')``.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def rows(spark: SparkSession, data: list, schema: T.StructType) -> DataFrame:
    """Small in-memory rows with an explicit schema (never inferred)."""
    return spark.createDataFrame(data, schema)
