"""Helpers shared by the operators: scratch tables, output schemas, words."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quarry.session import delete_path, scratch_path

SEED = 42


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class Scratch:
    """Tables written under ``spark.checkpoint.dir``.

    Writing cuts the lineage: the rows outlive the executors that made them.
    ``drop`` removes tables that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, {}

    def write(self, df: DataFrame, what: str) -> DataFrame:
        path = scratch_path(self.spark, f"{self.name}-{what}")
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        for t in tables:
            _, path = self.paths.pop(id(t), (None, None))
            if path:
                delete_path(self.spark, path)


def text_of(name: str = "text") -> Column:
    """A null text counts as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def map_texts(df: DataFrame, fn: Callable[[list], dict], schema: str, text: str = "text",
              batch_bytes: int = 8 << 20) -> DataFrame:
    """Replace column ``text`` by the columns that ``fn`` makes from a list of texts.

    ``fn(texts) -> {column: list or array}``; the other columns of ``df`` are
    carried along and come first, but for columns of the new names, which are
    replaced. At most about ``batch_bytes`` of text (or
    one document) are decoded at a time, so memory does not follow the batch.
    """
    made = T.StructType.fromDDL(schema)
    keep = [f for f in df.schema.fields if f.name not in (text, *made.names)]
    df = df.select(*[f"`{f.name}`" for f in keep], f"`{text}`")
    out = T.StructType([T.StructField(f.name, f.dataType, True) for f in keep] + made.fields)
    arrow = arrow_of(out)
    new = made.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in split_batch(batch, text, batch_bytes):
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                values = fn(texts)
                cols = [part.column(part.schema.get_field_index(f.name)).cast(arrow.field(i).type) for i, f in enumerate(keep)]
                cols += [pa.array(values[n], type=arrow.field(len(keep) + i).type) for i, n in enumerate(new)]
                yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return df.mapInArrow(run, out)


def arrow_of(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def split_batch(batch: pa.RecordBatch, text: str, batch_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of about ``batch_bytes`` of text; a longer text stands alone."""
    col = batch.column(batch.schema.get_field_index(text))
    n = len(col)
    if not n:
        return
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64))
    start = 0
    while start < n:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + batch_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def words_of(text: str) -> list[bytes]:
    """A-Z lower-cased, split at ASCII white space (bytes methods touch ASCII only)."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], k: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every k-word shingle, space-joined, repeats included; of the
    whole sequence if it has fewer words; none for no words."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= k:
        return np.array([digest(joined, seed)], dtype=np.uint64)
    lens = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[: n - k + 1].tolist()
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, ends[k - 1:].tolist())), np.uint64, n - k + 1)
