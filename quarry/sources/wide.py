"""A wide-column table as a Spark data source: rows in files sorted by a key,
appended by jobs that count whole or not at all.

``append`` sorts the rows by ranges of the key; each task writes a file of its
own name and reports its row groups with their least and greatest key. The
driver's commit names the files of the tasks that succeeded in one entry of the
table's log, which makes them visible together; an abort deletes what the
others wrote. A file of a lost executor or a second attempt is named by no entry.

A reader takes the row groups of all entries, leaves out those whose keys a
filter on the key excludes, and deals the others out in the order of their keys,
about ``rowsPerTask`` rows a task: a key with very many rows is read by as many
tasks. The option ``columns`` names the columns to read. Spark applies every
filter again.

Options: ``path`` (the table's folder, a URI or absolute path) or ``root``,
``keyspace`` and ``table``; when writing, ``key``, a column of integers, strings,
dates or timestamps. Rows without a key are kept and never left out by a range.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    IsNotNull, LessThan, LessThanOrEqual, WriterCommitMessage)
from pyspark.sql.pandas.types import to_arrow_schema

from quarry.sources import transactions

FORMAT = "quarry_wide"
ROWS = 500_000  # rows a task reads, about
GROUP, GROUP_BYTES = 50_000, 32 << 20  # rows and bytes of a row group


def folder_of(options: dict) -> str:
    path = options.get("path")
    if path:
        return path.rstrip("/")
    return "/".join([options["root"].rstrip("/"), options["keyspace"], options["table"]])


def _plain(value):
    """A key as JSON keeps it, in the same order."""
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat(timespec="microseconds")
    return value.isoformat() if isinstance(value, datetime.date) else value


def state(folder: str) -> dict | None:
    """Schema, key and files of the table; None if nothing was written."""
    out = None
    for _, entry in transactions.entries(f"{folder}/log"):
        if out is None or entry["replace"]:
            out = {"schema": entry["schema"], "key": entry["key"], "files": []}
        if entry["schema"] != out["schema"]:
            raise ValueError(f"{folder} was written with two schemas")
        out["files"] += entry["files"]
    return out


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    groups: list


class WideWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: T.StructType, overwrite: bool):
        self.folder, self.schema, self.replace = folder_of(options), schema, overwrite
        known = state(self.folder)
        self.key = options.get("key") or (known["key"] if known else None)
        if self.key not in schema.names:
            raise ValueError(f"the key {self.key!r} is not a column")
        if known and not overwrite and known["schema"] != schema.json():
            raise ValueError(f"{self.folder} has another schema")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        file = f"{self.folder}/data/{uuid.uuid4().hex}.parquet"
        system, path = transactions.locate(file)
        writer, held, size, groups = None, [], 0, []
        try:
            for batch in batches:
                if not len(batch):
                    continue
                if writer is None:
                    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    stream = system.open_output_stream(path)
                    writer = pq.ParquetWriter(stream, batch.schema)
                held.append(batch)
                size += batch.nbytes
                if sum(map(len, held)) >= GROUP or size >= GROUP_BYTES:
                    groups.append(self._group(writer, held))
                    held, size = [], 0
            if held:
                groups.append(self._group(writer, held))
            if writer is not None:
                writer.close()
                stream.close()
        except BaseException:
            if writer is not None:
                system.delete_file(path)
            raise
        return Written(file if groups else None, groups)

    def _group(self, writer: pq.ParquetWriter, held: list) -> dict:
        rows = pa.Table.from_batches(held)
        writer.write_table(rows, row_group_size=len(rows))
        keys = rows.column(self.key)
        ends = pc.min_max(keys)
        return {"rows": len(rows), "nulls": keys.null_count > 0, "low": _plain(ends["min"].as_py()), "high": _plain(ends["max"].as_py())}

    def commit(self, messages: list) -> None:
        files = [{"file": m.file, "groups": m.groups} for m in messages if m is not None and m.file]
        if files or self.replace:
            transactions.append(f"{self.folder}/log", {"schema": self.schema.json(), "key": self.key, "replace": self.replace, "files": files})

    def abort(self, messages: list) -> None:
        for m in messages:
            if m is not None and m.file:
                system, path = transactions.locate(m.file)
                system.delete_file(path)


class Groups(InputPartition):
    """Row groups by file."""

    def __init__(self, groups: dict[str, list[int]], low, high, rows: int):
        self.groups, self.low, self.high, self.rows = groups, low, high, rows


class WideReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.folder, self.schema, self.rows = folder_of(options), schema, int(options.get("rowspertask", ROWS))
        self.keep: list[tuple] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Ranges of the key are remembered; Spark applies all filters again."""
        known = state(self.folder)
        for f in filters:
            if known and getattr(f, "attribute", None) == (known["key"],):
                if isinstance(f, (EqualTo, EqualNullSafe)) and f.value is not None:
                    self.keep.append((_plain(f.value), _plain(f.value)))
                elif isinstance(f, In):
                    values = [_plain(v) for v in f.value if v is not None]
                    self.keep.append((min(values), max(values)) if values else (None, None))
                elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    self.keep.append((_plain(f.value), None))
                elif isinstance(f, (LessThan, LessThanOrEqual)):
                    self.keep.append((None, _plain(f.value)))
                elif isinstance(f, IsNotNull):
                    self.keep.append((None, None))
            yield f

    def _wanted(self, group: dict) -> bool:
        low, high = group["low"], group["high"]
        if low is None:  # keys are all null, which no range holds
            return not self.keep
        return all((a is None or high >= a) and (b is None or low <= b) for a, b in self.keep)

    def partitions(self) -> list[Groups]:
        known = state(self.folder)
        found = [(g["low"], f["file"], i, g) for f in (known["files"] if known else []) for i, g in enumerate(f["groups"]) if self._wanted(g)]
        found.sort(key=lambda x: (x[0] is not None, x[0], x[1], x[2]) if x[0] is not None else (False, 0, x[1], x[2]))
        out: list[Groups] = []
        for low, file, i, g in found:
            if not out or out[-1].rows + g["rows"] > self.rows:
                out.append(Groups({}, low, g["high"], 0))
            part = out[-1]
            part.groups.setdefault(file, []).append(i)
            part.rows += g["rows"]
            part.high = g["high"] if part.high is None or (g["high"] is not None and g["high"] > part.high) else part.high
        return out

    def read(self, part: Groups | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # what Spark passes if there are no partitions
            return
        arrow = to_arrow_schema(self.schema)
        for file, groups in part.groups.items():
            system, path = transactions.locate(file)
            with system.open_input_file(path) as f:
                for batch in pq.ParquetFile(f).iter_batches(8192, row_groups=groups, columns=self.schema.names):
                    yield pa.RecordBatch.from_arrays([batch.column(n).cast(arrow.field(n).type) for n in self.schema.names], schema=arrow)


class WideTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        known = state(folder_of(self.options))
        if known is None:
            raise ValueError(f"no table in {folder_of(self.options)}")
        whole = T.StructType.fromJson(json.loads(known["schema"]))
        names = [n.strip() for n in self.options.get("columns", "").split(",") if n.strip()]
        return T.StructType([whole[n] for n in names]) if names else whole

    def reader(self, schema: T.StructType) -> WideReader:
        return WideReader(self.options, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> WideWriter:
        return WideWriter(self.options, schema, overwrite)


def register(spark: SparkSession) -> str:
    """Make the format known to the session, with filters on its key pushed to
    it; returns its name."""
    spark.dataSource.register(WideTable)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return FORMAT


def append(rows: DataFrame, options: dict[str, str], mode: str = "append") -> None:
    """Add rows, sorted by ranges of the key, in one job; ``mode`` overwrite
    replaces the table's rows. The rows of one key are dealt by a hash of the row,
    so that a hot key is written by several tasks."""
    key = options["key"]
    rest = F.xxhash64(*[F.col(f"`{f.name}`") for f in rows.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))])
    rows.repartitionByRange(key, rest).sortWithinPartitions(key).write.format(register(rows.sparkSession)).options(**options).mode(mode).save()
