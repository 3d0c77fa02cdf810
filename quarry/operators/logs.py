"""Web access logs: parse into typed rows with a stable request id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import parse_access_log, request_id


FIELDS = ("host", "datetime", "path", "bytes")


def log_rows(lines: DataFrame, position: str | None = None, value: str = "value") -> DataFrame:
    """``(host, datetime, path, bytes, req_id)`` from access-log lines.

    ``req_id`` hashes the parsed fields and, so that equal lines get distinct
    ids, a ``position`` column of the lines or else the occurrence: the n
    lines with the same fields are numbered 1 to n.  Neither depends on how
    the input is split, so a retried task or a reload on another cluster
    gives the same ids.  Equal lines are counted, a partial + final
    aggregate, and spread out again: a hot line never gathers in one task
    before it is numbered.
    """
    parsed = parse_access_log(lines, value)
    if position is None:
        counted = parsed.groupBy(*FIELDS).agg(F.count(F.lit(1)).alias("_n"))
        parsed = counted.select(*FIELDS, F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_pos"))
        position = "_pos"
    return parsed.select(*FIELDS, request_id(*FIELDS, position).alias("req_id"))


def host_totals(rows: DataFrame) -> DataFrame:
    """``(host, requests, bytes)`` per host: one aggregate."""
    return rows.groupBy("host").agg(F.count(F.lit(1)).alias("requests"), F.sum("bytes").alias("bytes"))
