"""Every registered query against its DuckDB oracle on sf0.001 (the driver
does the same at sf0.01), and the smoke entry point."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from quarry.plans import ORACLE, QUERIES
from quarry.sources.readers import DRIVER_TABLES
from tests.conftest import SF_SMALL


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["hour", "title", "views"]


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_every_query_has_oracle_or_is_model():
    missing = set(QUERIES) - set(ORACLE)
    assert missing == {"q32_weather_predictions", "q32_weather_metrics", "q33_score_tomorrow", "q34_colour_classifier"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(df.columns, srows) == _digest(ocols, orows)
