"""Plan properties: pruning reaches the scan, partition filters apply, and no
registered query evaluates Python per row."""

import pytest

from quarry.plans import QUERIES
from quarry.plans.q_warehouse import write_partitioned_events
from quarry.sources import table
from tests.conftest import SF_SMALL

SKIP_PLAN = {"q32_weather_predictions", "q32_weather_metrics", "q33_score_tomorrow", "q34_colour_classifier"}


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_column_pruning_reaches_scan(spark):
    df = QUERIES["q08_average_score"](spark, SF_SMALL)
    p = plan_text(df)
    assert "ReadSchema: struct<o_totalprice:double,o_orderpriority:string>" in p
    assert "o_custkey" not in p.split("ReadSchema")[1].split("\n")[0]


def test_filter_pushdown(spark):
    df = QUERIES["q36_nonkey_filter"](spark, SF_SMALL)
    assert "PushedFilters: [IsNotNull(o_orderpriority), IsNotNull(o_orderstatus), EqualTo(o_orderpriority,1-URGENT)" in plan_text(df)


def test_partition_pruning(spark):
    path = write_partitioned_events(spark, SF_SMALL)
    from pyspark.sql import functions as F

    df = spark.read.parquet(path).where(F.col("event_type") == "click")
    p = plan_text(df)
    assert "PartitionFilters: [isnotnull(event_type" in p and "(event_type#" in p
    want = table(spark, SF_SMALL, "events").where(F.col("event_type") == "click").count()
    assert df.count() == want
    scan = [ln for ln in p.split("\n") if "PartitionFilters" in ln][0]
    assert "= click)" in scan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP_PLAN))
def test_no_python_evaluation(spark, name):
    p = plan_text(QUERIES[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_scans_and_exchanges_do_not_follow_the_size(spark):
    """The plans on tables of 6,000 and 60,000 lines have the same shape."""
    import re

    for name in ("q13_temp_range", "q16_correlate_logs", "q18_total_bytes", "q27_rgb_to_lab", "q36_key_lookup", "q05_top_pages_ties"):
        shapes = [re.findall(r"(Scan parquet|Exchange \w+|Aggregate|Join)", plan_text(QUERIES[name](spark, sf))) for sf in (SF_SMALL, "/root/testdata/sf0.01")]
        assert shapes[0] == shapes[1], name
        assert not any("RoundRobin" in x for x in shapes[1]), name


def test_observation_type_filter_is_pushed(spark):
    p = plan_text(QUERIES["q13_temp_range"](spark, SF_SMALL))
    assert "EqualTo(l_returnflag,R)" in p and "EqualTo(l_returnflag,A)" in p
