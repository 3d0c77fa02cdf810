"""Streaming regression: state continues over a restart from its checkpoint,
and the result equals the batch fit on the same points."""

import os

import pytest
from pyspark.sql import types as T

from quarry.streaming.regression import fit_points, start_fit
from tests.conftest import lines_df

TEXT = T.StructType([T.StructField("value", T.StringType())])


def _write(path, name, lines):
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_stream_restart_and_batch_equivalence(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    ckpt = str(tmp_path / "ckpt")
    _write(str(src), "a.txt", ["1 3", "2 5"])

    def run():
        stream = spark.readStream.schema(TEXT).text(str(src))
        q = start_fit(stream, ckpt, sink="memory", name="fit_test", available_now=True)
        q.awaitTermination()
        return spark.table("fit_test").first()

    first = run()
    assert first.n == 2 and first.slope == pytest.approx(2.0)
    _write(str(src), "b.txt", ["3 8", "junk", "4"])
    second = run()
    assert second.n == 3
    assert second.slope == pytest.approx(2.5) and second.intercept == pytest.approx(1 / 3)
    batch = fit_points(lines_df(spark, ["1 3", "2 5", "3 8", "junk", "4"])).first()
    assert (batch.n, batch.slope, batch.intercept) == pytest.approx((second.n, second.slope, second.intercept))


def test_stream_query_reads_a_table_stored_as_a_folder(spark, tmp_path):
    from quarry.plans import QUERIES
    from tests.conftest import SF_SMALL

    one = QUERIES["q19_stream_regression"](spark, SF_SMALL).first()
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(5).write.parquet(str(tmp_path / "many/events.parquet"))
    many = QUERIES["q19_stream_regression"](spark, str(tmp_path / "many")).first()
    assert many.n == one.n > 0 and (many.slope, many.intercept) == pytest.approx((one.slope, one.intercept))
    spark.read.parquet(f"{SF_SMALL}/events.parquet").limit(0).write.parquet(str(tmp_path / "none/events.parquet"))
    none = QUERIES["q19_stream_regression"](spark, str(tmp_path / "none")).first()
    assert none.n == 0 and none.slope is None
