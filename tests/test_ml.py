"""Model pipelines: the model follows from the rows, words unseen in training,
rows that cannot be scored."""

import datetime

import pytest
from pyspark.sql import functions as F

from quarry.operators import ml as M
from quarry.plans.q_models import daily_tmax
from quarry.session import materialize
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def days(spark):
    return materialize(M.with_yesterday(daily_tmax(spark, SF_SMALL)), "t")


def test_model_does_not_depend_on_the_partitions(spark, days):
    seen = []
    for n in (1, 2, 7):
        model = M.tmax_regressor(True, trees=5, depth=4).fit(M.for_training(days.repartition(n), ["station", "date"], 4))
        seen.append(sorted((r.station, r.date, r.prediction) for r in M.predict(model, days, M.INPUTS).collect()))
    assert seen[0] == seen[1] == seen[2]


def test_yesterday_explains_the_day(spark, days):
    train, valid = M.hash_split(days, ["station", "date"])
    model = M.tmax_regressor(True, trees=20, depth=6).fit(M.for_training(train, ["station", "date"], 4))
    m = M.regression_metrics(M.predict(model, valid, M.INPUTS)).first()
    assert m.n == m.scored and m.r2 > 0.5


def test_rows_that_cannot_be_scored_stay(spark, days):
    model = M.tmax_regressor(True, trees=2, depth=2).fit(M.for_training(days, ["station", "date"], 2))
    rows = days.limit(5).unionByName(days.limit(1).withColumn("yesterday_tmax", F.lit(None).cast("float")))
    out = M.predict(model, rows, M.INPUTS)
    assert out.count() == 6 and out.where("prediction is null").count() == 1
    m = M.regression_metrics(out).first()
    assert (m.n, m.scored) == (6, 5)


def test_word_only_in_the_validation_part(spark):
    rows = [(i % 256, 10, 20, "a" if i % 2 else "b") for i in range(60)] + [(1, 2, 3, "only")]
    df = spark.createDataFrame(rows, "R int, G int, B int, word string")
    words = M.word_index(df)
    assert words == ["a", "b", "only"]
    model = M.colour_classifier(words, iters=5).fit(df.where("word <> 'only'"))
    scored = model.transform(df)
    assert scored.count() == 61 and M.accuracy(scored).first().n == 61
    assert {r.predicted_word for r in scored.collect()} <= set(words)


def test_saved_model_joins_yesterday_itself(spark, days, tmp_path):
    from pyspark.ml import PipelineModel

    M.scoring_model(M.tmax_regressor(True, trees=2, depth=2).fit(M.for_training(days, ["station", "date"], 2))).write().save(str(tmp_path / "m"))
    model = PipelineModel.load(str(tmp_path / "m"))
    day = datetime.date(2024, 3, 1)
    latest = spark.createDataFrame([("9", day, 0.9, -1.3, 27.0, 5.0)], "station string, date date, latitude float, longitude float, elevation float, tmax float")
    got = M.score_tomorrow(model, latest).collect()
    assert [(r.station, r.date) for r in got] == [("9", datetime.date(2024, 3, 2))]
