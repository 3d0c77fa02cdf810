"""Q32-Q34: model pipelines.

Training has no SQL oracle; what surrounds it has one: the split, the
features, yesterday's value, the label index, and the metrics of predictors
that SQL can state (yesterday's value, the majority class).
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import ml as M
from quarry.operators.keyed import latest_per_key
from quarry.plans.registry import query
from quarry.session import materialize, scratch_path
from quarry.sources import table


def daily_tmax(spark: SparkSession, sf: str) -> DataFrame:
    """`events` as daily station maxima.  The tables hold no weather, so the
    maximum gets a season and a climate that can be learnt: the day's largest
    value, scaled down to noise, on top of a yearly wave and a gradient over
    the stations (station = user)."""
    e = table(spark, sf, "events", ["user_id", "ts", "value"])
    d = e.groupBy("user_id", F.to_date("ts").alias("date")).agg(F.max("value").alias("top"))
    season = F.cos((F.dayofyear("date") - 200) * (2 * 3.141592653589793 / 365)) * 15
    return d.select(
        F.col("user_id").cast("string").alias("station"),
        "date",
        (F.col("user_id") / 10.0).cast("float").alias("latitude"),
        (-F.col("user_id") / 7.0).cast("float").alias("longitude"),
        (F.col("user_id") * 3.0).cast("float").alias("elevation"),
        (season - F.col("user_id") % 50 * 0.2 + F.col("top") / 100).cast("float").alias("tmax"),
    )


KEY = ["station", "date"]


def _days(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All days with yesterday's value, written once, and their split."""
    data = materialize(M.with_yesterday(daily_tmax(spark, sf)), "tmax-days")
    train, valid = M.hash_split(data, KEY)
    return data, M.for_training(train, KEY), valid


@query("q32_weather_predictions")
def q32_weather_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Validation rows with the with-yesterday model's prediction."""
    _, train, valid = _days(spark, sf)
    model = M.tmax_regressor(True).fit(train)
    return M.predict(model, valid, M.INPUTS).select("station", "date", "tmax", "yesterday_tmax", "prediction")


@query("q32_weather_metrics")
def q32_weather_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """RMSE and R² on validation for both models, and the importance of
    yesterday's value (last feature) in the second."""
    _, train, valid = _days(spark, sf)
    out = []
    for name, use in (("baseline", False), ("with_yesterday", True)):
        model = M.tmax_regressor(use).fit(train)
        share = float(model.stages[-1].featureImportances.toArray()[-1]) if use else None
        scores = M.regression_metrics(M.predict(model, valid, M.INPUTS if use else M.INPUTS[:-1]))
        out.append(scores.select(F.lit(name).alias("model"), "*", F.lit(share).cast("double").alias("yesterday_importance")))
    return reduce(DataFrame.unionByName, out)


@query("q33_score_tomorrow")
def q33_score_tomorrow(spark: SparkSession, sf: str) -> DataFrame:
    """Train, save the scoring model, load it back, and predict the day after
    each station's latest reading."""
    _, train, _ = _days(spark, sf)
    path = scratch_path(spark, "tmax_model")
    M.scoring_model(M.tmax_regressor(True).fit(train)).write().overwrite().save(path)
    model = PipelineModel.load(path)
    latest = latest_per_key(
        daily_tmax(spark, sf), "station", ["date"], ["date", "latitude", "longitude", "elevation", "tmax"]
    )
    return M.score_tomorrow(model, latest)


_DAYS_SQL = """
    d AS (SELECT user_id, CAST(ts AS DATE) AS date, max(value) AS top FROM events GROUP BY ALL),
    y AS (SELECT t.user_id, t.date, t.top, p.top AS yesterday FROM d t JOIN d p ON p.user_id = t.user_id AND p.date = t.date - 1),
    s AS (SELECT *, CAST('0x' || substring(md5(CAST(user_id AS VARCHAR) || '|' || CAST(date AS VARCHAR)), 1, 8) AS BIGINT) % 10000 AS bucket FROM y)
"""


def daily_top(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events", ["user_id", "ts", "value"])
    d = e.groupBy("user_id", F.to_date("ts").alias("date")).agg(F.max("value").alias("top"))
    return M.with_previous_day(d, "user_id", "date", "top", "yesterday")


@query(
    "q32_features",
    f"""
    WITH {_DAYS_SQL}
    SELECT user_id, date, CAST(dayofyear(date) AS INTEGER) AS day_of_year, top, yesterday, bucket < 7500 AS train FROM s
    """,
)
def q32_features(spark: SparkSession, sf: str) -> DataFrame:
    """The regressor's feature table: day of year, yesterday's value, joined
    before the split, and the part of the split that each row is in."""
    train, valid = M.digest_split(M.with_day_of_year(daily_top(spark, sf)), ["user_id", "date"])
    both = train.withColumn("train", F.lit(True)).unionByName(valid.withColumn("train", F.lit(False)))
    return both.select("user_id", "date", "day_of_year", "top", "yesterday", "train")


@query(
    "q32_yesterday_as_prediction",
    f"""
    WITH {_DAYS_SQL}, v AS (SELECT top, yesterday FROM s WHERE bucket >= 7500)
    SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS scored, round(sqrt(avg((top - yesterday) ** 2)), 6) AS rmse,
           round(1 - sum((top - yesterday) ** 2) / (var_pop(top) * count(*)), 6) AS r2 FROM v
    """,
)
def q32_yesterday_as_prediction(spark: SparkSession, sf: str) -> DataFrame:
    """RMSE and R² of the forecast that a day is like the day before."""
    _, valid = M.digest_split(daily_top(spark, sf), ["user_id", "date"])
    out = M.regression_metrics(valid, "top", "yesterday")
    return out.select("n", "scored", F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2"))


def colour_words(spark: SparkSession, sf: str) -> DataFrame:
    """`embeddings` as colour words: R, G, B from the first three components
    (scaled to 0..255), word = the class label. The other components have no role:
    a colour has three."""
    e = table(spark, sf, "embeddings", ["vec_id", "embedding", "label"])

    def channel(i: int):
        v = F.round((F.get("embedding", i) + F.lit(0.5)) * 255)
        return F.least(F.greatest(v, F.lit(0.0)), F.lit(255.0)).cast("int")

    return e.select(
        "vec_id", channel(0).alias("R"), channel(1).alias("G"), channel(2).alias("B"),
        F.concat(F.lit("colour"), F.col("label").cast("string")).alias("word"),
    ).where(F.col("R").isNotNull() & F.col("G").isNotNull() & F.col("B").isNotNull())


@query("q34_colour_classifier")
def q34_colour_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracy of the RGB and the LAB perceptron on the validation split."""
    rows = materialize(colour_words(spark, sf), "colour-words")
    words = M.word_index(rows)
    train, valid = M.hash_split(rows, ["vec_id"])
    train = M.for_training(train, ["vec_id"])
    out = []
    for space in ("rgb", "lab"):
        model = M.colour_classifier(words, space).fit(train)
        out.append(M.accuracy(model.transform(valid)).select(F.lit(space).alias("space"), "n", "accuracy"))
    return reduce(DataFrame.unionByName, out)


_WORDS_SQL = """
    w AS (SELECT vec_id, 'colour' || CAST(label AS VARCHAR) AS word,
                 CAST('0x' || substring(md5(CAST(vec_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 AS bucket
          FROM embeddings WHERE len(embedding) >= 3 AND label IS NOT NULL),
    i AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS label FROM (SELECT DISTINCT word FROM w))
"""


def indexed_words(spark: SparkSession, sf: str) -> DataFrame:
    """`embeddings` labels as words with their place in the sorted word list."""
    e = table(spark, sf, "embeddings", ["vec_id", "embedding", "label"])
    rows = e.where((F.size("embedding") >= 3) & F.col("label").isNotNull()).select(
        "vec_id", F.concat(F.lit("colour"), F.col("label").cast("string")).alias("word")
    )
    words = M.word_index(rows)
    return M.StringIndexerModel.from_labels(words, inputCol="word", outputCol="label").transform(rows) if words else rows.withColumn("label", F.lit(0.0))


@query("q34_label_index", f"WITH {_WORDS_SQL} SELECT w.vec_id, w.word, CAST(i.label AS DOUBLE) AS label, w.word AS back FROM w JOIN i USING (word)")
def q34_label_index(spark: SparkSession, sf: str) -> DataFrame:
    """Word to label index and back to the word."""
    rows = indexed_words(spark, sf)
    words = M.word_index(rows)
    back = M.IndexToString(inputCol="label", outputCol="back", labels=words).transform(rows) if words else rows.withColumn("back", F.col("word"))
    return back.select("vec_id", "word", "label", "back")


@query(
    "q34_majority_accuracy",
    f"""
    WITH {_WORDS_SQL},
    l AS (SELECT w.vec_id, w.bucket, i.label FROM w JOIN i USING (word)),
    top AS (SELECT label FROM l WHERE bucket < 7500 GROUP BY label ORDER BY count(*) DESC, label LIMIT 1)
    SELECT CAST(count(*) AS BIGINT) AS n, round(avg(CASE WHEN l.label = top.label THEN 1.0 ELSE 0.0 END), 9) AS accuracy
    FROM l LEFT JOIN top ON true WHERE bucket >= 7500
    """,
)
def q34_majority_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracy of always predicting the training rows' commonest word."""
    train, valid = M.digest_split(indexed_words(spark, sf), ["vec_id"])
    counts = train.groupBy("label").count()
    top = counts.agg(F.max_by("label", F.struct("count", -F.col("label")))).first()[0]  # one label
    out = M.accuracy(valid.withColumn("prediction", F.lit(top).cast("double")))
    return out.select("n", F.round("accuracy", 9).alias("accuracy"))
