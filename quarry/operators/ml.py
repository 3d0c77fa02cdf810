"""Model pipelines on tables (Spark ML): temperature regression with
yesterday's value, scoring tomorrow, colour-word classification.

Splits are by a hash of the row key, so they are repeatable and do not
depend on partitioning (an unseeded ``randomSplit`` is neither).  Metrics are
plain SQL aggregates over the prediction table, so they distribute and can
be recomputed anywhere.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.colour import rgb_to_lab
from quarry.operators.join import with_previous_day

DAY_OF_YEAR_SQL = "SELECT *, dayofyear(date) AS day_of_year FROM __THIS__"
BASE_FEATURES = ["latitude", "longitude", "elevation", "day_of_year"]
# Columns that a row needs to be scored; the last only by the second model.
INPUTS = ["latitude", "longitude", "elevation", "date", "yesterday_tmax"]


def digest_split(df: DataFrame, key: Sequence[str], train_fraction: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """Like ``hash_split`` by the first 8 hex digits of an MD5 of the key's
    text, which any other engine can repeat."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in key])
    bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 10_000
    cut = int(train_fraction * 10_000)
    return df.where(bucket < cut), df.where(bucket >= cut)


def with_day_of_year(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumn("day_of_year", F.dayofyear(date))


def hash_split(df: DataFrame, key: Sequence[str], train_fraction: float = 0.75, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Deterministic train/validation split on a hash of the key columns."""
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in key], F.lit(seed)), F.lit(10_000))
    cut = int(train_fraction * 10_000)
    return df.where(bucket < cut), df.where(bucket >= cut)


TRAIN_PARTITIONS, TRAIN_ROWS = 32, 250_000


def training_partitions(rows: int) -> int:
    """Partitions for so many training rows: at most ``TRAIN_ROWS`` in one, and at
    least ``TRAIN_PARTITIONS``. It follows from the rows alone."""
    return max(TRAIN_PARTITIONS, -(-rows // TRAIN_ROWS))


def for_training(df: DataFrame, key: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Training rows in a number of partitions that follows from their number, by
    a hash of the row key, sorted by it.  Learners draw samples and add floats
    by partition, so this makes the fitted model a matter of the rows alone, not
    of the cores or the files.  Give ``partitions`` where the number is known:
    otherwise the rows are counted first."""
    partitions = partitions or training_partitions(df.count())
    return df.repartition(partitions, *key).sortWithinPartitions(*key)


def with_yesterday(df: DataFrame) -> DataFrame:
    """Add ``yesterday_tmax`` on the whole table, *before* any split, so a
    validation day keeps its yesterday even if that day went to training."""
    return with_previous_day(df, "station", "date", "tmax", "yesterday_tmax")


def tmax_regressor(use_yesterday: bool, trees: int = 50, depth: int = 10, seed: int = 42) -> Pipeline:
    """day-of-year -> features -> random forest.  With ``use_yesterday`` the
    input must already carry ``yesterday_tmax`` (see ``with_yesterday``)."""
    cols = BASE_FEATURES + (["yesterday_tmax"] if use_yesterday else [])
    return Pipeline(
        stages=[
            SQLTransformer(statement=DAY_OF_YEAR_SQL),
            VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="error"),
            RandomForestRegressor(featuresCol="features", labelCol="tmax", numTrees=trees, maxDepth=depth, seed=seed),
        ]
    )


class WithYesterday(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage that joins ``yesterday_tmax`` to raw daily rows."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_yesterday(dataset)


def scoring_model(fitted: PipelineModel) -> PipelineModel:
    """A fitted with-yesterday model that joins yesterday itself when scoring
    raw daily rows (for ``score_tomorrow``)."""
    return PipelineModel(stages=[WithYesterday(), *fitted.stages])


def predict(model: PipelineModel, rows: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """``rows`` with ``prediction``.  A row with a NULL among ``inputs`` cannot
    be scored: it stays, with a NULL prediction, and the metrics count it."""
    whole = reduce(and_, [F.col(c).isNotNull() for c in inputs])
    scored = model.transform(rows.where(whole)).select(*rows.columns, "prediction")
    return scored.unionByName(rows.where(~whole).withColumn("prediction", F.lit(None).cast("double")))


def regression_metrics(preds: DataFrame, label: str = "tmax", prediction: str = "prediction") -> DataFrame:
    """One row ``(n, scored, rmse, r2)`` from a prediction table, in one
    aggregate: all rows, those with a label and a prediction, and the fit on
    the latter."""
    both = F.col(label).isNotNull() & F.col(prediction).isNotNull()
    y = F.when(both, F.col(label).cast("double"))
    err = y - F.col(prediction)
    agg = preds.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(y).alias("scored"),
        F.avg(err * err).alias("mse"),
        F.sum(err * err).alias("sse"),
        F.var_pop(y).alias("var"),
    )
    return agg.select(
        "n",
        "scored",
        F.sqrt("mse").alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.col("sse"), F.col("var") * F.col("scored"))).alias("r2"),
    )


def score_tomorrow(model: PipelineModel, latest: DataFrame) -> DataFrame:
    """For each station's latest reading, score the next day.

    ``latest`` holds one row per station (``station, date, latitude,
    longitude, elevation, tmax``).  A placeholder row for tomorrow is added
    and the model (which joins yesterday itself) predicts it.
    """
    tomorrow = latest.select(
        "station", F.date_add("date", 1).alias("date"), "latitude", "longitude", "elevation", F.lit(0.0).cast("float").alias("tmax")
    )
    scored = model.transform(latest.unionByName(tomorrow))
    return scored.join(tomorrow.select("station", "date"), ["station", "date"]).select(
        "station", "date", F.col("prediction").alias("tmax_tomorrow")
    )


class RgbToLab(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage adding ``labL, labA, labB`` from ``R, G, B`` with the
    column expressions of ``quarry.functions.colour`` (no SQL text)."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        l_, a_, b_ = rgb_to_lab("R", "G", "B")
        return dataset.withColumns({"labL": l_, "labA": a_, "labB": b_})


MAX_CLASSES = 10_000


def word_index(words: DataFrame, word: str = "word", max_classes: int = MAX_CLASSES) -> list[str]:
    """All words in alphabetic order; a word's place is its label.  Taken from
    all rows, before any split, so that no part holds an unseen word.  The
    list is on the driver and in the model: more than ``max_classes`` words are
    refused, after reading that many and one."""
    found = words.select(word).where(F.col(word).isNotNull()).distinct().limit(max_classes + 1).collect()
    if len(found) > max_classes:
        raise ValueError(f"more than {max_classes} distinct words are no classes")
    return sorted(r[0] for r in found)


def colour_classifier(words: list[str], space: str = "rgb", hidden: int = 30, iters: int = 100, seed: int = 42) -> Pipeline:
    """(R, G, B) [-> LAB] -> features; word -> label; perceptron 3-hidden-n;
    predicted index mapped back to the word (``predicted_word``)."""
    stages: list = []
    if space == "lab":
        stages.append(RgbToLab())
        inputs = ["labL", "labA", "labB"]
    else:
        inputs = ["R", "G", "B"]
    stages += [
        VectorAssembler(inputCols=inputs, outputCol="features"),
        StringIndexerModel.from_labels(words, inputCol="word", outputCol="label"),
        MultilayerPerceptronClassifier(
            layers=[3, hidden, len(words)], featuresCol="features", labelCol="label", maxIter=iters, seed=seed
        ),
        IndexToString(inputCol="prediction", outputCol="predicted_word", labels=words),
    ]
    return Pipeline(stages=stages)


def accuracy(preds: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row ``(n, accuracy)``."""
    return preds.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"),
    )
