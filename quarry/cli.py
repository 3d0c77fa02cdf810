"""Command-line programs on raw files: the same programs a user of the
original scripts runs, each a thin wiring of the library operators.

    python -m quarry <program> [arguments]

Every program reads with an explicit schema, runs on Spark, and writes with
a Spark sink; nothing is collected except one-row results that are printed.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quarry.functions import json as J
from quarry.functions.text import parse_adjacency
from quarry.operators import aggregate as A
from quarry.operators import pagecounts as P
from quarry.operators import sinks as K
from quarry.operators import timeseries as TS
from quarry.operators.correlate import correlate, per_key_count_sum
from quarry.operators.graph import shortest_path, shortest_paths
from quarry.operators.join import relative_score
from quarry.operators.logs import log_rows
from quarry.session import ensure_checkpoint_dir, materialize
from quarry.sources import read_csv, read_json, read_lines, read_table, schemas


def _session(app: str) -> SparkSession:
    spark = SparkSession.builder.appName(app).getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def wordcount(spark, a) -> None:
    counts = A.word_count(read_lines(spark, a.inputs), keep_empty=a.keep_empty)
    K.write_text(K.format_lines(counts.orderBy("word"), "%s %d", ["word", "n"]), a.output)


def numbersum(spark, a) -> None:
    total = A.numeric_token_total(read_lines(spark, a.inputs)).first()
    print(total.total)


def wikipedia_popular(spark, a) -> None:
    counts = P.wanted_pages(P.parse_counts5(read_lines(spark, a.inputs)), exclude_prefix="Special:")
    if a.with_title:
        best = P.top_page_per_hour(counts).orderBy("hour")
        K.write_text(best.select(F.format_string("%s\t(%d, '%s')", "hour", "views", "title").alias("value")), a.output)
    else:
        best = P.max_views_per_hour(counts).orderBy("hour")
        K.write_text(K.format_lines(best, "%s\t%d", ["hour", "max_views"]), a.output)


def wikipedia_popular_df(spark, a) -> None:
    lines = read_lines(spark, a.inputs, with_file=True)
    counts = P.wanted_pages(P.parse_counts4(lines), exclude_prefix=a.exclude_prefix)
    # raw text is parsed once: the narrow parsed rows are written and read twice
    top = P.top_pages_per_hour(counts, strategy=a.join, materialize_input=True).orderBy("hour", "title")
    K.write_json(top, a.output)


def reddit_averages(spark, a) -> None:
    comments = J.pick_comments(read_lines(spark, a.inputs), score_type="double")
    avg = A.average_per_key(comments, "subreddit", "score", alias="average")
    # one JSON array a line: [subreddit, average]
    name = F.regexp_extract(F.to_json(F.struct(F.col("subreddit").alias("s"))), r"^\{\"s\":(.*)\}$", 1)
    K.write_text(avg.select(F.concat(F.lit("["), name, F.lit(", "), F.col("average").cast("string"), F.lit("]")).alias("value")), a.output)


def reddit_average_df(spark, a) -> None:
    df = read_json(spark, a.inputs, schemas.COMMENT)
    avg = A.average_per_key(df, "subreddit", "score").orderBy("subreddit")
    K.write_csv(avg, a.output)


def reddit_etl(spark, a) -> None:
    comments = J.pick_comments(read_lines(spark, a.inputs), score_type="bigint")
    chosen = comments.where(F.col("subreddit").contains("e"))
    K.write_split(K.with_split(chosen, F.col("score") > 0, "positive", "negative"), a.output)


def relative_scores(spark, a) -> None:
    v = J.parse_objects(read_lines(spark, a.inputs))
    obj = F.col("v")
    comments = v.select(
        J.get(obj, "subreddit", "string").alias("subreddit"),
        J.get_or_default(obj, "score", "double", 0.0).alias("score"),
        F.when(~J.present(obj, "author"), F.lit("unknown")).otherwise(J.get(obj, "author", "string")).alias("author"),
    ).where(F.col("score").isNotNull())
    rel = relative_score(
        comments, drop_empty_group=a.broadcast, strategy="broadcast" if a.broadcast else "auto", materialize_input=True
    )
    out = rel.orderBy(F.desc("rel"), "author")
    K.write_text(K.delimited_lines(out, ["rel", "author"]), a.output)


def weather_etl(spark, a) -> None:
    obs = read_csv(spark, a.inputs, schemas.OBSERVATION)
    K.write_json(TS.observation_etl(obs), a.output, compression="gzip")


def temp_range(spark, a) -> None:
    obs = read_csv(spark, a.inputs, schemas.OBSERVATION)
    out = TS.temperature_range_sql(spark, obs) if a.sql else TS.temperature_range(obs)
    K.write_csv(out.orderBy("date", "station"), a.output)


def load_logs(spark, a) -> None:
    rows = log_rows(read_lines(spark, a.inputs))
    options = {"keyspace": a.keyspace, "table": a.table} if a.format != "parquet" else {"path": a.table}
    K.append_table(rows, a.format, options, spread=a.spread)


def correlate_logs(spark, a) -> None:
    if a.format == "text":
        rows = log_rows(read_lines(spark, a.inputs))
    else:
        options = {"keyspace": a.keyspace, "table": a.inputs} if a.format != "parquet" else {"path": a.inputs}
        rows = read_table(spark, a.format, options, columns=["host", "bytes"])
    r = correlate(per_key_count_sum(rows, "host", "bytes")).first()
    print(f"r = {r.r}")
    print(f"r^2 = {r.r2}")


def read_stream(spark, a) -> None:
    from quarry.sources import read_stream as stream_source
    from quarry.streaming.regression import message_text, start_fit

    messages = stream_source(spark, "kafka", {"kafka.bootstrap.servers": a.servers, "subscribe": a.topic})
    q = start_fit(message_text(messages), a.checkpoint, sink="console", processing_time=a.every)
    q.awaitTermination(a.seconds)


def shortest(spark, a) -> None:
    edges = parse_adjacency(read_lines(spark, a.input_dir))
    trace = K.iteration_writer(a.output_dir, ["node", "dist", "prev"]) if a.trace else None
    dist = shortest_paths(edges, a.src, a.max_iters, trace=trace)
    if not dist.where("open").isEmpty():
        print(f"Cut after {a.max_iters} passes: longer paths were not searched", file=sys.stderr)
    path = shortest_path(dist, a.dst).orderBy("step")
    K.write_single_file(path.select(F.col("node").cast("string").alias("value")), f"{a.output_dir}/path")


def weather_train(spark, a) -> None:
    from quarry.operators import ml as M

    data = materialize(M.with_yesterday(read_csv(spark, a.inputs, schemas.TMAX)), "tmax-days")
    train, valid = M.hash_split(data, ["station", "date"])
    train = M.for_training(train, ["station", "date"])
    for name, use in (("baseline", False), ("yesterday", True)):
        model = M.tmax_regressor(use).fit(train)
        m = M.regression_metrics(M.predict(model, valid, M.INPUTS if use else M.INPUTS[:-1])).first()
        print(f"Validation rmse ({name}): {m.rmse:g}\nValidation r2 ({name}): {m.r2:g}")
    M.scoring_model(model).write().overwrite().save(a.model_dir)


def weather_test(spark, a) -> None:
    from pyspark.ml import PipelineModel

    from quarry.operators import ml as M

    model = PipelineModel.load(a.model_dir)
    m = M.regression_metrics(model.transform(read_csv(spark, a.inputs, schemas.TMAX))).first()
    print(f"r2 = {m.r2}\nrmse = {m.rmse}")
    print(model.stages[-1].featureImportances)


def weather_tomorrow(spark, a) -> None:
    import datetime

    from pyspark.ml import PipelineModel

    from quarry.operators import ml as M
    from quarry.sources import rows

    model = PipelineModel.load(a.model_dir)
    day = datetime.date.fromisoformat(a.date)
    latest = rows(spark, [(a.station, day, a.latitude, a.longitude, a.elevation, a.tmax)], schemas.TMAX)
    print("Predicted tmax tomorrow:", M.score_tomorrow(model, latest).first().tmax_tomorrow)


def colour_predict(spark, a) -> None:
    from quarry.operators import ml as M

    words = read_csv(spark, a.inputs, schemas.COLOUR_WORDS)
    key = ["R", "G", "B", "word"]
    index = M.word_index(words)
    train, valid = M.hash_split(words, key)
    train = M.for_training(train, key)
    for space in ("rgb", "lab"):
        model = M.colour_classifier(index, space).fit(train)
        acc = M.accuracy(model.transform(valid)).first().accuracy
        print(f"Validation score for {space.upper()} model: {acc:g}")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="quarry")
    sub = p.add_subparsers(dest="program", required=True)

    def cmd(name, fn, *args):
        s = sub.add_parser(name)
        for arg in args:
            s.add_argument(*arg[0], **arg[1])
        s.set_defaults(fn=fn)
        return s

    io = (["inputs"], {}), (["output"], {})
    cmd("wordcount", wordcount, *io, (["--keep-empty"], {"action": "store_true"}))
    cmd("numbersum", numbersum, (["inputs"], {}))
    cmd("wikipedia_popular", wikipedia_popular, *io, (["--with-title"], {"action": "store_true"}))
    cmd("wikipedia_popular_df", wikipedia_popular_df, *io, (["--exclude-prefix"], {"default": "Special"}),
        (["--join"], {"default": "auto", "choices": ["auto", "broadcast", "merge"]}))
    cmd("reddit_averages", reddit_averages, *io)
    cmd("reddit_average_df", reddit_average_df, *io)
    cmd("reddit_etl", reddit_etl, *io)
    cmd("relative_score", relative_scores, *io, (["--broadcast"], {"action": "store_true"}))
    cmd("weather_etl", weather_etl, *io)
    cmd("temp_range", temp_range, *io, (["--sql"], {"action": "store_true"}))
    cmd("load_logs", load_logs, (["inputs"], {}), (["keyspace"], {}), (["table"], {}),
        (["--format"], {"default": "org.apache.spark.sql.cassandra"}), (["--spread"], {"type": int, "default": None}))
    cmd("correlate_logs", correlate_logs, (["inputs"], {}), (["--format"], {"default": "text"}), (["--keyspace"], {"default": None}))
    cmd("read_stream", read_stream, (["topic"], {}), (["checkpoint"], {}), (["--servers"], {"default": "localhost:9092"}),
        (["--every"], {"default": "10 seconds"}), (["--seconds"], {"type": int, "default": None}))
    cmd("shortest_path", shortest, (["input_dir"], {}), (["output_dir"], {}), (["src"], {"type": int}), (["dst"], {"type": int}),
        (["--max-iters"], {"type": int, "default": None}), (["--trace"], {"action": "store_true"}))
    cmd("weather_train", weather_train, (["inputs"], {}), (["model_dir"], {}))
    cmd("weather_test", weather_test, (["model_dir"], {}), (["inputs"], {}))
    cmd("weather_tomorrow", weather_tomorrow, (["model_dir"], {}), (["--station"], {"required": True}),
        (["--date"], {"required": True}), (["--latitude"], {"type": float, "required": True}),
        (["--longitude"], {"type": float, "required": True}), (["--elevation"], {"type": float, "required": True}),
        (["--tmax"], {"type": float, "required": True}))
    cmd("colour_predict", colour_predict, (["inputs"], {}))
    a = p.parse_args(argv)
    a.fn(_session(f"quarry-{a.program}"), a)


if __name__ == "__main__":
    main(sys.argv[1:])
