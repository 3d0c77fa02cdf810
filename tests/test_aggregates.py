"""Group averages, relative score, split, arg-max, exact median, correlation
and regression (FIXTURES B1, B2, B3, B8, B11)."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.functions import json as J
from quarry.operators import aggregate as A
from quarry.operators import pagecounts as P
from quarry.operators.correlate import correlate, linear_fit
from quarry.operators.join import relative_score
from quarry.operators.sinks import with_split
from tests.conftest import lines_df

B1 = [
    '{"subreddit": "gardening", "author": "ines", "score": 9}',
    '{"subreddit": "gardening", "author": "jonas", "score": 1}',
    '{"subreddit": "chess", "author": "kim", "score": 6}',
    '{"subreddit": "chess", "author": "lea", "score": 2}',
    '{"subreddit": "baking", "author": "mona", "score": 20}',
    '{"subreddit": "baking", "author": "nils", "score": 5}',
]


def test_group_average(spark):
    c = J.pick_comments(lines_df(spark, B1), score_type="double")
    got = {r.subreddit: r.average_score for r in A.average_per_key(c, "subreddit", "score").collect()}
    assert got == {"gardening": 5.0, "chess": 4.0, "baking": 12.5}


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "merge"])
def test_relative_score(spark, strategy):
    c = J.pick_comments(lines_df(spark, B1), score_type="double")
    got = sorted(((r.rel, r.author) for r in relative_score(c, strategy=strategy).collect()), reverse=True)
    want = [(9 / 5, "ines"), (20 / 12.5, "mona"), (6 / 4, "kim"), (2 / 4, "lea"), (5 / 12.5, "nils"), (1 / 5, "jonas")]
    assert [a for _, a in got] == [a for _, a in want]
    assert [round(r, 9) for r, _ in got] == [round(r, 9) for r, _ in want]


def test_relative_score_drops_nonpositive_groups(spark):
    lines = B1 + ['{"subreddit": "neg", "author": "n1", "score": -1}', '{"subreddit": "", "author": "e", "score": 4}']
    c = J.parse_objects(lines_df(spark, lines)).select(
        J.get(F.col("v"), "subreddit", "string").alias("subreddit"),
        J.get_or_default(F.col("v"), "score", "double", 0.0).alias("score"),
        J.get(F.col("v"), "author", "string").alias("author"),
    )
    kept = {r.author for r in relative_score(c).collect()}
    assert "n1" not in kept and "e" in kept
    assert "e" not in {r.author for r in relative_score(c, drop_empty_group=True).collect()}


def test_split_positive_negative(spark):
    lines = B1 + [
        '{"subreddit": "eee", "author": "z", "score": 0}',
        '{"subreddit": "eee", "author": "m", "score": -1}',
        '{"subreddit": "eee"}',
    ]
    c = J.pick_comments(lines_df(spark, lines))
    out = with_split(c.where(F.col("subreddit").contains("e")), F.col("score") > 0, "positive", "negative")
    rows = {(r.author, r.bucket) for r in out.collect()}
    assert rows == {
        ("ines", "positive"), ("jonas", "positive"), ("kim", "positive"), ("lea", "positive"),
        ("z", "negative"), ("m", "negative"), ("unknown", "negative"),
    }


def _counts(spark, rows):
    df = spark.createDataFrame(rows, "hour string, lang string, title string, views bigint")
    return P.wanted_pages(df)


def test_argmax_ties_and_one(spark):
    rows = [
        ("h1", "en", "A", 10), ("h1", "en", "B", 10), ("h1", "en", "C", 3),
        ("h1", "en", "Main_Page", 99), ("h1", "en", "Special:X", 99), ("h1", "fr", "D", 50),
        ("h2", "en", "E", 1),
    ]
    c = _counts(spark, rows)
    for strategy in ("auto", "broadcast", "merge"):
        ties = sorted(tuple(r) for r in P.top_pages_per_hour(c, strategy).collect())
        assert ties == [("h1", "A", 10), ("h1", "B", 10), ("h2", "E", 1)]
    assert sorted(tuple(r) for r in P.top_pages_per_hour(c, materialize_input=True).collect()) == ties
    one = sorted(tuple(r) for r in P.top_page_per_hour(c).collect())
    assert one == [("h1", 10, "B"), ("h2", 1, "E")]


def test_counts_parsers(spark):
    lines = ["20160801-120000 en Foo 12 345", "20160801-120000 en Bar x 1", "short line", "20160801-120000 en Baz 7 1 2 3"]
    got = sorted(tuple(r) for r in P.parse_counts5(lines_df(spark, lines)).collect())
    assert got == [("20160801-120000", "en", "Baz", 7), ("20160801-120000", "en", "Foo", 12)]
    df = spark.createDataFrame(
        [("en Foo 12 345", "pagecounts-20160801-120000.gz"), ("en Foo 12 345", "other"), ("en Foo 12", "pagecounts-20160801-120000")],
        "value string, file_name string",
    )
    assert [tuple(r) for r in P.parse_counts4(df).collect()] == [("20160801-12", "en", "Foo", 12)]


def test_exact_median_matches_builtin(spark):
    rnd = random.Random(7)
    rows = [("a", float(rnd.randint(0, 50))) for _ in range(3001)]  # many duplicates
    rows += [("b", rnd.random() * 1e6) for _ in range(2000)]
    rows += [("c", 5.0)] * 500 + [("d", 1.0), ("d", 2.0), ("d", 3.0), ("d", 10.0)]
    rows += [(None, 1.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    want = {r.k: r.m for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    got = {r.k: r.median for r in A.exact_median(df, ["k"], "v").collect()}
    assert got == pytest.approx(want, rel=1e-12)
    assert want["d"] == 2.5


@pytest.mark.parametrize("partitions", ["1", "3", "16"])
def test_exact_median_of_odd_values(spark, partitions):
    rnd = random.Random(11)
    inf, nan = float("inf"), float("nan")
    rows = [("inf", rnd.choice([1.0, 2.0, 3.0, inf])) for _ in range(200)] + [("nan", rnd.choice([1.0, nan, 3.0])) for _ in range(201)]
    rows += [("wide", rnd.choice([-1, 1]) * 10 ** rnd.uniform(-300, 300)) for _ in range(500)] + [("allnan", nan)] * 3 + [("ends", -inf), ("ends", inf)]
    rows += [("zero", 0.0), ("zero", -0.0), ("big", 1e308), ("big", 1.5e308), (None, None), ("null", None), ("null", 4.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        want = {r.k: r.m for r in df.groupBy("k").agg(F.median("v").alias("m")).collect() if r.m is not None}
        got = {r.k: r.median for r in A.exact_median(df, ["k"], "v").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == pytest.approx(want, rel=1e-15, nan_ok=True)


def test_regression_and_correlation(spark):
    pts = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0), (3.0, 8.0)], "x double, y double")
    fit = linear_fit(pts).first()
    assert fit.n == 3 and fit.slope == pytest.approx(2.5) and fit.intercept == pytest.approx(1 / 3)
    assert correlate(pts).first().r == pytest.approx(0.99339926779878)
    one = spark.createDataFrame([(1.0, 3.0)], "x double, y double")
    assert linear_fit(one).first().slope is None
    const = spark.createDataFrame([(1.0, 3.0), (1.0, 5.0)], "x double, y double")
    assert linear_fit(const).first().slope is None
    assert correlate(const).first().r is None


def test_numeric_tokens(spark):
    df = lines_df(spark, ["1 2 2.5", "x -1 2"])
    got = {r.number: (r.n, r.subtotal) for r in A.numeric_token_sums(df).collect()}
    assert got == {1.0: (1, 1.0), 2.0: (2, 4.0), 2.5: (1, 2.5), -1.0: (1, -1.0)}
    tot = A.numeric_token_total(df).first()
    assert (tot.n_numbers, tot.total) == (5, 6.5)


def test_exact_median_with_extra_aggregates(spark):
    rows = [("x", i, float(i % 97)) for i in range(1500)] + [("y", 1, None), ("y", 2, 4.0), (None, 3, 2.0)]
    df = spark.createDataFrame(rows, "g string, id int, v double")
    want = {r.g: (r.n, r.a, r.m) for r in df.groupBy("g").agg(F.count("id").alias("n"), F.avg("v").alias("a"), F.median("v").alias("m")).collect()}
    out = A.exact_median(df, ["g"], "v", alias="m", extra={"n": F.count("id"), "a": F.avg("v")}, carry=["id"])
    got = {r.g: (r.n, r.a, r.m) for r in out.collect()}
    assert got.keys() == want.keys()
    for k, (n, a, m) in want.items():
        assert got[k][0] == n and got[k][1] == pytest.approx(a) and got[k][2] == pytest.approx(m)
