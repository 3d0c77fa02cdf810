"""Line parsing: words, integers, file-name hours, access logs, adjacency,
points, JSON picking (FIXTURES B3, B5, B10, B11)."""

from pyspark.sql import functions as F

from quarry.functions import json as J
from quarry.functions import text as T
from quarry.operators.aggregate import word_count
from quarry.operators.logs import host_totals, log_rows
from tests.conftest import lines_df

SAMPLE_LOG = [
    'alpha.example.org - - [03/Aug/1995:10:00:01 -0400] "GET /notes/one.txt HTTP/1.0" 200 1200',
    'beta.example.net - - [03/Aug/1995:10:00:02 -0400] "GET / HTTP/1.0" 304 0',
    'beta.example.net - - [03/Aug/1995:10:00:02 -0400] "GET /pics/a.gif HTTP/1.0" 304 0',
    'gamma-7.example.com - - [03/Aug/1995:10:00:04 -0400] "GET /pics/b.gif HTTP/1.0" 200 2500',
    'alpha.example.org - - [03/Aug/1995:10:00:05 -0400] "GET /notes/two.txt HTTP/1.0" 200 300',
    'beta.example.net - - [03/Aug/1995:10:00:06 -0400] "GET /pics/c.gif HTTP/1.0" 304 0',
    'delta.example.org - - [03/Aug/1995:10:00:07 -0400] "GET /index.html HTTP/1.0" 200 777',
    'gamma-7.example.com - - [03/Aug/1995:10:00:08 -0400] "GET /pics/d.gif HTTP/1.0" 200 500',
    'delta.example.org - - [03/Aug/1995:10:00:09 -0400] "GET /faq.html HTTP/1.0" 200 223',
    'beta.example.net - - [03/Aug/1995:10:00:09 -0400] "GET /pics/e.gif HTTP/1.0" 200 90',
]


def test_tokens_keep_and_drop_empty(spark):
    df = lines_df(spark, [" a, b!"])
    kept = df.select(T.tokens("value", keep_empty=True).alias("t")).first().t
    assert kept == ["", "a", "b", ""]
    counts = {r.word: r.n for r in word_count(df, "value").collect()}
    assert counts == {"a": 1, "b": 1}
    with_empty = {r.word: r.n for r in word_count(df, "value", keep_empty=True).collect()}
    assert with_empty == {"": 2, "a": 1, "b": 1}


def test_word_count_total_equals_tokens(spark):
    text = ["The cat; the DOG.", "dog's   day", ""]
    df = lines_df(spark, text)
    total = word_count(df, "value").agg(F.sum("n")).first()[0]
    import re
    import string

    expected = sum(1 for line in text for w in re.split(f"[{re.escape(string.punctuation)}\\s]+", line.lower()) if w)
    assert total == expected


def test_unicode_space_option(spark):
    df = lines_df(spark, ["a b"])
    assert df.select(T.tokens("value").alias("t")).first().t == ["a b"]
    assert df.select(T.tokens("value", unicode_space=True).alias("t")).first().t == ["a", "b"]


def test_tolerant_long(spark):
    df = lines_df(spark, ["12", " 7 ", "1_0", "5.9", "x", "-3", ""])
    got = [r.v for r in df.select(T.tolerant_long("value").alias("v")).collect()]
    assert got == [12, 7, 10, None, None, -3, None]


def test_hour_from_file_name(spark):
    df = lines_df(spark, ["pagecounts-20160801-120000.gz", "pagecounts-20160801-1200", "pagecounts-20160801-130000", "other.gz"])
    got = [r.h for r in df.select(T.hour_from_file_name("value").alias("h")).collect()]
    assert got == ["20160801-12", None, "20160801-13", None]


def test_number_tokens(spark):
    df = lines_df(spark, ["a 1.5 -2 x3 +4"])
    assert df.select(T.number_tokens("value").alias("n")).first().n == [1.5, -2.0, 3.0, 4.0]


def test_access_log_hosts(spark):
    rows = log_rows(lines_df(spark, SAMPLE_LOG))
    totals = {r.host: (r.requests, r.bytes) for r in host_totals(rows).collect()}
    assert totals == {
        "alpha.example.org": (2, 1500),
        "beta.example.net": (4, 90),
        "gamma-7.example.com": (2, 3000),
        "delta.example.org": (2, 1000),
    }
    ids = [r.req_id for r in rows.collect()]
    assert len(set(ids)) == len(SAMPLE_LOG)


def test_access_log_edges(spark):
    bad = [
        'h - - [01/Aug/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 -',
        'h - - [01/Aug/1995:00:00:01 -0400] "get /x HTTP/1.0" 200 5',
        'h - - [01/Aug/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 5',
    ]
    rows = log_rows(lines_df(spark, bad)).collect()
    assert len(rows) == 1
    import datetime

    assert rows[0].datetime == datetime.datetime(1995, 8, 1, 0, 0, 1)
    assert rows[0].bytes == 5


def test_request_id_does_not_depend_on_splits(spark, tmp_path):
    """Equal lines get distinct ids, the same ones however the file is cut."""
    path = tmp_path / "log.txt"
    path.write_text("\n".join(SAMPLE_LOG * 40) + "\n")
    seen = []
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("128m", "4k", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        seen.append(sorted(r.req_id for r in log_rows(spark.read.text(str(path))).collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert seen[0] == seen[1] == seen[2] and len(set(seen[0])) == 40 * len(SAMPLE_LOG)


def test_adjacency(spark):
    lines = ["1: 3 5", "2: 4", "3: 2 5", "4: 3", "5:", "6: 1 5", " 7 :  8", "junk"]
    edges = sorted((r.src, r.dst, r.weight) for r in T.parse_adjacency(lines_df(spark, lines)).collect())
    assert edges == [(1, 3, 1.0), (1, 5, 1.0), (2, 4, 1.0), (3, 2, 1.0), (3, 5, 1.0), (4, 3, 1.0), (6, 1, 1.0), (6, 5, 1.0), (7, 8, 1.0)]


def test_points(spark):
    pts = T.parse_points(lines_df(spark, ["1 3", "2 5", "  3   8 ", "x 2", "4"])).collect()
    assert [(p.x, p.y) for p in pts] == [(1.0, 3.0), (2.0, 5.0), (3.0, 8.0)]


def test_pick_comments_edges(spark):
    lines = [
        '{"subreddit": "datascience", "author": "carol", "score": 10}',
        '{"subreddit": "python", "score": 0}',
        '{"subreddit": "python", "author": "x", "score": null}',
        '{"author": "y", "score": 3}',
        '{"subreddit": "", "score": 3}',
        "not json",
        "[1]",
        '{"subreddit": "r", "author": "z", "score": 1.7}',
        '{"subreddit": "r", "author": "z", "score": "3"}',
        '{"subreddit": "r", "author": "z", "score": "3.5"}',
    ]
    got = sorted(
        (r.subreddit, r.score, r.author) for r in J.pick_comments(lines_df(spark, lines), score_type="bigint").collect()
    )
    assert got == [("datascience", 10, "carol"), ("python", 0, "unknown"), ("r", 1, "z"), ("r", 3, "z")]
    dbl = sorted(r.score for r in J.pick_comments(lines_df(spark, lines), score_type="double").collect())
    assert dbl == [0.0, 1.7, 3.0, 3.5, 10.0]
