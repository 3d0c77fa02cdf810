"""Ids that hold many rows are cut by a hash, in the order of the sort."""

import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F
from test_sketch import brute, rows_of

from quarry.llm import sketch, tokens
from quarry.llm.common import Scratch
from quarry.llm.ranges import dealt_by_id, with_part
from quarry.llm.tokens import END_ID


def tie(text):
    h = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return h - (1 << 64) if h >> 63 else h


@pytest.fixture()
def skewed(spark):
    """A third of the rows has no id, a third has one id."""
    rng = random.Random(3)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else rng.randrange(-500, 500), " ".join(rng.choices("abcdefgh", k=rng.randrange(1, 9))) + f" {i}") for i in range(900)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    yield rows, spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_parts_are_even_and_in_order(spark, skewed):
    rows, df = skewed
    for up in (True, False):
        got, n = with_part(df, "doc_id", F.xxhash64("text"), nulls_first=not up, ties_down=not up)
        got = got.collect()
        sizes = Counter(r.part for r in got)
        assert max(sizes) < n and min(sizes) >= 0 and max(sizes.values()) < 0.2 * len(rows)
        order = sorted(got, key=lambda r: ((r.doc_id is None) == up, r.doc_id or 0, tie(r.text) if up else -tie(r.text)))
        assert [r.part for r in order] == sorted(r.part for r in got)
    assert sum(1 for p in dealt_by_id(df, "doc_id", F.xxhash64("text")).rdd.glom().collect() if p) >= 9


def test_neighbours_and_files_over_cut_ids(spark, skewed):
    rows, df = skewed
    ordered = sorted(rows, key=lambda r: tie(r[1]))  # brute() sorts stably
    assert rows_of(sketch.edited_fingerprints(df.repartition(4))) == sorted(brute(ordered), key=str)

    got = sorted(map(tuple, tokens.read(tokens.write(df, "/opt/tokenizers/word_bpe_49k.json", Scratch(spark, "t"))).collect()), key=lambda r: r[1])
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, tie(r[1])))
    assert [r[0] for r in got] == [r[0] for r in want] and [r[1] for r in got][0] == 0
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:])) and END_ID == 1


def test_one_id_for_all_and_no_rows(spark, skewed):
    rows, df = skewed
    same = df.withColumn("doc_id", F.lit(5).cast("long"))
    got, n = with_part(same, "doc_id", F.xxhash64("text"))
    assert len({r.part for r in got.collect()}) >= 9
    none, n = with_part(df.withColumn("doc_id", F.lit(None).cast("long")), "doc_id", F.xxhash64("text"))
    assert len({r.part for r in none.collect()}) >= 9
    assert with_part(df.limit(0), "doc_id", F.xxhash64("text"))[0].count() == 0
