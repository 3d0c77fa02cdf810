"""Shortest paths (B4), upsert (B6), colour conversions (B12)."""

import colorsys

import pytest
from pyspark.sql import functions as F

from quarry.functions.colour import rgb_to_hsv, rgb_to_lab
from quarry.functions.text import parse_adjacency
from quarry.operators.graph import shortest_path, shortest_paths
from quarry.operators.keyed import change_rows, dedupe_on_key, upsert
from quarry.operators.sinks import delimited_lines
from quarry.sources.schemas import KEY_VALUE
from tests.conftest import lines_df

DIJKSTRA = ["1: 3 5", "2: 4", "3: 2 5", "4: 3", "5:", "6: 1 5"]


@pytest.fixture(scope="module")
def edges(spark):
    return parse_adjacency(lines_df(spark, DIJKSTRA))


def test_shortest_paths_golden(spark, edges):
    states = {}
    dist = shortest_paths(edges, 1, 6, trace=lambda i, d: states.setdefault(i, sorted(tuple(r)[:3] for r in d.collect())))
    got = sorted(tuple(r)[:3] for r in dist.collect())
    assert got == [(1, 0.0, None), (2, 2.0, 3), (3, 1.0, 1), (4, 3.0, 2), (5, 1.0, 1)]
    assert states[0] == [(1, 0.0, None)]
    assert states[1] == [(1, 0.0, None), (3, 1.0, 1), (5, 1.0, 1)]
    assert states[3] == got
    assert 4 not in states  # stopped early: pass 4 improves nothing
    path = sorted(tuple(r) for r in shortest_path(dist, 4).collect())
    assert path == [(0, 1), (1, 3), (2, 2), (3, 4)]
    assert shortest_path(dist, 6).count() == 0
    assert sorted(tuple(r) for r in shortest_path(dist, 1).collect()) == [(0, 1)]
    text = sorted(r.value for r in delimited_lines(dist, ["node", "dist", "prev"], sep=",").collect())
    assert "1,0.0,-1" in text


def test_shortest_paths_tie_takes_smaller_prev(spark):
    e = parse_adjacency(lines_df(spark, ["1: 7 3", "7: 9", "3: 9"]))
    got = {r.node: r.prev for r in shortest_paths(e, 1).collect()}
    assert got[9] == 3


def test_shortest_paths_property(spark):
    import random

    rnd = random.Random(3)
    lines = [f"{i}: " + " ".join(str(rnd.randint(0, 40)) for _ in range(rnd.randint(0, 3))) for i in range(40)]
    e = parse_adjacency(lines_df(spark, lines))
    d = {r.node: r.dist for r in shortest_paths(e, 0, max_iters=50).collect()}
    for r in e.collect():
        if r.src in d:
            assert r.dst in d and d[r.dst] <= d[r.src] + 1


def test_long_chain_hub_and_unreachable_target(spark):
    lines = [f"{i}: {i + 1}" for i in range(49)] + ["100: " + " ".join(str(200 + i) for i in range(300)), "49: 100", "900: 901"]
    e = parse_adjacency(lines_df(spark, lines))
    dist = shortest_paths(e, 0)
    got = {r.node: (r.dist, r.open) for r in dist.collect()}
    assert got[49] == (49.0, False) and got[499] == (51.0, False) and 901 not in got and len(got) == 351
    path = sorted(tuple(r) for r in shortest_path(dist, 499).collect())
    assert path == [*((i, i) for i in range(50)), (50, 100), (51, 499)]
    assert shortest_path(dist, 901).count() == 0
    target = spark.createDataFrame([(3,)], "node long")
    assert shortest_path(dist, target).count() == 4
    with pytest.raises(ValueError):
        shortest_path(dist, target.union(target))


def test_a_cut_search_says_so(spark):
    e = parse_adjacency(lines_df(spark, [f"{i}: {i + 1}" for i in range(10)]))
    cut = shortest_paths(e, 0, max_iters=3)
    assert sorted((r.node, r.open) for r in cut.collect()) == [(0, False), (1, False), (2, False), (3, True)]
    assert shortest_paths(e, 0, max_iters=30).where("open").isEmpty()


def test_weighted_paths_improve_on_longer_routes(spark):
    e = spark.createDataFrame([(1, 2, 10.0), (1, 3, 1.0), (3, 4, 1.0), (4, 2, 1.0), (2, 5, 1.0)], "src long, dst long, weight double")
    dist = shortest_paths(e, 1)
    assert {r.node: (r.dist, r.prev, r.hops) for r in dist.collect()} == {1: (0.0, None, 0), 3: (1.0, 1, 1), 4: (2.0, 3, 2), 2: (3.0, 4, 3), 5: (4.0, 2, 4)}
    assert [r.node for r in shortest_path(dist, 5).orderBy("step").collect()] == [1, 3, 4, 2, 5]


def test_upsert_golden(spark):
    base = spark.createDataFrame([], KEY_VALUE)
    seq = [(1, "initial", 1), (2, "secondary", 2), (3, "third", 3), (3, "tertiary", 4), (2, "double", 5)]
    ch = spark.createDataFrame(seq, "id int, data string, s int")
    state = upsert(base, change_rows(ch, ["data"], F.col("s")), "id", ["data"])
    assert sorted(tuple(r) for r in state.collect()) == [(1, "initial"), (2, "double"), (3, "tertiary")]
    batch = spark.createDataFrame([(4, "square", 1), (5, "cinq", 2)], "id int, data string, s int")
    state2 = upsert(state, change_rows(batch, ["data"], F.col("s")), "id", ["data"])
    assert sorted(tuple(r) for r in state2.collect()) == [
        (1, "initial"), (2, "double"), (3, "tertiary"), (4, "square"), (5, "cinq")
    ]


def test_upsert_keeps_unspecified_columns(spark):
    base = spark.createDataFrame([(1, "a", 10)], "id int, name string, n int")
    ch = spark.createDataFrame([(1, None, 11, ["n"], 1), (1, "b", None, ["name"], 2)],
                               "id int, name string, n int, _set array<string>, _seq int")
    assert [tuple(r) for r in upsert(base, ch, "id", ["name", "n"]).collect()] == [(1, "b", 11)]
    ch2 = spark.createDataFrame([(1, None, 12, ["name", "n"], 3)], "id int, name string, n int, _set array<string>, _seq int")
    assert [tuple(r) for r in upsert(base, ch2, "id", ["name", "n"]).collect()] == [(1, None, 12)]


def test_composite_key_keeps_the_latest(spark):
    df = spark.createDataFrame([("h", 1, "old", 1), ("h", 1, "new", 2), ("h", 1, "older", 0), ("h", 2, "a", 1), ("g", 1, "b", 1), ("g", 1, "b", 1)], "host string, t int, r string, s int")
    got = dedupe_on_key(df, ["host", "t"], ["s"])
    assert got.columns == df.columns
    assert sorted(tuple(r) for r in got.collect()) == [("g", 1, "b", 1), ("h", 1, "new", 2), ("h", 2, "a", 1)]


COLOURS = {
    "brick": (178, 34, 34), "teal": (0, 128, 128), "lime": (0, 255, 0), "navy": (0, 0, 128), "olive": (128, 128, 0),
    "plum": (142, 69, 133), "coal": (20, 20, 20), "ash": (178, 178, 178), "snow": (255, 255, 255), "cyan": (0, 255, 255),
}


def test_colours(spark):
    df = spark.createDataFrame([(k, *v) for k, v in COLOURS.items()], "name string, r int, g int, b int")
    l_, a_, b_ = rgb_to_lab("r", "g", "b")
    h, s, v = rgb_to_hsv("r", "g", "b")
    rows = {r.name: r for r in df.select("name", "r", "g", "b", l_.alias("L"), a_.alias("A"), b_.alias("B"),
                                          h.alias("h"), s.alias("s"), v.alias("v")).collect()}
    for grey in ("coal", "ash", "snow"):
        assert abs(rows[grey].A) < 0.05 and abs(rows[grey].B) < 0.05 and rows[grey].s == 0
    assert (rows["lime"].h, rows["lime"].s, rows["lime"].v) == pytest.approx((1 / 3, 1.0, 1.0))
    assert rows["cyan"].h == pytest.approx(1 / 2)
    assert rows["navy"].h == pytest.approx(4 / 6)
    assert rows["snow"].L == pytest.approx(100.0, abs=0.01)
    for r in rows.values():
        want = colorsys.rgb_to_hsv(r.r / 255, r.g / 255, r.b / 255)
        assert (r.h, r.s, r.v) == pytest.approx(want)


def test_iteration_trace_and_table(spark, edges, tmp_path):
    from quarry.operators.keyed import create_table_if_absent
    from quarry.operators.sinks import iteration_writer

    out = str(tmp_path / "trace")
    shortest_paths(edges, 1, 6, trace=iteration_writer(out, ["node", "dist", "prev"]))
    it0 = spark.read.csv(out + "/iter-0").collect()
    assert [tuple(r) for r in it0] == [("1", "0.0", "-1")]
    assert spark.read.csv(out + "/iter-3").count() == 5
    t = create_table_if_absent(spark, "kv_test", KEY_VALUE, str(tmp_path / "kv"))
    assert t.count() == 0
    t2 = create_table_if_absent(spark, "kv_test", KEY_VALUE, str(tmp_path / "kv"))
    assert t2.columns == ["id", "data"]


def test_write_split_and_lines(spark, tmp_path):
    from quarry.operators.sinks import format_lines, with_split, write_split

    df = spark.createDataFrame([("a", 1), ("b", -2), ("c", 0)], "k string, v int")
    out = str(tmp_path / "split")
    write_split(with_split(df, F.col("v") > 0, "positive", "negative"), out)
    pos = spark.read.json(out + "/bucket=positive").collect()
    neg = sorted(r.k for r in spark.read.json(out + "/bucket=negative").collect())
    assert [r.k for r in pos] == ["a"] and neg == ["b", "c"]
    lines = sorted(r.value for r in format_lines(df, "%s %d", ["k", "v"]).collect())
    assert lines == ["a 1", "b -2", "c 0"]


def test_long_path_walk(spark):
    chain = [f"{i}: {i + 1}" for i in range(20)]
    e = parse_adjacency(lines_df(spark, chain))
    path = sorted(tuple(r) for r in shortest_path(shortest_paths(e, 0), 20).collect())
    assert path == [(i, i) for i in range(21)]


def test_part_graph_distance_histogram(spark):
    """Hop counts from part 1 at sf0.01."""
    from quarry.plans import QUERIES
    from tests.conftest import SF_ORACLE

    d = QUERIES["q21_shortest_distances"](spark, SF_ORACLE)
    hist = sorted((r.dist, r["count"]) for r in d.groupBy("dist").count().collect())
    assert hist == [(0.0, 1), (1.0, 15), (2.0, 205), (3.0, 1341), (4.0, 437), (5.0, 1)]
