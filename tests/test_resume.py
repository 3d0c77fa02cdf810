"""A search that goes on from its folders; a stream fed slice by slice."""

import os

import pytest

from quarry.functions.text import parse_adjacency
from quarry.operators.graph import resumable_paths, shortest_path, shortest_paths
from quarry.operators.sinks import iteration_writer
from quarry.streaming.regression import fit_by_slice, fit_points
from tests.conftest import lines_df

CHAIN = [f"{i}: {i + 1} {i + 2 if i % 3 else 90 + i}" for i in range(12)] + ["700: 701"]


def found(df):
    return sorted(map(tuple, df.select("node", "dist", "prev", "hops").collect()))


def data_files(folder):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(folder) for f in names}


def test_a_search_resumes_midway_and_deletes_nothing(spark, tmp_path):
    edges, folder = parse_adjacency(lines_df(spark, CHAIN)), str(tmp_path / "search")
    capped = resumable_paths(edges, 0, folder, 3)
    assert found(capped) == found(shortest_paths(edges, 0, 3)) and capped.where("open").count() > 0
    before = data_files(folder)
    os.remove(f"{folder}/pass-00003/_SUCCESS")  # the driver was lost before this pass was closed
    traced = []
    whole = resumable_paths(edges, 0, folder, trace=lambda i, s: traced.append(i))
    assert found(whole) == found(shortest_paths(edges, 0)) and whole.where("open").count() == 0
    assert traced[0] == 3 and traced == list(range(3, traced[-1] + 1))
    after = data_files(folder)
    kept = {f: t for f, t in before.items() if "pass-00003" not in f}
    assert kept == {f: after[f] for f in kept}
    again = data_files(folder)
    assert found(resumable_paths(edges, 0, folder)) == found(whole) and data_files(folder) == again  # nothing left to do
    assert shortest_path(whole, 701).count() == 0 and shortest_path(whole, 5).count() > 0


def test_iterations_as_csv(spark, tmp_path):
    edges = parse_adjacency(lines_df(spark, CHAIN))
    resumable_paths(edges, 0, str(tmp_path / "s"), 2, iteration_writer(str(tmp_path / "t"), ["node", "dist", "prev"]))
    rows = {i: sorted(tuple(r) for r in spark.read.schema("node long, dist double, prev long").csv(f"{tmp_path}/t/iter-{i}").collect()) for i in range(3)}
    assert rows[0] == [(0, 0.0, -1)] and rows[1] == [(0, 0.0, -1), (1, 1.0, 0), (90, 1.0, 0)] and len(rows[2]) > 3


def test_slices_over_several_epochs_and_queries(spark, tmp_path):
    slices = [lines_df(spark, [f"{x} {2 * x + 1}" for x in range(k * 10, k * 10 + 10)] + ["junk"]).repartition(3) for k in range(3)]
    slices.insert(1, lines_df(spark, []))
    folder, state, out = (str(tmp_path / n) for n in ("in", "state", "out"))
    spark.createDataFrame([], "value string").write.text(folder)
    got = {r.slice: r for r in fit_by_slice(slices, folder, state, out, files_per_trigger=2, stop_after={2}).collect()}
    assert [got[k].n for k in range(4)] == [10, 10, 20, 30]
    assert all(got[k].slope == pytest.approx(2) and got[k].intercept == pytest.approx(1) for k in range(4))
    epochs = {r.epoch: r.n for r in spark.read.parquet(f"{out}/epochs").collect()}
    assert len(epochs) >= 5 and sorted(epochs) == list(range(len(epochs)))  # two files a trigger; one count on over both queries
    assert list(dict(sorted(epochs.items())).values()) == sorted(epochs.values()) and max(epochs.values()) == 30
    batch = fit_points(slices[0].union(slices[2]).union(slices[3])).first()
    assert (got[3].n, got[3].slope) == (batch.n, pytest.approx(batch.slope))
