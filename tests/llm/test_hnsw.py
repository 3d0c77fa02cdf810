import io
from collections import defaultdict

import numpy as np
import pytest

from quarry.llm import hnsw
from quarry.llm.common import Scratch, table
from quarry.llm.queries import QUERIES


def usable(i, v):
    return i is not None and v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)


def brute(rows, top=20, every=20):
    """query -> [(vec_id, score)], nearest first."""
    rows = [(i, tuple(v)) for i, v in rows if usable(i, v)]
    out = {}
    for q, v in {r for r in rows if r[0] % every == 0}:
        found = [(-float((np.array(v) * np.array(w)).sum()), i) for i, w in rows if i != q and len(w) == len(v)]
        out.setdefault(q, []).extend((i, -s) for s, i in sorted(found)[:top])
    return out


def result(df):
    out = defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        assert r.rank == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return dict(out)


def recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_recall_against_brute_force(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in table(spark, f"/root/testdata/{sf}", "embeddings").collect()]
    got = result(QUERIES["op11_nearest_neighbours"](spark, f"/root/testdata/{sf}"))
    vectors = {i: np.array(v, float) for i, v in rows if usable(i, v)}
    ids, x = list(vectors), np.array(list(vectors.values()))
    want = {}
    for q in (i for i in ids if i % 20 == 0):
        s = x @ vectors[q]
        order = [k for k in np.lexsort((ids, -s)) if ids[k] != q][:20]
        want[q] = [(ids[k], s[k]) for k in order]
    assert set(got) == set(want) and all(len(v) == min(20, len(ids) - 1) for v in got.values())
    assert recall(got, want) >= 0.97
    for q, found in got.items():
        assert all(s == (vectors[q] * vectors[i]).sum() for i, s in found)
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))


def test_graph_of_random_vectors_of_any_length():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 24)) * rng.lognormal(0, 1.5, (3000, 1))
    band = hnsw._bands(x)
    graphs = [hnsw.Graph.of(np.flatnonzero(band == b), x[band == b]) for b in np.unique(band)]
    assert len(graphs) > 3
    q = rng.normal(size=(50, 24))
    hits = 0
    best = [[] for _ in q]
    for g in graphs:
        for k, (ids, score) in enumerate(g.nearest(np.full(50, -1), q, 20, hnsw.EF)):
            best[k] += zip(-score, ids)
    for k, v in enumerate(q):
        hits += len({i for _, i in sorted(best[k])[:20]} & set(np.argsort(-(x @ v))[:20].tolist()))
    assert hits >= 0.97 * 1000


def test_layers_are_flat_and_stored_whole():
    rng = np.random.default_rng(1)
    g = hnsw.Graph.of(np.arange(1500), rng.normal(size=(1500, 8)).astype(np.float32))
    assert len(g.layers) >= 2 and len(g.layers[0]) == 1500
    for links in g.layers:
        assert links.dtype == np.int32 and links.max() < len(links) and ((links >= 0).sum(axis=1) > 0).mean() > 0.99 or len(links) == 1
        assert all(i not in row for i, row in enumerate(links.tolist()))
    f = io.BytesIO()
    g.write(f)
    f.seek(0)
    back = hnsw.Graph.read(f)
    assert all(np.array_equal(a, b) for a, b in zip([*(getattr(g, n) for n in g.FIELDS), *g.layers], [*(getattr(back, n) for n in g.FIELDS), *back.layers]))


def test_shards_follow_the_rows():
    assert hnsw.shard_rows(10, 200) == 2_048 and hnsw.shard_rows(10**6, 100) == 10_000 and hnsw.shard_rows(10**10, 1000) == 16_384


EDGE = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (5, [0.5, 0.5]), (7, [-1.0, 0.0]), (8, [300.0, 1.0]), (9, [1e-9, 1e-9]), (11, None), (12, []),
        (13, [None, 1.0]), (14, [float("nan"), 1.0]), (15, [float("inf"), 1.0]), (16, [0.0, 0.0]), (None, [1.0, 1.0]), (40, [1.0, 2.0, 3.0]), (41, [1.0, 0.0, 1.0]), (60, None), (80, [0.0])]


def test_nulls_ties_copies_lengths_and_clashing_columns(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hnsw, "LEAST_SHARD", 4)
    more = EDGE + [(100 + i, [1.0, 0.0]) for i in range(1, 60)] + [(300 + 20 * i, [0.0, 1.0]) for i in range(3)]
    spark.createDataFrame(more, "vec_id long, embedding array<double>").selectExpr("*", "1 AS id", "2 AS key", "3 AS rank", "4 AS label").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = result(QUERIES["op11_nearest_neighbours"](spark, str(tmp_path)))
    want = brute(more)
    assert {q: v for q, v in want.items() if v} == got
    assert got[40] == [(41, 4.0)] and got[0][:3] == [(8, 300.0), (3, 1.0), (3, 1.0)]


def test_no_queries_and_empty_tables(spark, tmp_path):
    for name, rows in (("none", []), ("unasked", [(1, [1.0]), (2, [2.0])]), ("alone", [(0, [1.0])])):
        spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / name / "embeddings.parquet"))
        df = QUERIES["op11_nearest_neighbours"](spark, str(tmp_path / name))
        assert df.columns == ["query_id", "rank", "vec_id", "score"] and df.count() == 0


def test_queries_of_their_own(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(500)]
    asked = [(-1, rng.normal(size=6).tolist()), (-2, rng.normal(size=6).tolist())]
    schema = "vec_id long, embedding array<double>"
    got = result(hnsw.nearest(spark.createDataFrame(rows, schema), spark.createDataFrame(asked, schema), Scratch(spark, "t"), top=5))
    for q, v in asked:
        want = sorted((-(np.array(v) * np.array(w)).sum(), i) for i, w in rows)[:5]
        assert [i for i, _ in got[q]] == [i for _, i in want]
