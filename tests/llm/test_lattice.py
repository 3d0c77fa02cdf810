import numpy as np

from quarry.llm import lattice
from quarry.llm.common import Scratch, table


def brute(ids, vectors, cosine=0.95):
    ok = [i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v) for i, v in zip(ids, vectors)]
    n = len(ids)
    unit = [np.array(v, float) / np.abs(np.array(v, float)).max() if o else None for v, o in zip(vectors, ok)]
    unit = [None if u is None else u / np.sqrt((u * u).sum()) for u in unit]
    link = [[] for _ in range(n)]
    for a in range(n):
        for b in range(a + 1, n):
            if ok[a] and ok[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                link[a].append(b)
                link[b].append(a)
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            for b in link[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        low = min(ids[b] for b in seen) if ids[a] is not None else None
        out.append((ids[a], len(link[a]), low, ids[a] is not None and low == ids[a]))
    return out


def rows_of(df):
    return [(r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()]


def test_e8_decoder_finds_the_nearest_point():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 8)) * 3
    p = lattice.nearest_e8(x)
    assert np.all((2 * p) % 1 == 0) and np.all(p.sum(axis=1) % 2 == 0)
    assert np.all((p % 1 == (p[:, :1] % 1)))
    own = ((x - p) ** 2).sum(axis=1)
    for r in lattice.ROOTS:
        assert np.all(own <= ((x - p - r) ** 2).sum(axis=1) + 1e-9)
    assert len({tuple(r) for r in lattice.ROOTS}) == 240 and np.all((lattice.ROOTS**2).sum(axis=1) == 2)


def cloud(seed=0, groups=30, dim=64, kind=np.float32):
    rng = np.random.default_rng(seed)
    out = []
    for g in range(groups):
        c = rng.normal(size=dim)
        for _ in range(rng.integers(1, 12)):
            out.append((c + rng.normal(size=dim) * rng.uniform(0.02, 0.24)).astype(kind).astype(float).tolist())
    return out


def test_edges_are_exact_here(spark):
    vectors = cloud()
    vectors += [vectors[3], vectors[3], vectors[3][:8], vectors[3][:8], [0.0] * 64, None, [None] + [1.0] * 63, [float("nan")] + [1.0] * 63, [float("inf")] + [1.0] * 63, [],
                [x * 1e-30 for x in vectors[5]], [-x for x in vectors[5]]]
    vectors = [v if v is None else [None if x is None else float(np.float32(x)) for x in v] for v in vectors]
    rng = np.random.default_rng(4)
    ids = [int(x) for x in rng.permutation(len(vectors))]
    ids += [None, ids[0]]
    vectors += [vectors[3], vectors[0]]
    df = spark.createDataFrame(list(zip(ids, vectors)), "vec_id long, embedding array<float>").selectExpr("*", "1 as label", "'x' as low", "2 as h")
    got = rows_of(lattice.near_duplicates(df.repartition(5), Scratch(spark, "t")))
    assert sorted(got, key=str) == sorted(brute(ids, vectors), key=str)
    assert rows_of(lattice.near_duplicates(df.limit(0), Scratch(spark, "t"))) == []


def test_split_cells_count_each_link_once(spark, monkeypatch):
    monkeypatch.setattr(lattice, "CHUNK", 16)
    vectors = cloud(2, groups=2, kind=np.float64) + [(np.ones(64) + np.random.default_rng(i).normal(size=64) * 0.12).tolist() for i in range(150)]
    ids = list(range(len(vectors)))
    df = spark.createDataFrame(list(zip(ids, vectors)), "vec_id long, embedding array<double>")
    assert sorted(rows_of(lattice.near_duplicates(df, Scratch(spark, "t")))) == sorted(brute(ids, vectors))


def test_recall_against_brute_force(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = df.collect()
    x = np.array([r.embedding for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    true = (x @ x.T >= 0.95).sum() - len(x)
    found = sum(r[1] for r in rows_of(lattice.near_duplicates(df, Scratch(spark, "t"))))
    assert found <= true and found >= 0.98 * true
    rng = np.random.default_rng(0)  # pairs just at the threshold
    a = lattice.unit(rng.normal(size=(20_000, 64)))
    e = rng.normal(size=a.shape)
    e = lattice.unit(e - (e * a).sum(axis=1, keepdims=True) * a)
    b = 0.951 * a + np.sqrt(1 - 0.951**2) * e
    (oa, na), (ob, nb) = (lattice.cells(v, lattice.TABLES, lattice.PROBES, lattice.SCALE) for v in (a, b))
    met = (oa == ob) | (na == ob[:, :, None]).any(axis=2) | (nb == oa[:, :, None]).any(axis=2)
    assert met.any(axis=1).mean() > 0.97


def test_cells_stay_small_as_vectors_grow():
    """Two sizes 16 times apart: recall at the threshold, pairs compared a vector."""
    for n in (10_000, 160_000):
        blocks, tables = lattice.shape(n)
        rng = np.random.default_rng(n)
        a = lattice.unit(rng.normal(size=(3_000, 64)))
        e = rng.normal(size=a.shape)
        e = lattice.unit(e - (e * a).sum(axis=1, keepdims=True) * a)
        b = 0.951 * a + np.sqrt(1 - 0.951**2) * e
        (oa, na), (ob, nb) = (lattice.cells(v, tables, lattice.PROBES, lattice.SCALE, blocks) for v in (a, b))
        met = ((oa == ob) | (na == ob[:, :, None]).any(axis=2) | (nb == oa[:, :, None]).any(axis=2)).any(axis=1).mean()
        own, near = zip(*(lattice.cells(lattice.unit(rng.normal(size=(20_000, 64))), 1, lattice.PROBES, lattice.SCALE, blocks) for _ in range(0, n, 20_000)))
        cell, size = np.unique(np.concatenate(own)[:n, 0], return_counts=True)
        looked = np.concatenate([np.concatenate(own)[:n, 0], np.concatenate(near)[:n, 0].ravel()])
        at = np.minimum(np.searchsorted(cell, looked), len(cell) - 1)
        compared = tables * size[at][cell[at] == looked].sum() / n
        print(f"{n} vectors, {blocks} blocks, {tables} tables: recall {met:.3f}, {compared:.0f} pairs compared a vector")
        assert met > 0.95 and compared < lattice.CROWD * tables * (1 + blocks * lattice.PROBES)
        assert size.max() < 0.02 * 128_000
    assert lattice.shape(1) == (1, 4) and lattice.shape(10**8) == (2, 8) and lattice.shape(10**10) == (3, 16)


def test_two_blocks_find_the_links(spark):
    vectors = cloud(7, groups=12, kind=np.float64)
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    want = brute(list(range(len(vectors))), vectors)
    got = rows_of(lattice.near_duplicates(df, Scratch(spark, "t"), blocks=2, tables=8))
    assert sum(r[1] for r in got) >= 0.9 * sum(r[1] for r in want) > 0
    assert {r[0]: r[1] for r in got}.items() <= {(i, n) for i, n, *_ in want} | {(i, n) for i, n, *_ in got if n <= dict((w[0], w[1]) for w in want)[i]}


def test_links_do_not_follow_the_number_of_vectors(spark, monkeypatch):
    """blocks and tables once changed with the number of vectors, and with them the links."""
    monkeypatch.setattr(lattice, "CROWD", 8)
    monkeypatch.setattr(lattice, "CELLS", 8)
    rng = np.random.default_rng(3)
    vectors = cloud(9, groups=25, kind=np.float64)
    strangers = rng.normal(size=(1500, 64)).tolist()
    assert lattice.shape(len(vectors)) != lattice.shape(len(vectors) + 1500)
    used, links = [], lattice.links

    def seen(distinct, scratch, *shape):
        used.append(shape)
        return links(distinct, scratch, *shape)

    monkeypatch.setattr(lattice, "links", seen)
    got = []
    for more in ([], strangers):
        df = spark.createDataFrame(list(enumerate(vectors + more)), "vec_id long, embedding array<double>")
        got.append(sorted(r for r in rows_of(lattice.near_duplicates(df, Scratch(spark, "t"))) if r[0] < len(vectors)))
    assert used[0] == used[1] and got[0] == got[1]
    assert sum(r[1] for r in got[0]) > 100


def test_cells_in_many_batches_and_of_many_lengths(spark):
    vectors = [v[:d] for d in (8, 64, 16) for v in cloud(5, groups=6, kind=np.float64)] + [(np.ones(64) + np.random.default_rng(i).normal(size=64) * 0.1).tolist() for i in range(60)]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    want = sorted(rows_of(lattice.near_duplicates(df, Scratch(spark, "t"))))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert sorted(rows_of(lattice.near_duplicates(df.repartition(3), Scratch(spark, "t")))) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    true = brute(list(range(len(vectors))), vectors)
    assert all(a[1] <= b[1] for a, b in zip(want, true)) and sum(r[1] for r in want) >= 0.99 * sum(r[1] for r in true)


def test_recall_of_the_operator_on_planted_pairs(spark):
    """A table with links: groups of noisy copies around random centres."""
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(300, 64))
    x = (np.repeat(centres, 6, axis=0) + rng.normal(size=(1800, 64)) * 0.21).astype(np.float32).astype(float)
    unit = lattice.unit(x)
    true = int((unit @ unit.T >= 0.95).sum() - len(x))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = sum(r[1] for r in rows_of(lattice.near_duplicates(df, Scratch(spark, "t"))))
    assert 1000 < true and 0.97 * true <= found <= true
