import itertools
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import simhash
from quarry.llm.common import Scratch
from quarry.llm.components import connected_components


def brute_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, codes, bits=2):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        if bin(codes[i] ^ codes[j]).count("1") <= bits:
            root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(ids))]


def test_fingerprint_matches_definition():
    for t in ["", None, " \t\n", "One", "a b", "A b\x0bC d É é", "x " * 400, "The the THE q z w"]:
        assert simhash.fingerprint(t) == brute_fingerprint(t), t


def in_gray_order(codes):
    code = np.array(sorted(codes), dtype=np.uint64)
    rank = code.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return code[np.argsort(rank)]


@pytest.mark.parametrize("bits", [0, 2, 4])
def test_index_finds_every_pair(bits):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    codes = set(rng.integers(0, 1 << 63, 300, dtype=np.uint64).tolist())
    for b in base.tolist():
        for _ in range(300):
            codes.add(b ^ sum(1 << int(x) for x in rng.choice(64, rng.integers(0, 5), replace=False)))
    code = in_gray_order(codes)
    every = np.arange(len(code))
    who, at = simhash.Index.of(code).near(code, bits, every)
    apart = np.bitwise_count(code[:, None] ^ code[None, :])
    assert set(zip(who.tolist(), at.tolist())) == {(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(apart <= bits, 1)))}
    who, at = simhash.Index.of(code).near(code[:50], bits)
    assert set(zip(who.tolist(), at.tolist())) == {(int(i), int(j)) for i, j in zip(*np.nonzero(apart[:50] <= bits))}
    one = simhash.Index.of(code[:1]).near(code[:3], 64)
    assert one[0].tolist() == [0, 1, 2]


def test_the_hierarchy_prunes_the_queries_own_rows(spark):
    """What the registered query searches at sf0.1: few nodes are looked at, and
    whole groups are dropped at every query."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    code = in_gray_order({r.fp & (1 << 64) - 1 for r in simhash.with_fingerprint(docs.select("doc_id", "text")).select("fp").distinct().collect()})
    n = len(code)
    index = simhash.Index.of(code)
    found = 0
    for i in range(0, n, simhash.BLOCK):
        query = np.arange(i, min(i + simhash.BLOCK, n))
        who, at = index.near(code[query], 2, query)
        found += len(who)
        want = np.bitwise_count(code[query][:, None] ^ code[None, :]) <= 2
        assert set(zip((query[who]).tolist(), at.tolist())) == {(int(a + i), int(b)) for a, b in zip(*np.nonzero(want)) if b > a + i}
    pairs = n * (n - 1) // 2
    print(f"{n} fingerprints, {found} links, {index.visited} nodes visited, {index.pruned} of {pairs} pairs pruned by nodes")
    assert n > 5000 and len(index.levels) >= 5 and found > 0
    assert index.visited < 0.12 * pairs and index.pruned > 0.9 * pairs
    cuts = np.array_split(code, 256)  # the levels over the ranges
    both, any_ = (np.array([f.reduce(c) for c in cuts]) for f in (np.bitwise_and, np.bitwise_or))
    who, _ = simhash.Index(both, ~(both ^ any_)).near(code, 2)
    assert len(who) < 0.5 * 256 * n


def test_ranges_follow_the_rows():
    assert simhash.ranges(0) == simhash.ranges(10**7) == 16 and simhash.ranges(10**10) == 9537


def test_links_join_all_near_codes_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(simhash, "MOST", 20)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = np.random.default_rng(5)
    codes = set(rng.integers(-1 << 63, 1 << 63, 150, dtype=np.int64).tolist())
    for b in list(codes)[:3]:
        for _ in range(60):
            flip = sum(1 << int(x) for x in rng.choice(64, rng.integers(1, 5), replace=False))
            codes.add(int(np.uint64(b & (1 << 64) - 1 ^ flip).astype(np.int64)))
    ids = sorted(codes)
    reps = spark.createDataFrame([(c,) for c in ids], "fp long")
    s = Scratch(spark, "t")
    got = {r.node: r.root for r in connected_components(simhash.links(reps, s), s).collect()}
    want = brute_components(list(range(len(ids))), [c & (1 << 64) - 1 for c in ids])
    assert [got.get(c, c) for c in ids] == [ids[w] for w in want]


def test_components_of_documents(spark):
    base = " ".join(f"w{i}" for i in range(200))
    rows = [(7, base), (3, base), (9, base + " tail"), (4, None), (2, ""), (8, " \n "), (None, base), (None, "only one here"),
            (11, "x" * 200_000), (12, "long " * 30_000), (11, "x" * 200_000)]
    rows += [(100 + i, " ".join(f"w{j if j != i * 3 else j + 1000}" for j in range(200))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("root", F.lit(1))
    got = simhash.components(docs, Scratch(spark, "t")).select("doc_id", "fp", "component_id").collect()
    codes = [brute_fingerprint(t) for _, t in rows]
    want = brute_components([d for d, _ in rows], codes)
    key = str
    assert sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got), key=key) == sorted(((d, c, w) for (d, _), c, w in zip(rows, codes, want)), key=key)
    assert simhash.components(docs.limit(0), Scratch(spark, "t")).count() == 0
    kept = simhash.dedup(docs, Scratch(spark, "t"))
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id) for r in kept.collect())) == sorted(str(x) for x in [*{w for w in want if w is not None}, None])


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000), (2000, 1999)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges, Scratch(spark, "t")).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1999: 1999, 2000: 1999}
