import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import mixing
from quarry.llm.common import Scratch, text_of


def corpus(spark):
    rows, i = [], 0
    for s, n in (("big", 600), ("mid", 150), ("small", 30), (None, 20), ("tiny", 2)):
        for k in range(n):
            rows.append((i, s, " ".join("w" * (k % 3 + 1) for _ in range(5 + (i * 7) % 40))))
            i += 1
    rows += [(None, "mid", "no id"), (5000, "big", None), (5001, "big", ""), (5002, "empty", " \t"), (5003, "mid", "x " * 3000), (7, "big", rows[7][2])]
    return rows, spark.createDataFrame(rows, "doc_id long, source string, text string")


def brute_exponent(tokens, budget, entropy, repeats):
    p = np.array([t for t in tokens.values() if t], float)
    total = p.sum()
    p /= total

    def at(a):
        w = p**a / (p**a).sum()
        return -(w * np.log(w)).sum(), (w * budget / (p * total)).max()

    grid = np.arange(mixing.GRID + 1) / mixing.GRID
    ok = [g for g in grid[:: mixing.GRID // 4096] if at(g)[0] >= entropy * math.log(len(p)) - 1e-12]
    flat = max(ok, default=0.0)
    if at(flat)[1] <= repeats:
        return flat
    return min((g for g in grid[:: mixing.GRID // 4096] if at(g)[1] <= repeats), default=1.0)


def test_exponent_is_bisected(spark):
    tokens = {"a": 9000, "b": 700, "c": 300, "d": 50, "e": 0}
    src = spark.createDataFrame(list(tokens.items()), "source string, tokens long")
    for budget, entropy, repeats in ((10_050, 0.95, 4.0), (10_050, 0.7, 40.0), (40_000, 0.9, 2.0), (10_050, 0.0, 1.0), (10_050, 1.0, 1e9), (2000, 0.95, 4.0)):
        got = mixing.exponent(src, budget, entropy, repeats)
        assert abs(got - brute_exponent(tokens, budget, entropy, repeats)) <= 2 / 4096, (budget, entropy, repeats, got)
    assert mixing.exponent(src.limit(0), 5) == 1.0
    assert mixing.exponent(src.limit(1), 5) == 1.0


def test_mixture_spends_the_budget_in_permuted_passes(spark):
    rows, docs = corpus(spark)
    docs = docs.withColumn("weight", F.lit(1)).withColumn("block", F.lit("x")).withColumn("whole", F.lit(2))
    got = mixing.mixture(docs.repartition(7), Scratch(spark, "t")).collect()
    keyed = docs.select("doc_id", "source", F.xxhash64(text_of()).alias("k"), mixing.tokens_of(text_of()).alias("n")).collect()
    tokens = Counter()
    for r in keyed:
        tokens[r.source] += r.n
    total = sum(tokens.values())
    power = brute_exponent(tokens, total, mixing.ENTROPY, mixing.REPEATS)
    norm = sum((t / total) ** power for t in tokens.values() if t)
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
    for s, t in tokens.items():
        if not t:
            assert [r.doc_id for r in by[s]] == [5002] and by[s][0].weight == 0
            continue
        weight = (t / total) ** power / norm
        assert abs(by[s][0].weight - weight) < 1e-3
        quota = by[s][0].weight * total
        assert sum(r.n_tokens for r in by[s]) <= quota + 1e-6
        passes = defaultdict(list)
        for r in by[s]:
            passes[r.epoch].append(r)
        last = max(passes)
        for e in range(last):
            assert Counter(r.doc_id for r in passes[e]) == Counter(r.doc_id for r in keyed if r.source == s)
        every = sorted((r.sort_key % 2**64) for r in passes[last])
        longest = max(r.n for r in keyed if r.source == s)
        assert sum(r.n_tokens for r in by[s]) > quota - 2 * longest - 1, s
        assert all(r.block == (r.sort_key % 2**64) >> 52 for r in by[s]) and every == sorted(set(every)) or s == "big"
        if last:
            assert [r.doc_id for r in sorted(passes[0], key=lambda r: r.sort_key)] != [r.doc_id for r in sorted(passes[1], key=lambda r: r.sort_key)][: len(passes[0])] or len(passes[0]) < 4
        assert all(0 <= r.stream_at <= 1 for r in by[s])


def test_cut_is_the_first_key_that_no_longer_fits(spark):
    rows, docs = corpus(spark)
    plan = mixing.plan(docs, Scratch(spark, "t"))
    drawn = mixing.copies(plan, docs).select("doc_id", "source", "__whole", "__copies", mixing.tokens_of(text_of()).alias("n"),
                                             mixing.permutation_key(F.col("__whole")).alias("key"), (F.col("__passes") - F.col("__whole")).alias("part")).collect()
    by = defaultdict(list)
    for r in drawn:
        by[r.source].append(r)
    for s, rs in by.items():
        left = math.floor(rs[0].part * sum(r.n for r in rs))
        groups = defaultdict(list)
        for r in rs:
            groups[r.key % 2**64].append(r)
        spent, open_ = 0, True
        for k in sorted(groups):
            spent += sum(r.n for r in groups[k])
            open_ = open_ and spent <= left
            extra = {r["__copies"] - r["__whole"] for r in groups[k]}
            assert extra == {int(open_ and rs[0].part > 0)}, (s, k)


def test_mixed_rows_keep_columns_and_empty_tables(spark):
    rows, docs = corpus(spark)
    wide = docs.selectExpr("doc_id", "text", "source", "1 as whole", "2 as cut")
    out = mixing.mixed(wide, Scratch(spark, "t"))
    assert out.columns == wide.columns
    a = Counter((r.doc_id, r.source, r.text) for r in out.collect())
    b = Counter((r.doc_id, r.source) for r in mixing.mixture(docs, Scratch(spark, "t")).collect())
    assert Counter({(d, s): n for (d, s, _), n in a.items()}) == b
    assert mixing.mixed(docs.limit(0), Scratch(spark, "t")).count() == 0
    assert mixing.mixture(docs.limit(0), Scratch(spark, "t")).count() == 0
