import hashlib
import random

import numpy as np
import xxhash

from quarry.llm import sketch as sk


def brute_sketch(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[i:i + 5]) for i in range(len(words) - 4)] or ([b" ".join(words)] if words else [])
    h = {xxhash.xxh64_intdigest(g, 42) for g in grams}
    return {x for x in h if x < 2**64 // 8} or ({min(h)} if h else set())


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0), reverse=True)
    out = []
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        a, b, c = brute_sketch(t), brute_sketch(edited), brute_sketch(nxt)
        like = lambda x, y: len(x & y) / len(x | y) if x or y else 1.0
        text = lambda s: "".join(f"{x:016x}" for x in sorted(s))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), text(a), text(b), like(a, b), like(a, c)))
    return out


def rows_of(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in df.collect()), key=str)


def test_edited_fingerprints_match_brute_force(spark):
    rng = random.Random(1)
    vocab = [f"w{i}é" for i in range(300)] + ["The", "OF"]
    texts = [" ".join(rng.choices(vocab, k=rng.choice([1, 3, 4, 5, 60, 400]))) for _ in range(60)]
    rows = [(i * 7 % 61, t) for i, t in enumerate(texts)]
    rows += [(1000, texts[0]), (1001, texts[0]), (2000, None), (2001, ""), (2002, "z " * 60_000), (None, "no id"), (-5, "𝒳 " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "text", "'x' as part", "1 as bucket", "true as halo")
    assert rows_of(sk.edited_fingerprints(docs.repartition(5))) == sorted(brute(rows), key=str)


def test_lone_empty_and_repeated_rows(spark):
    one = spark.createDataFrame([(4, "a b c d e f g")], "doc_id long, text string")
    assert rows_of(sk.edited_fingerprints(one)) == brute([(4, "a b c d e f g")])
    assert sk.edited_fingerprints(one.limit(0)).count() == 0
    same = spark.createDataFrame([(4, "a b c d e f")] * 5 + [(None, None)], "doc_id long, text string")
    got = sk.edited_fingerprints(same).collect()
    assert len(got) == 6 and len({r.fingerprint for r in got if r.doc_id == 4}) == 1
    assert {r.near_next for r in got if r.n_chars} == {1.0, 0.0}


def test_sketches_merge_and_estimate_containment():
    rng = random.Random(2)
    book = [f"b{rng.randrange(5000)}" for _ in range(20_000)]
    note = book[700:1500]
    a, b = sk.sketch(" ".join(note)), sk.sketch(" ".join(book))
    assert sk.containment(a, b) == 1.0 and sk.containment(b, a) < 0.1
    halves = sk.merge(sk.sketch(" ".join(book[:10_000])), sk.sketch(" ".join(book[9_996:])))
    assert np.array_equal(halves, b)
    assert np.array_equal(sk.from_text(sk.to_text(b)), b)
    assert np.array_equal(sk.merge(sk.sketch("one"), b), b[b < 2**61])


def test_with_sketch(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 3), (2, None, None)], "doc_id long, text string, fp long")
    got = {r.doc_id: r.fingerprint for r in sk.with_sketch(docs).collect()}
    assert got == {1: "".join(f"{x:016x}" for x in sorted(brute_sketch("a b c d e f"))), 2: ""}
