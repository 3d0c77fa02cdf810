import hashlib
from collections import Counter

import pytest
from test_bpe import TRUE
from test_simhash import brute_components, brute_fingerprint

import corpus_pipeline
from quarry.llm import mixing, pii, toxicity
from quarry.llm.common import Scratch, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage made of what the one before it kept."""
    scratch, out = Scratch(spark, "t"), [table(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(scratch.write(stage(spark, out[-1], SF), name))
    return out


def test_each_stage_against_brute_force(spark, steps):
    docs, clean, unique, masked, mixed, tokens = steps
    assert all(s.columns == docs.columns for s in steps[:5])
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in clean.collect()}
    known = [d for d in labels if d is not None and labels[d] == 0]
    assert sum(d in kept for d in known) >= 0.97 * len(known)
    model = toxicity.fit(docs, table(spark, SF, "labels"), Scratch(spark, "t"))
    assert kept == {r.doc_id for r in docs.collect() if model.above([model.linear(r.text)])[0, 0] < toxicity.REJECT}
    rows = clean.collect()
    want = brute_components([r.doc_id for r in rows], [brute_fingerprint(r.text) for r in rows])
    assert sorted(r.doc_id for r in unique.collect()) == sorted(set(want))
    assert {(r.doc_id, r.text, r.n_chars) for r in masked.collect()} == {(r.doc_id, t := pii.mask(r.text, pii.find(r.text)), len(t)) for r in unique.collect()}
    drawn = Counter(r.doc_id for r in mixing.mixture(masked, Scratch(spark, "t")).collect())
    assert Counter(r.doc_id for r in mixed.collect()) == drawn
    got = Counter(map(tuple, tokens.collect()))
    want = Counter()
    for r in mixed.collect():
        ids = TRUE.encode_ordinary(r.text)
        want[r.doc_id, len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()] += 1
    assert got == want


def test_run_is_the_stages_in_turn(spark, steps):
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == Counter(map(tuple, steps[-1].collect()))


def test_stages_take_an_odd_table(spark, steps):
    docs = table(spark, SF, "documents")
    odd = docs.limit(3).union(spark.createDataFrame([(None, None, None, None, None), (5, "", None, "s", 0), (5, "", None, "s", 0)], docs.schema))
    for rows, n in ((odd, None), (docs.limit(0), 0)):
        for name, stage in corpus_pipeline.STAGES:
            rows = Scratch(spark, "t").write(stage(spark, rows, SF), name)
        assert n is None or rows.count() == n
