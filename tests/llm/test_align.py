import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import align
from quarry.llm.common import Scratch, table
from quarry.llm.queries import QUERIES

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
TRUE_A, TRUE_B = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
TRUE_A.encode_special_tokens = True
CODE = align.encoder(A, B)
ALPHABET = st.text(alphabet="aAé  \n\n\t.'s1<|>▁ 　\x00\x1c😀tx", max_size=30)


def tokens(text):
    """(ids, bytes) of both, by the libraries on the whole text."""
    if not text:
        return [], [], [], []
    a, b = TRUE_A.encode(" " + text, add_special_tokens=False).ids, TRUE_B.encode(text)
    raw = [CODE.text_a[i] for i in a], [CODE.text_b[i] for i in b]
    if b"".join(raw[0]) != (" " + text).encode() or b"".join(raw[1]) != (" " + text).encode():
        return [], [], [], []
    return a, b, *raw


def owners(parts):
    """The token of every byte."""
    return [i for i, p in enumerate(parts) for _ in p]


def links_of(text):
    a, b, raw_a, raw_b = tokens(text)
    return [(a[i], b[j]) for i, j in set(zip(owners(raw_a), owners(raw_b)))]


def groups_of(text):
    a, b, raw_a, raw_b = tokens(text)
    own_a, own_b = owners(raw_a), owners(raw_b)
    out, one, two = [], [], []
    for k, (i, j) in enumerate(zip(own_a, own_b)):
        end_a, end_b = own_a[k + 1: k + 2] != [i], own_b[k + 1: k + 2] != [j]
        one += [str(a[i])] * end_a
        two += [str(b[j])] * end_b
        if end_a and end_b:
            out.append(",".join(one) + "|" + ",".join(two))
            one, two = [], []
    return out


def truth(docs):
    """Rows of (doc_id, text)."""
    links = [links_of(t) for _, t in docs]
    counts = Counter(p for ls in links for p in ls)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for (i, t), ls in zip(docs, links):
        a, b, *_ = tokens(t)
        groups = groups_of(t)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((i, len(a), len(b), len(groups), len(ls), sum(counts[p] == best[p[1]] for p in ls), sum(counts[p] for p in ls), digest))
    return out


def rows_of(df):
    return sorted(map(tuple, df.select(*[c.split()[0] for c in align.RESULT.split(", ")]).collect()), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 400), max_size=120), st.sets(st.integers(0, 400), max_size=60))
def test_gallop_is_a_rank(x, y):
    drive, into = np.array(sorted(x), np.int64), np.array(sorted(y), np.int64)
    assert align.gallop(drive, into).tolist() == np.searchsorted(into, drive).tolist()


def test_gallop_far_steps_and_empty_lists():
    into = np.arange(0, 3_000_000, 3)
    drive = np.array([0, 1, 2_999_996, 2_999_997, 2_999_998, 5_000_000])
    assert align.gallop(drive, into).tolist() == [0, 1, 999_999, 999_999, 1_000_000, 1_000_000]
    none = np.empty(0, np.int64)
    assert align.gallop(none, into).size == 0 and align.gallop(drive, none).tolist() == [0] * 6
    both = align.Alignment(none, none)
    assert both.a.size == both.link_b.size == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), ALPHABET), max_size=5))
def test_words_encode_as_whole_texts_do(texts):
    got = [tuple(np.frombuffer(x, "<u4").tolist() for x in pair) for pair in CODE.encode(texts)]
    assert got == [tuple(tokens(t)[:2]) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), ALPHABET), min_size=1, max_size=5))
def test_block_against_all_pairs(texts):
    made, pairs, n = align.aligned(CODE.encode(texts), CODE)
    want = [links_of(t) for t in texts]
    assert {(int(p) >> 32, int(p) & 0xFFFFFFFF): int(k) for p, k in zip(pairs, n)} == Counter(p for ls in want for p in ls)
    assert made["n_links"].tolist() == [len(ls) for ls in want]
    assert made["n_groups"].tolist() == [len(groups_of(t)) for t in texts]
    assert made["groups_sha256"] == [hashlib.sha256(";".join(g).encode()).hexdigest() if (g := groups_of(t)) else "" for t in texts]


def test_query_against_brute_force(spark, monkeypatch):
    docs = [(r.doc_id, r.text) for r in table(spark, "/root/testdata/sf0.001", "documents").collect() if len(r.text or "") < 4000]
    some = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(align, "BLOCK", 20_000)
    assert rows_of(align.alignments(some, A, B, Scratch(spark, "t"))) == sorted(truth(docs), key=repr)


def test_registered_query_reads_all_rows(spark):
    got = rows_of(QUERIES["op12_tokenizer_alignment"](spark, "/root/testdata/sf0.001"))
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    assert [r[0] for r in got] == sorted((r.doc_id for r in docs.collect()), key=lambda i: repr((i,))) or len(got) == docs.count()
    assert all(r[4] == r[1] + r[2] - r[3] for r in got)  # a group of m and n tokens has m + n - 1 links


def test_edges(spark, tmp_path):
    docs = [(1, None), (2, ""), (3, " "), (4, "a▁b"), (5, "x" * 30_000), (6, "the <|endoftext|> <s> cat"), (6, "the <|endoftext|> <s> cat"), (None, "ä\n\nb  c "), (7, "the cat")]
    spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS block", "2 AS pair", "3 AS n", "4 AS links").write.parquet(str(tmp_path / "documents.parquet"))
    assert rows_of(QUERIES["op12_tokenizer_alignment"](spark, str(tmp_path))) == sorted(truth([(i, t) for i, t in docs if i != 5] + [docs[4]]), key=repr)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert rows_of(QUERIES["op12_tokenizer_alignment"](spark, str(tmp_path / "none"))) == []
    totals = align.pair_totals(spark.createDataFrame(docs, "doc_id long, text string"), A, B, Scratch(spark, "t")).collect()
    assert {(r.a, r.b): r.total for r in totals} == Counter(p for _, t in docs for p in links_of(t))
