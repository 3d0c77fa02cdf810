import io
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import tokens
from quarry.llm.common import Scratch

PATH = public_tokenizers.path("word_bpe_49k.json")
TRUE = Tokenizer.from_file(PATH)
ENCODER = tokens.encoder(PATH)


def truth(t):
    return TRUE.encode(t, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "a", "É", "\u0301", " ", "'s", "."]), max_size=8).map("".join), st.text(alphabet="AaHhḴ́̊İΣς.,'s  \t é1", max_size=30)), max_size=6))
def test_words_encode_as_whole_texts_do(texts):
    assert [np.frombuffer(x, "<u4").tolist() for x in ENCODER.encode_batch(texts)] == [truth(t) for t in texts]


def test_special_strings_and_long_words():
    assert truth("<|endoftext|>") == [49407] != truth("<|ENDOFTEXT|>")
    texts = ["<|endoftext|>", "<|ENDOFTEXT|> x", "A<|endoftext|><|startoftext|>É.<|endoftext", " <|EndOfText|>, <|endoftext|>.\u0301 s", "<|endoftext|> a<|startoftext|>b", "x" * 5000, "...,, a., B.,. 'S it's. H̱. don't,", "", "Ångström É. ﬁ①"]
    assert [np.frombuffer(x, "<u4").tolist() for x in ENCODER.encode_batch(texts)] == [truth(t) for t in texts]


def test_words_of_letters_share_a_library_call(monkeypatch):
    """CPU: a text a distinct word went to the library before, 1,005 here."""
    words = [a + b + c for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyäßêzé"]
    texts = [" ".join(words[i: i + 50]) + "., don't x2 ..." for i in range(0, len(words), 10)]
    enc, asked = tokens.WordEncoder(PATH), []
    library = enc.library

    class Library:
        def encode_batch_fast(self, texts, **kw):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **kw)

    enc.library = Library()
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode_batch(texts)] == [truth(t) for t in texts]
    assert len(asked) < 40
    monkeypatch.setattr(tokens, "WORDS", 7)
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode_batch([None, *texts, ""])] == [[], *[truth(t) for t in texts], []]


def test_letters_that_fall_apart_and_odd_blanks():
    odd = ["\u0958", "a\u0958b", "İ", "ŉ", "ΑΣ", "ﷺ", "ǰ", "가", "\u212b", "日本語", "ªº", "ﬃ", "aİb", "\u0958\u0958", "ʰa", "𝒜𝒷", "ⅷ", "\u0300a"]
    texts = [f"one {' '.join(odd[i:])} two. {odd[i]}., x" for i in range(len(odd))]
    texts += [f"{chr(c)}a{chr(c)}b.{chr(c)}c,{chr(c)}" for c in [*range(0x21), 0x7F, 0x85, 0xA0, 0x1680, 0x2028, 0x3000]] + ["a.\nb,.\v\fc.\r\td .", "A. B\u0301. C."]
    texts += [f"x{chr(c)}., {chr(c)}.\u0301 ..{chr(c)}," for c in range(0x80, 0x180)]
    assert [np.frombuffer(x, "<u4").tolist() for x in tokens.WordEncoder(PATH).encode_batch(texts)] == [truth(t) for t in texts]


class Counting(io.BytesIO):
    got = 0

    def read(self, n=-1):
        out = super().read(n)
        self.got += len(out)
        return out


def file_of(docs):
    out = io.BytesIO()
    close, out.close = out.close, lambda: None
    w = tokens.Writer(out)
    for i, ids in docs:
        w.add(i, ids)
    w.close()
    return out.getvalue()


def test_file_reads_only_what_is_asked_and_checks_it():
    rng = np.random.default_rng(0)
    docs = [(i * 3 if i % 50 else None, rng.integers(0, 49_000, rng.integers(1, 900), dtype=np.uint32).tobytes()) for i in range(1000)]
    data = file_of(docs)
    f = Counting(data)
    r = tokens.Reader(f)
    assert len(r) == 1000 and r.find(None)[:2] == [0, 50] and r.find(21) == [7]
    f.got = 0
    assert r.ids(7) == docs[7][1] and f.got == r.table[7, 0]
    assert [ids for _, ids in r.scan(1000)] == [d for _, d in docs]
    assert r.starts.tolist() == np.cumsum([0] + [len(d) // 4 for _, d in docs])[:-1].tolist()
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert plain == b"".join(d for _, d in docs)
    bad = bytearray(data)
    bad[int(r.ends[6]) + 12] ^= 255
    with pytest.raises((ValueError, zstandard.ZstdError)):
        tokens.Reader(io.BytesIO(bytes(bad))).ids(7)
    assert tokens.Reader(io.BytesIO(file_of(docs))).ids(999) == docs[999][1]
    assert len(tokens.Reader(io.BytesIO(file_of([])))) == 0


def test_round_trip(spark):
    rows = [(i * 5 % 97, f"Word {i}, and it's the {i * i}th.") for i in range(97)]
    rows += [(1000, None), (1001, ""), (1002, "Long. " * 50_000), (None, "no id"), (7, rows[0][1]), (-3, "below")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as part", "1 as start", "2 as ids")
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in tokens.read(tokens.write(docs.repartition(4), PATH, Scratch(spark, "t"))).collect()), key=str)
    seven = sorted(t for i, t in rows if i == 7)
    for order in (seven, seven[::-1]):
        todo = sorted((r for r in rows if r[0] not in (None, 7)), key=lambda r: r[0])
        at = sum(r[0] < 7 for r in todo)
        todo = [*todo[:at], *((7, t) for t in order), *todo[at:], (None, "no id")]
        want, start = [], 0
        for i, t in todo:
            ids = [*truth(t or ""), 1]
            want.append((start, i, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
            start += len(ids)
        if got == sorted(want, key=str):
            break
    else:
        raise AssertionError("neither order of the tie matches")
    assert tokens.read(tokens.write(docs.limit(0), PATH, Scratch(spark, "t"))).count() == 0
