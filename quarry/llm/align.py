"""Cross-tokenizer alignment: which tokens of two vocabularies overlap.

Both token sequences of a text end at rising byte offsets. The shorter list of
ends drives an exponential, then a binary search into the longer one
(``gallop``). Offsets found in both cut the tokens into groups; the ranks of a
token's two ends differ by the tokens of the other side that it overlaps, which
gives all links without comparing tokens.

Links are counted by id pair over the whole corpus in three steps: a task sums
the pairs of a block of texts (about ``BLOCK`` bytes) and keeps, for each
document, numbers in that block's sorted list of pairs; Spark sums the pairs of
all blocks; each block gets the sums of its own pairs back. A pair that every
document holds thus has a row a block, and a group is a block's pairs.

The libraries see each distinct word of a worker once, up to ``KEPT`` bytes of
words, then anew: neither vocabulary joins what stands before a space or line
feed (after anything but white space) with what follows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm.common import Scratch, split_batch, text_of

BLOCK = 4 << 20
KEPT = 160 << 20  # bytes that a worker's known words take, about
ENTRY = 300  # of which for a word, beside its own and its ids' bytes
GROUP = 256  # words encoded together
SPACE = "▁"


def _search(ahead: np.ndarray, x: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For each x the number of values of ``ahead`` below it, at least ``low``:
    steps of 1, 2, 4... until a value is not below, then halving in between."""
    low, last, step = low.copy(), len(ahead) - 1, 1
    high = low.copy()
    live = np.flatnonzero(ahead[high] < x)
    while live.size:
        low[live] = high[live] + 1
        high[live] = np.minimum(high[live] + step, last)
        step *= 2
        live = live[ahead[high[live]] < x[live]]
    live = np.flatnonzero(low < high)
    while live.size:
        middle = (low[live] + high[live]) >> 1
        below = ahead[middle] < x[live]
        low[live[below]] = middle[below] + 1
        high[live[~below]] = middle[~below]
        live = live[low[live] < high[live]]
    return low


def gallop(drive: np.ndarray, into: np.ndarray) -> np.ndarray:
    """The number of values of ``into`` below each of ``drive`` (both rising).

    Positions are found coarse to fine, all of a stride at once: each search
    starts where the nearest known position before it ended.
    """
    n = len(drive)
    ahead = np.append(into, np.iinfo(np.int64).max)
    at = np.zeros(n, np.int64)
    if n:
        at[:1] = _search(ahead, drive[:1], at[:1])
    stride = 1 << max(n - 1, 0).bit_length()
    while stride:
        new = np.arange(stride, n, 2 * stride)
        at[new] = _search(ahead, drive[new], at[new - stride])
        stride >>= 1
    return at


class Alignment:
    """Of two rising lists of ends: ``a``, ``b`` are the positions of common
    ends, ``link_a``, ``link_b`` the positions of every overlapping pair (in the
    order of the shorter list)."""

    def __init__(self, ends_a: np.ndarray, ends_b: np.ndarray):
        swap = len(ends_b) < len(ends_a)
        drive, into = (ends_b, ends_a) if swap else (ends_a, ends_b)
        rank = gallop(drive, into)
        same = np.zeros(len(drive), bool)
        inside = rank < len(into)
        same[inside] = into[rank[inside]] == drive[inside]
        mine, other = np.flatnonzero(same), rank[same]
        after = rank + same  # ends of the other side up to and with this one
        first = np.concatenate([[0], after[:-1]]) if len(after) else after
        sizes = np.minimum(rank, len(into) - 1) - first + 1
        starts = np.cumsum(sizes) - sizes
        link = np.repeat(np.arange(len(drive)), sizes)
        linked = np.arange(len(link)) - np.repeat(starts - first, sizes)
        self.a, self.b = (other, mine) if swap else (mine, other)
        self.link_a, self.link_b = (linked, link) if swap else (link, linked)


def byte_level() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable
    ones themselves, the others in order from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def bytes_a(tokenizer: Tokenizer) -> list[bytes]:
    back = byte_level()
    names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    return [bytes(back[c] for c in t) if all(c in back for c in t) else b"" for t in names]


def bytes_b(pieces: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    out = []
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace(SPACE, " ").encode())
    return out


DOUBLE = ("  ", " \n", "\n ", "\n\n")
CUT = re.compile(r"(?<=\S)(?=[ \n])")


def words(text: str) -> list[str]:
    """Cuts space+text before each space or line feed that follows other than
    white space. A word's own leading space is left out where a word begins
    with just one; words that begin with white space stand as they are.

    Other white space before the cut does no harm, for it is a piece of its own
    in both vocabularies; the quick way thus only has to see that neither of the
    two follows the other.
    """
    full = " " + text
    if full[-1] != " " and not any(d in full for d in DOUBLE):
        return full.replace("\n", " \n").split(" ")[1:]
    return [w[1:] if w[0] == " " and w[1:2].strip() else w for w in CUT.split(full)]


def whole(word: str) -> str:
    return word if word[0] in " \n" else " " + word


class Encoder:
    """Token ids of both vocabularies, as little-endian 32-bit bytes."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.text_a, self.text_b = bytes_a(self.a), bytes_b(self.b)
        self.length_a, self.length_b = (np.array([len(t) for t in x], np.int64) for x in (self.text_a, self.text_b))
        self.space = self.b.piece_to_id(SPACE)
        names = [f"{i}{end}".encode() for i in range(max(len(self.text_a), len(self.text_b))) for end in ",|;"]
        self.names = np.array(names, "S8").view("<u8")  # eight bytes each, zeros behind
        self.known: dict[str, bytes] = {}
        self.known_b: dict[str, bytes] = {}
        self.bad: set[str] = set()  # words that their tokens do not spell
        self.size = 0

    def _pieces(self, parts: list[str]) -> list[list[int]]:
        """Ids of B, which itself adds the space that begins a part; one that
        begins with a line feed is encoded after that space, which then goes."""
        out = self.b.encode([p[1:] if p[0] == " " else p for p in parts], num_threads=1)
        return [[self.space] if p == " " else ids[1:] if p[0] == "\n" and ids[:1] == [self.space] else ids for p, ids in zip(parts, out)]

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        cut = [words(t) if t else [] for t in texts]
        if self.size > KEPT:
            self.known, self.known_b, self.bad, self.size = {}, {}, set(), 0
        new = list(set().union(*cut).difference(self.known))
        for i in range(0, len(new), 1 << 14):
            self._learn(new[i: i + (1 << 14)])
        out = []
        for c in cut:
            spelt = not self.bad or self.bad.isdisjoint(c)
            out.append((b"".join(map(self.known.__getitem__, c)), b"".join(map(self.known_b.__getitem__, c))) if spelt else (b"", b""))
        return out

    def _learn(self, new: list[str]) -> None:
        """Words without white space are strung together, for the libraries take
        long texts faster; where their tokens do not end with them, and for
        other words, each is encoded by itself."""
        plain, single = [], []
        for w in new:
            (plain if w[0] not in " \n" and not w[-1].isspace() else single).append(w)
        groups = [plain[i: i + GROUP] for i in range(0, len(plain), GROUP)]
        texts = [" " + " ".join(g) for g in groups]
        all_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        for g, text, ids_a, ids_b in zip(groups, texts, all_a, self.b.encode([t[1:] for t in texts], num_threads=1)):
            raw = text.encode()
            if b"".join(map(self.text_a.__getitem__, ids_a)) != raw or b"".join(map(self.text_b.__getitem__, ids_b)) != raw:
                single += g
                continue
            ends = np.cumsum([len(w.encode()) + 1 for w in g])
            cuts = []
            for ids, length in ((np.array(ids_a, "<u4"), self.length_a), (np.array(ids_b, "<u4"), self.length_b)):
                reached = np.cumsum(length[ids])
                at = np.searchsorted(reached, ends)
                if (reached[at] != ends).any():
                    break
                data, places = ids.tobytes(), [0, *(4 * at + 4).tolist()]
                cuts.append([data[x:y] for x, y in zip(places, places[1:])])
            if len(cuts) < 2:
                single += g
                continue
            self.known.update(zip(g, cuts[0]))
            self.known_b.update(zip(g, cuts[1]))
            self.size += ENTRY * len(g) + len(raw) + 4 * (len(ids_a) + len(ids_b))
        parts = [whole(w) for w in single]
        for w, part, a, b in zip(single, parts, self.a.encode_batch_fast(parts, add_special_tokens=False), self._pieces(parts)):
            raw = part.encode()
            if b"".join([self.text_a[i] for i in a.ids]) != raw or b"".join([self.text_b[i] for i in b]) != raw:
                self.bad.add(w)
            self.known[w], self.known_b[w] = np.array(a.ids, "<u4").tobytes(), np.array(b, "<u4").tobytes()
            self.size += ENTRY + len(raw) + 4 * (len(a.ids) + len(b))


@lru_cache(maxsize=1)
def encoder(path_a: str, path_b: str) -> Encoder:
    return Encoder(path_a, path_b)


def _totals(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of values between cuts."""
    run = np.concatenate([[0], np.cumsum(values)])
    return run[cuts[1:]] - run[cuts[:-1]]


def aligned(ids: list[tuple[bytes, bytes]], encoder: Encoder) -> tuple[dict, np.ndarray, np.ndarray]:
    """Columns of each text, the block's sorted pairs (A id x 2^32 + B id) and
    how often each is linked. The texts are aligned as one: a text's last ends
    are common ones."""
    a = np.frombuffer(b"".join(x for x, _ in ids), "<u4").astype(np.int64)
    b = np.frombuffer(b"".join(x for _, x in ids), "<u4").astype(np.int64)
    cut_a = np.cumsum([0] + [len(x) // 4 for x, _ in ids])
    cut_b = np.cumsum([0] + [len(x) // 4 for _, x in ids])
    both = Alignment(np.cumsum(encoder.length_a[a]), np.cumsum(encoder.length_b[b]))

    ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    ends_a[both.a], ends_b[both.b] = 1, 1
    codes = np.empty(len(a) + len(b), np.int64)
    codes[np.arange(len(a)) + np.concatenate([[0], both.b + 1])[np.cumsum(ends_a) - ends_a]] = 3 * a + ends_a
    codes[np.arange(len(b)) + (both.a + 1)[np.cumsum(ends_b) - ends_b]] = 3 * b + 2 * ends_b

    owner = np.searchsorted(cut_a, both.link_a, side="right") - 1
    pairs, at, n = np.unique(a[both.link_a] << 32 | b[both.link_b], return_inverse=True, return_counts=True)
    held, times = np.unique(owner * max(len(pairs), 1) + at, return_counts=True)
    owner, at = np.divmod(held, max(len(pairs), 1))
    cuts = np.searchsorted(owner, np.arange(len(ids) + 1))
    press = zstandard.ZstdCompressor(level=1)
    out: dict = {"n_a": np.diff(cut_a), "n_b": np.diff(cut_b), "n_groups": _totals(ends_a, cut_a),
                 "n_links": _totals(times, cuts), "groups_sha256": [], "links": []}
    for d in range(len(ids)):
        mine = encoder.names[codes[cut_a[d] + cut_b[d]: cut_a[d + 1] + cut_b[d + 1]]].tobytes().translate(None, b"\0")
        out["groups_sha256"].append(hashlib.sha256(mine[:-1]).hexdigest() if mine else "")
        out["links"].append(press.compress(packed(at[cuts[d]: cuts[d + 1]], times[cuts[d]: cuts[d + 1]])))
    return out, pairs, n


def packed(at: np.ndarray, times: np.ndarray) -> bytes:
    """Rising positions as steps, and their counts, by byte place: mostly zeros."""
    rows = np.stack([np.diff(at, prepend=0), times]).astype("<u4")
    return rows.view(np.uint8).reshape(2, -1, 4).transpose(0, 2, 1).tobytes()


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(data, np.uint8).reshape(2, 4, -1).transpose(0, 2, 1).copy().view("<u4")[..., 0].astype(np.int64)
    return np.cumsum(rows[0]), rows[1]


MADE = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(), "links": pa.binary()}
ROWS = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), *MADE.items(), ("pair", pa.int64()), ("n", pa.int64())])
ROWS_DDL = "block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, links binary, pair bigint, n bigint"
RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _rows(columns: dict) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in ROWS], schema=ROWS)


def blocks(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Two kinds of rows: a document's (block, doc_id, sizes, packed links) and a
    block's pairs (block, pair, n)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = count(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for part in split_batch(batch, "text", BLOCK):
                block, ids, code = next(number), [], encoder(path_a, path_b)
                for piece in split_batch(part, "text", 1 << 20):
                    ids += code.encode(piece.column(1).to_pylist())
                made, pairs, n = aligned(ids, code)
                yield _rows({"block": np.full(len(ids), block), "doc_id": part.column(0), **made})
                for i in range(0, len(pairs), 1 << 16):
                    these = pairs[i: i + (1 << 16)]
                    yield _rows({"block": np.full(len(these), block), "pair": these, "n": n[i: i + (1 << 16)]})

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text")).mapInArrow(run, ROWS_DDL)


def _answer(docs: pa.Table, sums: pa.Table) -> pa.Table:
    """A block's documents with the sums of its pairs."""
    order = np.argsort(np.asarray(sums.column("pair")))
    total, best = np.asarray(sums.column("total"))[order], np.asarray(sums.column("best"))[order]
    plain, n_best, count_sum = zstandard.ZstdDecompressor(), [], []
    for data in docs.column("links").to_pylist():
        at, times = unpacked(plain.decompress(data))
        n_best.append(int(times[best[at]].sum()))
        count_sum.append(int((times * total[at]).sum()))
    columns = {n: docs.column(n) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    columns |= {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64()), "groups_sha256": docs.column("groups_sha256")}
    return pa.table(columns)


def alignments(docs: DataFrame, path_a: str, path_b: str, scratch: Scratch) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of
    every row of ``docs``.

    Space+text is encoded by the byte-level vocabulary A, text by the piece
    vocabulary B. A null or empty text, and one whose tokens do not spell it in
    both (say, with U+2581), has no tokens: zeros and ''. Rows of one or of no id
    count each; other columns are ignored. Best pairs: one maximum for each id
    of B, a table no longer than its vocabulary.
    """
    made = scratch.write(blocks(docs, path_a, path_b), "blocks")
    pairs = made.where(F.col("pair").isNotNull()).select(F.col("block").alias("of"), "pair", "n")
    totals = scratch.write(pairs.groupBy("pair").agg(F.sum("n").alias("total")), "totals")
    b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    most = totals.groupBy(b.alias("b")).agg(F.max("total").alias("most"))
    totals = totals.withColumn("b", b).join(F.broadcast(most), "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    sums = pairs.join(totals, "pair").select("of", "pair", "total", "best")
    rows = made.where(F.col("pair").isNull()).drop("pair", "n")
    return rows.groupBy("block").cogroup(sums.groupBy("of")).applyInArrow(_answer, RESULT)


def pair_totals(docs: DataFrame, path_a: str, path_b: str, scratch: Scratch) -> DataFrame:
    """(a, b, total): how many links of the corpus hold each id pair."""
    made = scratch.write(blocks(docs, path_a, path_b).where(F.col("pair").isNotNull()).select("pair", "n"), "pairs")
    return made.groupBy(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b")).agg(F.sum("n").alias("total"))
