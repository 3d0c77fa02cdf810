"""Token files: one zstandard frame a document and a trailing seek table.

Layout of a file, in the order of its documents:

- a zstandard frame for each document: its ids, little-endian unsigned 32-bit;
- a skippable frame (0x184D2A50): the document ids, int64, then a byte each
  that is 0 where the id is null, then the number of ids before each document
  in this file, int64;
- the seek table, a skippable frame (0x184D2A5E): compressed size, plain size
  and checksum (low 32 bits of XXH64 of the plain bytes) of each frame, then
  the number of frames, a flag byte and the magic 0x8F92EAB1.

The frames are independent, so a reader fetches the table and then only the
byte ranges of the documents asked for; any zstandard decoder can also read
the file from front to back.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from quarry.llm.common import Scratch, split_batch, text_of
from quarry.llm.ranges import dealt_by_id
from quarry.llm.store import locate, new_file, new_folder, spread

END_ID = 1
DIRECTORY, SEEK, FOOTER = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
KEPT = 256 << 20  # bytes that the words of a worker take, about; then it starts anew
ENTRY = 190  # of which for a word, beside its own and its ids' bytes
LINE, LINES = 256, 128  # words of letters alone that go to the library as one text; such texts at once
WORDS = 1 << 18  # whose ids are gathered at once


class Writer:
    """Appends documents to an open binary stream; ``close`` adds the tables."""

    def __init__(self, stream, level: int = 1):
        self.stream, self.press = stream, zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.table, self.doc_ids, self.valid, self.starts, self.ids, self.bytes = [], [], bytearray(), [], 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.press.compress(ids)
        self.stream.write(frame)
        self.table.append(struct.pack("<III", len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.doc_ids.append(doc_id or 0)
        self.valid.append(doc_id is not None)
        self.starts.append(self.ids)
        self.ids += len(ids) // 4
        self.bytes += len(frame)

    def close(self) -> None:
        directory = np.array(self.doc_ids, "<i8").tobytes() + bytes(self.valid) + np.array(self.starts, "<i8").tobytes()
        self.stream.write(struct.pack("<II", DIRECTORY, len(directory)) + directory)
        table = b"".join(self.table) + struct.pack("<IBI", len(self.table), 0x80, FOOTER)
        self.stream.write(struct.pack("<II", SEEK, len(table)) + table)
        self.stream.close()


class Reader:
    """Random access to the documents of a file (seekable, readable)."""

    def __init__(self, file):
        self.file = file
        file.seek(0, 2)
        size = file.tell()
        n, flags, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != FOOTER or not flags & 0x80:
            raise ValueError("no seek table with checksums")
        at = size - 9 - 12 * n
        if struct.unpack("<II", self._read(at - 8, 8)) != (SEEK, 12 * n + 9):
            raise ValueError("broken seek table")
        self.table = np.frombuffer(self._read(at, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.ends = np.cumsum(self.table[:, 0])
        here = int(self.ends[-1]) if n else 0
        if struct.unpack("<II", self._read(here, 8)) != (DIRECTORY, 17 * n):
            raise ValueError("broken directory")
        data = self._read(here + 8, 17 * n)
        self.doc_ids, self.starts = np.frombuffer(data[: 8 * n], "<i8"), np.frombuffer(data[9 * n:], "<i8")
        self.valid = np.frombuffer(data[8 * n: 9 * n], np.uint8).astype(bool)
        self.plain = zstandard.ZstdDecompressor()

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def __len__(self) -> int:
        return len(self.table)

    def _frame(self, k: int, frame: bytes) -> bytes:
        ids = self.plain.decompress(frame, max_output_size=int(self.table[k, 1])) if self.table[k, 1] else b""
        if len(ids) != self.table[k, 1] or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != self.table[k, 2]:
            raise ValueError(f"frame {k} is damaged")
        return ids

    def ids(self, k: int) -> bytes:
        """Ids of the k-th document: one range read, one frame decompressed."""
        size = int(self.table[k, 0])
        return self._frame(k, self._read(int(self.ends[k]) - size, size))

    def find(self, doc_id: int | None) -> list[int]:
        """Positions of the documents with an id."""
        return np.flatnonzero(~self.valid if doc_id is None else self.valid & (self.doc_ids == doc_id)).tolist()

    def scan(self, block: int = 4 << 20) -> Iterator[tuple[int, bytes]]:
        """All documents in order, fetched in ranges of about ``block`` bytes."""
        k = 0
        while k < len(self):
            start = int(self.ends[k] - self.table[k, 0])
            stop = max(k + 1, int(np.searchsorted(self.ends, start + block, side="right")))
            data = self._read(start, int(self.ends[stop - 1]) - start)
            for i in range(k, stop):
                end = int(self.ends[i]) - start
                yield i, self._frame(i, data[end - int(self.table[i, 0]): end])
            k = stop


class WordEncoder:
    """Encodes texts through the tokenizers library, word by word.

    The tokenizer drops white space and never lets a piece cross it, so a
    text's ids are those of its words; each distinct word goes to the library
    once. A-Z are lowered first, as the tokenizer does, unless a mark follows
    one (it could compose with the lowered letter). A word's full stops and
    commas at the end, after a Latin-1 letter, are a piece of their own, and count as a
    word.

    Words of letters alone go to the library many in a line. Each is one piece,
    and a piece's last token, no other, ends in the vocabulary's end mark, so
    the ids fall apart behind those; if they are not as many as the words, the
    line's words go one by one, as all others do.

    The strings of special tokens stand for those tokens, as by the library's
    defaults: they are looked for in the text as it is, before letters are
    lowered, so that an upper-case look-alike is ordinary text; what lies
    between them is encoded by itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # cut out before; the library sees look-alikes only
        special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        self.fixed = {t: np.array([i], "<u4").tobytes() for t, i in special.items()}
        vocabulary, mark = self.library.get_vocab(with_added_tokens=False), self.library.model.end_of_word_suffix
        self.ending = np.zeros(1 + max([*vocabulary.values(), *special.values()]), bool)
        self.ending[[i for t, i in vocabulary.items() if mark and t.endswith(mark)]] = True
        self.marked = bool(mark) and all(c + mark in vocabulary for c in ByteLevel.alphabet())  # no last byte is lost
        self.known: dict[bytes, bytes] = {b"": b""}
        self.size = 0

    def _cut(self, text: str) -> tuple[list[bytes], list[bytes]]:
        """What lies between special strings, and the ids of those."""
        parts, ids, at = [], [], 0
        for m in self.special.finditer(text):
            parts.append(text[at: m.start()])
            ids.append(self.fixed[m[0]])
            at = m.end()
        raw = [p.encode("utf-8", "surrogatepass") for p in [*parts, text[at:]]]
        return [r.lower() if r.isascii() or not MARKED.search(text) else r for r in raw], ids

    def encode_batch(self, texts: list) -> list[bytes]:
        cut = [self._cut(t or "") for t in texts]
        parts = iter(self._encode([p for c in cut for p in c[0]]))
        return [b"".join([next(parts), *(x for i in ids for x in (i, next(parts)))]) for _, ids in cut]

    def _encode(self, parts: list[bytes]) -> list[bytes]:
        """Each distinct word of the batch is looked up once; Arrow numbers them."""
        rows = pc.replace_substring_regex(pa.array(parts, pa.large_binary()), STOPS, rb"\1 \2\3").view(pa.large_string())
        words = pc.ascii_split_whitespace(rows)
        coded = words.flatten().view(pa.large_binary()).dictionary_encode()
        found = self._ids(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, at = np.frombuffer(b"".join(found), "<u4"), np.cumsum(size) - size
        word = np.asarray(coded.indices)
        n = size[word]
        end = np.cumsum(n)
        ids = np.empty(n.sum(), "<u4")
        for a in range(0, len(word), WORDS):
            w, k, e = (x[a: a + WORDS] for x in (word, n, end))
            first, last = e[0] - k[0], e[-1]
            ids[first:last] = flat[np.arange(first, last) + np.repeat(at[w] - e + k, k)]
        cuts = np.r_[0, end][np.asarray(words.offsets) - words.offsets[0].as_py()].tolist()
        return [ids[i:j].tobytes() for i, j in itertools.pairwise(cuts)]

    def _ids(self, words: list[bytes]) -> list[bytes]:
        if self.size > KEPT:
            self.known, self.size = {b"": b""}, 0
        new = [w for w in words if w not in self.known]
        if new:
            self._learn(list(zip(new, b"\n".join(new).decode("utf-8", "replace").split("\n"))))
        return list(map(self.known.__getitem__, words))

    def _learn(self, words: list[tuple[bytes, str]]) -> None:
        plain = [x for x in words if x[1].isalpha()] if self.marked else []
        apart = [x for x in words if not x[1].isalpha()] if self.marked else words
        for i in range(0, len(plain), LINES * LINE):
            part = [plain[k: k + LINE] for k in range(i, min(i + LINES * LINE, len(plain)), LINE)]
            for line, e in zip(part, self.library.encode_batch_fast([" ".join([t for _, t in line]) for line in part], add_special_tokens=False)):
                ids = np.array(e.ids, "<u4")
                ends = (np.flatnonzero(self.ending[ids]) + 1) * 4
                if len(ends) != len(line):  # a letter that the normalizer turned into more than a letter
                    apart += line
                    continue
                raw, ends = ids.tobytes(), ends.tolist()
                self.known.update(zip([w for w, _ in line], [raw[i:j] for i, j in itertools.pairwise([0, *ends])]))
                self.size += sum([len(w) for w, _ in line]) + ENTRY * len(line) + len(raw)
        for i in range(0, len(apart), 1 << 15):
            part = apart[i: i + (1 << 15)]
            for (w, _), e in zip(part, self.library.encode_batch_fast([t for _, t in part], add_special_tokens=False)):
                self.known[w] = ids = np.array(e.ids, "<u4").tobytes()
                self.size += ENTRY + len(w) + len(ids)


MARKED = regex.compile(r"[A-Z]\p{M}")
STOPS = rb"([a-zA-Z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])([.,]+)([ \t\n\v\f\r]|$)"  # behind A-Z and the letters up to U+00FF


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


MANIFEST = "part int, file string, docs bigint, ids bigint"


def write(docs: DataFrame, tokenizer: str, scratch: Scratch, end_id: int = END_ID,
          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every text, append ``end_id`` and write the ids in ascending
    ``doc_id`` order (null last, ties by text hash), a file for each range of
    ids. Returns the manifest with ``start``, the ids before each file.

    A null text is empty: its document holds the end id alone. Repeated rows
    are written each. No row, no file. Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    rows = dealt_by_id(rows, "doc_id", F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
    folder = new_folder(docs.sparkSession, f"{scratch.name}-files")
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = part = None
        for batch in batches:
            for piece in split_batch(batch, "text", 4 << 20):
                if writer is None:
                    part = piece.column(2)[0].as_py()
                    file = new_file(folder, f"part-{part:05d}", ".ids.zst")
                    system, path = locate(file)
                    writer = Writer(system.open_output_stream(path, compression=None))
                for i, ids in zip(piece.column(0).to_pylist(), encoder(tokenizer).encode_batch(piece.column(1).to_pylist())):
                    writer.add(i, ids + end)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([file]), pa.array([len(writer.table)], pa.int64()), pa.array([writer.ids], pa.int64())],
                                             names=["part", "file", "docs", "ids"])

    files = scratch.write(rows.select("doc_id", "text", "part").mapInArrow(run, MANIFEST), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    return files.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = locate(row["file"])
                with system.open_input_file(path) as f:
                    reader = Reader(f)
                    crc = np.empty(len(reader), np.int64)
                    for k, ids in reader.scan():
                        crc[k] = zlib.crc32(ids)
                for a in range(0, len(reader), 1 << 16):
                    s = slice(a, a + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(reader.doc_ids[s], mask=~reader.valid[s]), pa.array(reader.starts[s] + row["start"]), pa.array(reader.table[s, 1] // 4), pa.array(crc[s])],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return spread(manifest).select("file", "start").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
