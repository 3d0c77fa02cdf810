"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints: a 64-bit majority vote over the XXH64 of all 3-word shingles.
Two fingerprints link if they differ in at most 2 bits.

Search. All distinct fingerprints are sorted by their rank in the reflected Gray
sequence and cut into ranges, one a task. Upper nodes of the index hold the bits
on which all fingerprints below agree, factored level by level: a node keeps
only what it adds to the node above. The topmost levels stand over the ranges;
they are a small table (two words a range) that every task has. A fingerprint
goes down them, adding up its differences, and is sent to each range behind its
own in which they do not exceed the distance. There it goes on down the levels
over the fingerprints, ``FAN`` below each node, and whole groups are dropped as
soon as the sum exceeds the distance. At the bottom the sum is the distance.

All of it is exact at any distance: no candidate is capped, and there is no
other path for small or large groups. The fingerprints are distinct, so ranges
are even. For 2^p ranges a fingerprint is sent to about p * p / 4 of them at
distance 2, so there are no more ranges than the tasks' memory asks for: 16 up to
16 million fingerprints, however many partitions Spark has. A range gives
back a spanning forest of its links and, for each fingerprint sent to it, one
link to each component it touches, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, map_texts, shingle_hashes, text_of, words_of
from quarry.llm.components import connected_components, joined

WORDS, BITS = 3, 2
FAN = 8
MOST, SPREAD = 1 << 20, 16  # fingerprints of a range; ranges of a table that needs no more
BLOCK = 512  # fingerprints that go down the index together


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The fingerprint as an unsigned integer; 0 for no words."""
    h = shingle_hashes(words_of(text or ""), words)
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 14):
        part = h[i: i + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", words: int = WORDS) -> DataFrame:
    """``docs`` with ``text`` replaced by ``fp``, the fingerprint as a signed long."""

    def make(texts: list) -> dict:
        return {"fp": np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)}

    return map_texts(docs, make, "fp bigint", text)


def hex_of(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _gray_rank(code: Column, bits: int) -> Column:
    """Position of ``code`` in the reflected Gray sequence."""
    shift = 1
    while shift < bits:
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
        shift *= 2
    return code


def ranges(n: int) -> int:
    """Ranges for n fingerprints: ``SPREAD``, or as many as hold ``MOST`` each."""
    return max(SPREAD, -(-n // MOST))


class Index:
    """Levels from the top, each (pattern, mask): the bits a node adds to those
    its parent shares. The lowest level are the given patterns."""

    def __init__(self, pattern: np.ndarray, mask: np.ndarray):
        shared = [(pattern, mask)]
        while len(shared[-1][0]) > 1:
            pattern, mask = shared[-1]
            at = np.arange(0, len(pattern), FAN)
            both, any_ = np.bitwise_and.reduceat(pattern, at), np.bitwise_or.reduceat(pattern, at)
            shared.append((both, np.bitwise_and.reduceat(mask, at) & ~(both ^ any_)))
        shared.reverse()
        self.levels = [shared[0]]
        for (_, above), (pattern, mask) in zip(shared, shared[1:]):
            self.levels.append((pattern, mask & ~np.repeat(above, FAN)[: len(mask)]))
        self.visited = self.pruned = 0  # nodes looked at; patterns below those that were dropped

    @classmethod
    def of(cls, code: np.ndarray) -> Index:
        return cls(code, np.full(len(code), ~np.uint64(0)))

    def near(self, query: np.ndarray, bits: int, after: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``query``, position of a pattern) where they differ in at
        most ``bits`` of the pattern's bits; ``after``: patterns behind these only."""
        depth = len(self.levels) - 1
        n = len(self.levels[depth][0])
        who, at = np.arange(len(query)), np.zeros(len(query), np.int64)
        far = np.zeros(len(query), np.int64)
        for k, (pattern, mask) in enumerate(self.levels):
            span = FAN ** (depth - k)
            if k:
                at = (at[:, None] * FAN + np.arange(FAN)).ravel()
                who, far = np.repeat(who, FAN), np.repeat(far, FAN)
                there = at < len(pattern)
                if after is not None:
                    there &= (at + 1) * span - 1 > after[who]
                at, who, far = at[there], who[there], far[there]
            far = far + np.bitwise_count((query[who] ^ pattern[at]) & mask[at])
            keep = far <= bits
            self.visited += len(at)
            self.pruned += int(np.minimum(span, n - at[~keep] * span).sum())
            at, who, far = at[keep], who[keep], far[keep]
        if after is not None:
            keep = at > after[who]
            at, who = at[keep], who[keep]
        return who, at


def links(reps: DataFrame, scratch: Scratch, bits: int = BITS) -> DataFrame:
    """(a, b): links that join all fingerprints of ``reps(fp)``, which are distinct
    and not null, linked at ``bits`` differing bits."""
    spark = reps.sparkSession
    n = ranges(reps.count())
    rank = _gray_rank(F.col("fp"), 64).bitwiseXOR(F.lit(-1 << 63))  # ranks are unsigned, longs are not
    ranked = reps.select("fp", rank.alias("rank"))
    at = ranked.agg(F.percentile_approx("rank", [i / n for i in range(1, n)], 100 * n)).first()[0] or []
    cut = Bucketizer(splits=[-np.inf, *(sorted({float(x) for x in at}) or [0.0]), np.inf], inputCol="place", outputCol="bucket")
    dealt = cut.transform(ranked.withColumn("place", F.col("rank").cast("double"))).select("fp", "rank", F.col("bucket").cast("int").alias("part"))
    dealt = scratch.write(dealt.repartitionById(n, F.col("part")).sortWithinPartitions("rank"), "ranges")
    tops = dealt.groupBy("part").agg(F.expr("bit_and(fp)").alias("both"), F.expr("bit_or(fp)").alias("any")).orderBy("part").collect()  # a row a range
    if not tops:
        return spark.createDataFrame([], "a bigint, b bigint")
    parts = np.array([r.part for r in tops])
    both, any_ = (np.array([r[c] for r in tops], np.int64).view(np.uint64) for c in ("both", "any"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = Index(both, ~(both ^ any_))
        for batch in batches:
            code, own = np.asarray(batch.column(0)).view(np.uint64), np.asarray(batch.column(2))
            place = np.searchsorted(parts, own)
            yield _sent(own, np.zeros(len(own), np.int8), batch.column(1), batch.column(0))
            for i in range(0, len(code), BLOCK):
                who, at = top.near(code[i: i + BLOCK], bits, place[i: i + BLOCK])
                some = pa.array(who + i)
                yield _sent(parts[at], np.ones(len(at), np.int8), batch.column(1).take(some), batch.column(0).take(some))

    sent = dealt.mapInArrow(send, "part int, visitor tinyint, rank bigint, fp bigint")
    sent = sent.repartitionById(int(parts.max()) + 1, F.col("part")).sortWithinPartitions("visitor", "rank").select("visitor", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _linked(((np.asarray(b.column(0)), np.asarray(b.column(1)).view(np.uint64)) for b in batches), bits)

    return sent.mapInArrow(run, "a bigint, b bigint")


def _sent(part: np.ndarray, visitor: np.ndarray, rank: pa.Array, fp: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(visitor), rank, fp], names=["part", "visitor", "rank", "fp"])


def _linked(batches: Iterator[tuple[np.ndarray, np.ndarray]], bits: int) -> Iterator[pa.RecordBatch]:
    """Links of one range: its own fingerprints come first, then the visitors,
    which are not held."""
    own: list[np.ndarray] = []
    index = code = label = None

    def pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def close() -> pa.RecordBatch:
        nonlocal index, code, label
        code = np.concatenate(own)
        index, label = Index.of(code), np.arange(len(code))
        for i in range(0, len(code), BLOCK):
            query = np.arange(i, min(i + BLOCK, len(code)))
            who, at = index.near(code[query], bits, query)
            label = joined(label, query[who], at)
        moved = np.flatnonzero(label != np.arange(len(code)))
        return pairs(code[moved], code[label[moved]])

    for visitor, codes in batches:
        first = int(np.searchsorted(visitor, 1))
        if first:
            own.append(codes[:first])
        if first == len(codes):
            continue
        if index is None:
            yield close()
        codes = codes[first:]
        for i in range(0, len(codes), BLOCK):
            query = codes[i: i + BLOCK]
            who, at = index.near(query, bits)
            if len(who):
                one = np.unique(np.stack([who, label[at]]), axis=1)
                yield pairs(query[one[0]], code[one[1]])
    if index is None and own:
        yield close()


def components(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text",
               words: int = WORDS, bits: int = BITS, extra: list[Column] | None = None) -> DataFrame:
    """Every row's ``fp``, the ``root`` fingerprint of its component and
    ``component_id``, the smallest ``doc_id`` among the documents reachable
    over links.

    A null text is the empty text; an empty text, or one of white space, has
    fingerprint 0 and links like any other. Rows with a null ``doc_id`` take
    part; the id of a component that has only such rows is null. Repeated rows
    are kept. An empty table gives an empty result. Other columns of ``docs``
    are ignored, whatever their names.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), *(extra or []), text_of(text).alias("text"))
    rows = scratch.write(with_fingerprint(rows, "text", words), "fingerprints")
    reps = scratch.write(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    roots = connected_components(links(reps.select("fp"), scratch, bits), scratch)
    member = reps.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
    member = scratch.write(member.select("fp", "low", F.coalesce("root", "fp").alias("root")), "members")
    least = scratch.write(member.groupBy("root").agg(F.min("low").alias("component_id")), "least")
    named = scratch.write(member.join(least, "root").select("fp", "root", "component_id"), "named")
    scratch.drop(reps, roots, member, least)
    return rows.join(named, "fp")


def dedup(docs: DataFrame, scratch: Scratch, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """``docs`` with one row of each component: the smallest ``doc_id`` (null
    last); of several rows with that id, the one of smallest text hash, then of
    the smallest hash of all columns; of rows equal in all of them, one."""
    text_key, row_key = F.xxhash64(text_of()), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    found = components(docs, scratch, words=words, bits=bits, extra=[text_key.alias("text_key"), row_key.alias("row_key")])
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_key").alias("text"), F.col("row_key").alias("row"))
    kept = found.groupBy("root").agg(F.min(order).alias("k")).select("k.id", "k.text", "k.row")
    kept = scratch.write(kept.distinct(), "kept")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept_row"), F.col("doc_id").alias("its_id"), text_key.alias("its_text"), row_key.alias("its_row"))
    same = F.col("its_id").eqNullSafe(F.col("id")) & (F.col("its_text") == F.col("text")) & (F.col("its_row") == F.col("row"))
    out = rows.join(kept, same, "left_semi")
    twice = found.groupBy("doc_id", "text_key", "row_key").count().where("count > 1")
    twice = twice.join(kept, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("text")) & (F.col("row_key") == F.col("row")), "left_semi")
    if not twice.isEmpty():  # rows repeated as a whole
        out = out.dropDuplicates(["its_id", "its_text", "its_row"])
    return out.select("kept_row.*")
