"""Document fingerprints: threshold-scaled sketches of 5-word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range, so
its size follows the document's and the union of two sketches is the sketch of
both documents' shingles. That makes containment comparable between a note and
a book, where fixed-size sketches fail. A document none of whose hashes is that
small keeps its smallest one, which a merge drops again beside smaller ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import arrow_of, map_texts, shingle_hashes, split_batch, text_of, words_of
from quarry.llm.ranges import with_part

WORDS = 5
SCALE = 8  # one hash of 8 is kept


def sketch(text: str | None, words: int = WORDS, scale: int = SCALE) -> np.ndarray:
    """Sorted distinct hashes kept of a text; empty only for no words."""
    h = shingle_hashes(words_of(text or ""), words)
    kept = np.unique(h[h < np.uint64((1 << 64) // scale)])
    return kept if len(kept) or not len(h) else np.array([h.min()], np.uint64)


def merge(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of both documents' shingles together."""
    both = np.union1d(a, b)
    kept = both[both < np.uint64((1 << 64) // scale)]
    return kept if len(kept) else both[:1]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of the shingles; 1 for two empty sketches."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common) if len(a) or len(b) else 1.0


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 1.0


def to_text(s: np.ndarray) -> str:
    """16 hex digits a hash, in ascending order."""
    return s.astype(">u8").tobytes().hex()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(s), ">u8").astype(np.uint64)


def with_sketch(docs: DataFrame, text: str = "text", words: int = WORDS, scale: int = SCALE) -> DataFrame:
    """``docs`` with ``text`` replaced by ``fingerprint``. A null text counts as empty."""
    return map_texts(docs, lambda texts: {"fingerprint": [to_text(sketch(t, words, scale)) for t in texts]}, "fingerprint string", text)


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(doc_id, text)`` dealt out by descending ``doc_id`` (null last, ties
    by text hash), one range of ids a partition and sorted in it. The last row
    of a partition, marked ``halo``, repeats the row that follows its range;
    after the last row of all follows the first.

    Text is shuffled once. The cut points come from the ids alone; the driver
    sees an id and a hash for each partition.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    tie = F.xxhash64("text")
    rows, n = with_part(rows, "doc_id", tie, nulls_first=True, ties_down=True)
    begin = F.struct("doc_id", F.bitwise_not(tie).alias("tie"))  # greatest where a range begins
    first = {r[0]: r[1] for r in rows.groupBy("part").agg(F.max(begin)).collect()}
    if not first:
        return rows.select("doc_id", "text", F.lit(False).alias("halo"))
    full = sorted(first)
    above = dict(zip(full, [*full[1:], full[0]]))
    every = [first.get(i) for i in range(n)]

    def at_part(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("part") + 1)

    leads = F.col("doc_id").eqNullSafe(at_part([r and r.doc_id for r in every], "long")) & (F.bitwise_not(tie) == at_part([r and r.tie for r in every], "long"))
    goes = at_part([above.get(i, -1) for i in range(n)], "int")
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("halo"))
    halo = F.struct(goes.alias("part"), F.lit(True).alias("halo"))
    to = F.when(leads, F.array(own, halo)).otherwise(F.array(own))
    dealt = rows.select("doc_id", "text", F.explode(to).alias("to")).select("doc_id", "text", "to.part", "to.halo")
    dealt = dealt.repartitionById(n, F.col("part"))
    order = [F.col("halo"), F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    return dealt.sortWithinPartitions(*order).select("doc_id", "text", "halo")


EDITED = T.StructType([
    *(T.StructField(c, T.LongType()) for c in ("doc_id", "n_chars")),
    *(T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")),
    *(T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next", "contained_edited", "contained_next")),
])


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                        words: int = WORDS, scale: int = SCALE) -> DataFrame:
    """Each document's sketch against its edited text's and the next document's.

    The edited text has its last floor(n/2) code points replaced by the first
    as many (or all) of the next document, in descending ``doc_id``. A null
    text is empty; null ids come last; rows with one id follow each other by
    text hash; a lone document is its own next. Repeated rows stay. Other
    columns are ignored. ``contained_*`` is the share of the document's sketch
    found in the other one.
    """
    rows = with_next(docs, doc_id, text)

    schema = arrow_of(EDITED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # id, text and sketch of the row whose next is to come
        for batch in batches:
            for part in split_batch(batch, "text", 4 << 20):
                out = []
                for i, t, halo in zip(*(c.to_pylist() for c in part.columns)):
                    mine = sketch(t, words, scale) if before is not None or not halo else None
                    if before is not None:
                        out.append(_edited_row(*before, t, mine, words, scale))
                        before = None
                    if not halo:
                        before = (i, t, mine)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return rows.mapInArrow(run, EDITED)


def _edited_row(i, text: str, mine: np.ndarray, following: str, theirs: np.ndarray, words: int, scale: int) -> tuple:
    n = len(text)
    edited = text[: n - n // 2] + following[: n // 2]
    new = sketch(edited, words, scale)
    return (i, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), to_text(mine), to_text(new),
            likeness(mine, new), likeness(mine, theirs), containment(mine, new), containment(mine, theirs))
