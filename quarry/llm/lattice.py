"""Embedding near-duplicates by lattice hashing.

A table projects unit vectors onto eight random directions, ``blocks`` times, and
decodes the points, divided by ``scale``, to the nearest points of the lattice E8;
together they name a cell. A vector is stored under its own cell in every table and
looked up there and in neighbouring cells: those that differ in one block, by one of
the ``probes`` lattice points (of 240) nearest to it. What shares a cell is compared
by cosine in double precision, so no pair below the threshold links.

Whether a pair is found depends on its two vectors alone: blocks, tables, probes and
scale are the same for every table of vectors, so rows that come or go change no
other pair. A pair at the threshold is found with a probability of 0.994, one of
cosine 0.958 with 0.997, a closer one with more. Two blocks tell about 17,600 cells of
random vectors apart: a vector meets about one in 700 of all others, 24 cells taken
together, so the price of that is a work that grows faster than the table.

Equal vectors are one class from the start. A cell with more than ``CHUNK``
stored classes is split into chunks, each of which sees all look-ups. Tasks
give back sums of links and a spanning forest, never pairs: a pair that meets
several times counts in the first table, and for the smaller side, only; both
sides carry all their cells, so that a task can tell.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import SEED, Scratch
from quarry.llm.components import connected_components, joined

COSINE = 0.95
FIXED_BLOCKS, FIXED_TABLES, FIXED_PROBES, FIXED_SCALE = 2, 8, 1, 2.1  # of near_duplicates, however many vectors there are
TABLES, PROBES, SCALE = 4, 2, 1.6  # of links and of the rule in ``shape``
CROWD, CELLS = 64, 2000  # strangers wanted in a cell at most; cells that a block tells apart
TABLE_GROWTH = 2  # tables for each block more
CHUNK = 16_384

_half = [v for v in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
_whole = [[s if k == i else t if k == j else 0.0 for k in range(8)] for i, j in itertools.combinations(range(8), 2) for s in (1, -1) for t in (1, -1)]
ROOTS = np.array([*_half, *_whole])  # the 240 shortest vectors of E8


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with integer coordinates of even sum."""
    out = np.rint(x)
    off = x - out
    odd = np.flatnonzero(out.sum(axis=1) % 2)
    worst = np.abs(off[odd]).argmax(axis=1)
    out[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return out


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest lattice points: E8 is D8 and D8 moved by one half everywhere."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def shape(n: int) -> tuple[int, int]:
    """(blocks, tables) with ``PROBES`` and ``SCALE`` that keep cells of n distinct
    vectors small, for a caller who sets them; tables of another shape may miss
    other pairs, so ``near_duplicates`` does not choose by size."""
    blocks = max(1, math.ceil(math.log(max(n, 2) / CROWD) / math.log(CELLS)))
    return blocks, TABLES * TABLE_GROWTH ** (blocks - 1)


def cells(x: np.ndarray, tables: int, probes: int, scale: float, blocks: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Own cell (rows, tables) and probed cells (rows, tables, blocks * probes) of
    unit vectors, as 32-bit names. A shared name only adds comparisons."""
    own, near = np.empty((len(x), tables), np.uint32), np.empty((len(x), tables, blocks * probes), np.uint32)
    for t in range(tables):
        home, moved = [], []
        for b in range(blocks):
            rng = np.random.default_rng([SEED, x.shape[1], t, b][: 4 if b else 3])
            at = x @ rng.standard_normal((x.shape[1], 8)) / scale
            odd = rng.integers(1, 1 << 62, 8, dtype=np.int64) * 2 + 1
            point = nearest_e8(at)
            off = at - point
            far = -2 * off @ ROOTS.T  # squared distance to each neighbour less a constant: all roots have one length
            order = np.argsort(far, axis=1, kind="stable")[:, :probes]
            home.append(_hash(point, odd))
            moved.append([_hash(point + ROOTS[order[:, p]], odd) for p in range(probes)])
        own[:, t] = _name(home)
        for b in range(blocks):
            for p in range(probes):
                near[:, t, b * probes + p] = _name([moved[b][p] if c == b else h for c, h in enumerate(home)])
    return own, near


def _hash(points: np.ndarray, odd: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = ((2 * points).astype(np.int64) * odd).sum(axis=1).view(np.uint64)
        return (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)


def _name(blocks: list[np.ndarray]) -> np.ndarray:
    h = blocks[0]
    with np.errstate(over="ignore"):
        for other in blocks[1:]:
            h = (h ^ (h >> np.uint64(29)) ^ other) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(32)).astype(np.uint32)


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    inf = float("inf")
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (v < inf) & (v > -inf)) & F.exists(vector, lambda v: v != 0)
    return F.coalesce(fine, F.lit(False))


FILED = "low bigint, h bigint, n bigint, dim int, own array<bigint>, near array<bigint>, vector binary, names binary"
FOUND = "low bigint, h bigint, root_low bigint, root_h bigint, links bigint"


def _file(tables: int, probes: int, scale: float, kind: str, blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            sizes = np.asarray(lists.value_lengths())
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                rows = batch.take(pa.array(at))
                x = np.asarray(rows.column(3).flatten(), dtype=np.float64).reshape(len(at), dim)
                own, near = cells(unit(x), tables, probes, scale, blocks)
                table = np.arange(tables, dtype=np.int64) << 32
                keys = [(own + table).tolist(), (near + table[:, None]).reshape(len(at), -1).tolist()]
                names = np.concatenate([own[:, :, None], near], axis=2).astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:3], pa.array(np.full(len(at), dim, np.int32)), *(pa.array(k, pa.list_(pa.int64())) for k in keys),
                     pa.array([r.tobytes() for r in x.astype(kind)], pa.binary()), pa.array([r.tobytes() for r in names], pa.binary())],
                    names=[f.split()[0] for f in FILED.split(", ")])

    return run


class Side:
    """Rows of one table as arrays, with their cells in the tables up to it."""

    def __init__(self, rows: pa.RecordBatch, probes: int, kind: str):
        col = {n: rows.column(i) for i, n in enumerate(rows.schema.names)}
        self.low, self.h, self.n = (np.asarray(col[c], dtype=np.int64) for c in ("low", "h", "n"))
        k = len(self.low)
        self.x = unit(np.frombuffer(b"".join(col["vector"].to_pylist()), kind).reshape(k, -1).astype(np.float64))
        names = np.frombuffer(b"".join(col["names"].to_pylist()), "<u4").reshape(k, -1, 1 + probes)
        self.own, self.near = names[:, :, 0], names[:, :, 1:]

    @staticmethod
    def of(sides: list[Side], rows: slice = slice(None)) -> Side:
        out = object.__new__(Side)
        for a in ("low", "h", "n", "x", "own", "near"):
            setattr(out, a, np.concatenate([getattr(s, a) for s in sides]) if len(sides) > 1 else getattr(sides[0], a)[rows])
        return out


class Cell:
    """Links of one chunk of a cell: stored rows among themselves, then look-ups against them."""

    def __init__(self, table: int, cosine: float):
        self.table, self.cosine, self.parts, self.stored = table, cosine, [], None

    def store(self, side: Side) -> None:
        self.parts.append(side)

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.stored is None and self.parts:
            self.stored = Side.of(self.parts)
            if len(self.stored.low) > 1:
                yield from self.match(self.stored, "stored")

    def match(self, q: Side, role: str) -> Iterator[pa.RecordBatch]:
        s = self.stored
        step = max(1, (1 << 22) // max(1, len(s.low)))
        for a in range(0, len(q.low), step):
            i, j = np.nonzero(q.x[a: a + step] @ s.x.T >= self.cosine)
            if not len(i):
                continue
            i = i + a
            if role == "stored":
                keep = i < j
            else:
                smaller = (q.low[i] < s.low[j]) | (q.low[i] == s.low[j]) & (q.h[i] < s.h[j])
                back = (s.near[j, self.table] == q.own[i, self.table][:, None]).any(axis=1) if role == "probe" else True
                keep = smaller | ~np.asarray(back)
            for t in range(self.table):
                met = (q.own[i, t] == s.own[j, t]) | (q.near[i, t] == s.own[j, t][:, None]).any(axis=1) | (s.near[j, t] == q.own[i, t][:, None]).any(axis=1)
                keep &= ~met
            keep &= (q.low[i] != s.low[j]) | (q.h[i] != s.h[j])  # two cells of one name
            i, j = i[keep], j[keep]
            if len(i):
                yield _found(q, s, i, j, role == "stored")


def _found(q: Side, s: Side, i: np.ndarray, j: np.ndarray, same: bool) -> pa.RecordBatch:
    """Sums of links and the local root of each row that has a link."""
    m = len(s.low)
    at = i if same else i + m
    low, h, n = (getattr(s, c) if same else np.concatenate([getattr(s, c), getattr(q, c)]) for c in ("low", "h", "n"))
    links = np.zeros(len(low), np.int64)
    np.add.at(links, at, n[j])
    np.add.at(links, j, n[at])
    root = joined(np.arange(len(low)), at, j)
    on = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays([pa.array(v) for v in (low[on], h[on], low[root[on]], h[root[on]], links[on])], names=[f.split()[0] for f in FOUND.split(", ")])


def _compare(probes: int, cosine: float, kind: str):
    """Rows come sorted by length, cell, chunk and role; stored rows (role 0) first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cell = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            dim, g, chunk, role = (np.asarray(batch.column(k), dtype=np.int64) for k in range(4))
            rest = batch.select(list(range(4, batch.num_columns)))
            for first, last in _runs(dim, g >> 32):  # vectors and names of one length
                side = Side(rest.slice(first, last - first), probes, kind)
                cells_ = np.array(_runs(g[first:last], chunk[first:last])) + first
                stored = np.add.reduceat(role[first:last] == 0, cells_[:, 0] - first, dtype=np.int64)
                use = (stored > 0) & (cells_[:, 1] - cells_[:, 0] > 1)  # others have nothing to compare,
                use[[0, -1]] = True  # unless they began in the last batch or go on in the next
                for a, b in cells_[use].tolist():
                    here = int(dim[a]), int(g[a]), int(chunk[a])
                    if here != key:
                        if cell:
                            yield from cell.close()
                        key, cell = here, Cell(here[1] >> 32, cosine)
                    own, probe = (a + np.searchsorted(role[a:b], [1, 2])).tolist()
                    if own > a:
                        cell.store(Side.of([side], slice(a - first, own - first)))
                    for i, j, name in ((own, probe, "own"), (probe, b, "probe")):
                        if j > i and (cell.parts or cell.stored):
                            yield from cell.close()
                            yield from cell.match(Side.of([side], slice(i - first, j - first)), name)
        if cell:
            yield from cell.close()

    return run


def _runs(*cols: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal values."""
    new = np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in cols], axis=0)]).tolist()
    return list(itertools.pairwise([*new, len(cols[0])]))


def classes(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(low, h, n, vector): each distinct usable vector, its smallest id, hash and number of rows."""
    own = rows.where(usable(F.col("vector")) & F.col("vec_id").isNotNull()).groupBy("vector").agg(F.min("vec_id").alias("low"), F.count("*").alias("n"))
    return scratch.write(own.select("low", F.xxhash64("vector").alias("h"), "n", "vector"), "classes")


def links(distinct: DataFrame, scratch: Scratch, cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE,
          blocks: int = 1) -> DataFrame:
    """(low, h, root_low, root_h, links): per class and cell, links to rows of
    other classes and the root of a local forest; to be summed and joined."""
    kind = "<f4" if distinct.schema["vector"].dataType.elementType == T.FloatType() else "<f8"
    filed = scratch.write(distinct.select("low", "h", "n", F.col("vector").cast("array<double>")).mapInArrow(_file(tables, probes, scale, kind, blocks), FILED), "filed")
    crowd = filed.select(F.explode("own").alias("g"), "dim").groupBy("g", "dim").count().where(F.col("count") > CHUNK)
    crowd = scratch.write(crowd.select("g", "dim", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks")), "crowded")
    mark = lambda c, probe: F.transform(c, lambda g: F.struct(g.alias("g"), F.lit(probe).alias("probe")))
    rows = filed.select("low", "h", "n", "dim", "vector", "names", F.explode(F.concat(mark(F.col("own"), False), mark(F.col("near"), True))).alias("to"))
    rows = rows.select("to.g", "to.probe", "low", "h", "n", "dim", "vector", "names").join(crowd, ["g", "dim"], "left")
    chunks = F.coalesce("chunks", F.lit(1))
    home = F.pmod(F.col("h"), chunks).cast("int")
    role = lambda c: F.when(F.col("probe"), 2).when(c == home, 0).otherwise(1)
    rows = rows.withColumn("home", home).withColumn("at", F.explode(F.sequence(F.lit(0), chunks - 1)))
    names = F.substring("names", F.lit(1), (F.shiftright("g", 32) + 1).cast("int") * (4 * (1 + blocks * probes)))  # a pair met before in these tables only
    rows = rows.select("dim", "g", F.col("at").alias("chunk"), role(F.col("at")).alias("role"), "low", "h", "n", "vector", names.alias("names"))
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "g", "dim", "chunk").sortWithinPartitions("dim", "g", "chunk", "role")
    return rows.mapInArrow(_compare(blocks * probes, cosine, kind), FOUND)


def near_duplicates(vectors: DataFrame, scratch: Scratch, cosine: float = COSINE, blocks: int = FIXED_BLOCKS, tables: int = FIXED_TABLES,
                    probes: int = FIXED_PROBES, scale: float = FIXED_SCALE, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    A vector that is null, zero, or has a null or non-finite component links
    with nothing; vectors of different lengths never link. Equal vectors, and
    repeated rows, link with each other. The number of vectors
    changes none of ``blocks``, ``tables``, ``probes`` and ``scale``. A row without id is returned with no
    links, no component and not kept, and counts for no other row. An empty
    table gives no rows; other columns are ignored.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    distinct = classes(rows, scratch)
    found = scratch.write(links(distinct, scratch, cosine, tables, probes, scale, blocks), "found")
    node = lambda a, b: F.struct(F.col(a).alias("low"), F.col(b).alias("h"))
    roots = connected_components(found.select(node("low", "h").alias("a"), node("root_low", "root_h").alias("b")), scratch)
    sums = found.groupBy("low", "h").agg(F.sum("links").alias("links"))
    named = distinct.join(sums, ["low", "h"], "left").join(roots.select("node.low", "node.h", F.col("root.low").alias("root")), ["low", "h"], "left")
    named = scratch.write(named.select(F.col("vector").alias("key"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("root", "low").alias("component")), "named")
    scratch.drop(found, distinct, roots)
    key = F.when(usable(F.col("vector")) & F.col("vec_id").isNotNull(), F.col("vector"))
    out = rows.withColumn("mine", key).join(named, F.col("mine") == F.col("key"), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
