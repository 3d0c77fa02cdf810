"""Approximate nearest neighbours by inner product: navigable small worlds.

The rows are dealt evenly to shards. A task builds the graph of its shard and
stores it as flat arrays: node i of the lower layers is node i of the upper
ones (nodes stand in the order of falling levels), so that a layer is one
matrix of neighbour numbers, -1 where there is none. A second job searches
every shard for blocks of queries, and the best of all shards are merged.

Largest inner product is made nearest neighbour: the vectors of a graph, divided
by the longest, get one more coordinate that gives all of them length one (a
query gets a zero there). Vectors of different length or less than half as long
as a graph's longest have graphs of their own, so that this coordinate never
drowns the others. Equal vectors of a shard are one node; all their ids count.

A layer grows in batches: all new nodes search the layer as it is, are compared
with each other, choose diverse neighbours (none nearer to a chosen one than to
the node), and the chosen ones take them in, choosing anew where they are full.
Searching, too, moves many queries at once. Scores returned are inner products
of the original vectors in double precision, added up in one order.

A graph search per shard and query is what the job costs. Shards take
rows/partitions rows between ``LEAST_SHARD`` and ``MOST_SHARD``: a search as wide as
``EF`` finds 0.98 of the nearest in a graph of that size but 0.90 in one of 50,000
(measured on the test tables), and a wider search in larger shards costs as much
as it saves. So the share found does not fall as the table grows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import SEED, Scratch
from quarry.llm.lattice import usable
from quarry.llm.store import locate, new_file, new_folder

TOP = 20
LINKS, LINKS_BELOW = 16, 32  # neighbours in upper layers and in the lowest
EF_BUILD, EF, EF_DOWN = 64, 160, 8
LEAST_SHARD, MOST_SHARD, QUERIES_A_BLOCK = 2_048, 16_384, 1_024
BATCH, AT_ONCE = 256, 4  # nodes that search together; nodes that a search opens in a round


def shard_rows(rows: int, partitions: int) -> int:
    return min(MOST_SHARD, max(LEAST_SHARD, math.ceil(rows / max(partitions, 1))))


def search(x: np.ndarray, links: np.ndarray, q: np.ndarray, entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, scores) of the ``ef`` best found for each query in one layer, best
    first, -1 where fewer; ``entry`` are the nodes to begin with, -1 for none."""
    out_ids, out_score = np.full((len(q), ef), -1, np.int32), np.full((len(q), ef), -np.inf, np.float32)
    if not len(q):
        return out_ids, out_score
    rows, n = np.arange(len(q)), len(links)
    seen = np.full(len(q) * n, -1, np.int32)  # by query and node: when it was met
    ids, score, closed = out_ids.copy(), out_score.copy(), np.ones((len(q), ef), bool)

    def meet(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """New nodes of each row and their scores; known or repeated ones go."""
        found, points = found.copy(), np.full(found.shape, -np.inf, np.float32)
        r, c = np.nonzero(found >= 0)
        flat = rows[r] * n + found[r, c]
        new = seen[flat] < 0
        seen[flat[new]] = np.arange(new.sum(), dtype=np.int32)
        new[new] = seen[flat[new]] == np.arange(new.sum())
        found[r[~new], c[~new]] = -1
        r, c = r[new], c[new]
        points[r, c] = np.einsum("kd,kd->k", x[found[r, c]], q[rows[r]])
        return found, points

    def merge(found: np.ndarray, points: np.ndarray) -> None:
        nonlocal ids, score, closed
        every, points = np.concatenate([ids, found], axis=1), np.concatenate([score, points], axis=1)
        shut = np.concatenate([closed, found < 0], axis=1)
        best = np.argpartition(-points, ef - 1, axis=1)[:, :ef] if points.shape[1] > ef else np.broadcast_to(np.arange(points.shape[1]), points.shape)
        ids, score, closed = (np.take_along_axis(m, best, axis=1) for m in (every, points, shut))

    merge(*meet(entry))
    while True:
        live = ~closed.all(axis=1)
        if live.sum() < 0.7 * len(rows) or not live.any():
            done = ~live
            out_ids[rows[done]], out_score[rows[done]] = ids[done], score[done]
            rows, ids, score, closed = rows[live], ids[live], score[live], closed[live]
            if not len(rows):
                break
        points = np.where(closed, -np.inf, score)
        first = np.argpartition(-points, AT_ONCE - 1, axis=1)[:, :AT_ONCE] if ef > AT_ONCE else np.broadcast_to(np.arange(ef), points.shape)
        opened = np.where(np.take_along_axis(points, first, axis=1) > -np.inf, np.take_along_axis(ids, first, axis=1), -1)
        np.put_along_axis(closed, first, True, axis=1)
        around = np.where((opened >= 0)[:, :, None], links[opened], -1)
        merge(*meet(around.reshape(len(rows), -1)))
    order = np.argsort(-out_score, axis=1, kind="stable")
    return np.take_along_axis(out_ids, order, axis=1), np.take_along_axis(out_score, order, axis=1)


def diverse(x: np.ndarray, near: np.ndarray, score: np.ndarray, most: int, fill: bool) -> np.ndarray:
    """Of each row's candidates, best first (-1: none), at most ``most`` of which
    none is nearer to one chosen before than to the row's own node; ``fill`` adds
    the best of the others to empty places."""
    points = x[near]
    between = points @ points.transpose(0, 2, 1)
    chosen, count = np.zeros(near.shape, bool), np.zeros(len(near), np.int64)
    for j in range(near.shape[1]):
        fine = (near[:, j] >= 0) & (count < most) & ~((between[:, j] >= score[:, j, None]) & chosen).any(axis=1)
        chosen[:, j] = fine
        count += fine
    place = np.where(chosen, 0, np.where(near >= 0, 1 if fill else 2, 2))
    order = np.argsort(place, axis=1, kind="stable")[:, :most]
    out = np.where(np.take_along_axis(place, order, axis=1) < 2, np.take_along_axis(near, order, axis=1), -1)
    if out.shape[1] < most:
        out = np.concatenate([out, np.full((len(out), most - out.shape[1]), -1, out.dtype)], axis=1)
    return out


def _ranked(near: np.ndarray, score: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-score, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(near, order, axis=1), np.take_along_axis(score, order, axis=1)


def _take_in(x: np.ndarray, links: np.ndarray, batch: np.ndarray) -> None:
    """Each neighbour chosen by a node of the batch links back to it."""
    most = links.shape[1]
    r, c = np.nonzero(links[batch] >= 0)
    source, target = batch[r], links[batch[r], c]
    score = np.einsum("kd,kd->k", x[source], x[target])
    order = np.lexsort((-score, target))
    source, target = source[order], target[order]
    heads = np.flatnonzero(np.diff(target, prepend=-1))
    place = np.arange(len(target)) - np.repeat(heads, np.diff(np.append(heads, len(target))))
    fits = place < 2 * most  # the nearest of those that ask at once
    new = np.full((len(heads), min(int(place.max(initial=0)) + 1, 2 * most)), -1, links.dtype)
    group = np.searchsorted(heads, np.arange(len(target)), side="right") - 1
    new[group[fits], place[fits]] = source[fits]
    nodes = target[heads]
    for i in range(0, len(nodes), 1024):
        node, had = nodes[i: i + 1024], links[nodes[i: i + 1024]]
        add = new[i: i + 1024]
        add = np.where((add[:, :, None] == had[:, None, :]).any(axis=2), -1, add)
        near = np.concatenate([had, add], axis=1)
        full = (near >= 0).sum(axis=1) > most
        some = ~full
        links[node[some]] = np.take_along_axis(near[some], np.argsort(near[some] < 0, axis=1, kind="stable")[:, :most], axis=1)
        if full.any():
            near = near[full]
            score = np.where(near >= 0, np.einsum("tkd,td->tk", x[near], x[node[full]]), -np.inf)
            links[node[full]] = diverse(x, *_ranked(near, score, near.shape[1]), most, fill=False)


def build(x: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, list[np.ndarray]]:
    """(order of the rows as nodes, layers from the lowest up) of unit vectors."""
    rng = np.random.default_rng(seed)
    level = np.floor(-np.log(1 - rng.random(len(x))) / math.log(LINKS)).astype(int)
    order = np.argsort(-level, kind="stable")
    x, level = x[order], level[order]
    layers: list[np.ndarray] = []
    for height in range(int(level[0]), -1, -1):
        size = int((level >= height).sum())
        most = LINKS if height else LINKS_BELOW
        links = np.full((size, most), -1, np.int32)
        have = 0
        if layers:
            have = len(layers[0])
            links[:have, : layers[0].shape[1]] = layers[0]
        while have < size:
            batch = np.arange(have, min(size, have + min(max(have, 64), BATCH)))
            q = x[batch]
            near, score = np.empty((len(batch), 0), np.int32), np.empty((len(batch), 0), np.float32)
            if have:
                near, score = search(x, links[:have], q, _descend(x, layers, q), EF_BUILD)
            mates = q @ q.T
            np.fill_diagonal(mates, -np.inf)
            other = np.broadcast_to(batch.astype(np.int32), mates.shape)
            other, mates = _ranked(np.where(np.isfinite(mates), other, -1), mates, EF_BUILD)
            near, score = _ranked(np.concatenate([near, other], axis=1), np.concatenate([score, mates], axis=1), EF_BUILD)
            links[batch] = diverse(x, near, score, most, fill=True)
            have += len(batch)
            _take_in(x, links[:have], batch)
        layers.insert(0, links)
    return order, layers


def _descend(x: np.ndarray, layers: list[np.ndarray], q: np.ndarray) -> np.ndarray:
    """Entry nodes for the layer below ``layers`` (lowest first)."""
    entry = np.zeros((len(q), 1), np.int32)
    for links in reversed(layers):
        entry, _ = search(x, links, q, entry, EF_DOWN)
    return entry


class Graph:
    """Flat arrays of the vectors of a shard that go together."""

    FIELDS = ("ids", "starts", "vectors", "unit")

    def __init__(self, ids: np.ndarray, starts: np.ndarray, vectors: np.ndarray, unit: np.ndarray, layers: list[np.ndarray]):
        self.ids, self.starts, self.vectors, self.unit, self.layers = ids, starts, vectors, unit, layers

    @classmethod
    def of(cls, ids: np.ndarray, vectors: np.ndarray) -> Graph:
        vectors = np.ascontiguousarray(vectors)
        rows = vectors.view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1])))[:, 0]
        _, first, node = np.unique(rows, return_index=True, return_inverse=True)
        x = vectors[first].astype(np.float64)
        x /= np.abs(x).max()
        length = np.sqrt((x * x).sum(axis=1))
        x /= length.max()
        rest = np.sqrt(np.maximum(1 - (x * x).sum(axis=1), 0))
        unit = np.concatenate([x, rest[:, None]], axis=1).astype(np.float32)
        order, layers = build(unit)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        sort = np.lexsort((ids, place[node]))
        starts = np.searchsorted(place[node][sort], np.arange(len(order) + 1))
        return cls(ids[sort], starts, vectors[first][order], unit[order], layers)

    def write(self, f) -> None:
        for a in (np.array([len(self.layers)]), *(getattr(self, n) for n in self.FIELDS), *self.layers):
            np.lib.format.write_array(f, np.ascontiguousarray(a), allow_pickle=False)

    @classmethod
    def read(cls, f) -> Graph:
        layers = int(np.lib.format.read_array(f)[0])
        arrays = [np.lib.format.read_array(f) for _ in range(len(cls.FIELDS) + layers)]
        return cls(*arrays[: len(cls.FIELDS)], arrays[len(cls.FIELDS):])

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, top: int, ef: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of each query's best, of other ids than its own."""
        q = queries / np.abs(queries).max(axis=1, keepdims=True)
        q = q / np.sqrt((q * q).sum(axis=1, keepdims=True))
        q = np.concatenate([q, np.zeros((len(q), 1))], axis=1).astype(np.float32)
        ef = min(max(ef, top + 1), max(len(self.unit), 1))
        nodes, _ = search(self.unit, self.layers[0], q, _descend(self.unit, self.layers[1:], q), ef)
        for own, query, found in zip(query_ids.tolist(), queries, nodes):
            found = found[found >= 0]
            with np.errstate(over="ignore", invalid="ignore"):
                score = (self.vectors[found].astype(np.float64) * query).sum(axis=1)
            keep = np.argsort(-score, kind="stable")
            keep = keep[score[keep] >= score[keep[min(top, len(keep) - 1)]]]  # with all that tie at the end
            ids, points = [], []
            for k in keep:
                mine = self.ids[self.starts[found[k]]: self.starts[found[k] + 1]][: top + 1]
                ids.append(mine)
                points.append(np.full(len(mine), score[k]))
            ids, points = np.concatenate(ids), np.concatenate(points)
            fine = ids != own
            ids, points = ids[fine], points[fine]
            best = np.lexsort((ids, -points))[:top]
            yield ids[best], points[best]


MANIFEST = "part int, file string, rows bigint"


def _arrays(batches: Iterator[pa.RecordBatch], first: int) -> dict[int, list]:
    """By the vectors' length: the columns before ``first`` and the vectors."""
    out: dict[int, list] = {}
    for batch in batches:
        sizes = np.asarray(batch.column(first).value_lengths())
        for dim in np.unique(sizes).tolist():
            rows = batch.take(pa.array(np.flatnonzero(sizes == dim)))
            flat = np.asarray(rows.column(first).flatten()).reshape(len(rows), dim)
            out.setdefault(dim, []).append([*(np.asarray(c) for c in rows.columns[:first]), flat])
    return {dim: [np.concatenate(c) for c in zip(*parts)] for dim, parts in sorted(out.items())}


def _bands(vectors: np.ndarray) -> np.ndarray:
    """How often a vector's length is halved from the longest."""
    scale = np.abs(vectors).max(axis=1).astype(np.float64)
    length = np.log2(scale) + 0.5 * np.log2(((vectors / scale[:, None]) ** 2).sum(axis=1))
    return np.floor(length.max() - length).astype(int)


def index(rows: DataFrame, shards: int, folder: str, scratch: Scratch) -> DataFrame:
    """Manifest (part, file, rows) of the graphs of all rows (id, vector)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = _arrays(batches, 1)
        if not every:
            return
        graphs = []
        for ids, vectors in every.values():
            band = _bands(vectors.astype(np.float64))
            graphs += [Graph.of(ids[band == b], vectors[band == b]) for b in np.unique(band)]
        file = new_file(folder, "graph", ".npy")
        system, path = locate(file)
        with system.open_output_stream(path, compression=None) as f:
            np.lib.format.write_array(f, np.array([len(graphs)]), allow_pickle=False)
            for g in graphs:
                g.write(f)
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([file]), pa.array([sum(len(g.ids) for g in graphs)], pa.int64())], names=["part", "file", "rows"])

    return scratch.write(rows.repartition(shards).mapInArrow(run, MANIFEST), "graphs")


def _query_blocks(queries: DataFrame, blocks: int, folder: str, scratch: Scratch) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = _arrays(batches, 2)
        if not every:
            return
        file = new_file(folder, "queries", ".npy")
        system, path = locate(file)
        with system.open_output_stream(path, compression=None) as f:
            np.lib.format.write_array(f, np.array([len(every)]), allow_pickle=False)
            for arrays in every.values():
                for a in arrays:
                    np.lib.format.write_array(f, np.ascontiguousarray(a), allow_pickle=False)
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([file]), pa.array([sum(len(a[0]) for a in every.values())], pa.int64())], names=["part", "file", "rows"])

    return scratch.write(queries.repartition(blocks).mapInArrow(run, MANIFEST), "queries")


def _load(file: str, kind: str) -> list:
    system, path = locate(file)
    with system.open_input_file(path) as f:
        n = int(np.lib.format.read_array(f)[0])
        return [Graph.read(f) if kind == "graph" else [np.lib.format.read_array(f) for _ in range(3)] for _ in range(n)]


FOUND = "query_id bigint, query_key bigint, vec_id bigint, score double"
FOUND_ARROW = pa.schema([("query_id", pa.int64()), ("query_key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def nearest(table: DataFrame, queries: DataFrame, scratch: Scratch, top: int = TOP, ef: int = EF, vec_id: str = "vec_id",
            embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each distinct row of ``queries`` the
    ``top`` rows of ``table`` found with the largest inner product, nearest
    first, ties to the smaller id; rows of the query's own id are left out.

    Both frames have ``vec_id`` and ``embedding``. Rows whose id is null or whose
    vector is null, zero or holds null or non-finite components take no part;
    only vectors of one length are compared. Repeated rows of the table count
    each. Other columns are ignored; no candidates, no rows.
    """
    spark = table.sparkSession

    def plain(rows: DataFrame) -> DataFrame:
        return rows.where(usable(F.col(embedding)) & F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("vector"))

    rows = plain(table)
    queries = scratch.write(plain(queries).distinct().select("id", F.xxhash64("vector").alias("key"), "vector"), "distinct")
    n, n_queries = rows.count(), queries.count()
    if not n or not n_queries:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    size = shard_rows(n, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shards, blocks = math.ceil(n / size), math.ceil(n_queries / QUERIES_A_BLOCK)
    folder = new_folder(spark, f"{scratch.name}-index")
    graphs = index(rows, shards, folder, scratch)
    asked = _query_blocks(queries, blocks, folder, scratch)
    number = F.row_number().over(Window.orderBy("file")) - 1  # a row a file
    asked = asked.select(number.alias("block"), F.col("file").alias("queries"))
    jobs = graphs.select(F.col("file").alias("graph"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")).join(asked, "block")
    jobs = jobs.select("graph", "queries").repartition(min(shards * blocks, 100_000), "graph", "queries").sortWithinPartitions("graph")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded, known = None, []
        for batch in batches:
            for graph, block in zip(*(c.to_pylist() for c in batch.columns)):
                if graph != loaded:
                    loaded, known = graph, _load(graph, "graph")
                for ids, keys, vectors in _load(block, "queries"):
                    for g in known:
                        if g.vectors.shape[1] != vectors.shape[1]:
                            continue
                        for a in range(0, len(ids), BATCH):
                            s = slice(a, a + BATCH)
                            found = list(g.nearest(ids[s], vectors[s].astype(np.float64), top, ef))
                            sizes = [len(f) for f, _ in found]
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.repeat(ids[s], sizes)), pa.array(np.repeat(keys[s], sizes)),
                                 pa.array(np.concatenate([f for f, _ in found])), pa.array(np.concatenate([p for _, p in found]))], schema=FOUND_ARROW)

    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    merged = jobs.mapInArrow(run, FOUND).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return merged.select("query_id", "rank", "vec_id", "score")
