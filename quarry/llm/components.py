"""Connected components of a link table: alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; root is the smallest
    node reachable. Self links and repeats are allowed, null ends are not.

    Every round first hangs each node's larger neighbours, then its smaller
    ones, on the smallest neighbour; the rounds grow with the logarithm of a
    component's size. Minima are partial aggregates and are written before
    they are joined, so that both sides of a join are plain scans and Spark
    can split a hub's partition. No neighbour list is ever built.
    """
    hi, lo = F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    links = scratch.write(edges.where("a <> b").select(hi, lo).distinct(), "links")
    state = _state(links)
    while state[0]:
        both = links.union(links.select("lo", "hi")).toDF("node", "other")
        least = scratch.write(both.groupBy("node").agg(F.min("other").alias("m")), "least")
        least_ = least.select(F.col("node").alias("lo"), F.least("node", "m").alias("m"))
        large = links.join(least_, "lo").select("hi", F.col("m").alias("lo")).distinct()
        large = scratch.write(large, "large")
        scratch.drop(least)
        first = scratch.write(large.groupBy("hi").agg(F.min("lo").alias("m")), "first")
        moved = large.join(first, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        small = scratch.write(moved.union(first.select("hi", "m")).distinct(), "small")
        scratch.drop(large, first, links)
        links, before = small, state
        state = _state(links)
        if state == before:
            break
    roots = links.select("lo").distinct().select(F.col("lo").alias("node"), F.col("lo").alias("root"))
    out = scratch.write(links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots), "roots")
    scratch.drop(links)
    return out


def _state(links: DataFrame) -> tuple:
    """Equal before and after a round only if the links are."""
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo")), F.bit_xor(F.xxhash64("lo", "hi"))).first()
    return row[0], row[1], row[2]


def joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``label`` (each position's smallest linked position, itself at first)
    after linking positions i and j; for the links inside one task."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            break
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label
