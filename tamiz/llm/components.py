"""Connected components of a graph given as edges, by alternating large-star and small-star rounds.

Edges are first connected in parts of bounded size, each by one task, which spares most rounds. Every round replaces the edges by at
most as many that span the same components and lie closer to stars around the smallest node. All state is a table in the shared
folder, so lineage stays short and a lost executor costs a task, not the run.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.session import written_once

from .common import lean

#: Edges that a task connects at once.
PART = 1 << 20


def stars(first: np.ndarray, second: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among n rows as stars: (row, the smallest row that it is connected to) of all rows but those."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[first], label[second])
        np.minimum.at(label, first, low)
        np.minimum.at(label, second, low)
        label = label[label]
        if (label == before).all():
            break
    own = np.flatnonzero(label != np.arange(n))
    return own, label[own]


def _connected(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges that connect what those of a task do, PART of them at a time: from each node to the smallest that it is connected to."""

    def out(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = np.concatenate([np.asarray(b.column(c)) for c in (0, 1) for b in held])
        nodes, at = np.unique(ends, return_inverse=True)
        own, least = stars(*np.split(at, 2), len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes[x]) for x in (own, least)], names=["u", "v"])

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= PART:
            yield out(held)
            held, n = [], 0
    if n:
        yield out(held)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hangs its larger neighbours on the smallest node it knows."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hangs itself and its smaller neighbours on the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that can be reached. Nodes without an edge to another node are not listed."""
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    pairs = written_once(pairs, "edges")
    pairs = written_once(pairs.coalesce(pairs.count() // PART + 1).mapInArrow(lean(_connected), "u long, v long"), "edges")
    seen = _print(pairs)
    while True:
        pairs = written_once(_small_star(_large_star(pairs)), "edges")
        now = _print(pairs)
        if now == seen:
            break
        seen = now
    members = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return written_once(members.unionByName(roots), "components")
