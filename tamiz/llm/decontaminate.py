"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

An item is contained in a document when at least ``percent`` % of the item's distinct k-word shingles are among the document's.
Items are partitioned by the size of their set, with upper bounds at powers of two. In the partition with upper bound u an item's
sketch is its m = floor((100 - percent) % of u) + 1 smallest hashes (the bottom-m MinHash; the whole set, if smaller). An
item that is contained lacks at most m - 1 of its shingles, so at least one of its sketch is in the document, however long
the document is: the search has no false negatives. Documents that meet a sketch are compared exactly, on whole sets.

The items are sent to the executors in slices of at most ``SLICE`` shingles, each a bounded broadcast and one narrow scan of
the documents; nothing is shuffled. More items mean more slices, not larger ones.

* an item or text that is null, empty or without words has an empty set and is never contained and contains nothing; with
  fewer than k words the whole sequence is the only shingle;
* repeated rows give repeated results; items with equal text are reported each; a null id is reported as null;
* an empty table on either side gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamiz.session import written_once

from .common import lean, numbered_texts, same_row, text_mark
from .words import words_of

#: Shingles of items that are broadcast at once: 16 bytes each.
SLICE = 1 << 20
_FIELD = 1 << 22


def sketch_size(n: int, percent: int) -> int:
    """Hashes in the sketch of an item of n shingles: by the upper bound of its size partition."""
    upper = 1 << (n - 1).bit_length() if n else 0
    return min(n, upper * (100 - percent) // 100 + 1)


def _item_sets(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, words in words_of(batch.column(1)):
            sets = [np.unique(x).view(np.int64) for x in words.shingle_lists(k)]
            arrays = [batch.column(0).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(sets, pa.list_(pa.int64()))], names=["item_id", "n", "shingles"])


class Index:
    """A slice of items: their sketches, and which items hold a shingle."""

    def __init__(self, ids: list, sets: list[np.ndarray], percent: int):
        self.ids, self.percent = ids, percent
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        sketches = [np.sort(s)[: sketch_size(len(s), percent)] for s in sets]
        self.sketch = np.unique(np.concatenate(sketches))
        self.field = np.zeros(_FIELD, dtype=bool)
        self.field[self.sketch & np.uint64(_FIELD - 1)] = True
        flat, item = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        by = np.argsort(flat, kind="stable")
        self.shingles, first = np.unique(flat[by], return_index=True)
        self.items, self.bounds = item[by], np.append(first, len(flat))

    def meets(self, shingles: np.ndarray) -> np.ndarray:
        """Positions of shingles that are in a sketch."""
        at = np.flatnonzero(self.field[shingles & np.uint64(_FIELD - 1)])
        near = np.minimum(np.searchsorted(self.sketch, shingles[at]), len(self.sketch) - 1)
        return at[self.sketch[near] == shingles[at]]

    def contained(self, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(items contained in a document's set, shared shingles of each)."""
        at = np.minimum(np.searchsorted(self.shingles, distinct), len(self.shingles) - 1)
        at = at[self.shingles[at] == distinct]
        n = self.bounds[at + 1] - self.bounds[at]
        held = self.items[np.repeat(self.bounds[at + 1] - np.cumsum(n), n) + np.arange(n.sum())]
        items, shared = np.unique(held, return_counts=True)
        enough = 100 * shared >= self.percent * self.sizes[items]
        return items[enough], shared[enough]


def _searched(batches: Iterable[pa.RecordBatch], index: Broadcast, k: int) -> Iterator[pa.RecordBatch]:
    items: Index = index.value
    names = ["doc_id", "mark", "item_id", "shared", "item_shingles"]
    for batch in batches:
        for i, _, words in words_of(batch.column(1)):
            rows: list[int] = []
            found: list[np.ndarray] = []
            shared: list[np.ndarray] = []
            lists = list(words.shingle_lists(k))
            ends = np.cumsum([len(x) for x in lists])
            hit = items.meets(np.concatenate(lists)) if len(lists) else ends
            for r in np.unique(np.searchsorted(ends, hit, side="right")).tolist():
                own, n = items.contained(np.unique(lists[r]))
                rows.extend([i + r] * len(own))
                found.append(own)
                shared.append(n)
            if rows:
                which = np.concatenate(found)
                arrays = [
                    batch.column(0).take(pa.array(rows)),
                    batch.column(2).take(pa.array(rows)),
                    pa.array([items.ids[x] for x in which], pa.int64()),
                    pa.array(np.concatenate(shared), pa.int64()),
                    pa.array(items.sizes[which], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=names)


def contaminated(docs: DataFrame, benchmark: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, item_id, shared, item_shingles and containment for each document and item that it contains."""
    return _search(docs, benchmark, k, percent).drop("mark")


def _search(docs: DataFrame, benchmark: DataFrame, k: int, percent: int) -> DataFrame:
    """The same with the mark of the document's text."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    sets = items.mapInArrow(lambda b: _item_sets(b, k), "item_id long, n long, shingles array<long>").where("n > 0")
    # Slices of at most SLICE shingles: a running sum within buckets of items by hash, each bucket cut on its own.
    salted = sets.withColumn("bucket", F.pmod(F.xxhash64("item_id", F.size("shingles"), F.element_at("shingles", 1)), F.lit(64)))
    running = F.sum("n").over(Window.partitionBy("bucket").orderBy("item_id", F.element_at("shingles", 1)).rowsBetween(Window.unboundedPreceding, -1))
    sets = written_once(salted.withColumn("cut", F.floor(F.coalesce(running, F.lit(0)) / (SLICE // 64))), "items")
    cuts = [r[0] for r in sets.select("cut").distinct().orderBy("cut").collect()]  # one row per slice

    schema = "doc_id long, mark long, item_id long, shared long, item_shingles long"
    texts = numbered_texts(docs).withColumn("mark", text_mark())
    passes = []
    for cut in cuts:
        own = sets.where(F.col("cut") == cut).select("item_id", "shingles").toArrow()
        lists = [np.array(x, dtype=np.int64).view(np.uint64) for x in own.column("shingles").to_pylist()]
        index = spark.sparkContext.broadcast(Index(own.column("item_id").to_pylist(), lists, percent))
        passes.append(texts.mapInArrow(lean(lambda b, index=index: _searched(b, index, k)), schema))
    if not passes:
        return spark.createDataFrame([], schema + ", containment double")
    found = reduce(DataFrame.unionByName, passes)
    return found.withColumn("containment", F.col("shared") / F.col("item_shingles"))


def clean(docs: DataFrame, benchmark: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents that contain no item, each judged by its own text, whatever its doc_id."""
    found = _search(docs, benchmark, k, percent).select(F.col("doc_id").alias("_told_id"), F.col("mark").alias("_told_mark"))
    found = written_once(found.distinct(), "contaminated")
    return docs.join(found, same_row(docs, "_told_id", "_told_mark"), "left_anti").select(docs.columns)
