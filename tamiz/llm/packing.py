"""Order-preserving packing of token sequences by dynamic programming.

Documents, in ascending doc_id order, are one stream of ids. It is cut into sequences of at most ``length`` ids. A sequence is
padded to ``length`` unless its size is a power of two. The cost of a cutting is its padding, plus a penalty for each cut that
does not fall on a document's end (smaller at a sentence's end), plus a small cost per sequence.

    best[j] = penalty[j] + per_sequence + min( length - x[j] + min over x[i] >= x[j] - length of (best[i] + x[i]),
                                               min over powers p < length with x[j] - p = x[i] of best[i] )

over the candidate cuts x. The inner minimum runs over a sliding window, so a monotone queue serves every candidate once.
The stream is range-partitioned by doc_id and optimised in blocks of bounded size, so any order of size of input and any single
source costs the same per id; the last sequence of a block is cut at single ids where that saves padding.

* a null or empty text is the end id alone; ties in doc_id are ordered by the text's hash; repeated rows are packed as often;
* a text longer than a block is a block of its own; an empty table gives no piece; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamiz.session import written_once

from .common import lean
from .tokens import encoder

#: Ids optimised at once, at least one document.
BLOCK = 1 << 20
#: A candidate cut at least every so many ids, even inside a sentence.
STRIDE = 128


class Costs(NamedTuple):
    """In padding ids: for a cut at a sentence's end, for any other cut inside a document, and for each sequence."""

    sentence: int = 4
    inside: int = 48
    sequence: int = 24


def cuts(x: np.ndarray, penalty: np.ndarray, length: int, per_sequence: int) -> list[int]:
    """The indices into the candidate cuts ``x`` (ascending from 0) of the cheapest cutting, both ends included.

    No gap between candidates may exceed ``length``. Ties go to the earliest start of the last sequence.
    """
    at, n = x.tolist(), len(x)
    price = penalty.tolist()
    exact: dict[int, list[int]] = {}
    power = 1
    while power < length:
        i = np.searchsorted(x, x - power)
        for j in np.flatnonzero((i < n) & (x[np.minimum(i, n - 1)] == x - power) & (x >= power)).tolist():
            exact.setdefault(j, []).append(int(i[j]))
        power *= 2
    full = length & (length - 1) == 0
    best, came = [0] * n, [0] * n
    window: deque[tuple[int, int]] = deque([(0, 0)])  # (best + x, index), ascending in both
    for j in range(1, n):
        here = at[j]
        while at[window[0][1]] < here - length:
            window.popleft()
        value, i = window[0]
        cost = value + length - here
        for k in exact.get(j, ()):
            if best[k] < cost:
                cost, i = best[k], k
        cost += per_sequence + price[j]
        best[j], came[j] = cost, i
        value = cost + here
        while window and window[-1][0] > value:
            window.pop()
        window.append((value, j))
    assert full or length > 0
    out, j = [n - 1], n - 1
    while j:
        j = came[j]
        out.append(j)
    return out[::-1]


def candidates(ends: np.ndarray, sentence: np.ndarray, length: int, costs: Costs) -> tuple[np.ndarray, np.ndarray]:
    """Candidate cuts of a block and their penalties: document ends, sentence ends, and places inside long sentences.

    ``ends``: where documents end, the last is the block's; ``sentence``: where sentences end. Within the last ``length``
    ids every place is a candidate, for the rest of a block has no further sequence to lend it ids.
    """
    total = int(ends[-1])
    natural = np.unique(np.concatenate([[0], sentence, ends]))
    gaps = np.diff(natural)
    fill = (gaps - 1) // STRIDE
    inner = np.repeat(natural[:-1], fill)
    inner = inner + STRIDE * (np.arange(len(inner)) - np.repeat(np.cumsum(fill) - fill, fill) + 1)
    x = np.unique(np.concatenate([natural, inner, np.arange(max(0, total - length), total + 1)]))
    penalty = np.full(len(x), costs.inside, dtype=np.int64)
    penalty[np.searchsorted(x, natural)] = costs.sentence
    penalty[np.searchsorted(x, ends)] = 0
    penalty[0] = 0
    return x, penalty


_PIECES = (
    "part int, place long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, offset long,"
    " sequence_tokens long"
)
_ARROW = pa.schema(
    [("part", pa.int32()), ("place", pa.int64())]
    + [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "offset", "sequence_tokens")]
)


def _pack_block(doc_ids: list, lists: list[np.ndarray], ends_sentence: np.ndarray, length: int, costs: Costs) -> Iterator[tuple]:
    ids = np.concatenate(lists)
    sizes = np.array([len(x) for x in lists])
    ends = np.cumsum(sizes)
    sentence = np.flatnonzero(ends_sentence[ids]) + 1
    x, penalty = candidates(ends, sentence, length, costs)
    at = [int(x[i]) for i in cuts(x, penalty, length, costs.sequence)]
    wide = ids.astype("<u4")
    doc = 0
    for place, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
        here = a
        while here < b:
            while ends[doc] <= here:
                doc += 1
            upto = min(b, int(ends[doc]))
            first = int(ends[doc] - sizes[doc])
            crc = zlib.crc32(wide[here:upto].tobytes())
            yield place, doc_ids[doc], here - first, upto - here, crc, int(sizes[doc]), here - a, b - a
            here = upto


def _packed(batches: Iterable[pa.RecordBatch], path: str, end_id: int, length: int, costs: Costs) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    ends_sentence = sentence_ends(path)
    part = TaskContext.get().partitionId()
    places = 0
    doc_ids: list = []
    lists: list[np.ndarray] = []
    held = 0

    def flush() -> pa.RecordBatch:
        nonlocal places, held
        rows = list(_pack_block(doc_ids, lists, ends_sentence, length, costs))
        columns = list(zip(*rows, strict=True))
        columns[0] = [places + p for p in columns[0]]
        places = columns[0][-1] + 1
        doc_ids.clear()
        lists.clear()
        held = 0
        arrays = [pa.array([part] * len(rows), pa.int32())] + [pa.array(c, pa.int64()) for c in columns]
        return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)

    end = np.array([end_id], dtype=enc.dtype)
    for batch in batches:
        for doc_id, ids in zip(batch.column(0).to_pylist(), enc.column(batch.column(1)), strict=True):
            doc_ids.append(doc_id)
            lists.append(np.concatenate([ids, end]))
            held += len(ids) + 1
            if held >= BLOCK:
                yield flush()
    if doc_ids:
        yield flush()


_ends_of: dict[str, np.ndarray] = {}


def sentence_ends(path: str) -> np.ndarray:
    """For each id of a vocabulary, whether its string ends a sentence or a line."""
    if path not in _ends_of:
        enc = encoder(path)
        _ends_of[path] = np.array([enc.string(i).rstrip(" ").endswith((".", "!", "?", "\n")) for i in range(enc.size)])
    return _ends_of[path]


def pack(docs: DataFrame, vocabulary: str, end_id: int, length: int = 2048, costs: Costs = Costs()) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens.

    ``vocabulary``: the file of the tokenizer, readable on every executor. ``sequence_id`` ascends with the documents.
    """
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumns({"tie": F.xxhash64("text"), "nth": F.monotonically_increasing_id()})
        .repartitionByRange("doc_id", "tie", "nth")  # equal rows, too, are dealt over several tasks
        .sortWithinPartitions("doc_id", "tie", "nth")
        .select("doc_id", "text")
    )
    pieces = written_once(ordered.mapInArrow(lean(lambda b: _packed(b, vocabulary, end_id, length, costs)), _PIECES), "pieces")
    # A row per range partition: few, and bounded by the number of tasks.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        pieces.groupBy("part")
        .agg((F.max("place") + 1).alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("first"))
    )
    return pieces.join(parts, "part").select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("first") + F.col("place")).alias("sequence_id"),
        "offset",
        "sequence_tokens",
    )
