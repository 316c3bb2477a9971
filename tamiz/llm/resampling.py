"""Importance resampling toward a target distribution: documents weighed by hashed word runs, drawn by a distributed radix sort.

Runs of words are counted in ``buckets`` places by their CRC, for all documents and for all target texts. A bucket's gain is
the logarithm of how much more frequent it is in the target, in thousandths, and a document's weight the mean gain of its runs.
Each task reads the gains as one array. A document's score is its weight and Gumbel noise that its doc_id fixes; the highest
scores are a sample without replacement by weight.

Ranks come from a least-significant-digit radix sort. The composite key (score from the highest, doc_id, number of runs) is cut
into digits; each pass counts the rows of every (digit, block), turns the counts into global offsets, and gives each row its
place: the offset plus its number within its digit and block. Blocks are as many as the session's shuffle partitions, so that
no key, not even one that all rows share, gathers more than a block's rows; offsets are running sums over blocks for each digit
and over the digits, whose number is fixed.

* a null or empty text has no runs and weight 0; a null doc_id counts as empty in the noise and goes before others in ties;
* rows with equal doc_id and score are ranked by their number of runs; wholly equal rows may change places;
* documents below ``least_words`` are not drawn, have no rank, and stay in the result; an empty table gives an empty result;
* with an empty target only the documents' own counts matter; extra columns are ignored;
* a text is read whole; it has to fit a worker's memory, with about 30 bytes per byte of text.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator, Sequence
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.session import written_once

from .common import numbered_texts
from .words import LETTERS, pieces

#: Bits of a digit of the radix sort.
DIGIT = 13
#: Runs up to so many bytes are hashed side by side.
SHORT = 64

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_crc = _crc_table()


def crc32_of_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC of the bytes of each span, a byte of all spans at a time; of long ones one by one."""
    lengths = ends - starts
    order = np.argsort(np.minimum(lengths, SHORT + 1).astype(np.uint8), kind="stable")
    sizes, at = lengths[order], starts[order]
    state = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    for k in range(int(min(sizes[-1], SHORT)) if len(sizes) else 0):
        left = int(np.searchsorted(np.minimum(sizes, SHORT + 1), k, side="right"))
        now = state[left:]
        state[left:] = _crc[(now ^ data[at[left:] + k]) & 0xFF] ^ (now >> np.uint32(8))
    out = np.empty(len(order), dtype=np.uint32)
    out[order] = ~state
    for i in np.flatnonzero(lengths > SHORT):
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes())
    return out


def _joined(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of some texts in lower case with one byte between two: bytes, starts, ends, and the first word of each text."""
    kind = LETTERS[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    begins = kind.copy()
    begins[1:] &= ~kind[:-1] | edge[1:-1]
    stops = kind.copy()
    stops[:-1] &= ~kind[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    bounds = np.searchsorted(starts, offsets)
    upto = np.cumsum(ends - starts + 1)
    first = upto - (ends - starts + 1)
    flat = np.full(int(upto[-1]) if len(upto) else 0, 0x20, dtype=np.uint8)
    filled = np.ones(len(flat), dtype=bool)
    filled[upto - 1] = False
    flat[filled] = _lower[data[kind]]
    return flat, first, upto - 1, bounds


def _buckets(column: pa.Array, runs: int, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, buckets of all runs, runs of each text, words of each text) of pieces of a batch."""
    for i, j, data, offsets in pieces(column):
        flat, starts, ends, bounds = _joined(data, offsets)
        owner = np.repeat(np.arange(j - i), np.diff(bounds))
        places, owners = [], []
        for n in range(1, runs + 1):
            whole = owner[: max(0, len(owner) - n + 1)] == owner[n - 1 :]
            own = np.flatnonzero(whole)
            places.append(crc32_of_spans(flat, starts[own], ends[own + n - 1]) % np.uint32(buckets))
            owners.append(owner[own])
        place, of = np.concatenate(places), np.concatenate(owners)
        if runs > 1:
            order = np.argsort(of, kind="stable")
            place, of = place[order], of[order]
        yield i, j, place.astype(np.int64), np.bincount(of, minlength=j - i), np.diff(bounds)


def _counted(batches: Iterable[pa.RecordBatch], runs: int, buckets: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(buckets, dtype=np.int64)
    for batch in batches:
        for _, _, place, _, _ in _buckets(batch.column(0), runs, buckets):
            counts += np.bincount(place, minlength=buckets)
    own = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(counts[own], pa.int64())], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, runs: int, buckets: int) -> np.ndarray:
    """How many runs of all texts fall into each bucket: a task sums its own, ``buckets`` numbers come to the driver."""
    partial_counts = texts.select("text").mapInArrow(partial(_counted, runs=runs, buckets=buckets), "bucket long, n long")
    counts = np.zeros(buckets, dtype=np.int64)
    for bucket, n in partial_counts.groupBy("bucket").agg(F.sum("n")).collect():
        counts[bucket] = n
    return counts


def gains_of(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket, from the counts in the documents and in the target."""
    smooth = len(own)
    docs, wanted = float(own.sum() + smooth), float(target.sum() + smooth)
    ratios = ((float(t + 1) * docs) / (float(s + 1) * wanted) for s, t in zip(own.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


_WEIGHED = "doc_id long, n_words long, n_features long, weight long"


def _weighed(batches: Iterable[pa.RecordBatch], gains: np.ndarray, runs: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, place, n, words in _buckets(batch.column("text"), runs, len(gains)):
            upto = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(gains[place])])
            last = np.cumsum(n)
            weight = (upto[last] - upto[last - n]) // np.maximum(n, 1)
            columns = [batch.column("doc_id").slice(i, j - i), pa.array(words, pa.int64()), pa.array(n, pa.int64()), pa.array(weight, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a hash of seed and doc_id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((bits + F.lit(0.5)) / F.lit(4294967296.0))))


def _digits(fields: Sequence[tuple[Column, int]]) -> list[Column]:
    """Digits of the number whose fields (value, bits) are given from the lowest on; the lowest digit first."""
    total = sum(bits for _, bits in fields)
    out = []
    for low in range(0, max(total, 1), DIGIT):
        parts, at = [F.lit(0).cast("long")], 0
        for value, bits in fields:
            if at < low + DIGIT and low < at + bits:
                moved = F.shiftright(value, low - at) if low >= at else F.shiftleft(value.bitwiseAND((1 << (low + DIGIT - at)) - 1), at - low)
                parts.append(moved.bitwiseAND((1 << DIGIT) - 1))
            at += bits
        out.append(reduce(lambda a, b: a.bitwiseOR(b), parts))
    return out


def radix_sorted(rows: DataFrame, digits: Sequence[Column], n: int) -> DataFrame:
    """``rows`` with ``place``, from 0 on, in the order of a key given by its digits, the lowest first. ``n``: how many rows.

    Each pass is a stable counting sort; a pass shuffles the rows once and is written to the shared folder.
    """
    blocks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = max(1, math.ceil(n / blocks))
    here, zero = Window.partitionBy("block", "digit"), F.lit(0).cast("long")
    now = rows.withColumns({"block": F.spark_partition_id().cast("long"), "place": F.monotonically_increasing_id()})
    for k, digit in enumerate(digits):
        now = written_once(now.withColumn("digit", digit), f"digit-{k}")
        counts = written_once(now.groupBy("digit", "block").agg(F.count(F.lit(1)).alias("held")), f"counts-{k}")
        # One row per value of a digit at most.
        lower = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        totals = counts.groupBy("digit").agg(F.sum("held").alias("total"))
        totals = totals.select("digit", F.coalesce(F.sum("total").over(lower), zero).alias("under"))
        before = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.select("digit", "block", F.coalesce(F.sum("held").over(before), zero).alias("ahead"))
        starts = starts.join(F.broadcast(totals), "digit").select("digit", "block", (F.col("under") + F.col("ahead")).alias("start"))
        numbered = now.withColumn("own", F.row_number().over(here.orderBy("place")).cast("long") - 1)
        place = F.col("start") + F.col("own")
        now = numbered.join(starts, ["block", "digit"]).withColumn("place", place)
        now = now.withColumn("block", F.floor(F.col("place") / width)).select(*rows.columns, "block", "place")
    return now.drop("block")


def _key(rows: DataFrame) -> tuple[int, list[Column]]:
    """The number of rows, and the digits of (score from the highest, doc_id with nulls first, n_features)."""
    high, low = F.shiftright("doc_id", 32), F.col("doc_id").bitwiseAND(0xFFFFFFFF)
    found = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.col("doc_id").isNotNull().cast("int")).alias("known"),
        *(f(c).alias(f"{name}_{x}") for x, f in (("min", F.min), ("max", F.max)) for name, c in
          (("score", F.col("score")), ("high", high), ("low", low), ("n", F.col("n_features")))),
    ).first()
    if not found["n"]:
        return 0, []
    known = F.col("doc_id").isNotNull()
    spread = (found["high_max"] or 0) - (found["high_min"] or 0)
    # Below more than one upper half the lower half needs all its bits.
    least, most = (0, 0xFFFFFFFF) if spread else (found["low_min"] or 0, found["low_max"] or 0)
    nothing = F.lit(0).cast("long")
    fields = [
        (F.col("n_features") - found["n_min"], (found["n_max"] - found["n_min"]).bit_length()),
        (F.when(known, low - least).otherwise(nothing), (most - least).bit_length()),
        (F.when(known, high - (found["high_min"] or 0)).otherwise(nothing), spread.bit_length()),
        (known.cast("long"), 1),
        (F.lit(found["score_max"]).cast("long") - F.col("score"), (found["score_max"] - found["score_min"]).bit_length()),
    ]
    return found["n"], _digits([f for f in fields if f[1]])


def resample(
    docs: DataFrame, target: DataFrame, *, runs: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024
) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null unless drawn) of every document of ``docs``.

    ``runs``: features are runs of 1 to so many words; ``percent`` of the documents with ``least_words`` words are drawn.
    """
    if runs < 1 or buckets < 1 or not 0 <= percent <= 100:
        raise ValueError("runs and buckets are at least 1, percent is 0 to 100")
    texts = numbered_texts(docs)
    own, wanted = (bucket_counts(x, runs, buckets) for x in (texts, target.select(F.col("text").cast("string").alias("text"))))
    weighed = texts.mapInArrow(partial(_weighed, gains=gains_of(own, wanted), runs=runs), _WEIGHED)
    scored = written_once(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scores")
    long_enough = F.col("n_words") >= least_words
    rows = scored.where(long_enough)
    n, digits = _key(rows)
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = scored.where(~long_enough).select(*columns, F.lit(None).cast("long").alias("rank"))
    if not n:
        return rest
    drawn = percent * n // 100
    rank = F.when(F.col("place") < drawn, F.col("place") + 1).alias("rank")
    return radix_sorted(rows.select(*columns), digits, n).select(*columns, rank).unionByName(rest)
