"""Small helpers of the llm operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a written table that may be broadcast: some tens of MB.
BROADCAST_ROWS = 1 << 19


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, held: Column | None = None) -> DataFrame:
    """``df``, a written table of narrow rows, marked for broadcast if it is known to be small; else joined by a shuffle.

    ``held``: how many numbers a row holds, for rows with arrays; these are then what ``rows`` bounds.
    """
    n = df.count() if held is None else df.agg(F.sum(held)).first()[0] or 0
    return F.broadcast(df) if n <= rows else df


def numbered_texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, as the types the operators work on."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def text_mark(text: str = "text") -> Column:
    """64 bits of a text, null or not. With the doc_id it names a row: rows that share both are the same document read again."""
    column = F.col(text).cast("string")
    return F.xxhash64(column, column.isNull())


def same_row(docs: DataFrame, doc_id: str, mark: str) -> Column:
    """The condition that joins a row of ``docs`` to a told (doc_id, mark), nulls included; columns of other names than docs has."""
    return docs["doc_id"].cast("long").eqNullSafe(F.col(doc_id)) & (F.xxhash64(docs["text"].cast("string"), docs["text"].isNull()) == F.col(mark))


def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task; what they took goes back to the system at the end, for the worker is used again by the next."""
    yield from batches
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another system's allocator
        pass


def lean(work: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``work`` of mapInArrow, trimmed."""
    return lambda batches: trimmed(work(batches))


#: Rows and bytes of texts that are handed to a Python worker at once, at most, after ``small_batches``.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Has the session hand texts to Python workers in small batches: workers and the buffers beside the heap stay small.

    A smaller setting of the caller's stays.
    """
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key, None)
        if now is None or not now.strip().isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))
