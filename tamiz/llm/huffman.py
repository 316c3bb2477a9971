"""Canonical length-limited Huffman files of token ids.

The counts of all ids over all documents give one code (package-merge, so that no code word exceeds ``LIMIT`` bits; canonical, so
that the lengths alone define it). A file set is two Parquet folders:

* ``code``: id, bits - one row per id that occurs;
* ``blocks``: part, block, tokens_before (in the same part), n_tokens, payload (the bit string, first bit highest, two spare bytes),
  checkpoints (bit offset of every ``EVERY``-th token), doc_ids and doc_tokens of its documents in order.

Blocks hold whole documents and decode on their own. Decoding looks up 16 bits at a time and walks all checkpoints of a batch in
step, so the loop runs ``EVERY`` times however many tokens there are.

* documents are in ascending doc_id order over (part, block); a block is numbered by its first document's place in the part;
  ties in doc_id are ordered by the text's hash;
* a null or empty text is the end id alone; repeated rows are stored as often; an empty table gives empty files;
* a text longer than ``BLOCK`` ids is a block of its own; other columns are not stored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamiz.session import scratch, written_once

from .tokens import encoder

LIMIT = 16
BLOCK = 1 << 15
EVERY = 256
#: Tokens decoded at once.
_BATCH = 1 << 21


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits of each symbol's code word in an optimal prefix code of at most ``limit`` bits; 0 where the count is 0.

    Package-merge: a symbol's length is the number of levels at which it is among the chosen items. The chosen symbols of
    a level are always the rarest ones, so counting them is enough. Ties go to the smaller symbol.
    """
    present = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    n = len(present)
    if n == 0:
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit into {limit} bits")
    order = present[np.argsort(counts[present], kind="stable")]
    leaves = counts[order].astype(np.int64)
    if n == 1:
        lengths[order] = 1
        return lengths
    levels, row = [], leaves
    is_leaf = np.ones(n, dtype=bool)
    for _ in range(limit - 1):
        levels.append(is_leaf)
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        by = np.argsort(both, kind="stable")
        row, is_leaf = both[by], by < n
    levels.append(is_leaf)
    chosen = 2 * n - 2
    for is_leaf in reversed(levels):
        mine = int(is_leaf[:chosen].sum())
        lengths[order[:mine]] += 1
        chosen = 2 * (chosen - mine)
    return lengths


def code_words(lengths: np.ndarray) -> np.ndarray:
    """Canonical code words: ascending by (length, symbol)."""
    words = np.zeros(len(lengths), dtype=np.uint32)
    code = last = 0
    for symbol in np.lexsort((np.arange(len(lengths)), lengths)):
        bits = int(lengths[symbol])
        if bits:
            code <<= bits - last
            words[symbol] = code
            code, last = code + 1, bits
    return words


def decode_table(lengths: np.ndarray) -> np.ndarray:
    """For every 16 bits the symbol that they begin with, times 32, plus its length; 0 where no word begins so."""
    words = code_words(lengths)
    table = np.zeros(1 << LIMIT, dtype=np.uint32)
    for symbol in np.flatnonzero(lengths).tolist():
        bits = int(lengths[symbol])
        first = int(words[symbol]) << (LIMIT - bits)
        table[first : first + (1 << (LIMIT - bits))] = symbol << 5 | bits
    return table


def encode(ids: np.ndarray, lengths: np.ndarray, words: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bit string of some ids, and the bit offset of every EVERY-th of them."""
    bits = lengths[ids].astype(np.int64)
    at = np.cumsum(bits) - bits
    total = int(at[-1] + bits[-1]) if len(ids) else 0
    # Each word lies in two neighbouring units of 16 bits at most; the parts of a unit do not overlap, so they add up.
    shifted = words[ids].astype(np.int64) << (32 - bits - (at & 15))
    unit = at >> 4
    n = (total + 15) // 16 + 1
    units = np.zeros(n, dtype=np.int64)
    if len(ids):
        starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
        units[unit[starts]] += np.add.reduceat(shifted >> 16, starts)
        units[unit[starts] + 1] += np.add.reduceat(shifted & 0xFFFF, starts)
    return units.astype(">u2").tobytes(), at[::EVERY].astype(np.int32)


def decode(payloads: list[bytes], checkpoints: list[np.ndarray], tokens: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The ids of some blocks, one after the other."""
    raw = np.frombuffer(b"".join(payloads) + b"\0\0\0\0", dtype=np.uint8).astype(np.uint32)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    sizes = np.array([len(p) for p in payloads], dtype=np.int64)
    firsts = (np.cumsum(sizes) - sizes) * 8
    lanes = np.array([len(c) for c in checkpoints])
    at = np.concatenate(checkpoints).astype(np.int64) + np.repeat(firsts, lanes)
    # Tokens of each lane: EVERY, but the rest in a block's last one.
    count = np.full(len(at), EVERY, dtype=np.int64)
    count[np.cumsum(lanes) - 1] = tokens - (lanes - 1) * EVERY
    out = np.zeros((EVERY, len(at)), dtype=np.uint32)
    last = len(window) - 1
    for step in range(EVERY):
        hit = table[window[np.minimum(at >> 3, last)] >> (16 - (at & 7)).astype(np.uint32) & 0xFFFF]
        out[step] = hit >> 5
        at += hit & 31
    return out.T[np.arange(EVERY) < count[:, None]]


_IDS = "part int, place long, before long, doc_id long, ids binary"


def _tokenised(batches: Iterable[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Each document's ids, its place in its part and the ids before it there."""
    enc = encoder(path)
    end = np.array([end_id], dtype=enc.dtype)
    part = TaskContext.get().partitionId()
    place = before = 0
    for batch in batches:
        ids = [np.concatenate([x, end]).astype(enc.dtype) for x in enc.column(batch.column(1))]
        sizes = np.array([len(x) for x in ids], dtype=np.int64)
        arrays = [
            pa.array(np.full(len(ids), part), pa.int32()),
            pa.array(np.arange(place, place + len(ids)), pa.int64()),
            pa.array(before + np.cumsum(sizes) - sizes, pa.int64()),
            batch.column(0),
            pa.array([x.tobytes() for x in ids], pa.binary()),
        ]
        place, before = place + len(ids), before + int(sizes.sum())
        yield pa.RecordBatch.from_arrays(arrays, names=["part", "place", "before", "doc_id", "ids"])


def _counted(batches: Iterable[pa.RecordBatch], size: int, dtype: str) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(size, dtype=np.int64)
    for batch in batches:
        counts += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=dtype), minlength=size)
    found = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(counts[found], pa.int64())], names=["id", "n"])


_BLOCKS = (
    "part int, block long, tokens_before long, n_tokens long, payload binary, checkpoints array<int>,"
    " doc_ids array<long>, doc_tokens array<long>"
)
_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int64()),
        ("tokens_before", pa.int64()),
        ("n_tokens", pa.int64()),
        ("payload", pa.binary()),
        ("checkpoints", pa.list_(pa.int32())),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_tokens", pa.list_(pa.int64())),
    ]
)


def _blocks(batches: Iterable[pa.RecordBatch], lengths: np.ndarray, dtype: str) -> Iterator[pa.RecordBatch]:
    """Blocks of documents that follow each other in a part. A block is named by the place of its first document."""
    words = code_words(lengths)
    first: tuple[int, int, int] = (0, 0, 0)
    follows = None
    doc_ids: list = []
    lists: list[np.ndarray] = []
    held = 0

    def flush() -> pa.RecordBatch:
        nonlocal held
        payload, checkpoints = encode(np.concatenate(lists), lengths, words)
        row = [*first, held, payload, checkpoints, list(doc_ids), [len(x) for x in lists]]
        held = 0
        doc_ids.clear()
        lists.clear()
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ARROW, strict=True)], schema=_ARROW)

    for batch in batches:
        for part, place, before, doc_id, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if lists and (part, place) != follows:
                yield flush()
            if not lists:
                first = (part, place, before)
            doc_ids.append(doc_id)
            lists.append(np.frombuffer(raw, dtype=dtype))
            follows = (part, place + 1)
            held += len(lists[-1])
            if held >= BLOCK:
                yield flush()
    if lists:
        yield flush()


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int) -> None:
    """Writes the ids of all documents, each with the end id, as a file set below ``path``.

    Texts are encoded once: the ids go to the shared folder, in order, and both the counts and the blocks are made from there.
    """
    size = encoder(vocabulary).size
    dtype = "<u4" if size > 1 << 16 else "<u2"
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumns({"tie": F.xxhash64("text"), "nth": F.monotonically_increasing_id()})
        .repartitionByRange("doc_id", "tie", "nth")  # equal rows, too, are dealt over several tasks
        .sortWithinPartitions("doc_id", "tie", "nth")
        .select("doc_id", "text")
    )
    ids = written_once(ordered.mapInArrow(lambda b: _tokenised(b, vocabulary, end_id), _IDS), "ids")
    # One row per id of the vocabulary at most.
    counts = np.zeros(size, dtype=np.int64)
    found = ids.select("ids").mapInArrow(lambda b: _counted(b, size, dtype), "id int, n long").groupBy("id").agg(F.sum("n"))
    for row in found.collect():
        counts[row[0]] = row[1]
    lengths = code_lengths(counts)
    session = docs.sparkSession
    code = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    session.createDataFrame(code, "id int, bits int").coalesce(1).write.parquet(f"{path}/code")
    # A split of the ids table holds rows of a part in order; where parts or splits end, a new block begins.
    blocks = ids.mapInArrow(lambda b: _blocks(b, lengths, dtype), _BLOCKS)
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")


def _decoded(batches: Iterable[pa.RecordBatch], lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
    table = decode_table(lengths)
    names = ["part", "doc_id", "start_in_part", "n_tokens", "ids"]
    for whole in batches:
        tokens = np.asarray(whole.column("n_tokens"))
        cut = np.flatnonzero(np.diff((np.cumsum(tokens) - tokens) // _BATCH)) + 1
        for a, b in zip([0, *cut], [*cut, len(tokens)], strict=True):
            batch = whole.slice(a, b - a)
            if not len(batch):
                continue
            checkpoints = [np.array(c, dtype=np.int32) for c in batch.column("checkpoints").to_pylist()]
            ids = decode(batch.column("payload").to_pylist(), checkpoints, tokens[a:b], table).astype("<u4")
            per_block = batch.column("doc_tokens").to_pylist()
            sizes = np.array([n for x in per_block for n in x], dtype=np.int64)
            upto = np.cumsum(sizes)
            docs = np.array([len(x) for x in per_block])
            in_block = (upto - sizes) - np.repeat(np.cumsum(tokens[a:b]) - tokens[a:b], docs)
            rows = [
                pa.array(np.repeat(np.asarray(batch.column("part")), docs), pa.int32()),
                pa.array([d for x in batch.column("doc_ids").to_pylist() for d in x], pa.int64()),
                pa.array(np.repeat(np.asarray(batch.column("tokens_before")), docs) + in_block, pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array([ids[e - n : e].tobytes() for e, n in zip(upto.tolist(), sizes.tolist(), strict=True)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(rows, names=names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian unsigned 32-bit) of each document."""
    code = spark.read.parquet(f"{path}/code").collect()  # one row per id of the vocabulary at most
    lengths = np.zeros(max((r["id"] for r in code), default=0) + 1, dtype=np.uint8)
    for r in code:
        lengths[r["id"]] = r["bits"]
    blocks = spark.read.parquet(f"{path}/blocks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        blocks.groupBy("part")
        .agg(F.sum("n_tokens").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("first"))
    )
    schema = "part int, doc_id long, start_in_part long, n_tokens long, ids binary"
    docs = blocks.mapInArrow(lambda b: _decoded(b, lengths), schema)
    return docs.join(F.broadcast(parts), "part").select(  # a row per range partition of the writer
        "doc_id", (F.col("first") + F.col("start_in_part")).alias("start"), "n_tokens", "ids"
    )


def round_trip(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Writes the file set into the shared folder, reads it back, and gives doc_id, start, n_tokens, ids_crc32."""
    path = scratch(docs.sparkSession, "huffman")
    write(docs, path, vocabulary, end_id)
    return read(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
