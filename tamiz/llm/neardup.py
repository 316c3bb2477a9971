"""Near-duplicate documents by a multi-index Hamming join of b-bit MinHash signatures, confirmed on full shingle sets.

1. A document's set is its distinct k-word shingles. ``SYMBOLS`` MinHash values of ``16`` bits form its signature. Documents
   with equal sets are one class, represented by its smallest doc_id.
2. The signature is split into chunks. Two signatures that differ in at most ``distance`` symbols have, by the pigeonhole
   principle, a chunk that differs in at most ``distance // chunks`` = 1 symbol, so they share that chunk with one symbol left
   out; ``limits`` gives both numbers for a similarity. Each signature is filed under all chunks with each symbol left out; keys held by one class only, and keys
   with the same holders as another, are dropped by counts.
3. Holders of a key are compared by their signatures in blocks; the pairs within that distance are not listed: each block
   gives a spanning forest of them, and their components are the clusters that may hold links.
4. Within a cluster the full sets are intersected, again in blocks that give spanning forests of the confirmed links.

Every pair within the signature distance is compared. At a similarity of 0.85 the distance of 60 symbols is binomial with mean
9 and deviation 2.8, so a link is missed with a probability of about 2e-6, less for closer ones; at 0.8 with mean 12 and 3.1. Blocks are bounded in size: a
key or cluster with many holders is spread over pairs of blocks, none is capped, and no pair list exists anywhere.

* a null or empty text, or one without words, has an empty set and is linked with nothing, not even with another such text;
* rows are judged by their texts: those with equal doc_id and different texts are different nodes, repeated rows fall into one
  class, and rows without doc_id are linked like others;
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import partial
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamiz.session import written_once

from .common import bounded_broadcast, lean, numbered_texts, same_row, text_mark
from .components import components, stars
from .words import mix, words_of

SYMBOLS = 60
#: Probability of missing a pair at the least similarity.
MISS = 2.5e-6


def limits(percent: int) -> tuple[int, int]:
    """(chunks, distance): the least distance that misses a pair of that similarity with MISS at most, and chunks for it."""
    p, tail, distance = 1 - percent / 100, 0.0, SYMBOLS
    while distance and (more := tail + comb(SYMBOLS, distance) * p**distance * (1 - p) ** (SYMBOLS - distance)) <= MISS:
        tail, distance = more, distance - 1
    chunks = next((c for c in range(1, SYMBOLS // 2 + 1) if SYMBOLS % c == 0 and distance < 2 * c), None)
    if chunks is None:
        raise ValueError(f"{SYMBOLS} symbols are too few for a similarity of {percent} %")
    return chunks, distance


CHUNKS, DISTANCE = limits(85)
#: Holders of a key, and shingles of a cluster, that one side of a block pair may have.
HOLDERS, SHINGLES = 2048, 1 << 20

_seeds = mix(np.arange(1, 2 * SYMBOLS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_xor, _mul = _seeds[:SYMBOLS], _seeds[SYMBOLS:] | np.uint64(1)
_salt = mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64))


def signature(distinct: np.ndarray) -> np.ndarray:
    """The SYMBOLS MinHash symbols of 16 bits of a set of hashes."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(distinct), 4096):
        least = np.minimum(least, ((distinct[i : i + 4096] ^ _xor[:, None]) * _mul[:, None]).min(axis=1))
    return (least & np.uint64(0xFFFF)).astype(np.uint16)


def keys_of(symbols: np.ndarray, chunks: int = CHUNKS) -> np.ndarray:
    """The keys a signature is filed under: every chunk with every symbol left out."""
    wide = SYMBOLS // chunks
    parts = symbols.astype(np.uint64).reshape(chunks, wide)
    keys = np.zeros((chunks, wide), dtype=np.uint64)
    for out in range(wide):
        for i in range(wide):
            if i != out:
                # Up to four symbols fit whole; of wider chunks, older ones are mixed in.
                keys[:, out] = (mix(keys[:, out]) if wide > 5 else keys[:, out] << np.uint64(16)) ^ parts[:, i]
    return mix(keys ^ _salt.reshape(chunks, wide)).ravel().view(np.int64)


def _described(batches: Iterable[pa.RecordBatch], k: int, chunks: int) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "mark", "n_shingles", "set_a", "set_b", "signature", "keys"]
    for batch in batches:
        for i, j, words in words_of(batch.column(1)):
            n, a, b, signatures, keys = [], [], [], [], []
            for shingles in words.shingle_lists(k):
                own = np.unique(shingles)
                n.append(len(own))
                a.append(int(np.sum(own).view(np.int64)) if len(own) else 0)
                b.append(int(np.bitwise_xor.reduce(mix(own)).view(np.int64)) if len(own) else 0)
                symbols = signature(own) if len(own) else None
                signatures.append(None if symbols is None else (symbols & 0xFF).astype(np.uint8).tobytes())
                keys.append(None if symbols is None else keys_of(symbols, chunks))
            arrays = [c.slice(i, j - i) for c in (batch.column(0), batch.column(2))]
            arrays += [pa.array(x, pa.int64()) for x in (n, a, b)]
            arrays += [pa.array(signatures, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)


def _sets(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, words in words_of(batch.column(1)):
            sets = [np.unique(x).tobytes() for x in words.shingle_lists(k)]
            arrays = [batch.column(0).slice(i, j - i), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "shingles"])


#: Columns of the rows of one block pair.
Rows = dict[str, np.ndarray]


class Forest:
    """Groups of 0..n-1; ``join`` tells which of some items were not yet in the group of another."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, item: int, others: np.ndarray) -> np.ndarray:
        labels, first = np.unique(self.label[others], return_index=True)
        new = labels != self.label[item]
        if new.any():
            self.label[np.isin(self.label, labels[new])] = self.label[item]
        return others[first[new]]


def _near_signatures(rows: Rows, sides: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Spanning pairs (row, row) of those within the distance for ``percent`` whose sizes allow a link; across sides if there are two."""
    _, distance = limits(percent)
    symbols = np.frombuffer(b"".join(rows["signature"]), dtype=np.uint8).reshape(-1, SYMBOLS)
    sizes = rows["n_shingles"]
    forest, m = Forest(len(symbols)), len(symbols)
    split = int(np.searchsorted(sides, sides[-1])) if sides[0] != sides[-1] else 0
    for r in range(split or m - 1):
        start = split or r + 1
        far = (symbols[start:] != symbols[r]).sum(axis=1)
        fits = 100 * np.minimum(sizes[start:], sizes[r]) >= percent * np.maximum(sizes[start:], sizes[r])
        near = np.flatnonzero((far <= distance) & fits) + start
        for other in forest.join(r, near) if len(near) else ():
            yield r, int(other)


def _near_pairs(rows: Rows, first: np.ndarray, second: np.ndarray, percent: int) -> np.ndarray:
    """For pairs of rows whether ``_near_signatures`` links them."""
    _, distance = limits(percent)
    near = 100 * np.minimum(a := rows["n_shingles"][first], b := rows["n_shingles"][second]) >= percent * np.maximum(a, b)
    at = np.flatnonzero(near)
    symbols = np.frombuffer(b"".join(rows["signature"]), dtype=np.uint8).reshape(-1, SYMBOLS)
    for i in range(0, len(at), 1 << 16):
        part = at[i : i + (1 << 16)]
        near[part] = (symbols[first[part]] != symbols[second[part]]).sum(axis=1) <= distance
    return near


def overlaps(sets: list[np.ndarray], upto: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each of the first sets, how many members it shares with every set."""
    m = len(sets)
    _, which, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    doc = np.repeat(np.arange(m), [len(s) for s in sets])
    shared = count[which] > 1  # a member of one set only is in no intersection
    doc, which = doc[shared], which[shared]
    by = np.argsort(which, kind="stable")
    holders, ends = doc[by], np.cumsum(np.bincount(which, minlength=len(count)))
    own = np.searchsorted(doc, np.arange(m + 1))
    for r in range(upto):
        mine = which[own[r] : own[r + 1]]
        n = count[mine]
        at = np.repeat(ends[mine] - np.cumsum(n), n) + np.arange(n.sum())
        yield r, np.bincount(holders[at], minlength=m)


def _confirmed(rows: Rows, sides: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Spanning pairs (row, row) of those whose full sets are similar enough; across sides if there are two."""
    sets = [np.frombuffer(x, dtype=np.uint64) for x in rows["shingles"]]
    sizes = np.array([len(s) for s in sets])
    m = len(sets)
    split = int(np.searchsorted(sides, sides[-1])) if sides[0] != sides[-1] else 0
    if m == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        if 100 * both >= percent * (sizes.sum() - both):
            yield 0, 1
        return
    forest = Forest(m)
    for r, both in overlaps(sets, split or m - 1):
        linked = 100 * both >= percent * (sizes[r] + sizes - both)
        linked[: split or r + 1] = False
        found = np.flatnonzero(linked)
        for other in forest.join(r, found) if len(found) else ():
            yield r, int(other)


#: Pairs of rows that are compared at once in groups of up to SMALL rows.
AT_ONCE, SMALL = 1 << 19, 256


def small_groups(cuts: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """Which runs of rows have one side and SMALL rows at most, and the pairs (row, later row) within those, AT_ONCE at a time."""
    size = np.diff(cuts)
    small = (size <= SMALL) & (side[cuts[:-1]] == side[cuts[1:] - 1])
    rows = np.arange(cuts[-1])[np.repeat(small, size)]
    later = np.repeat(cuts[1:], size)[rows] - rows - 1

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        part = np.cumsum(later) // AT_ONCE
        bounds = np.append(np.searchsorted(part, np.unique(part)), len(rows))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            n = later[a:b]
            first = np.repeat(rows[a:b], n)
            yield first, first + 1 + np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)

    return small, pairs()


def _by_group(
    batches: Iterable[pa.RecordBatch], pairs: Callable[[Rows, np.ndarray], Iterator], near: Callable[[Rows, np.ndarray, np.ndarray], np.ndarray] | None
) -> Iterator[pa.RecordBatch]:
    """Runs ``pairs`` on each run of rows with equal (group, one, two), which may go over several batches.

    ``near`` tells which of many pairs of rows are linked; with it small groups are compared side by side.
    """

    def out(rows: pa.RecordBatch, cuts: list[int]) -> pa.RecordBatch:
        columns = {
            n: np.asarray(c) if pa.types.is_integer(c.type) else np.array(c.to_pylist(), dtype=object)
            for n, c in zip(rows.schema.names, rows.columns, strict=True)
        }
        found, done = [], np.zeros(len(cuts) - 1, dtype=bool)
        links = np.zeros((0, 2), dtype=np.int64)
        if near is not None:
            done, many = small_groups(np.array(cuts), columns["side"])
            met = [(i[x], j[x]) for i, j in many if (x := near(columns, i, j)).any()]
            if met:
                links = np.stack(stars(*(np.concatenate(c) for c in zip(*met, strict=True)), len(rows)), axis=1)
        for g in np.flatnonzero(~done).tolist():
            a, b = cuts[g], cuts[g + 1]
            part = {n: c[a:b] for n, c in columns.items()}
            found += [(a + i, a + j) for i, j in pairs(part, part["side"])]
        at = np.concatenate([links, np.array(found, dtype=np.int64).reshape(-1, 2)])
        docs = columns["doc_id"]
        return pa.RecordBatch.from_arrays([pa.array(docs[at[:, k]], pa.int64()) for k in range(2)], names=["a", "b"])

    rest: list[pa.RecordBatch] = []  # the rows of a run that is not known to have ended
    for batch in batches:
        if not len(batch):
            continue
        keys = [np.asarray(batch.column(c)) for c in ("group", "one", "two")]
        if rest and any(k[0] != rest[0].column(c)[0].as_py() for k, c in zip(keys, ("group", "one", "two"), strict=True)):
            whole = pa.Table.from_batches(rest).combine_chunks().to_batches()[0]
            yield out(whole, [0, len(whole)])
            rest = []
        new = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
        if not len(new):
            rest.append(batch)
            continue
        head = pa.Table.from_batches([*rest, batch.slice(0, int(new[-1]))]).combine_chunks().to_batches()[0]
        before = sum(map(len, rest))
        yield out(head, [0, *(new[:-1] + before).tolist(), len(head)])
        rest = [batch.slice(int(new[-1]))]
    if rest:
        whole = pa.Table.from_batches(rest).combine_chunks().to_batches()[0]
        yield out(whole, [0, len(whole)])


def in_blocks(rows: DataFrame, blocks: str, payload: list[str], pairs: Callable, near: Callable | None = None) -> DataFrame:
    """(a, b) from ``pairs`` over every pair of blocks of each ``group``; ``blocks``: SQL for the number of a group's blocks.

    ``near``: the same test for arrays of pairs, for the many small groups.
    """
    spread = (
        rows.withColumn("blocks", F.expr(blocks).cast("int"))
        .withColumn("side", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("group", F.least("side", "other").alias("one"), F.greatest("side", "other").alias("two"), "side", "doc_id", *payload)
    )
    met = spread.repartition("group", "one", "two").sortWithinPartitions("group", "one", "two", "side", "doc_id")
    return met.mapInArrow(lean(partial(_by_group, pairs=pairs, near=near)), "a long, b long")


def describe(docs: DataFrame, k: int, percent: int = 85) -> DataFrame:
    """doc_id, the text's mark, n_shingles, two hashes of the whole set, signature and keys of each row."""
    chunks, _ = limits(percent)
    schema = "doc_id long, mark long, n_shingles long, set_a long, set_b long, signature binary, keys array<long>"
    return numbered_texts(docs).withColumn("mark", text_mark()).mapInArrow(lean(lambda b: _described(b, k, chunks)), schema)


def _classified(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, mark, n_shingles, the number of the row's component (null for an empty set) and its smallest doc_id."""
    described = written_once(describe(docs, k, percent), "signatures")
    whole = ["n_shingles", "set_a", "set_b"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("least_id"), "mark", "signature", "keys")).alias("first")
    classes = described.where("n_shingles > 0").groupBy(*whole).agg(first).select(*whole, "first.*").drop("none")
    # A class has a number of its own, so that rows of one doc_id with different texts are different nodes.
    classes = written_once(classes.withColumn("doc_id", F.monotonically_increasing_id()), "classes")

    filed = classes.select("doc_id", F.explode("keys").alias("group"))
    held = filed.groupBy("group").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.bit_xor(F.xxhash64("doc_id")).alias("x")
    )
    # Keys with the same holders ask for the same comparisons; one of them is enough.
    chosen = written_once(held.where("n > 1").groupBy("n", "lo", "hi", "x").agg(F.min("group").alias("group")), "keys")
    holders = filed.join(chosen.select("group", "n"), "group").join(classes.select("doc_id", "signature", "n_shingles"), "doc_id")
    near = in_blocks(holders, f"ceil(n / {HOLDERS})", ["signature", "n_shingles"], partial(_near_signatures, percent=percent), partial(_near_pairs, percent=percent))
    clusters = components(near).select(F.col("node").alias("doc_id"), F.col("component").alias("group"))

    sized = clusters.join(classes.select("doc_id", "n_shingles", "least_id", "mark"), "doc_id")
    load = sized.groupBy("group").agg(F.sum("n_shingles").alias("load"))
    wanted = sized.select(F.col("doc_id").alias("node"), F.col("least_id").alias("_told_id"), F.col("mark").alias("_told_mark"))
    texts = numbered_texts(docs)
    texts = texts.join(wanted, same_row(texts, "_told_id", "_told_mark")).select(F.col("node").alias("doc_id"), "text")
    sets = written_once(texts.mapInArrow(lean(lambda b: _sets(b, k)), "doc_id long, shingles binary"), "sets")
    # A class's first row may have been read several times.
    members = sets.dropDuplicates(["doc_id"]).join(clusters, "doc_id").join(load, "group")
    links = in_blocks(members, f"ceil(load / {SHINGLES})", ["shingles"], partial(_confirmed, percent=percent))
    linked = components(links)

    own = linked.join(classes.select(F.col("doc_id").alias("node"), "least_id"), "node")
    least = own.groupBy("component").agg(F.min("least_id").alias("component_id"))
    joined = linked.join(least, "component").select(F.col("node").alias("doc_id"), "component", "component_id")
    found = classes.select(*whole, "doc_id", "least_id").join(joined, "doc_id", "left")
    known = F.when(F.col("component").isNull(), F.col("least_id")).otherwise(F.col("component_id")).alias("component_id")
    found = written_once(found.select(*whole, F.coalesce("component", "doc_id").alias("component"), known), "classes")
    return described.select("doc_id", "mark", *whole).join(found, whole, "left").select("doc_id", "mark", "n_shingles", "component", "component_id")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id of its component) and kept of each row.

    A row without doc_id has its component's number, and none if no row of it has one; it is kept only then.
    """
    own = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return _classified(docs, k, percent).select(
        "doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept")
    )


def representatives(docs: DataFrame, k: int = 5, percent: int = 85) -> DataFrame:
    """One row of each component: that of the smallest doc_id, then of the smallest text mark; rows without doc_id come last.

    Rows of one doc_id with different texts are judged each for itself; rows with an empty set stay.
    """
    rows = written_once(_classified(docs, k, percent).where("component is not null"), "rows")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    firsts = rows.groupBy("component").agg(F.min(place).alias("first")).select("component", "first.*")
    told = rows.groupBy("doc_id", "mark").agg(F.min("component").alias("component"), F.count("*").alias("copies"))
    best = firsts.select(F.col("component").alias("of"), F.col("doc_id").alias("best_id"), F.col("mark").alias("best_mark"))
    stays = F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("mark") == F.col("best_mark"))
    marked = told.join(best, F.col("component") == F.col("of")).select(
        F.col("doc_id").alias("_told_id"), F.col("mark").alias("_told_mark"), stays.alias("_stays"), F.col("copies").alias("_copies")
    )
    marked = written_once(marked.where("not _stays or _copies > 1"), "dropped")
    joined = docs.join(bounded_broadcast(marked), same_row(docs, "_told_id", "_told_mark"), "left")
    single = joined.where("_copies is null").select(docs.columns)
    if not marked.where("_stays").limit(1).count():
        return single
    # Copies of the row that stays: the first by the hash of all their columns.
    copies = joined.where("_stays and _copies > 1").withColumn("_hash", F.xxhash64(*[docs[c] for c in docs.columns]))
    first = Window.partitionBy("_told_id", "_told_mark").orderBy("_hash")
    again = copies.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").select(docs.columns)
    return single.unionByName(again)
