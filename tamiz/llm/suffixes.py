"""Passages that repeat, by a sparse suffix array.

1. Of the suffixes of all texts (from each word on) those are retained that start at a minimiser: the position of the least hash
   among ``least - gram + 1`` neighbouring grams of ``gram`` words. Two equal passages of ``least`` words select the same
   position, so a passage of that length never goes without a retained suffix. Suffixes whose gram occurs once are dropped.
2. The others are range-partitioned and sorted by gram and what follows it, and each is compared with its neighbours: the longest
   match to the right of any suffix is with a neighbour. The same is done by what stands before the gram, read backwards.
   Every match is extended to both sides, up to ``least - gram`` words, for longer ones have further suffixes of their own.
3. Among three or more suffixes with one gram, a passage may join a longer match to the right with one and to the left with another,
   neither of ``least`` words to be seen from here. So the windows of ``least`` words round the gram that no neighbour covers are
   grouped by their hash, counted in each task first; a window that occurs again is a match.
4. Matches of at least ``least`` words are merged into the passages of each text.

Neighbours on either side of a partition's edge are compared in a second step over one row per edge, so a suffix that
a third of all documents share is dealt over many tasks like any other. Words are lower-cased (A-Z) and compared by hash.

* a null or empty text, or one shorter than ``least`` words, has no passage; a passage that repeats within one text counts;
* repeated rows and copies repeat as a whole; positions and passages belong to a text, whatever other text shares its doc_id, and a
  null doc_id is reported as null;
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamiz.session import written_once

from .common import lean, numbered_texts
from .words import Words, mix, words_of

#: Rows that are compared, or windows that are handed on, at once.
AT_ONCE = 4000
_ROW = "gram long, doc_id long, own long, pos long, before binary, after binary"
_MATCH = "doc_id long, own long, pos long, left int, right int, other_doc_id long, other_pos long"


def selected(words: Words, gram: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(word positions, gram hashes) of the minimisers of all texts that have at least ``least`` words."""
    grams = words.shingles(gram)
    width = least - gram + 1
    if len(grams) < width:
        return np.zeros(0, dtype=np.int64), grams[:0]
    n = len(grams) - width + 1
    inside = np.zeros(n, dtype=bool)  # windows that do not go over a text's end
    for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
        inside[a : max(a, b - least + 1)] = True
    starts = np.flatnonzero(inside)
    windows = np.lib.stride_tricks.sliding_window_view(grams, width)
    chosen = [starts[i : i + 65536] + windows[starts[i : i + 65536]].argmin(axis=1) for i in range(0, len(starts), 65536)]
    at = np.unique(np.concatenate(chosen)) if chosen else starts
    return at, grams[at]


def _anchors(batches: Iterable[pa.RecordBatch], gram: int, least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, _, words in words_of(batch.column(1)):
            at, grams = selected(words, gram, least)
            text = np.searchsorted(words.bounds, at, side="right") - 1
            arrays = [
                pa.array(grams.view(np.int64)),
                batch.column(0).take(pa.array(text + i)),
                batch.column(2).take(pa.array(text + i)),
                pa.array(at - words.bounds[text], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["gram", "doc_id", "own", "pos"])


def _contexts(batches: Iterable[pa.RecordBatch], gram: int, least: int) -> Iterator[pa.RecordBatch]:
    """For the wanted positions: the words before the gram, nearest first, and those after it, as 32-bit hashes."""
    reach = least - gram
    for batch in batches:
        wanted, owns = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        for i, j, words in words_of(batch.column(1)):
            codes = (words.hashes >> np.uint64(32)).astype(">u4")
            grams = words.shingles(gram)
            rows: list[tuple] = []
            for r in range(i, j):
                a, b = int(words.bounds[r - i]), int(words.bounds[r - i + 1])
                doc = batch.column(0)[r].as_py()
                for pos in wanted[r]:
                    at = a + pos
                    before = codes[max(a, at - reach) : at][::-1].tobytes()
                    after = codes[at + gram : min(b, at + gram + reach)].tobytes()
                    rows.append((int(grams[at].view(np.int64)), doc, owns[r], pos, before, after))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["gram", "doc_id", "own", "pos", "before", "after"])


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading columns agree, row by row; the padding of a shorter one never agrees."""
    same = (a == b) & (a >= 0)
    return np.where(same.all(axis=1), same.shape[1], np.argmin(same, axis=1)).astype(np.int64)


def _padded(column: pa.Array, reach: int) -> np.ndarray:
    """Binary contexts as rows of signed numbers, -1 beyond their end."""
    out = np.full((len(column), reach), -1, dtype=np.int64)
    for r, x in enumerate(column.to_pylist()):
        out[r, : len(x) // 4] = np.frombuffer(x, dtype=">u4")
    return out


def _windows(grams: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """For each row and each j a hash of the gram with the j words before it and the reach - j words after it."""
    reach = before.shape[1]
    ahead, behind = np.zeros((2, len(grams), reach + 1), dtype=np.uint64)
    place = np.arange(reach, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    np.cumsum(mix(before.view(np.uint64) + place), axis=1, out=ahead[:, 1:])
    np.cumsum(mix(~(after.view(np.uint64) + place)), axis=1, out=behind[:, 1:])
    j = np.arange(reach + 1, dtype=np.uint64)
    return mix(mix(grams.view(np.uint64))[:, None] + mix(ahead + j) + behind[:, ::-1]).view(np.int64)


def _neighbours(batches: Iterable[pa.RecordBatch], gram: int, least: int, windows: bool) -> Iterator[pa.RecordBatch]:
    """Matches of neighbouring rows, once for each of the two; and, with a part number, the first and last row of the partition.

    With ``windows`` also (window hash, row, j) of the windows that neither neighbour covers, of rows whose gram may have three.
    """
    reach = least - gram
    part = TaskContext.get().partitionId()
    previous: pa.RecordBatch | None = None
    kinds = [("doc_id", pa.int64()), ("own", pa.int64()), ("pos", pa.int64()), ("left", pa.int32()), ("right", pa.int32())]
    kinds += [("other_doc_id", pa.int64()), ("other_pos", pa.int64()), ("part", pa.int32()), ("edge", pa.int32())]
    schema = pa.schema([*kinds, ("gram", pa.int64()), ("before", pa.binary()), ("after", pa.binary()), ("window", pa.int64())])

    def out(n: int, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    def edge(row: pa.RecordBatch, which: int) -> pa.RecordBatch:
        held = {c: row.column(c) for c in ("doc_id", "own", "pos", "gram", "before", "after")}
        return out(1, **held, part=pa.array([part], pa.int32()), edge=pa.array([which], pa.int32()))

    def uncovered(rows: pa.RecordBatch, same: np.ndarray, left: np.ndarray, right: np.ndarray, before: np.ndarray, after: np.ndarray, last: bool):
        """The last row is left to the next call, unless there is none."""
        n, j = len(rows), np.arange(reach + 1)
        # A run that may go on beyond these rows counts as long.
        linked = np.r_[True, same, True]
        many = (linked[:-1] & linked[1:]) | (linked[:-1] & np.r_[True, linked[:-2]]) | (linked[1:] & np.r_[linked[2:], True])
        needed = (j <= (before >= 0).sum(axis=1)[:, None]) & (reach - j <= (after >= 0).sum(axis=1)[:, None]) & many[:, None]
        covered = same[:, None] & (j <= left[:, None]) & (reach - j <= right[:, None])
        needed[:-1] &= ~covered
        needed[1:] &= ~covered
        at, offset = np.nonzero(needed if last else needed[:-1])
        if not len(at):
            return
        own = np.unique(at)
        hashes = _windows(np.asarray(rows.column("gram"))[own], before[own], after[own])[np.searchsorted(own, at), offset]
        for i in range(0, len(at), AT_ONCE):
            part_at, j = pa.array(at[i : i + AT_ONCE]), offset[i : i + AT_ONCE]
            held = {c: rows.column(c).take(part_at) for c in ("doc_id", "own", "pos")}
            sides = {"left": pa.array(j, pa.int32()), "right": pa.array(reach - j, pa.int32())}
            yield out(len(j), **held, **sides, window=pa.array(hashes[i : i + AT_ONCE]))

    def compared(rows: pa.RecordBatch, last: bool) -> Iterator[pa.RecordBatch]:
        grams = np.asarray(rows.column("gram"))
        same = grams[1:] == grams[:-1]
        here = np.flatnonzero(same)
        if not len(here) and not windows:
            return
        before, after = _padded(rows.column("before"), reach), _padded(rows.column("after"), reach)
        left, right = np.zeros(len(same), dtype=np.int64), np.zeros(len(same), dtype=np.int64)
        left[here], right[here] = _common(before[here], before[here + 1]), _common(after[here], after[here + 1])
        if windows:
            yield from uncovered(rows, same, left, right, before, after, last)
        here = here[(left + right + gram >= least)[here]]
        if len(here):
            ones, others = (pa.array(np.concatenate(x)) for x in ((here, here + 1), (here + 1, here)))
            held = {c: rows.column(c).take(ones) for c in ("doc_id", "own", "pos")}
            held |= {f"other_{c}": rows.column(c).take(others) for c in ("doc_id", "pos")}
            yield out(len(ones), **held, **{n: pa.array(np.tile(x[here], 2), pa.int32()) for n, x in (("left", left), ("right", right))})

    for batch in batches:
        if not len(batch):
            continue
        if previous is None:
            yield edge(batch.slice(0, 1), 0)
            rows = batch
        else:
            rows = pa.Table.from_batches([previous, batch]).combine_chunks().to_batches()[0]
        previous = batch.slice(len(batch) - 1, 1)
        for start in range(0, len(rows) - 1, AT_ONCE):
            yield from compared(rows.slice(start, AT_ONCE + 1), False)
    if previous is not None:
        yield from compared(previous, True)
        yield edge(previous, 1)


def _matches(contexts: DataFrame, first: str, second: str, gram: int, least: int, windows: bool) -> DataFrame:
    """Matches of each suffix with its neighbours in the order of (gram, first, second), and by the windows that these leave open."""
    order = ["gram", first, second, "doc_id", "own", "pos"]
    held = ["gram", "doc_id", "own", "pos", "before", "after"]
    ordered = contexts.repartitionByRange(*order).sortWithinPartitions(*order).select(*held)
    schema = f"{_MATCH}, part int, edge int, gram long, before binary, after binary, window long"
    compare = partial(_neighbours, gram=gram, least=least, windows=windows)
    found = written_once(ordered.mapInArrow(lean(compare), schema), "neighbours")
    # The last row of a partition meets the first row of the next one that has rows: at most two rows per partition.
    meeting = found.where("edge is not null").select("part", "edge", *held).repartition(1).sortWithinPartitions("part", "edge")
    across = meeting.mapInArrow(partial(_across, gram=gram, least=least), _MATCH)
    matches = found.where("edge is null and window is null").select(*across.columns).unionByName(across)
    if not windows:
        return matches
    place = F.struct("doc_id", "pos", "own")
    rows = found.where("window is not null").select("window", "doc_id", "own", "pos", "left", "right")
    again = rows.groupBy("window").agg(F.count("*").alias("n"), F.min(place).alias("least"), F.max(place).alias("greatest")).where("n > 1")
    again = written_once(again.select("window", "least", "greatest"), "windows")
    other = F.when(F.struct("doc_id", "pos", "own") == F.col("least"), F.col("greatest")).otherwise(F.col("least"))
    met = rows.join(again, "window").withColumn("other", other)
    open_ones = met.select(*rows.columns[1:], F.col("other.doc_id").alias("other_doc_id"), F.col("other.pos").alias("other_pos"))
    return matches.unionByName(open_ones.select(*matches.columns))


def _across(batches: Iterable[pa.RecordBatch], gram: int, least: int) -> Iterator[pa.RecordBatch]:
    """Matches between the last row of each partition and the first of the next."""
    last: dict | None = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["edge"] == 1:
                last = row
                continue
            if last is not None and last["gram"] == row["gram"]:
                left, right = (
                    int(_common(_padded(pa.array([last[c]]), least - gram), _padded(pa.array([row[c]]), least - gram))[0])
                    for c in ("before", "after")
                )
                if left + right + gram >= least:
                    pairs = [(last, row), (row, last)]
                    yield pa.RecordBatch.from_pylist(
                        [
                            {"doc_id": x["doc_id"], "own": x["own"], "pos": x["pos"], "left": left, "right": right, "other_doc_id": y["doc_id"], "other_pos": y["pos"]}
                            for x, y in pairs
                        ],
                        schema=pa.schema(
                            [("doc_id", pa.int64()), ("own", pa.int64()), ("pos", pa.int64()), ("left", pa.int32()), ("right", pa.int32())]
                            + [("other_doc_id", pa.int64()), ("other_pos", pa.int64())]
                        ),
                    )


def repeated_passages(docs: DataFrame, least: int = 50, gram: int = 20) -> DataFrame:
    """doc_id, start_word, n_words of every passage that repeats, with another place of (part of) it.

    ``other_doc_id`` and ``other_start_word`` are the smallest place among the passage's longest matches.
    """
    # Rows without doc_id, or of equal ones, may have different texts: positions belong to a text.
    texts = numbered_texts(docs).withColumn("own", F.xxhash64("text"))
    schema = "gram long, doc_id long, own long, pos long"
    anchors = written_once(texts.mapInArrow(lean(lambda b: _anchors(b, gram, least)), schema), "anchors")
    # Written, so that the join is between two plain tables and a gram with many suffixes is split over tasks.
    often = written_once(anchors.groupBy("gram").count().where("count > 1").select("gram"), "grams")
    wanted = anchors.join(often, "gram", "left_semi").groupBy("doc_id", "own").agg(F.collect_set("pos").alias("wanted"))  # of one text
    wanted = wanted.select(F.col("doc_id").alias("of"), F.col("own").alias("of_text"), "wanted")
    met = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("own") == F.col("of_text")))
    contexts = met.select("doc_id", "text", "wanted", "own").mapInArrow(lean(lambda b: _contexts(b, gram, least)), _ROW)
    contexts = written_once(contexts, "contexts")
    # Windows that stay open in one order are looked up; what the other order finds besides is found twice.
    matches = _matches(contexts, "after", "before", gram, least, True).unionByName(_matches(contexts, "before", "after", gram, least, False))

    spans = matches.select(
        "doc_id",
        "own",
        (F.col("pos") - F.col("left")).alias("start"),
        (F.col("pos") + gram + F.col("right")).alias("stop"),
        F.struct(
            (-(F.col("left") + F.col("right"))).alias("rank"), "other_doc_id", (F.col("other_pos") - F.col("left")).alias("other_start")
        ).alias("other"),
    )
    spans = spans.groupBy("doc_id", "own", "start", "stop").agg(F.min("other").alias("other"))
    in_order = Window.partitionBy("doc_id", "own").orderBy("start", "stop")  # the spans of one text
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    new = (F.coalesce(F.max("stop").over(before), F.lit(-1)) < F.col("start")).cast("int")
    islands = spans.withColumn("new", new).withColumn("island", F.sum("new").over(in_order))
    merged = islands.groupBy("doc_id", "own", "island").agg(
        F.min("start").alias("start_word"), (F.max("stop") - F.min("start")).alias("n_words"), F.min("other").alias("other")
    )
    return merged.select(
        "doc_id",
        "start_word",
        "n_words",
        F.col("other.other_doc_id").alias("other_doc_id"),
        F.col("other.other_start").alias("other_start_word"),
    )
