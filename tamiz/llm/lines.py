"""Fuzzy line deduplication: a join on shared grams that every similar pair has, edit similarity, one line per group.

1. A line is normalised to its words: runs of ASCII letters and digits and of characters beyond ASCII, with A-Z in lower case. Lines
   of fewer than ``min_words`` words stay as they are, lines without a word always. Equal normalised lines are one class.
2. A line of x words differs from a similar, not longer one in d = (1 - ``similarity``) * x words at most, and an edit changes two of
   its x - 1 pairs of neighbouring words, so both lines have x - 1 - 2 * d pairs in common (q-gram lemma). Where that is nothing,
   single words take the place of pairs. With the pairs of all lines in one order, two lines with T pairs in common share one of the first
   n - T of their n - 1 pairs (prefix filter); each line is filed under the first 2 * d + 1 or so. The order begins with pairs of
   rare words; any order is right, and frequencies are those of classes of words, a table whose size is fixed. Grams
   with one holder are dropped in buckets of packed arrays, and so are holders with no other whose words before and behind the gram
   are as many but for the edits allowed; grams with the same holders as another are dropped by counts and XORs. The unedited
   words of two similar lines are in one order, so the first gram that both have unedited is met in place.
3. Holders of a gram are compared by ``SKETCH`` * 64 parities of word counts, of which an edit changes two at most, and long lines by
   ``TALLY`` word counts too, in blocks that give spanning forests; the components are clusters. No pair that is similar enough is lost.
4. In a cluster, lines whose word edit similarity 1 - distance / longer length reaches ``similarity`` are linked, again in
   blocks. Each group of linked lines keeps its first occurrence by (doc_id, text mark, line number); the others are removed.

SimHash codes cannot take the place of steps 2 and 3: two lines of ten words with two words replaced differ in 13 of 64 bits on
average, for which the pigeonhole principle leaves blocks of four bits.

* a null text stays null and an empty one empty; a text all of whose lines are removed becomes empty;
* rows without doc_id stay as they are and their lines do not count; rows with an equal doc_id and text are the same document
  read again and keep the same lines, those with an equal doc_id and different texts have lines of their own;
* an empty table gives an empty result; all columns are carried along, clashing names included, for only new names are added.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, partial
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.session import written_once

from .common import bounded_broadcast, lean, numbered_texts, same_row, text_mark
from .components import components
from .neardup import Forest, Rows, in_blocks, overlaps, small_groups, stars
from .words import _PLACES, LETTERS, PIECE, Words, mix, pieces, sequence_hashes

#: Default of ``min_words``: lines of one word are lines.
MIN_WORDS = 1
#: Numbers of 64 parities that describe a line's words.
SKETCH = 4
#: Entries of a bucket of grams; distinct lines of a piece of text from which on a gram's holders need no count.
BUCKET, OFTEN = 1 << 21, 32
#: Words before or behind a gram from which on they are not counted.
ANYWHERE = 255
#: Bytes of text cut into words at once: what that takes stays in a processor's cache.
TEXT = 1 << 17
#: Classes that words are counted by, and steps of a weight to a doubling.
CLASSES, STEPS = 1 << 16, 8
_COUNT = np.dtype([("class", np.uint16), ("n", np.int64)])
#: Numbers in the rows of a table that may be broadcast: 16 MB.
NUMBERS = 1 << 21
#: Lines of a key, and words of a cluster, on one side of a block pair.
HOLDERS, WORDS = 2048, 1 << 18
#: Pairs of lines that are looked at at once, as a matrix, and its rows.
ABREAST, ROWS = 1 << 16, 1 << 10
#: Words up to which edit distances of many pairs are reckoned together, so many words at once.
LONG, CELLS = 512, 1 << 16
#: Pairs that are too few for that; pairs of a large cluster that are gathered for it.
FEW, PAIRS = 16, 1 << 12
#: Classes of words, as a power of two, that the lines of a large cluster are compared by in any order.
WORD_BITS = 18
#: Words from which on a line is also described by how many of its words are of each of TALLY classes.
TALLIED, TALLY = 128, 64
_SKETCHES = [f"sketch{i}" for i in range(SKETCH)]


def _line_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the lines of some texts begin."""
    # Lines without a byte need no number: the one after a line end that closes a text counts as the next text's first.
    own = np.sort(np.concatenate([offsets[:-1], np.flatnonzero(data == 0x0A) + 1]), kind="stable")
    return own[np.r_[True, own[1:] != own[:-1]]] if len(own) else own


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of some texts; for each line its text, its number there, its first word and the word after its last."""
    words = Words(data, offsets, LETTERS)
    own = _line_starts(data, offsets)
    text = np.searchsorted(offsets[:-1], own, side="right") - 1
    number = np.arange(len(own)) - np.searchsorted(text, text)
    first = np.searchsorted(words.starts, own)
    stop = np.append(own[1:], len(data))
    return words, text, number, first, np.searchsorted(words.starts, stop)


def _edits(n: int, similarity: float) -> int:
    """The edits that a line of n words may be from a similar one that is not longer."""
    return floor((1 - similarity) * n + 1e-9)


def _longest(n: int, similarity: float) -> int:
    """The words of the longest line that may be similar to one of n words."""
    return floor(n / similarity + 1e-9)


def sketches(hashes: np.ndarray, first: np.ndarray, last: np.ndarray, wide: int = SKETCH) -> np.ndarray:
    """For each span the parity of the number of its values in each of 64 * wide classes, as so many numbers; no two spans overlap."""
    n = last - first
    own = mix(hashes + np.uint64(2))
    if n.sum() < len(own):
        own = own[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    row = np.repeat(np.arange(len(n)), n)
    cell = row * wide + (own >> np.uint64(6)).astype(np.int64) % wide
    out = np.zeros(len(n) * wide, dtype=np.uint64)
    np.bitwise_xor.at(out, cell, np.uint64(1) << (own & np.uint64(63)))
    return out.reshape(-1, wide)


def tallies(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each span how many of its values are of each of TALLY classes, up to 255."""
    n = last - first
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    cell = np.repeat(np.arange(len(n)), n) * TALLY + (hashes[at] & np.uint64(TALLY - 1)).astype(np.int64)
    return np.minimum(np.bincount(cell, minlength=len(n) * TALLY), 255).astype(np.uint8).reshape(-1, TALLY)


def _word_class(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - CLASSES.bit_length() + 1)).astype(np.int64)


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many words are of each class, from the packed counts of tasks."""
    counts = np.zeros(CLASSES, dtype=np.int64)
    for batch in batches:
        for packed in batch.column(0).to_pylist():
            told = np.frombuffer(packed, dtype=_COUNT)
            counts[told["class"]] += told["n"]
    met = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], names=["class", "n"])


def word_weights(counted: DataFrame) -> tuple[np.ndarray, int]:
    """For each class of words how frequent it is, as a rounded logarithm in a byte; and how many words there are.

    ``counted``: the packed counts of ``_occurrences``.
    """
    counts = counted.mapInArrow(lean(_word_counts), "class long, n long").groupBy("class").agg(F.sum("n").alias("n"))
    weights, total = np.zeros(CLASSES, dtype=np.uint8), 0
    for row in counts.collect():  # CLASSES rows at most
        weights[row["class"]] = min(255, int(STEPS * np.log2(row["n"])))
        total += row["n"]
    return weights, total


@lru_cache(maxsize=1 << 16)
def _filed(n: int, k: int, similarity: float) -> int:
    """How many of its first grams of k words a line of n words is filed under; lines without an edit are similar to equal ones only.

    A line of x words is told to be similar to shorter ones by pairs of words if some are left by its edits, else by single words.
    """
    x = np.arange(n, _longest(n, similarity) + 1)
    d = np.floor((1 - similarity) * x + 1e-9).astype(np.int64)
    told = (d > 0) & ((x - 1 - 2 * d > 0) == (k == 2))
    return int((n - x + k * d + 1)[told].max(initial=0))


def line_grams(
    hashes: np.ndarray, first: np.ndarray, last: np.ndarray, weights: np.ndarray, similarity: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(line, key, words before, words after) of the grams each line is filed under: the first by the weights of their words, then by key.

    The order compares 16 bits of a key; a line is also filed under the grams that its last one ties with. Counts of words end at
    ANYWHERE, which both counts of a gram are that a line has several times.
    """
    sizes = last - first
    weight = weights[_word_class(hashes)].astype(np.int64)
    out: list[list[np.ndarray]] = [[np.zeros(0, dtype=t)] for t in (np.int64, np.uint64, np.uint8, np.uint8)]
    for k in (1, 2):
        most = np.zeros(int(sizes.max(initial=0)) + 1, dtype=np.int64)
        for n in np.unique(sizes).tolist():
            most[n] = _filed(n, k, similarity)
        of = np.flatnonzero((most[sizes] > 0) & (sizes >= k))
        if not len(of):
            continue
        n = sizes[of] - k + 1
        starts = np.cumsum(n) - n
        line = np.repeat(np.arange(len(of)), n)
        at = np.arange(n.sum()) + (first[of] - starts)[line]
        raw, common = hashes[at], weight[at]
        if k == 2:
            raw, common = raw * _PLACES[0] + hashes[at + 1] * _PLACES[1], common + weight[at + 1]
        order = common << 16 | (raw >> np.uint64(48)).astype(np.int64)
        wide = len(at).bit_length()
        if len(of).bit_length() + 25 + wide <= 63:
            by = np.sort((line << 25 | order) << wide | np.arange(len(at))) & ((1 << wide) - 1)
        else:
            by = np.lexsort((order, line))
        order = order[by]  # lines stay where they were
        end = order[starts + np.minimum(most[sizes[of]], n) - 1]
        early = np.flatnonzero(order <= end[line])
        line, at = line[early], by[early]
        key = mix(raw[at] + np.uint64(k))
        before = at - starts[line]
        after = n[line] - 1 - before
        new = np.r_[True, (key[1:] != key[:-1]) | (line[1:] != line[:-1])]
        again = ~new
        again[:-1] |= ~new[1:]
        before[again] = after[again] = ANYWHERE
        for column, values in zip(out, (of[line], key, np.minimum(before, ANYWHERE), np.minimum(after, ANYWHERE)), strict=True):
            column.append(values[new].astype(column[0].dtype))
    return tuple(np.concatenate(column) for column in out)


def _cut(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of the runs of some values that begin at ``cuts``."""
    ends = (np.append(cuts, len(values)) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def _filings(batches: Iterable[pa.RecordBatch], weights: np.ndarray, similarity: float, min_words: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(line, key, before, after) of about PIECE bytes of text at once, each line of a smaller piece once."""
    met: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in batches:
        for _, _, data, offsets in pieces(batch.column(1), TEXT):
            words, _, _, first, last = _lines(data, offsets)
            keep = last - first >= min_words
            first, last = first[keep], last[keep]
            hashes, one = np.unique(sequence_hashes(words.hashes, first, last), return_index=True)
            line, *rest = line_grams(words.hashes, first[one], last[one], weights, similarity)
            met.append((hashes[line], *rest))
            size += len(data)
            if size >= PIECE:
                yield tuple(np.concatenate(c) for c in zip(*met, strict=True))
                met, size = [], 0
    if met:
        yield tuple(np.concatenate(c) for c in zip(*met, strict=True))


def _packed(batches: Iterable[pa.RecordBatch], weights: np.ndarray, similarity: float, min_words: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Per piece of text and bucket one row of packed (key, line, words before, words after); rows of grams that are often held are ``sure``.

    A key has 32 bits beside its bucket; in ``sure`` rows, which are dealt by line, it is written with the bucket.
    """
    names = ["bucket", "sure", "keys", "lines", "before", "after"]
    for line, key, before, after in _filings(batches, weights, similarity, min_words):
        if not len(key):
            continue
        key = ((key >> np.uint64(32)) * np.uint64(buckets) & ~np.uint64(0xFFFFFFFF)) | (key & np.uint64(0xFFFFFFFF))
        by = np.argsort(key)
        line, key, before, after = line[by], key[by], before[by], after[by]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        n = np.diff(np.append(starts, len(key)))
        often = np.repeat(n > OFTEN, n)
        # Two entries of a gram that is often held tell the others that it is held, anywhere; its own holders go anywhere.
        ends = np.zeros(len(key), dtype=bool)
        ends[starts], ends[starts + n - 1] = True, True
        before[often], after[often] = ANYWHERE, ANYWHERE
        for sure, chosen in ((False, ~often | ends), (True, often)):
            if not chosen.any():
                continue
            k, x, a, b = key[chosen], line[chosen], before[chosen], after[chosen]
            if sure:
                bucket = (mix(x) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
                by = np.argsort(bucket)
                bucket, k, x, a, b = bucket[by], k[by], x[by], a[by], b[by]
            else:
                bucket, k = k >> np.uint64(32), k.astype(np.uint32)
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            arrays = [pa.array(bucket[cuts].astype(np.int64)), pa.array(np.full(len(cuts), sure)), *(_cut(c, cuts) for c in (k, x, a, b))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)


@lru_cache(maxsize=4)
def _edits_in_place(similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """For lines of so many words the edits from a similar one, not longer or as long as it may be."""
    sizes = range(2 * ANYWHERE + 3)
    return np.array([_edits(n, similarity) for n in sizes]), np.array([_edits(_longest(n, similarity), similarity) for n in sizes])


def _in_place(before: np.ndarray, after: np.ndarray, first: np.ndarray, second: np.ndarray, similarity: float) -> np.ndarray:
    """For pairs of holders of a gram whether their lines may be similar with the gram where it is.

    The edits before the gram are as many as the words before differ at least, and so behind it; a count that ends at ANYWHERE
    differs by no more than the whole one would.
    """
    edits, longest = _edits_in_place(similarity)
    told = (before < ANYWHERE) & (after < ANYWHERE)
    size = np.where(told, before + after + 2, 0)  # words, one more for grams of one
    most = np.maximum(size[first], size[second])
    both = told[first] & told[second]
    one = told[first] | told[second]
    apart = np.abs(before[first] - before[second]) + np.abs(after[first] - after[second])
    wild = (before == ANYWHERE) & (after == ANYWHERE)
    return (apart <= np.where(both, edits[most], longest[most])) | ~one | wild[first] | wild[second]


def _shared(batches: Iterable[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """(line, key) of the grams that are sure or that two lines have where it lets them be similar; rows come by bucket.

    Grams that may have sure rows are told to be ``often`` held, and then a holder may come again. The holders of the others are all
    in one bucket, each once: a row without a line has how many they are and the XOR of their lines.
    """
    names = ["doc_id", "group", "often", "n", "x"]

    def out(key: np.ndarray, line: np.ndarray, often: np.ndarray) -> pa.RecordBatch:
        none = pa.nulls(len(key), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(line.view(np.int64)), pa.array(key.view(np.int64)), pa.array(often), none, none], names=names)

    def told(key: np.ndarray, line: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])[: len(key)]
        n, x = np.diff(np.append(cuts, len(key))), np.bitwise_xor.reduceat(line, cuts) if len(cuts) else line
        arrays = [pa.nulls(len(cuts), pa.int64()), pa.array(key[cuts].view(np.int64)), pa.array(np.zeros(len(cuts), dtype=bool))]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(n), pa.array(x.view(np.int64))], names=names)

    def counted(bucket: int, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        kinds = (np.uint32, np.uint64, np.uint8, np.uint8)
        key, line, before, after = (np.frombuffer(b"".join(p[i] for p in parts), dtype=kind) for i, kind in enumerate(kinds))
        by = np.sort(key.astype(np.uint64) << np.uint64(32) | np.arange(len(key), dtype=np.uint64))
        same = by[1:] >> np.uint64(32) == by[:-1] >> np.uint64(32)
        by = (by & np.uint64(0xFFFFFFFF))[np.r_[False, same] | np.r_[same, False]]
        by = by[np.lexsort((line[by], key[by]))]
        key, line, before, after = key[by], line[by], before[by].astype(np.int64), after[by].astype(np.int64)
        if not len(key):
            return
        # A line of several pieces of text is one holder; one that tells different places may have the gram anywhere.
        one = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (line[1:] != line[:-1])])
        key, line = key[one], line[one]
        places = [(np.minimum.reduceat(c, one), np.maximum.reduceat(c, one)) for c in (before, after)]
        fixed = np.logical_and.reduce([low == high for low, high in places])
        before, after = (np.where(fixed, low, ANYWHERE) for low, _ in places)
        cuts = np.append(np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), len(key))
        small, pairs = small_groups(cuts, np.zeros(len(key), dtype=np.int8))
        held = np.repeat(~small, np.diff(cuts))
        for first, second in pairs:
            near = _in_place(before, after, first, second, similarity)
            held[first[near]] = held[second[near]] = True
        # What goes anywhere may tell of sure rows; it holds with all others.
        often = np.repeat(np.logical_or.reduceat((before == ANYWHERE) & (after == ANYWHERE), cuts[:-1]), np.diff(cuts))
        key = np.uint64(bucket << 32) | key.astype(np.uint64)
        yield out(key[held], line[held], often[held])
        held &= ~often
        yield told(key[held], line[held])

    last, parts = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["sure"]:
                key = np.frombuffer(row["keys"], dtype=np.uint64)
                yield out(key, np.frombuffer(row["lines"], dtype=np.uint64), np.ones(len(key), dtype=bool))
                continue
            if row["bucket"] != last and parts:
                yield from counted(last, parts)
                parts = []
            last = row["bucket"]
            parts.append((row["keys"], row["lines"], row["before"], row["after"]))
    if parts:
        yield from counted(last, parts)


def _occurrences(batches: Iterable[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """The lines of texts; a task's last row has no line but how many of its words are of each class."""
    names = ["doc_id", "mark", "line_no", "line", "check", *_SKETCHES, "n_words", "tally", "counts"]
    counts = np.zeros(CLASSES, dtype=np.int64)
    met, size = [np.zeros(0, dtype=np.int64)], 0
    for batch in batches:
        for i, _, data, offsets in pieces(batch.column(1), TEXT):
            words, text, number, first, last = _lines(data, offsets)
            met.append(_word_class(words.hashes))
            size += len(words.hashes)
            if size >= 4 * CLASSES:
                counts += np.bincount(np.concatenate(met), minlength=CLASSES)
                met, size = met[:1], 0
            keep = last - first >= min_words
            text, number, first, last = text[keep], number[keep], first[keep], last[keep]
            codes, many = sketches(words.hashes, first, last), last - first > TALLIED
            tally = tallies(words.hashes, first[many], last[many])
            arrays = [
                *(batch.column(c).take(pa.array(text + i)) for c in (0, 2)),
                pa.array(number, pa.int64()),
                pa.array(sequence_hashes(words.hashes, first, last).view(np.int64)),
                pa.array(sequence_hashes(mix(words.hashes + np.uint64(1)), first, last).view(np.int64)),
                *(pa.array(np.ascontiguousarray(codes[:, i]).view(np.int64)) for i in range(SKETCH)),
                pa.array(last - first, pa.int64()),
                _cut(tally.ravel(), TALLY * (np.cumsum(many) - many)),
                pa.nulls(len(first), pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    counts += np.bincount(np.concatenate(met), minlength=CLASSES)
    told = np.zeros(np.count_nonzero(counts), dtype=_COUNT)
    told["class"] = np.flatnonzero(counts)
    told["n"] = counts[told["class"]]
    arrays = [pa.nulls(1, pa.int64()) for _ in names[:-2]]
    yield pa.RecordBatch.from_arrays([*arrays, pa.nulls(1, pa.binary()), pa.array([told.tobytes()], pa.binary())], names=names)


def _sequences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The word hashes of the named lines of each text; no other line is cut into words."""
    for batch in batches:
        wanted = batch.column(2)
        counts = wanted.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        told = wanted.flatten()
        numbers, names = (told.field(c).to_numpy(zero_copy_only=False) for c in ("line_no", "line"))
        ends = np.append(0, np.cumsum(counts))
        for i, j, data, offsets in pieces(batch.column(1)):
            own = _line_starts(data, offsets)
            begin = np.searchsorted(own, offsets[:-1])
            mine = slice(ends[i], ends[j])
            text = np.repeat(np.arange(j - i), counts[i:j])
            at = begin[text] + numbers[mine]
            known = at < np.append(begin[1:], len(own))[text]
            at, line = at[known], names[mine][known]
            stops = np.append(own[1:], len(data))
            sizes = stops[at] - own[at]
            bounds = np.append(0, np.cumsum(sizes))
            chosen = data[np.repeat(own[at] - bounds[:-1], sizes) + np.arange(bounds[-1])]
            words = Words(chosen, bounds, LETTERS)
            same = sequence_hashes(words.hashes, words.bounds[:-1], words.bounds[1:]).view(np.int64) == line  # else another text of this doc_id
            sequences = [words.hashes[a:b].tobytes() for a, b, s in zip(words.bounds[:-1], words.bounds[1:], same, strict=True) if s]
            yield pa.RecordBatch.from_arrays([pa.array(line[same], pa.int64()), pa.array(sequences, pa.binary())], names=["doc_id", "words"])


def edit_distance(a: list, b: list) -> int:
    """Insertions, deletions and replacements from one sequence to the other (bit-parallel columns of one big integer)."""
    skip = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    a, b = a[skip:], b[skip:]
    skip = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b), strict=False)) if x != y), min(len(a), len(b)))
    a, b = a[: len(a) - skip], b[: len(b) - skip]
    if not a or not b:
        return len(a) + len(b)
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    mask, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = mask, 0, len(a)
    for x in b:
        same = places.get(x, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        plus, minus = down | (~(diagonal | up) & mask), up & diagonal
        score += 1 if plus & top else -1 if minus & top else 0
        plus, minus = (plus << 1 | 1) & mask, minus << 1 & mask
        up, down = minus | (~(diagonal | plus) & mask), plus & diagonal
    return score


def _near_blocks(codes: np.ndarray, sizes: np.ndarray, sides: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of rows, across sides if there are two, that sizes and parities allow to be similar; ABREAST or one row are told at once.

    Rows are met by size: one is compared with those that are not too long or too short for it, and no other pair is looked at.
    """
    split = int(np.searchsorted(sides, sides[-1])) if sides[0] != sides[-1] else 0
    by = np.argsort(sizes[:split] if split else sizes, kind="stable")
    other = split + np.argsort(sizes[split:], kind="stable") if split else by
    longest = np.floor(sizes / similarity + 1e-9).astype(np.int64) + 1  # one to spare
    low = np.searchsorted(longest[other], sizes[by]) if split else np.arange(1, len(by) + 1)
    high = np.searchsorted(sizes[other], longest[by], side="right")
    codes, sizes = np.ascontiguousarray(codes.T), sizes.astype(np.int32)
    allowed = np.floor((1 - similarity) * sizes + 1e-9).astype(np.int32)
    i = 0
    while i < len(by):
        wide = high[i : i + ROWS] - low[i]
        j = i + max(1, np.count_nonzero(np.arange(1, len(wide) + 1) * wide <= ABREAST))
        first, second = by[i:j], other[low[i] : high[j - 1]]
        apart = np.abs(sizes[first][:, None] - sizes[second])
        edits = np.maximum(allowed[first][:, None], allowed[second])  # those of the longer line
        # A replaced word changes two parities, an added one changes one, and there are as many added as the sizes differ.
        bits = np.zeros(apart.shape, dtype=np.int16)
        for c in codes:
            bits += np.bitwise_count(c[first][:, None] ^ c[second])
        near = (apart <= edits) & (bits <= 2 * edits - apart)
        if not split:
            near &= np.arange(low[i], high[j - 1]) > np.arange(i, j)[:, None]
        a, b = np.nonzero(near)
        if len(a):
            yield first[a], second[b]
        i = j


def _joined(label: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The labels of rows, each the smallest row of its group, after some pairs of rows are linked."""
    a, b = label[first], label[second]
    if (a == b).all():
        return label
    new = np.arange(len(label))
    own, least = stars(a, b, len(label))
    new[own] = least
    return new[label]


def _alike(rows: Rows, first: np.ndarray, second: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """For pairs of rows whether their counts of words differ by ``limit`` at most, where both have some.

    Parities say little of two lines of many words: those of unlike lines differ by half of the bits at most.
    """
    tally = rows.get("tally", [])
    many = np.array([bool(x) for x in tally])
    out = np.ones(len(first), dtype=bool)
    if not many.any():
        return out
    own, counts = np.cumsum(many) - 1, np.frombuffer(b"".join(x for x in tally if x), dtype=np.uint8).reshape(-1, TALLY)
    told = np.flatnonzero(many[first] & many[second])
    for i in range(0, len(told), ABREAST // TALLY):
        part = told[i : i + ABREAST // TALLY]
        a, b = counts[own[first[part]]], counts[own[second[part]]]
        out[part] = (np.maximum(a, b) - np.minimum(a, b)).sum(axis=1, dtype=np.int64) <= limit[part]
    return out


def _limits(sizes: np.ndarray, first: np.ndarray, second: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of rows how much their sizes differ less than is allowed, and how many parities or counts of words may differ.

    A replaced word changes two of these, an added one changes one, and there are as many added as the sizes differ.
    """
    allowed = np.floor((1 - similarity) * sizes + 1e-9).astype(np.int32)
    edits = np.maximum(allowed[first], allowed[second])  # those of the longer line
    apart = np.abs(sizes[first] - sizes[second])
    return edits - apart, 2 * edits - apart


def _near_lines(rows: Rows, sides: np.ndarray, similarity: float) -> Iterator[tuple[int, int]]:
    """Links of each row to the smallest row that pairs of near lines connect it to."""
    codes = np.stack([rows[c].view(np.uint64) for c in _SKETCHES], axis=1)
    sizes, label = rows["n_words"].astype(np.int32), np.arange(len(codes))
    for first, second in _near_blocks(codes, sizes, sides, similarity):
        new = label[first] != label[second]
        first, second = first[new], second[new]
        near = _alike(rows, first, second, _limits(sizes, first, second, similarity)[1])
        label = _joined(label, first[near], second[near])
    own = np.flatnonzero(label != np.arange(len(label)))
    yield from zip(own.tolist(), label[own].tolist(), strict=True)


def _near_line_pairs(rows: Rows, first: np.ndarray, second: np.ndarray, similarity: float) -> np.ndarray:
    """For pairs of rows whether ``_near_lines`` links them."""
    spare, limit = _limits(rows["n_words"].astype(np.int32), first, second, similarity)
    near = spare >= 0
    at = np.flatnonzero(near)
    i, j = first[at], second[at]
    bits = sum(np.bitwise_count(rows[c].view(np.uint64)[i] ^ rows[c].view(np.uint64)[j]).astype(np.int64) for c in _SKETCHES)
    near[at] = bits <= limit[at]
    at = at[near[at]]
    near[at] = _alike(rows, first[at], second[at], limit[at])
    return near


def _occurrences_of(words: np.ndarray) -> np.ndarray:
    """Each word with how often it came before, as one number: shared ones are what two lines can match at most."""
    by = np.argsort(words, kind="stable")
    run = np.flatnonzero(np.r_[True, words[by][1:] != words[by][:-1]])
    nth = np.empty(len(words), dtype=np.uint64)
    nth[by] = np.arange(len(words)) - np.repeat(run, np.diff(np.append(run, len(words))))
    return mix(words + nth * np.uint64(0x9E3779B97F4A7C15))


def _shared_words(a: list, b: list) -> int:
    """How many words two lines can match at most, in any order."""
    left: dict = {}
    for x in a:
        left[x] = left.get(x, 0) + 1
    both = 0
    for x in b:
        n = left.get(x, 0)
        if n:
            left[x] = n - 1
            both += 1
    return both


def edit_distances(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The edit distances of pairs of spans of words: the columns of ``edit_distance``, each pair in some bytes of the big integers."""
    swap = sizes[first] < sizes[second]
    first, second = np.where(swap, second, first), np.where(swap, first, second)
    out = np.zeros(len(first), dtype=np.int64)
    by = np.lexsort((sizes[second], sizes[first]))
    while len(by):
        most = sizes[first[by]]
        n = int(most[max(1, np.searchsorted(np.arange(1, len(by) + 1) * most, CELLS, side="right")) - 1])
        at = by[: max(1, CELLS // max(n, 1))]
        at = at[sizes[first[at]] <= n]
        by = by[len(at) :]
        a, b, wide = first[at], second[at], n // 8 + 1  # a bit or more between two pairs
        if len(at) < FEW:
            spans = [[words[starts[c] : starts[c] + sizes[c]].tolist() for c in pair] for pair in zip(a, b, strict=True)]
            out[at] = [edit_distance(x, y) for x, y in spans]
            continue
        rows = words[np.minimum(starts[a][:, None] + np.arange(n), len(words) - 1)]
        told = np.arange(n) < sizes[a][:, None]
        field = np.zeros((len(at), 8 * wide), dtype=bool)
        field[:, :n] = True
        mask = int.from_bytes(np.packbits(field, bitorder="little").tobytes(), "little")
        field[:, 1:] = False
        ones = int.from_bytes(np.packbits(field, bitorder="little").tobytes(), "little")
        up, down = mask, 0
        for j in range(int(sizes[b].max()) + 1):
            ended = np.flatnonzero(sizes[b] == j)
            if len(ended):
                steps = [np.frombuffer(x.to_bytes(len(at) * wide, "little"), dtype=np.uint8).reshape(-1, wide)[ended] for x in (up, down)]
                steps = [np.unpackbits(x, axis=1, count=n, bitorder="little") & told[ended] for x in steps]
                out[at[ended]] = j + steps[0].sum(axis=1, dtype=np.int64) - steps[1].sum(axis=1, dtype=np.int64)
            field[:, :n] = rows == words[np.minimum(starts[b] + j, len(words) - 1)][:, None]
            same = int.from_bytes(np.packbits(field, bitorder="little").tobytes(), "little")
            diagonal = (((same & up) + up) ^ up) | same | down
            plus, minus = down | (~(diagonal | up) & mask), up & diagonal
            plus, minus = (plus << 1 & mask) | ones, minus << 1 & mask
            up, down = minus | (~(diagonal | plus) & mask), plus & diagonal
    return out


def _flat(rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of some lines, where each line begins in them and how many it has."""
    words = np.frombuffer(b"".join(rows["words"]), dtype=np.uint64)
    sizes = np.array([len(x) // 8 for x in rows["words"]])
    return words, np.cumsum(sizes) - sizes, sizes


def _shared_by_pair(values: np.ndarray, sizes: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """What tells for pairs of lines how many values they share at most, in any order; those of one of 2^WORD_BITS classes count as equal."""
    own = (mix(values) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    cells, n = np.unique(np.repeat(np.arange(len(sizes)), sizes) << WORD_BITS | own, return_counts=True)
    which = cells & ((1 << WORD_BITS) - 1)
    starts = np.searchsorted(cells, np.arange(len(sizes) + 1) << WORD_BITS)
    here = np.zeros(1 << WORD_BITS, dtype=np.int64)

    def shared(first: np.ndarray, second: np.ndarray) -> np.ndarray:
        out = np.zeros(len(first), dtype=np.int64)
        by = np.argsort(first, kind="stable")
        for at in np.split(by, np.flatnonzero(np.diff(first[by])) + 1) if len(by) else ():
            mine = slice(starts[first[at[0]]], starts[first[at[0]] + 1])
            begin, ends = starts[second[at]], np.cumsum(starts[second[at] + 1] - starts[second[at]])
            before = np.append(0, ends[:-1])
            theirs = np.repeat(begin - before, ends - before) + np.arange(ends[-1])
            here[which[mine]] = n[mine]
            out[at] = np.add.reduceat(np.minimum(here[which[theirs]], n[theirs]), before)
            here[which[mine]] = 0
        return out

    return shared


def _both(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    first, second = (np.concatenate(c) for c in zip(*pairs, strict=True))
    return first, second


def _linked(flat: tuple, label: np.ndarray, first: np.ndarray, second: np.ndarray, similarity: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The labels after the similar of some pairs of lines are linked, and similar pairs that connect what all of them would."""
    words, starts, sizes = flat
    allowed = np.floor((1 - similarity) * sizes + 1e-9).astype(np.int64)
    met: list[tuple[int, int]] = []
    left = np.flatnonzero(label[first] != label[second])
    while len(left):
        _, one = np.unique(second[left], return_index=True)  # a pair of each line: where lines are alike, it spares them the others
        at = left[one]
        a, b = first[at], second[at]
        edits = np.maximum(allowed[a], allowed[b])
        many = np.maximum(sizes[a], sizes[b]) <= LONG
        near = np.zeros(len(at), dtype=bool)
        near[many] = edit_distances(words, starts, sizes, a[many], b[many]) <= edits[many]
        for i in np.flatnonzero(~many).tolist():
            x, y = (words[starts[c] : starts[c] + sizes[c]].tolist() for c in (a[i], b[i]))
            near[i] = _shared_words(x, y) >= max(len(x), len(y)) - edits[i] and edit_distance(x, y) <= edits[i]
        met += zip(a[near].tolist(), b[near].tolist(), strict=True)
        label = _joined(label, a[near], b[near])
        left = np.delete(left, one)
        left = left[label[first[left]] != label[second[left]]]
    return label, met


def _similar_line_pairs(rows: Rows, first: np.ndarray, second: np.ndarray, similarity: float) -> np.ndarray:
    """For pairs of rows whether they are similar; where other pairs connect them, a pair may be left out."""
    words, starts, sizes = flat = _flat(rows)
    codes = sketches(words, starts, starts + sizes)
    described = {"n_words": sizes} | {c: codes[:, i] for i, c in enumerate(_SKETCHES)}
    at = np.flatnonzero(_near_line_pairs(described, first, second, similarity))
    label, _ = _linked(flat, np.arange(len(sizes)), first[at], second[at], similarity)
    return label[first] == label[second]


def _similar_lines(rows: Rows, sides: np.ndarray, similarity: float) -> Iterator[tuple[int, int]]:
    """Spanning pairs of similar lines. Only pairs that may be similar by their words in any order get their edit distance."""
    sequences = [np.frombuffer(x, dtype=np.uint64) for x in rows["words"]]
    sizes = np.array([len(s) for s in sequences])
    m = len(sequences)
    if m == 2:
        a, b = (s.tolist() for s in sequences)
        longer = max(len(a), len(b))
        if _shared_words(a, b) >= similarity * longer - 1e-9 and edit_distance(a, b) <= (1 - similarity) * longer + 1e-9:
            yield 0, 1
        return
    if sizes.mean() <= LONG:
        words, starts, _ = flat = _flat(rows)
        codes = sketches(words, starts, starts + sizes, SKETCH * (1 + int(sizes.mean()) // 64))
        label, waiting, n = np.arange(m), [], 0
        last = np.zeros(len(words), dtype=bool)
        last[starts + sizes - 1] = True
        shared = _shared_by_pair(words, sizes)
        shared_pairs = _shared_by_pair((words[:-1] * _PLACES[0] + words[1:] * _PLACES[1])[~last[:-1]], sizes - 1)
        for first, second in _near_blocks(codes, sizes, sides, similarity):
            new = label[first] != label[second]
            first, second = first[new], second[new]
            for k, told in ((1, shared), (2, shared_pairs)):  # an edit changes k of a line's runs of k words
                longer = np.maximum(sizes[first], sizes[second])
                least = longer + 1 - k - k * np.floor((1 - similarity) * longer + 1e-9).astype(np.int64)
                enough = least <= 0
                some = np.flatnonzero(~enough)
                enough[some] = told(first[some], second[some]) >= least[some]
                first, second = first[enough], second[enough]
            waiting.append((first, second))
            n += len(first)
            if n >= PAIRS:
                label, met = _linked(flat, label, *_both(waiting), similarity)
                yield from met
                waiting, n = [], 0
        if n:
            yield from _linked(flat, label, *_both(waiting), similarity)[1]
        return
    split = int(np.searchsorted(sides, sides[-1])) if sides[0] != sides[-1] else 0
    forest = Forest(m)
    for r, both in overlaps([_occurrences_of(s) for s in sequences], split or m - 1):
        start = split or r + 1
        longer = np.maximum(sizes, sizes[r])
        fits = (both >= similarity * longer - 1e-9) & (forest.label != forest.label[r])
        fits[:start] = False
        for other in np.flatnonzero(fits):
            if forest.label[other] == forest.label[r]:
                continue
            if edit_distance(sequences[r].tolist(), sequences[other].tolist()) <= (1 - similarity) * longer[other] + 1e-9:
                forest.join(r, np.array([other]))
                yield r, int(other)


def line_groups(docs: DataFrame, similarity: float, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """(occurrences of lines, (line, component) of the lines that are linked to a different one)."""
    codes = ", ".join(f"{c} long" for c in _SKETCHES)
    schema = f"doc_id long, mark long, line_no long, line long, check long, {codes}, n_words long, tally binary, counts binary"
    texts = numbered_texts(docs).where("doc_id is not null and text is not null").withColumn("mark", text_mark())
    told = written_once(texts.mapInArrow(lean(partial(_occurrences, min_words=min_words)), schema), "lines")
    found = told.where("line is not null").drop("counts")
    weights, total = word_weights(told.where("counts is not null").select("counts"))
    grams = partial(_packed, weights=weights, similarity=similarity, min_words=min_words, buckets=max(256, total // BUCKET))
    packed = texts.mapInArrow(lean(grams), "bucket long, sure boolean, keys binary, lines binary, before binary, after binary")
    packed = packed.repartition("bucket").sortWithinPartitions("bucket")
    met = packed.mapInArrow(lean(partial(_shared, similarity=similarity)), "doc_id long, group long, often boolean, n long, x long")
    met = written_once(met, "line-grams")
    # A line of several pieces of text is filed by each of them.
    often = written_once(met.where("often").select("doc_id", "group").distinct(), "line-grams-often")
    filed = met.where("doc_id is not null and not often").select("doc_id", "group").unionByName(often)
    # Lines that share no gram have no similar line.
    some = written_once(filed.select(F.col("doc_id").alias("line")).distinct(), "lines-filed")
    # A place where the line stands: any, but one. Minima of single numbers are kept in hash tables, those of structs are sorted for.
    place, described = ["doc_id", "mark", "line_no"], [*_SKETCHES, "n_words"]
    classes = found.join(bounded_broadcast(some, 1 << 20), "line").withColumn("by", F.xxhash64(*place))
    classes = classes.groupBy("line").agg(*[F.min_by(c, "by").alias(c) for c in place], *[F.min(c).alias(c) for c in described])
    classes = written_once(classes, "line-classes")
    held = often.groupBy("group").agg(F.count("*").alias("n"), F.bit_xor("doc_id").alias("x"))
    held = held.unionByName(met.where("doc_id is null").select("group", "n", "x"))
    # Grams with the same holders ask for the same comparisons; one of them is enough.
    chosen = written_once(held.groupBy("n", "x").agg(F.min("group").alias("group")).select("group", "n"), "line-keys")
    holders = filed.join(bounded_broadcast(chosen, 1 << 20), "group")
    holders = holders.join(classes.select(F.col("line").alias("doc_id"), *described), "doc_id")
    long = found.where(f"n_words > {TALLIED}").groupBy(F.col("line").alias("doc_id")).agg(F.min("tally").alias("tally"))
    holders = holders.join(long, "doc_id", "left")
    look, look_side_by_side = (partial(f, similarity=similarity) for f in (_near_lines, _near_line_pairs))
    near = in_blocks(holders, f"ceil(n / {HOLDERS})", [*described, "tally"], look, look_side_by_side)
    clusters = components(near).select(F.col("node").alias("line"), F.col("component").alias("group"))

    members = written_once(classes.join(clusters, "line"), "line-clusters")
    wanted = members.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("line_no", "line")).alias("lines"))  # lines of one text
    wanted = bounded_broadcast(written_once(wanted, "line-texts"), NUMBERS, 2 * F.size("lines") + 3)
    # A document read again gives the same lines again.
    sequences = texts.join(wanted, ["doc_id", "mark"]).select("doc_id", "text", "lines").mapInArrow(lean(_sequences), "doc_id long, words binary")
    own = members.select(F.col("line").alias("doc_id"), "group")
    load = members.groupBy("group").agg(F.sum("n_words").alias("load"))
    rows = sequences.dropDuplicates(["doc_id"]).join(own, "doc_id").join(load, "group")
    look, look_side_by_side = (partial(f, similarity=similarity) for f in (_similar_lines, _similar_line_pairs))
    links = in_blocks(rows, f"ceil(load / {WORDS})", ["words"], look, look_side_by_side)
    return found, components(links).select(F.col("node").alias("line"), "component")


def removable(docs: DataFrame, similarity: float = 0.8, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, mark, removed): the numbers of the lines of each text that repeat a line kept elsewhere."""
    found, linked = line_groups(docs, similarity, max(min_words, 1))
    # Only lines that stand twice or are linked can lose a place.
    again = found.groupBy("line").agg(F.count("*").alias("n")).where("n > 1").select("line").join(linked, "line", "full")
    again = bounded_broadcast(written_once(again, "lines-again"), NUMBERS, F.lit(2))
    fuzzy = F.col("component").isNotNull()
    grouped = found.join(again, "line").select(
        "doc_id",
        "mark",
        "line_no",
        F.coalesce("component", "line").alias("a"),
        F.when(fuzzy, 0).otherwise(F.col("check")).alias("b"),  # equal lines that are linked to no other one: by both hashes
    )
    grouped = written_once(grouped, "lines-grouped")
    place = F.struct("doc_id", "mark", "line_no")
    kept = grouped.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").drop("last")
    again = grouped.join(kept, ["a", "b"]).where(place != F.col("first"))
    return again.groupBy("doc_id", "mark").agg(F.collect_set("line_no").alias("removed"))  # lines of one text


def deduplicate_lines(docs: DataFrame, similarity: float = 0.8, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with its text cleared of repeated lines, and how many lines it had and lost.

    The added columns are ``lines_before`` and ``lines_removed``. Lines of fewer than ``min_words`` words are not looked at.
    """
    removed = removable(docs, similarity, min_words).withColumnsRenamed({"doc_id": "_told_id", "mark": "_told_mark", "removed": "_removed"})
    removed = bounded_broadcast(written_once(removed, "removed-lines"), NUMBERS, F.size("_removed") + 3)
    joined = docs.join(removed, same_row(docs, "_told_id", "_told_mark"), "left")
    lines, gone = F.split(docs["text"], "\n", -1), F.col("_removed")
    left = F.filter(lines, lambda _, i: ~F.array_contains(gone, i.cast("long")))
    text = F.when(gone.isNull(), docs["text"]).otherwise(F.array_join(left, "\n"))
    # Line ends are counted by bytes; only a text that loses lines is cut.
    ends = F.octet_length(docs["text"]) - F.octet_length(F.replace(docs["text"], F.lit("\n"), F.lit("")))
    counts = [
        F.when(docs["text"] != "", ends + 1).otherwise(0).cast("long").alias("lines_before"),
        F.when(gone.isNull(), 0).otherwise(F.size(gone)).cast("long").alias("lines_removed"),
    ]
    return joined.select(*[text.alias("text") if c == "text" else docs[c] for c in docs.columns], *counts)
