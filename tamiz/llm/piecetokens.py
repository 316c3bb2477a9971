"""SentencePiece ids of whole texts by a merge-type prefix table, and texts from ids.

The model is of the BPE kind: the neighbours whose piece scores best are merged first, the leftmost of equals. Two pieces are
*compatible* if merging the characters of both together ends in just these two. A sequence of pieces is a text's encoding if
and only if all its neighbours are compatible, so each prefix of a text has one last piece: the one that an automaton finds
at the prefix's end and that is compatible with the last piece of what lies before it. The table of last pieces is filled from
left to right and read backwards.

Between two characters that no piece holds side by side no merge can happen; texts are cut there, and a worker computes each
distinct stretch once for as long as its memory of stretches lasts. Characters without a piece become the ids of their bytes.

* a null or empty text has no ids; ids of an empty or null list give the empty text;
* every row of the input gives one row, ids and texts repeated or null alike; an empty table gives an empty result;
* other columns are carried along; a column with the name of the result is replaced;
* a text of any length is encoded whole; it has to fit a worker's memory, with about 30 bytes per byte of text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .words import pieces, span_hashes

#: Stretches that one worker remembers, and the pairs of pieces whose compatibility it does; both are forgotten as a whole.
STRETCHES, PAIRS = 300_000, 500_000
#: Longer stretches are computed each time.
LONGEST = 64
_SPACE = "▁"
_UNKNOWN = -1


class PieceTable:
    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        self.processor = SentencePieceProcessor(model_file=path)
        proto = ModelProto.FromString(self.processor.serialized_model_proto())
        kinds, norm = proto.SentencePiece, proto.normalizer_spec
        if proto.trainer_spec.model_type != proto.trainer_spec.BPE or not proto.trainer_spec.byte_fallback:
            raise ValueError("the prefix table needs a BPE model with byte fallback")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("the prefix table needs a model that leaves texts as they are, but for spaces")
        if proto.trainer_spec.treat_whitespace_as_suffix or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces):
            raise ValueError("user-defined or unused pieces and suffixed spaces are not supported")
        self.prefix = b" " if norm.add_dummy_prefix else b""
        self.texts = [p.piece for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        self.scores = [p.score for p in proto.pieces]
        self.bytes = [0] * 256
        for i, p in enumerate(proto.pieces):
            if p.type == kinds.BYTE:
                self.bytes[int(p.piece[3:5], 16)] = i
        self.whole = {piece: i for piece, i in self.ids.items() if self.merged(piece) == [i]}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.whole.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self._cut = self._cuts()
        self.compatible: dict[tuple[int, int], bool] = {}
        self._forget()

    def _cuts(self) -> np.ndarray:
        """For two bytes: whether a stretch may end between them. A space stands for the mark that pieces have for it."""
        cut = np.zeros((256, 256), dtype=bool)
        cut[:128, :128] = True
        cut[128:, 0x20] = True
        cut[0x81, 0x20] = False  # it may be the last byte of that mark itself
        for piece in self.ids:
            for x, y in zip(piece, piece[1:], strict=False):
                a = 0x20 if x == _SPACE else ord(x)
                b = 0x20 if y == _SPACE else ord(y)
                if b < 128:
                    cut[a if a < 128 else slice(128, 256), b] = False
        return cut

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.found: list[list[int]] = []

    def merged(self, text: str) -> list[int]:
        """The ids of a short text by merging the best neighbours until none is left; used for pairs of pieces only."""
        parts = list(text)
        ids, scores = self.ids, self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = ids.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or scores[piece] > best):
                    best, at = scores[piece], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ids.get(p, _UNKNOWN) for p in parts]

    def fits(self, a: int, b: int) -> bool:
        """Whether two pieces are compatible, worked out and remembered."""
        if len(self.compatible) >= PAIRS:
            self.compatible.clear()
        found = self.compatible[a, b] = self.merged(self.texts[a] + self.texts[b]) == [a, b]
        return found

    def stretch(self, text: str) -> list[int]:
        """The ids of a text in which spaces are marks already."""
        one = self.whole.get(text)
        if one is not None:
            return [one]
        n = len(text)
        last, size = [_UNKNOWN] * (n + 1), [1] * (n + 1)
        compatible, at = self.compatible, 0
        for end, (piece, length) in self.automaton.iter(text):
            # The matches at an end come one after the other; the first that fits is the only one.
            end += 1
            if end == at:
                continue
            before = last[end - length]
            if before != _UNKNOWN:
                fits = compatible.get((before, piece))
                if not (self.fits(before, piece) if fits is None else fits):
                    continue
            at = end
            last[end], size[end] = piece, length
        out: list[int] = []
        while n:
            if last[n] == _UNKNOWN:
                out.extend(self.bytes[x] for x in reversed(text[n - 1].encode()))
            else:
                out.append(last[n])
            n -= size[n]
        out.reverse()
        return out

    def _ids(self, raw: bytes) -> list[int]:
        return self.stretch(raw.decode().replace(" ", _SPACE))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts, one after the other, and where each text's ids start."""
        if not len(data):
            return np.zeros(0, dtype=np.int32), np.zeros(len(offsets), dtype=np.int64)
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[1:-1] = self._cut[data[:-1], data[1:]]
        cut[offsets] = True
        cut[len(data)] = False
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        _, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) + len(first) > STRETCHES:
            self._forget()
        lists = []
        for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True):
            raw = data[a:b].tobytes()
            if b - a > LONGEST:
                lists.append(self._ids(raw))
                continue
            at = self.known.get(raw)
            if at is None:
                at = self.known[raw] = len(self.found)
                self.found.append(self._ids(raw))
            lists.append(self.found[at])
        sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        place = np.cumsum(sizes) - sizes
        pool = np.fromiter(chain.from_iterable(lists), dtype=np.int32, count=int(sizes.sum()))
        lengths = sizes[which]
        upto = np.zeros(len(lengths) + 1, dtype=np.int64)
        np.cumsum(lengths, out=upto[1:])
        ids = pool[np.repeat(place[which] - upto[:-1], lengths) + np.arange(upto[-1])]
        return ids, upto[np.searchsorted(starts, offsets)]

    def column(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, last row + 1, ids, starts) of runs of texts of an Arrow column."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        if self.prefix:
            marked = pc.binary_join_element_wise(pa.scalar(self.prefix, pa.large_binary()), texts, pa.scalar(b"", pa.large_binary()))
            texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, marked)
        for i, j, data, offsets in pieces(texts):
            yield i, j, *self.encode(data, offsets)

    def decode(self, lists: list[list[int]]) -> list[str]:
        return self.processor.decode(lists, num_threads=1) if lists else []


@lru_cache(maxsize=2)
def table(path: str) -> PieceTable:
    """One table per worker process and model."""
    return PieceTable(path)


def id_lists(column: pa.ListArray) -> list[list[int]]:
    """The ids of each row, none for a null. Taken from the flat ids, for ``to_pylist`` makes a scalar object of each id first."""
    flat = column.flatten().to_numpy().tolist()
    ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy()).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), column], names=[*kept, name])


def _encoded(batches: Iterable[pa.RecordBatch], path: str, text: str, into: str, decoded: str | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, ids, starts in table(path).column(batch.column(text)):
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))
            out = _with(batch.slice(i, j - i), into, lists)
            yield out if decoded is None else _with(out, decoded, pa.array(table(path).decode(id_lists(lists)), pa.string()))


def _decoded(batches: Iterable[pa.RecordBatch], path: str, ids: str, into: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _with(batch, into, pa.array(table(path).decode(id_lists(batch.column(ids))), pa.string()))


def _schema(df: DataFrame, *more: T.StructField) -> T.StructType:
    names = {f.name for f in more}
    return T.StructType([f for f in df.schema.fields if f.name not in names] + list(more))


_IDS = T.ArrayType(T.IntegerType(), containsNull=False)


def encode(df: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``df`` with the ids of each row's text; no shuffle. ``path``: the model file, at the same place on every executor."""
    return df.mapInArrow(partial(_encoded, path=path, text=text, into=into, decoded=None), _schema(df, T.StructField(into, _IDS)))


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """``df`` with the text of each row's ids, as the model's library gives it."""
    return df.mapInArrow(partial(_decoded, path=path, ids=ids, into=into), _schema(df, T.StructField(into, T.StringType())))


def round_trip(df: DataFrame, path: str, text: str = "text", into: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``decode(encode(df))`` in one pass, so that the ids are not handed over twice."""
    more = T.StructField(into, _IDS), T.StructField(decoded, T.StringType())
    return df.mapInArrow(partial(_encoded, path=path, text=text, into=into, decoded=decoded), _schema(df, *more))
