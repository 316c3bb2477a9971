"""Token ids of whole texts by the ``tokenizers`` library, with the merges of each distinct word done once per worker.

Merging dominates the cost of encoding, and words repeat. A text is cut at each single space or line end between two other
characters, which is always a boundary between pre-tokens. The pieces of a batch are told apart by a 64-bit hash, looked up
in a table of the pieces met so far, and only an unseen one goes through the library's own normaliser, pre-tokeniser and
model. The ids are those of ``Tokenizer.encode`` on the whole text. Strings of special tokens in a text are ordinary
text. The table is emptied when full, so memory is bounded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from .words import pieces, span_hashes

#: Pieces remembered by one worker, at 16 bytes each, and their ids, at 2 or 4 bytes each.
REMEMBERED, POOL = 2_000_000, 16_000_000
#: Letters of one run and the punctuation after it: two pre-tokens in every vocabulary that PROBES agree with.
_plain = re.compile("( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")
PROBES = (" a", " The", "thing,", " Word.", " été", "Ünd!!", " ZÿÀ?", " don", "s.", " re", " ll:;", " ÖÐþ.")

_white = np.zeros(256, dtype=bool)
_white[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
#: First bytes of white space beyond ASCII: of two bytes, and of three.
_lead2, _lead3 = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_lead2[0xC2] = True
_lead3[[0xE1, 0xE2, 0xE3]] = True


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces start. Beside a character that may be white space no cut is made; a longer piece is right as well."""
    at = np.flatnonzero((data == 0x20) | (data == 0x0A))
    at = at[(at > 2) & (at < len(data) - 1)]
    before, after = data[at - 1], data[at + 1]
    even = ~(_white[before] | _white[after] | _lead2[after] | _lead3[after] | _lead2[data[at - 2]] | _lead3[data[at - 3]])
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[at[even]] = True
    # A separator at the edge of a text is not between two characters of it.
    cut[offsets[1:][offsets[1:] > 0] - 1] = False
    cut[offsets[:-1]] = True
    cut[len(data)] = False
    return np.flatnonzero(cut)


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.size = tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.normalizer, self.splitter, self.model = tokenizer.normalizer, tokenizer.pre_tokenizer, tokenizer.model
        self.tokenizer = tokenizer
        # How the splitter writes a letter, and a space before a word (nothing, if it drops white space).
        letters = [chr(c) for c in (*range(0x21, 0x7F), *range(0xC0, 0x100))]
        written = {c: self.splitter.pre_tokenize_str(c)[0][0] for c in letters}
        self.written = str.maketrans({c: w for c, w in written.items() if c != w})
        self.space = self.splitter.pre_tokenize_str(" a")[0][0].removesuffix("a")
        self.lower = self.normalizer is not None and self.normalizer.normalize_str("A") == "a"
        self.plain = all(self._simple(_plain.fullmatch(x)) == self._any(x) for x in PROBES)
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.place = np.zeros(0, dtype=np.uint32)
        self.length = np.zeros(0, dtype=np.uint32)
        self.pool = np.zeros(0, dtype=self.dtype)

    def _ids(self, word: str) -> list[int]:
        return [t.id for t in self.model.tokenize(word)]

    def _any(self, text: str) -> list[int]:
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        return [i for word, _ in self.splitter.pre_tokenize_str(text) for i in self._ids(word)]

    def _simple(self, match: re.Match) -> list[int]:
        """The same for a plain piece, without the splitter."""
        space, word, after = match.groups()
        word = word.lower() if self.lower else word
        word = word if word.isascii() else word.translate(self.written)
        ids = self._ids(self.space + word if space else word)
        return ids + self._ids(after) if after else ids

    def _learn(self, hashes: np.ndarray, texts: list[bytes]) -> None:
        """Adds pieces, whose hashes are sorted, to the table."""
        lists = []
        for raw in texts:
            text = raw.decode()
            match = _plain.fullmatch(text) if self.plain else None
            lists.append(self._any(text) if match is None else self._simple(match))
        lengths = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        at = len(self.pool) + np.cumsum(lengths) - lengths
        flat = np.fromiter((i for x in lists for i in x), dtype=self.dtype, count=int(lengths.sum()))
        self.pool = np.concatenate([self.pool, flat])
        where = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, where, hashes)
        self.place = np.insert(self.place, where, at.astype(np.uint32))
        self.length = np.insert(self.length, where, lengths.astype(np.uint32))

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, dtype=self.dtype), np.zeros(len(offsets), dtype=np.int64)
        starts = _cuts(data, offsets)
        ends = np.append(starts[1:], len(data))
        distinct, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        new = np.ones(len(distinct), dtype=bool)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, distinct), len(self.known) - 1)
            new = self.known[at] != distinct
        if len(self.known) + new.sum() > REMEMBERED or len(self.pool) > POOL:
            self._forget()
            new[:] = True
        if new.any():
            texts = [data[a:b].tobytes() for a, b in zip(starts[first[new]], ends[first[new]], strict=True)]
            self._learn(distinct[new], texts)
        at = np.searchsorted(self.known, distinct)
        lengths = self.length[at].astype(np.int64)[which]
        upto = np.zeros(len(lengths) + 1, dtype=np.int64)
        np.cumsum(lengths, out=upto[1:])
        ids = self.pool[np.repeat(self.place[at].astype(np.int64)[which] - upto[:-1], lengths) + np.arange(upto[-1])]
        return ids, upto[np.searchsorted(starts, offsets)]

    def column(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text of an Arrow column; a null counts as empty."""
        for _, _, data, offsets in pieces(texts):
            ids, bounds = self._encode(data, offsets)
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                yield ids[a:b]

    def encode(self, text: str | None) -> np.ndarray:
        return next(self.column(pa.array([text], pa.string())))

    def string(self, index: int) -> str:
        return self.tokenizer.decode([index], skip_special_tokens=False)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(path)
