"""Words, token ids, packing and Huffman files."""

import random

import numpy as np
import plain
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tamiz.llm import huffman, packing, words
from tamiz.llm.tokens import Encoder

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ["", " ", "\n", "  a  b\n\nc ", "a\tb　c\xa0d", "It's we'll 'S Don'T", "é xΣΑΣ İs", "<|endoftext|> x"]
ODD += ["a\r\nb\r\n", "日本 \U0001f389\U0001f389", "\x1c a\x1fb", "x y z\u0085w", "1234 56.7 !!??", "a \n b", "x" * 3000]
SCHEMA = "doc_id long, text string, part int, place long, tie string, n long"


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ids_are_the_library_s(path):
    encoder = Encoder(path)
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("ab \xe9\n\t .,'sS1 \xdf́Σ") for _ in range(rng.randint(0, 14))) for _ in range(400)]
    got = [x.tolist() for x in encoder.column(pa.array(texts))]
    encoder.tokenizer.encode_special_tokens = True
    assert got == [x.ids for x in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_table_of_pieces_starts_anew_when_full(monkeypatch):
    monkeypatch.setattr("tamiz.llm.tokens.REMEMBERED", 5)
    encoder = Encoder(BYTES)
    for text in ("a b c d", "c d e f g", "a b c d e f g h i"):
        assert encoder.encode(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB \n\t.\xe9", max_size=20), max_size=6))
def test_shingles(texts):
    names = {}
    lists = [x.tolist() for _, _, w in words.words_of(pa.array(texts, pa.string())) for x in w.shingle_lists(3)]
    for text, hashes in zip(texts, lists, strict=True):
        own = plain.words(text)
        expected = [tuple(own[i : i + 3]) for i in range(max(1, len(own) - 2))] if own else []
        assert [names.setdefault(h, s) for h, s in zip(hashes, expected, strict=True)] == expected
    assert len(set(names.values())) == len(names)


def best_cost(x, penalty, length, per_sequence):
    best = [0] + [None] * (len(x) - 1)
    for j in range(1, len(x)):
        for i in range(j):
            size = x[j] - x[i]
            if size <= length:
                cost = best[i] + per_sequence + penalty[j] + (0 if size & (size - 1) == 0 else length - size)
                best[j] = cost if best[j] is None else min(best[j], cost)
    return best[-1]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 7), min_size=1, max_size=30), st.integers(0, 5), st.randoms())
def test_cuts_are_the_cheapest(steps, per_sequence, rng):
    x = np.cumsum([0, *steps])
    penalty = np.array([0] + [rng.randint(0, 6) for _ in steps])
    chosen = packing.cuts(x, penalty, 16, per_sequence)
    assert chosen[0] == 0 and chosen[-1] == len(x) - 1
    cost = 0
    for i, j in zip(chosen[:-1], chosen[1:], strict=True):
        size = x[j] - x[i]
        assert 0 < size <= 16
        cost += per_sequence + penalty[j] + (0 if size & (size - 1) == 0 else 16 - size)
    assert cost == best_cost(x.tolist(), penalty.tolist(), 16, per_sequence)


def packed(df):
    rows = packing.pack(df, BYTES, end_id=1).collect()
    sequences, pieces = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.sequence_tokens))
        pieces.setdefault(r.doc_id, []).append(r)
    for parts in sequences.values():
        at = 0
        for offset, length, total in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == total <= 2048
    assert sorted(sequences) == list(range(len(sequences)))
    return sequences, pieces


def test_packing_documents(spark, documents):
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    sequences, pieces = packed(documents)
    tokens = padding = 0
    for (doc_id, _), ids in zip(docs, plain.token_ids("byte_bpe_50k.json", [t for _, t in docs], 1), strict=True):
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == plain.crc(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        size = sum(n for _, n, _ in parts)
        tokens += size
        padding += 0 if size & (size - 1) == 0 else 2048 - size
    assert padding < 0.03 * tokens


def test_packing_edges(spark):
    rows = [(3, "a b", 1, 2, "t", 3), (3, "a b", 1, 2, "t", 3), (1, None, None, None, None, None), (None, "x.", 0, 0, "", 0), (2, "", 0, 0, "", 0)]
    rows.append((9, "Long words. " * 9000, 0, 0, "", 0))
    _, pieces = packed(spark.createDataFrame(rows, SCHEMA))
    assert sum(r.length for r in pieces[3]) == 2 * 3
    assert [r.doc_tokens for r in pieces[1]] == [1] and [r.doc_tokens for r in pieces[2]] == [1]
    assert [r.doc_tokens for r in pieces[None]] == [3]
    assert sum(r.length for r in pieces[9]) == pieces[9][0].doc_tokens > 20_000
    assert packed(spark.createDataFrame([], SCHEMA)) == ({}, {})


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=2, max_size=40), st.integers(6, 12))
def test_code_lengths_are_optimal(counts, limit):
    lengths = huffman.code_lengths(np.array(counts), limit)
    present = [c for c in counts if c]
    assert all((n > 0) == (c > 0) for n, c in zip(lengths, counts, strict=True)) and max(lengths, default=0) <= limit
    if len(present) > 1:
        assert sum(2.0 ** -int(n) for n in lengths if n) == 1
        if limit == 12 and len(present) <= 12:  # no limit binds: plain Huffman
            heap, cost = sorted(present), 0
            while len(heap) > 1:
                both = heap[0] + heap[1]
                cost += both
                heap = sorted([*heap[2:], both])
            assert cost == sum(int(n) * c for n, c in zip(lengths, counts, strict=True))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), min_size=1, max_size=700), min_size=1, max_size=5))
def test_blocks_decode(blocks):
    arrays = [np.array(b) for b in blocks]
    lengths = huffman.code_lengths(np.bincount(np.concatenate(arrays), minlength=64), 8)
    coded = [huffman.encode(a, lengths, huffman.code_words(lengths)) for a in arrays]
    got = huffman.decode([p for p, _ in coded], [c for _, c in coded], np.array([len(a) for a in arrays]), huffman.decode_table(lengths))
    assert got.tolist() == np.concatenate(arrays).tolist()


def test_code_is_limited_for_steep_counts():
    counts = np.array([1 << min(i, 60) for i in range(40)])
    assert huffman.code_lengths(counts, 8).max() == 8


def test_huffman_files(spark, documents, monkeypatch):
    monkeypatch.setattr(huffman, "BLOCK", 4096)
    docs = sorted((r.doc_id, r.text) for r in documents.select("doc_id", "text").collect())
    before, expected = 0, []
    for (doc_id, _), ids in zip(docs, plain.token_ids("word_bpe_49k.json", [t for _, t in docs], 2), strict=True):
        expected.append((doc_id, before, len(ids), plain.crc(ids)))
        before += len(ids)
    assert sorted(map(tuple, huffman.round_trip(documents, WORDS, 2).collect())) == expected


def test_huffman_edges(spark):
    rows = [(2, "a b", 1, 2, "t", 3), (2, "a b", 1, 2, "t", 3), (1, None, None, None, None, None), (3, "", 0, 0, "", 0), (4, "word " * 70_000, 0, 0, "", 0)]
    got = sorted(map(tuple, huffman.round_trip(spark.createDataFrame(rows, SCHEMA), WORDS, 2).collect()))
    assert [r[:3] for r in got] == [(1, 0, 1), (2, 1, 3), (2, 4, 3), (3, 7, 1), (4, 8, 70_001)]
    assert huffman.round_trip(spark.createDataFrame([], SCHEMA), WORDS, 2).count() == 0
