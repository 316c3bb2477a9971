"""Prefix trie, SentencePiece ids and importance resampling, against plain versions and the library."""

import hashlib
import random
from time import process_time

import numpy as np
import plain
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tamiz.llm import piecetokens, queries, resampling, turntrie

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def as_text(rows):
    return sorted(rows, key=str)


# Prefix trie


def turns(df):
    tie = F.xxhash64(F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    return [tuple(r) for r in df.select("conv_id", "turn", "role", "text", tie).collect()]


def nodes(df):
    return as_text(tuple(r) for r in df.collect())


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(turntrie, "CHUNK", 3)
    monkeypatch.setattr(turntrie, "PART", 16)


CONVS = "conv_id long, turn long, role string, text string, key int, n string, depth int"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", None) for r in rows], CONVS).repartition(5)


def test_trie_of_odd_conversations(spark, small_parts):
    rng, rows = random.Random(4), []
    for c in [*range(40), None, 55, 57]:
        for t in range(rng.randint(1, 14)):
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice("ua"), rng.choice(["x", "y\xe9", "", None])))
    # Long copies that part late, a conversation of equal rows, and a group of copies that ends at one node.
    rows += [(c, t, "u", f"long {t // 3}") for c, n in ((60, 900), (61, 700), (62, 700)) for t in range(n)]
    rows += [(65, 1, None, "q")] * 50 + [(c, t, "u", "same") for c in range(100, 150) for t in range(4)]
    df = conversations(spark, rows)
    assert nodes(turntrie.rebuilt_trie(df)) == as_text(plain.trie(turns(df)))
    assert nodes(turntrie.prefix_trie(df)) == as_text(plain.trie(turns(df), rebuild=False))


def test_trie_of_turnless_conversations(spark):
    skipped = [c for c in range(1, 40) if c % 5 and plain.zlib.crc32(str(c).encode()) % 9 > 0][:6]
    df = conversations(spark, [(c, 0, "u", "only") for c in skipped])
    expected = plain.trie(turns(df))
    assert nodes(turntrie.rebuilt_trie(df)) == as_text(expected)
    assert expected[0][1:4] == (0, None, len(skipped)) and len(expected) == 1


def test_trie_of_nothing(spark):
    df = conversations(spark, []).where("false")
    assert turntrie.rebuilt_trie(df).collect() == [] and turntrie.prefix_trie(df).collect() == []


# SentencePiece


@pytest.fixture(scope="module")
def table():
    return piecetokens.PieceTable(MODEL)


def ids_of(table, texts):
    out = []
    for i, j, ids, starts in table.column(pa.array(texts, pa.string())):
        out += [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)]
        assert len(out) == j and i <= j
    return out


ODD = ["", " ", "  ", "   a", " " * 40 + "b", " " * 17, "\n\n a\tb", "\u2581a \u2581 \u2581\u2581", "\u65e5\u672c\U0001f389"]
ODD += ["<s>a</s> <unk> <0x0A>", "\x00 a\x00", "1234 5.6", "x" * 5000, "A'S don't  \u3000x", "e\u0301 \ufffd", "ab" * 700]


def test_ids_are_those_of_the_library(table):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("ab  c\n e\u2581itn.,1\xe9\u03a3\u65e5\u0301\U0001f389t") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    got = ids_of(table, texts)
    assert got == table.processor.encode(texts)
    assert table.decode(got) == table.processor.decode(got)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    table = piecetokens.table(MODEL)
    assert ids_of(table, [text]) == [table.processor.encode(text)]


def test_forgetting(monkeypatch):
    monkeypatch.setattr(piecetokens, "STRETCHES", 5)
    monkeypatch.setattr(piecetokens, "PAIRS", 3)
    table = piecetokens.PieceTable(MODEL)
    for text in ("one two three", "three four fives sixes", "a b c d e f g h i j"):
        assert ids_of(table, [text]) == [table.processor.encode(text)]


def test_pieces_of_tables(spark, table):
    rows = [(1, "a b", "x", 1.0), (1, "a b", "y", 2.0), (None, None, None, None), (2, "", "z", 0.0), (3, "\xe9t\xe9 " * 5000, "", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded double")
    out = piecetokens.round_trip(df, MODEL)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    expected = [(r[0], r[1], table.processor.encode(r[1] or "")) for r in rows]
    expected = [(*r, table.processor.decode(r[2])) for r in expected]
    assert as_text(map(tuple, out.collect())) == as_text(expected)
    apart = piecetokens.decode(piecetokens.encode(df, MODEL), MODEL, into="decoded")
    assert as_text(map(tuple, apart.collect())) == as_text(expected)
    assert piecetokens.round_trip(df.where("false"), MODEL).collect() == []


def test_lists_of_ids_are_taken_from_the_flat_ids():
    rows = pa.array([[9], [1, 2], None, [], [3], [4, 5]], pa.list_(pa.int32()))
    for column in (rows, rows.slice(1), rows.slice(2, 2), rows.slice(6)):
        assert piecetokens.id_lists(column) == [x or [] for x in column.to_pylist()]
    many = pa.array([list(range(1000))] * 300, pa.list_(pa.int32()))

    def seconds(work):
        start = process_time()
        work()
        return process_time() - start

    # No Arrow scalar is made of each id.
    assert min(seconds(lambda: piecetokens.id_lists(many)) for _ in range(3)) < 0.5 * min(seconds(many.to_pylist) for _ in range(3))


def test_pieces_query(spark, documents, table):
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    for r in queries.op12_pieces(spark, SF).collect():
        ids = table.processor.encode(texts.pop(r.doc_id))
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(table.processor.decode(ids).encode()).hexdigest()
    assert not texts


# Importance resampling


def test_crc32_of_spans():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    starts = rng.integers(0, 4000, 300)
    ends = starts + rng.integers(0, 900, 300) // rng.choice([1, 40], 300)
    expected = [plain.zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
    assert resampling.crc32_of_spans(data, starts, ends).tolist() == expected
    assert not len(resampling.crc32_of_spans(data, starts[:0], ends[:0]))


@pytest.mark.parametrize("runs", [1, 3])
def test_resampling_of_documents(spark, documents, runs):
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = resampling.resample(documents, target, runs=runs, buckets=500)
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    assert as_text(map(tuple, got.collect())) == as_text(plain.resampled(docs, [r.text for r in target.collect()], runs, 500))


def test_resampling_edges(spark):
    rows = [(1, "a b c " * 9), (1, "a b c d " * 9), (1, "a b c " * 9), (None, "x y " * 20), (None, None), (2**62, "q " * 25), (-(2**62), "q " * 25)]
    rows += [(-5, "x" * 500 + " \xe9 " * 30), (2**33, "Q q " * 13), (3, ""), (4, "... !!"), *((i, "same words " * 12) for i in range(5, 60))]
    df = spark.createDataFrame([(*r, 0, "p", 1) for r in rows], "doc_id long, text string, score int, place string, block int")
    target = spark.createDataFrame([("q same",), (None,)], "text string")
    for percent in (0, 37, 100):
        got = as_text(map(tuple, resampling.resample(df, target, percent=percent).collect()))
        assert got == as_text(plain.resampled(rows, ["q same", ""], percent=percent))
    none = target.where("false")
    assert as_text(map(tuple, resampling.resample(df, none).collect())) == as_text(plain.resampled(rows, []))
    assert resampling.resample(df.where("false"), target).collect() == []


def test_radix_sort(spark):
    rng = random.Random(8)
    rows = [(rng.randint(0, 3) * 2**40 + rng.choice([0, 5, 2**13, 2**26]), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "v long, i long").repartition(7)
    digits = resampling._digits([(F.col("i"), 11), (F.col("v"), 42)])
    out = sorted(resampling.radix_sorted(df, digits, len(rows)).collect(), key=lambda r: r.place)
    assert [r.place for r in out] == list(range(len(rows)))
    assert [(r.v, r.i) for r in out] == sorted(rows)


def test_new_queries_are_registered():
    assert {"op11_trie", "op12_pieces", "op13_resampling"} <= set(queries.QUERIES) and "op11_trie" in queries.ORACLES
