"""The operators on documents against plain versions, and on awkward tables."""

import hashlib
import math
import random
import re

import corpus_pipeline
import numpy as np
import plain
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tamiz.llm import components, decontaminate, fingerprints, lines, neardup, quality, queries, sharding, suffixes
from tamiz.llm.words import LETTERS, Words

#: Names that the operators use themselves.
EXTRA = "group string, part int, line string, tie int, n int, keys int, n_chars long, lang string, source string, shard string"
SCHEMA = f"doc_id long, text string, {EXTRA}"


def table(spark, rows):
    return spark.createDataFrame([(*r, "g", 1, "l", 2, 3, 4, 5, None, None, "s") for r in rows], SCHEMA)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# --- components ----------------------------------------------------------------------------------------------------


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(7, 7)]
    groups = plain.Sets({x for e in edges for x in e})
    for a, b in edges:
        groups.join(a, b)
    linked = {x for e in edges if e[0] != e[1] for x in e}
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, groups.find(x)) for x in linked)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize(("part", "most"), [(1 << 20, 1), (50, 9)])
def test_edges_are_connected_in_parts_before_the_rounds(spark, monkeypatch, part, most):
    """A long path that fits into a task needs one round, which changes nothing; in parts it gives the same."""
    monkeypatch.setattr(components, "PART", part, raising=False)
    rounds, star = [], components._large_star
    monkeypatch.setattr(components, "_large_star", lambda edges: (rounds.append(1), star(edges))[1])
    path = list(range(0, 300, 2)) + list(range(1, 300, 2))
    edges = spark.createDataFrame(list(zip(path, path[1:], strict=False)), "a long, b long")
    got = components.components(edges).collect()
    assert {tuple(r) for r in got} == {(i, 0) for i in range(300)} and len(got) == 300 and len(rounds) <= most


# --- passages ------------------------------------------------------------------------------------------------------


def spans(df, least=50, gram=20):
    return sorted((r.doc_id, r.start_word, r.n_words) for r in suffixes.repeated_passages(df, least, gram).collect())


def test_passages(spark, documents):
    assert spans(documents) == sorted(plain.repeated(texts(documents)))


@pytest.mark.parametrize("seed", range(6))
def test_passages_between_frequent_halves(spark, seed):
    """Two documents share a passage whose first and last words many others have: no neighbour in either order is the partner."""
    rng = random.Random(seed)
    passage = prose(900 + seed, 60).split()
    own = iter(range(10_000, 20_000))
    around = lambda words: " ".join([prose(next(own), 25), *words, prose(next(own), 25)])
    rows = [around(passage) for _ in range(2)]
    rows += [around(passage[:45]) for _ in range(12)] + [around(passage[-45:]) for _ in range(12)]
    rng.shuffle(rows)
    docs = list(enumerate(rows))
    assert spans(table(spark, docs).repartition(3)) == sorted(plain.repeated(docs)) != []


def test_documents_of_frequent_lines(spark):
    """Lines of 17 words in varying order: passages over three of them."""
    rng = random.Random(5)
    lines_of = [prose(800 + i, 17) for i in range(6)]
    docs = [(i, "\n".join(rng.sample(lines_of, 4))) for i in range(40)]
    assert spans(table(spark, docs).repartition(4)) == sorted(plain.repeated(docs)) != []


def test_passages_share_and_edges(spark):
    shared, other = prose(1, 60), prose(2, 52)
    rows = [(i, f"{prose(10 + i, 40)} {shared} {prose(50 + i, 30)}") for i in range(12)]
    rows += [(20, f"{other} {prose(90, 5)} {other}"), (21, prose(91, 49)), (22, prose(91, 49)), (23, None), (24, ""), (25, " \n ")]
    rows += [(26, prose(92, 30)), (26, prose(92, 30))]
    df = table(spark, rows).repartition(7)
    expected = plain.repeated([(i, t) for i, t in rows if i != 26])
    assert spans(df) == sorted(expected)
    assert (20, 0, 52) in expected and {r[0] for r in expected} == {*range(12), 20}
    assert spans(table(spark, [])) == []


def test_texts_of_one_id_keep_their_own_positions(spark):
    shared, line = prose(3, 55), prose(4, 12)
    rows = [(None, f"{prose(5, 300)} {shared}"), (None, prose(6, 60)), (None, None), (7, f"{prose(7, 200)} {shared}"), (7, prose(8, 52))]
    # In one partition the short texts stand at the end, where positions of the long ones are out of range.
    df = table(spark, rows).coalesce(1)
    assert [(r[0] or 0, *r[1:]) for r in spark_rows(suffixes.repeated_passages(df))] == [(0, 300, 55), (7, 200, 55)]
    rows = [(1, f"{prose(9, 5)}\n\n\n{line}"), (1, "one line"), (2, f"{line} more")]
    assert {r.lines_removed for r in lines.deduplicate_lines(table(spark, rows).coalesce(1)).collect() if r.doc_id == 2} == {1}


def spark_rows(df):
    return sorted(((r.doc_id, r.start_word, r.n_words) for r in df.collect()), key=lambda r: (r[0] is not None, r))


# --- near-duplicates ------------------------------------------------------------------------------------------------


def near(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect()}


def test_near_duplicates(spark, documents):
    docs = texts(documents)
    groups = plain.near_components(docs)
    assert near(documents) == {i: (len(plain.shingles(t)), groups[i], groups[i] == i) for i, t in docs}


def variants(n, size=150, most=9):
    rng, base = random.Random(4), prose(7, size).split()
    out = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.randrange(most)):
            own[rng.randrange(size)] = f"edit{i}"
        out.append((1000 + i, " ".join(own)))
    return out


@pytest.mark.parametrize("blocks", [(2048, 1 << 20), (16, 4000)])
def test_a_large_group_is_compared_in_blocks(spark, monkeypatch, blocks):
    monkeypatch.setattr(neardup, "HOLDERS", blocks[0])
    monkeypatch.setattr(neardup, "SHINGLES", blocks[1])
    rows = variants(120)
    groups = plain.near_components(rows)
    assert {i: v[1] for i, v in near(table(spark, rows)).items()} == groups
    assert 1 < len(set(groups.values())) < 120


def test_near_duplicates_edges(spark):
    rows = [(1, None), (2, None), (3, ""), (4, " \t"), (5, "a b"), (6, "A  b"), (7, prose(1, 90)), (7, prose(1, 90)), (8, prose(1, 90) + " x")]
    rows += [(None, prose(1, 90)), (9, prose(3, 30_000))]
    got = neardup.near_duplicates(table(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == {
        1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (0, 4), 5: (1, 5), 6: (1, 5), 7: (86, 7), 8: (87, 7), 9: (29996, 9)
    }
    kept = neardup.representatives(table(spark, rows))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [1, 2, 3, 4, 5, 7, 9] and kept.columns == table(spark, []).columns
    assert neardup.near_duplicates(table(spark, [])).count() == 0 and neardup.representatives(table(spark, [])).count() == 0


def test_rows_of_one_doc_id_are_judged_by_their_texts(spark):
    one, other, third = prose(1, 90), prose(2, 90), prose(3, 90)
    rows = [(1, one), (1, other), (1, other), (2, one + " x"), (3, other), (None, third), (None, third), (None, prose(4, 90)), (5, third + " y")]
    kept = sorted((r.doc_id or 0, r.text) for r in neardup.representatives(table(spark, rows)).collect())
    assert kept == sorted([(1, one), (1, other), (0, prose(4, 90)), (5, third + " y")])
    found = {(r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(table(spark, rows)).collect()}
    assert found == {(1, 1, True), (2, 1, False), (3, 1, False), (None, 5, False), (None, None, True), (5, 5, True)}


def test_pairs_of_small_groups(monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 5)
    for at_once in (1, 7, 1 << 19):
        monkeypatch.setattr(neardup, "AT_ONCE", at_once)
        cuts = np.array([0, 3, 4, 10, 12, 14])
        side = np.array([0] * 10 + [0, 1, 2, 2])
        small, pairs = neardup.small_groups(cuts, side)
        assert small.tolist() == [True, True, False, False, True]
        assert [p for i, j in pairs for p in zip(i.tolist(), j.tolist(), strict=True)] == [(0, 1), (0, 2), (1, 2), (12, 13)]
        large, none = neardup.small_groups(np.array([0, 9]), np.zeros(9, dtype=int))
        assert not large.any() and not list(none)
    assert [x.tolist() for x in neardup.stars(np.array([4, 2, 1]), np.array([5, 4, 3]), 7)] == [[3, 4, 5], [1, 2, 2]]


def test_signatures_within_the_distance_share_a_key():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = rng.integers(0, 1 << 16, neardup.SYMBOLS, dtype=np.uint16)
        b = a.copy()
        at = rng.choice(neardup.SYMBOLS, neardup.DISTANCE, replace=False)
        b[at] ^= rng.integers(1, 1 << 16, neardup.DISTANCE, dtype=np.uint16)
        assert set(neardup.keys_of(a)) & set(neardup.keys_of(b))


def test_the_pipeline_links_pairs_from_80_percent(spark):
    base = prose(21, 140).split()
    two, three = list(base), list(base)
    two[60], two[100] = "edit", "edit"  # 126 of 146 shingles
    three[40], three[90], three[120] = "note", "note", "note"  # 121 of 151
    rows = [(i, prose(30 + i, 140)) for i in range(5)] + [(20 + i, " ".join(x)) for i, x in enumerate((base, two, three))]
    wide, narrow = plain.near_components(rows, 80), plain.near_components(rows, 85)
    assert wide != narrow
    kept = corpus_pipeline.drop_near_duplicates(spark, table(spark, rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in wide if wide[i] == i)


def test_limits_follow_the_similarity():
    assert neardup.limits(85) == (12, 23) and neardup.limits(80) == (15, 28)
    rng, (chunks, distance) = np.random.default_rng(2), neardup.limits(80)
    for _ in range(300):
        a = rng.integers(0, 1 << 16, neardup.SYMBOLS, dtype=np.uint16)
        b = a.copy()
        b[rng.choice(neardup.SYMBOLS, distance, replace=False)] ^= np.uint16(1)
        assert set(neardup.keys_of(a, chunks)) & set(neardup.keys_of(b, chunks))


# --- lines ---------------------------------------------------------------------------------------------------------


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2))
        assert lines.edit_distance(a, b) == plain.edit_distance(a, b)


WORDS_OF_LINE = re.compile("[0-9a-z\x80-\U0010ffff]+")


def test_lines(spark, documents):
    """All equal lines go but the first; what else goes is similar to a line that stays or went."""
    docs = sorted(texts(documents))
    got = {r.doc_id: r for r in lines.deduplicate_lines(documents).collect()}
    seen, gone = {}, []
    for i, text in docs:
        left, out = got[i].text.split("\n"), 0
        for line in text.split("\n"):
            norm = tuple(WORDS_OF_LINE.findall(line.translate(plain.LOWER)))
            stays = bool(left) and left[0] == line and (not norm or norm not in seen)
            if stays:
                left.pop(0)
            else:
                out += 1
                if norm not in seen:
                    gone.append(norm)
            if norm:
                seen.setdefault(norm, i)
        assert left in ([], [""]) and out == got[i].lines_removed and got[i].lines_before == len(text.split("\n"))
    for norm in gone:
        close = (s for s in seen if s != norm and abs(len(s) - len(norm)) <= 0.2 * max(len(s), len(norm)))
        assert any(plain.edit_distance(norm, s) <= 0.2 * max(len(s), len(norm)) for s in close)


def test_lines_edges(spark):
    long = prose(5, 60)
    fuzzy = f"{long} {long.split()[7]}"  # the same distinct words
    rows = [(1, f"{long}\nx y\n\n"), (2, f"x y\n{long.upper()}!\nnew words here"), (3, fuzzy), (4, None), (5, ""), (None, long)]
    rows += [(6, "one two three"), (6, "one two three"), (7, "--- \n--- \n---")]
    df = table(spark, rows)
    out = lines.deduplicate_lines(df)
    assert out.columns == [*df.columns, "lines_before", "lines_removed"]
    got = sorted(((r.doc_id or 0, r.text, r.lines_before, r.lines_removed) for r in out.collect()), key=str)
    assert got == sorted(
        [(1, f"{long}\nx y\n\n", 4, 0), (2, "new words here", 3, 2), (3, "", 1, 1), (4, None, 0, 0), (5, "", 0, 0), (0, long, 1, 0)]
        + [(6, "one two three", 1, 0)] * 2
        + [(7, "--- \n--- \n---", 3, 0)],
        key=str,
    )
    assert lines.deduplicate_lines(table(spark, [])).count() == 0
    short = {r.doc_id: r.text for r in lines.deduplicate_lines(df, min_words=3).collect()}
    assert short[2] == "x y\nnew words here"


def test_lines_of_texts_that_share_a_doc_id(spark):
    """A line belongs to its text: what one text of a doc_id loses does not depend on the other's line numbers."""
    rows = [(1, "first line here\nsecond line there"), (2, "other words stand\nsecond line there"), (2, "second line there\nmore of it")]
    rows += [(2, "second line there\nmore of it"), (3, "more of it\nthe last one")]
    out = lines.deduplicate_lines(table(spark, rows)).collect()
    assert sorted((r.doc_id, r.text, r.lines_removed) for r in out) == [
        (1, rows[0][1], 0), (2, "more of it", 1), (2, "more of it", 1), (2, "other words stand", 1), (3, "the last one", 1)
    ]


def edited_lines(seed, n):
    """Lines of 4 to 45 words in families: each line differs from one before it in up to a quarter of its words."""
    rng, out = random.Random(seed), []
    vocabulary = prose(seed, 400).split()
    for _ in range(n):
        own = rng.choices(vocabulary, k=rng.randrange(4, 46))
        out.append(own)
        for _ in range(rng.randrange(4)):
            own = list(own)
            for _ in range(rng.randrange(1, 1 + max(1, len(own) // 4))):
                at, kind = rng.randrange(len(own)), rng.randrange(3)
                own[at : at + (kind != 0)] = [rng.choice(vocabulary)] if kind != 1 else []
            out.append(own)
    return [tuple(x) for x in out if len(x) >= 3]


@pytest.mark.parametrize("often", [32, 1])
def test_every_pair_of_similar_lines_is_found(spark, monkeypatch, often):
    """The groups of lines are those of a comparison of all pairs at an edit similarity of 0.8."""
    monkeypatch.setattr(lines, "OFTEN", often, raising=False)
    found = sorted(set(edited_lines(11, 150)))
    groups = plain.Sets(range(len(found)))
    for a in range(len(found)):
        for b in range(a + 1, len(found)):
            longer = max(len(found[a]), len(found[b]))
            if 5 * abs(len(found[a]) - len(found[b])) <= longer and 5 * plain.edit_distance(found[a], found[b]) <= longer:
                groups.join(a, b)
    assert len({groups.find(i) for i in range(len(found))}) < 0.8 * len(found)
    df = table(spark, [(i, " ".join(x)) for i, x in enumerate(found)]).repartition(5)
    out = {r.doc_id: r.lines_removed for r in lines.deduplicate_lines(df).collect()}
    assert out == {i: int(groups.find(i) != i) for i in range(len(found))}


def test_lines_are_filed_under_few_grams():
    """What is shuffled to find similar lines takes less than six bytes a word."""
    texts = pa.array(["\n".join(" ".join(f"w{(i * 40 + j) * 7919 % 100003}" for j in range(40)) for i in range(500))])
    batch = pa.RecordBatch.from_arrays([pa.array([1]), texts], names=["doc_id", "text"])
    packed = list(lines._packed([batch], weights=np.zeros(lines.CLASSES, np.uint8), similarity=0.8, min_words=1, buckets=16))
    size = sum(len(x) for out in packed for row in out.to_pylist() for x in (row["keys"], row["lines"]))
    assert 0 < size < 6 * 500 * 40


def test_the_grams_of_a_size_are_reckoned_once():
    for similarity in (0.8, 0.7, 0.95):
        for n, k in ((n, k) for n in (*range(1, 60), 500, 4001) for k in (1, 2)):
            longer = ((x, lines._edits(x, similarity)) for x in range(n, lines._longest(n, similarity) + 1))
            most = max((n - x + k * d + 1 for x, d in longer if d and (2 if x - 1 - 2 * d > 0 else 1) == k), default=0)
            assert lines._filed(n, k, similarity) == max(most, 0)
    sizes = np.arange(1, 200)
    last = np.cumsum(sizes)
    hashes, weights = np.arange(last[-1], dtype=np.uint64), np.zeros(lines.CLASSES, np.uint8)
    lines.line_grams(hashes, last - sizes, last, weights, 0.8)
    before = lines._filed.cache_info().misses
    lines.line_grams(hashes, last - sizes, last, weights, 0.8)
    assert lines._filed.cache_info().misses == before


def test_two_lines_are_compared_without_an_index_of_their_words(monkeypatch):
    monkeypatch.setattr(lines, "overlaps", None)
    rng = random.Random(3)
    for sides in (np.array([0, 0]), np.array([0, 1])):
        for _ in range(500):
            a = [rng.randrange(6) for _ in range(rng.randrange(1, 12))]
            b = [x if rng.random() < 0.85 else rng.randrange(6) for x in a] + [9] * rng.randrange(3)
            rows = {"words": [np.array(x, dtype=np.uint64).tobytes() for x in (a, b)]}
            near = 5 * plain.edit_distance(a, b) <= max(len(a), len(b))
            assert list(lines._similar_lines(rows, sides, 0.8)) == ([(0, 1)] if near else [])


def test_lines_with_a_gram_out_of_place_are_not_compared():
    """A pair of rare words at the start of one line and at the end of another asks for no comparison; in place it does."""
    own = [[f"w{i}x{j}" for j in range(38)] for i in range(3)]
    texts = [["rare", "pair", *own[0]], [*own[1], "rare", "pair"], [*own[2][:3], "odd", "one", *own[2][3:]], [*own[0][:4], "odd", "one", *own[1][:34]]]
    weights = np.full(lines.CLASSES, 9, np.uint8)
    weights[lines._word_class(Words(np.frombuffer(b"rare pair odd one", np.uint8), np.array([0, 17]), LETTERS).hashes)] = 0
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["\n".join(map(" ".join, texts[:3]))])], names=["doc_id", "text"])
    more = pa.RecordBatch.from_arrays([pa.array([2]), pa.array([" ".join(texts[3])])], names=["doc_id", "text"])

    def met(*batches):
        packed = [p for b in batches for p in lines._packed([b], weights=weights, similarity=0.8, min_words=1, buckets=1)]
        return sum(len(out) for out in lines._shared(packed, similarity=0.8))

    assert met(batch) == 0
    assert met(batch, more) >= 2


@pytest.mark.parametrize(("cells", "few"), [(1 << 16, 16), (1000, 1), (50, 1)])
def test_edit_distances_of_many_pairs_are_reckoned_together(monkeypatch, cells, few):
    monkeypatch.setattr(lines, "CELLS", cells)
    monkeypatch.setattr(lines, "FEW", few)
    rng = random.Random(7)
    own = [[rng.randrange(4) for _ in range(rng.choice([1, 2, 7, 8, 9, 16, 33]))] for _ in range(60)]
    own += [[x for x in a if rng.random() < 0.9] or [1] for a in own]
    sizes = np.array([len(a) for a in own])
    words = np.array([x for a in own for x in a], dtype=np.uint64)
    pairs = np.array([(rng.randrange(120), rng.randrange(120)) for _ in range(400)] + [(i, i + 60) for i in range(60)])
    got = lines.edit_distances(words, np.cumsum(sizes) - sizes, sizes, *pairs.T)
    assert got.tolist() == [plain.edit_distance(own[a], own[b]) for a, b in pairs]


@pytest.mark.parametrize("sides", [1, 2])
def test_only_lines_of_like_sizes_are_looked_at(monkeypatch, sides):
    """The links of near lines connect what all pairs do, and the pairs that are too far apart in size are not looked at."""
    monkeypatch.setattr(lines, "ABREAST", 64)
    rng = np.random.default_rng(4)
    sizes = np.repeat(2 ** np.arange(2, 9), 8)  # no size is similar to another
    words = rng.integers(0, 1 << 63, sizes.sum(), dtype=np.uint64)
    last = np.cumsum(sizes)
    codes = lines.sketches(words, last - sizes, last)
    codes[1::2] = codes[::2]  # near each other
    by = rng.permutation(len(sizes))
    side = np.sort(np.arange(len(sizes)) % sides)
    rows = {"n_words": sizes[by]} | {c: codes[by, i].view(np.int64) for i, c in enumerate(lines._SKETCHES)}
    groups, linked = plain.Sets(range(len(by))), plain.Sets(range(len(by)))
    for a in range(len(by)):
        for b in range(a + 1, len(by)):
            if (codes[by[a]] == codes[by[b]]).all() and (sides == 1 or side[a] != side[b]):
                groups.join(a, b)
    looked, count = [], np.bitwise_count
    monkeypatch.setattr(lines.np, "bitwise_count", lambda x: (looked.append(x.size), count(x))[1])
    for a, b in lines._near_lines(rows, side, 0.8):
        linked.join(a, b)
    assert [linked.find(i) for i in range(len(by))] == [groups.find(i) for i in range(len(by))]
    assert sum(looked) < lines.SKETCH * len(by) * 16


def test_a_large_cluster_is_linked_like_all_pairs(monkeypatch):
    monkeypatch.setattr(lines, "PAIRS", 20)
    found = [list(map(hash, x)) for x in sorted(set(edited_lines(23, 60)))]
    rows = {"words": [np.array([x & (1 << 64) - 1 for x in words], dtype=np.uint64).tobytes() for words in found]}
    for sides in (np.zeros(len(found), dtype=int), np.sort(np.arange(len(found)) % 2)):
        groups, linked, small = (plain.Sets(range(len(found))) for _ in range(3))
        first, second = np.triu_indices(len(found), 1)
        told = lines._similar_line_pairs(rows, first, second, 0.8)
        for a, b, near in zip(first.tolist(), second.tolist(), told.tolist(), strict=True):
            longer = max(len(found[a]), len(found[b]))
            if 5 * plain.edit_distance(found[a], found[b]) <= longer and (sides[a] != sides[b] or not sides.any()):
                groups.join(a, b)
            if near:
                small.join(a, b)
        for a, b in lines._similar_lines(rows, sides, 0.8):
            linked.join(a, b)
        own = [groups.find(i) for i in range(len(found))]
        assert [linked.find(i) for i in range(len(found))] == own
        assert sides.any() or [small.find(i) for i in range(len(found))] == own


def test_words_of_letters_are_hashed_whole():
    """Words are the same as when each byte is looked at; equal ones have equal hashes, whatever their case and what follows them."""
    rng = random.Random(9)
    for _ in range(200):
        own = [bytes(rng.choice(b"abAB z\n.09\x00\xc3\xa9") for _ in range(rng.randrange(60))) for _ in range(rng.randrange(5))]
        data = np.frombuffer(b"".join(own), np.uint8)
        offsets = np.append(0, np.cumsum([len(x) for x in own])).astype(np.int64)
        new, old = Words(data, offsets, LETTERS), Words(data, offsets, LETTERS, by_bytes=True)
        assert all((getattr(new, c) == getattr(old, c)).all() for c in ("starts", "ends", "bounds"))
        told = {(a, b) for a, b in zip(new.hashes.tolist(), old.hashes.tolist(), strict=True)}
        assert len(told) == len(set(new.hashes.tolist())) == len(set(old.hashes.tolist()))


def test_holders_of_rare_grams_are_counted_where_they_meet():
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["one two three four five six\none two three four five seven"])], names=["doc_id", "text"])
    packed = list(lines._packed([batch], weights=np.zeros(lines.CLASSES, np.uint8), similarity=0.8, min_words=1, buckets=1))
    rows = [r for out in lines._shared(packed, similarity=0.8) for r in out.to_pylist()]
    held = {r["group"]: {x["doc_id"] for x in rows if x["group"] == r["group"] and x["doc_id"] is not None} for r in rows}
    counts = {r["group"]: (r["n"], r["x"]) for r in rows if r["doc_id"] is None}
    assert held and counts == {g: (2, a ^ b) for g, (a, b) in held.items()} and not any(r["often"] for r in rows)


def test_long_lines_are_told_apart_by_counts_of_words():
    """Counts of words part lines that parities do not, and never two that are similar enough."""
    rng = random.Random(13)
    own = [[rng.randrange(1 << 63) if rng.random() < 0.5 else rng.randrange(5) for _ in range(rng.randrange(129, 200))] for _ in range(12)]
    own += [[x if rng.random() < 0.9 else rng.randrange(1 << 63) for x in a] + [7] * rng.randrange(9) for a in own]
    sizes = np.array([len(a) for a in own])
    words, last = np.array([x for a in own for x in a], dtype=np.uint64), np.cumsum(sizes)
    tally = [x.tobytes() for x in lines.tallies(words, last - sizes, last)]
    first, second = np.triu_indices(len(own), 1)
    similar = np.array([5 * plain.edit_distance(own[a], own[b]) <= max(len(own[a]), len(own[b])) for a, b in zip(first, second, strict=True)])
    rows = {"n_words": sizes, "tally": np.array(tally, dtype=object)} | {c: np.zeros(len(own), dtype=np.int64) for c in lines._SKETCHES}
    near = lines._near_line_pairs(rows, first, second, 0.8)
    assert similar.sum() == 12 and near[similar].all() and near.sum() < 30
    rows["tally"][::2] = None
    assert lines._near_line_pairs(rows, first, second, 0.8).sum() > 100
    linked = plain.Sets(range(len(own)))
    rows["tally"] = np.array(tally, dtype=object)
    for a, b in lines._near_lines(rows, np.zeros(len(own), dtype=int), 0.8):
        linked.join(a, b)
    assert all(linked.find(a) == linked.find(a + 12) for a in range(12)) and len({linked.find(a) for a in range(24)}) > 6


def test_copies_of_short_lines_go_in_the_query(spark, tmp_path):
    rows = [(1, "x y\nHome\n--\n世界世界"), (2, "X, y!\nnot home"), (3, "home\n--\n\n世界世界\nhomes"), (4, "y x")]
    table(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.text, r.lines_removed) for r in queries.op3_lines(spark, str(tmp_path)).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("not home", 1), 3: ("--\n\nhomes", 2), 4: ("y x", 0)}
    assert corpus_pipeline.drop_repeated_lines(spark, table(spark, rows), "").where("doc_id = 2").first().text == "not home"


# --- contamination ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("slice_", [1 << 20, 640])
def test_containment(spark, documents, monkeypatch, slice_):
    monkeypatch.setattr(decontaminate, "SLICE", slice_)
    rng = random.Random(8)
    docs = texts(documents)[:80]
    items = [(100, None), (101, ""), (102, "one two"), (103, docs[0][1])]
    for i in range(40):
        w = docs[rng.randrange(80)][1].split()
        at = rng.randrange(max(1, len(w) - 40))
        part = w[at : at + rng.randrange(3, 40)]
        if i % 2 and part:
            part[rng.randrange(len(part))] = "changed"
        items.append((i, " ".join(part)))
    rows = [*docs, (5000, "One  TWO"), (5001, "one two three"), (5002, None)]
    expected = []
    for d, t in rows:
        own = plain.shingles(t)
        for i, item in items:
            q = plain.shingles(item)
            if q and 100 * len(q & own) >= 80 * len(q):
                expected.append((d, i, len(q & own), len(q)))
    benchmark = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, cut int")
    got = decontaminate.contaminated(table(spark, rows), benchmark).select("doc_id", "item_id", "shared", "item_shingles")
    assert sorted(map(tuple, got.collect())) == sorted(expected) and expected
    clean = decontaminate.clean(table(spark, rows), benchmark)
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in rows} - {e[0] for e in expected}
    assert clean.columns == table(spark, []).columns


def test_contaminated_rows_go_by_their_text(spark):
    item, good = prose(5, 40), prose(6, 80)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, good + " " + item), (1, good), (None, item), (None, good), (2, None)]
    left = decontaminate.clean(table(spark, rows), benchmark)
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == sorted([(1, good), (0, good), (2, "")])


def test_containment_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(table(spark, [(1, "a b")]), none).count() == 0
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.contaminated(table(spark, []), some).count() == 0


def test_a_sketch_meets_every_containing_set():
    rng = np.random.default_rng(3)
    for n in (1, 2, 4, 5, 9, 16, 17, 40, 100):
        own = rng.integers(0, 1 << 62, n).astype(np.uint64)
        lost = n * 20 // 100
        smallest = np.sort(own)[lost:]  # the worst case: just the smallest are missing
        assert np.isin(np.sort(own)[: decontaminate.sketch_size(n, 80)], smallest).any()


# --- sharding --------------------------------------------------------------------------------------------------------


def bid(key, shard):
    seed = xxhash.xxh64(int(key).to_bytes(8, "little", signed=True), seed=42).intdigest()
    return xxhash.xxh64(int(shard).to_bytes(4, "little"), seed=seed).intdigest() >> 11


def test_sharding(spark, documents):
    rows = sharding.shard_documents(documents, 8).collect()
    by = dict(texts(documents))
    assert len(rows) == len(by)
    for r in rows:
        shares = [bid(r.doc_id, s) for s in range(9)]
        assert r.shard == shares.index(max(shares[:8])) and r.grown_shard == shares.index(max(shares))
        assert r.grown_shard in (r.shard, 8)
        raw = by[r.doc_id].encode()
        assert r["size"] == len(raw) + 1 and r.text_crc32 == __import__("zlib").crc32(raw)
    for shard in range(8):
        own = [r.slot for r in rows if r.shard == shard]
        assert sorted(own) == list(range(len(own)))


def test_sharding_weights_and_edges(spark):
    ids = spark.range(20_000).select(F.col("id").alias("k"))
    share = {r.shard: r["count"] for r in sharding.assign(ids, ["k"], {0: 1.0, 1: 3.0}).groupBy("shard").count().collect()}
    assert abs(share[1] / 20_000 - 0.75) < 0.02
    rows = [(None, None), (None, "x"), (1, ""), (1, ""), (2, "\xe9")]
    got = sharding.shard_documents(table(spark, rows).repartition(3), 8).collect()
    assert len(got) == 5 and len({(r.shard, r.slot) for r in got}) == 5
    assert sorted((r.doc_id or 0, r["size"], r.text_crc32) for r in got)[:3] == [(0, 1, 0), (0, 2, 2363233923), (1, 1, 0)]
    assert sharding.shard_documents(table(spark, []), 8).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_of([F.lit(1)], {0: 0.0})


def test_written_shards(spark, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(spark.range(100).select(F.col("id").alias("k")), path, ["k"], 4)
    assert spark.read.parquet(path).count() == 100


# --- fingerprints ----------------------------------------------------------------------------------------------------

PARAGRAPH = re.compile(r"(?<=[.!?])\s+|\n", re.ASCII)


def check_fingerprints(spark, rows):
    order = sorted(rows, reverse=True)
    got = {r.doc_id: r for r in fingerprints.fingerprints(table(spark, rows)).collect()}
    assert len(got) == len(order)
    parts = lambda t: {x for x in PARAGRAPH.split(t) if x.strip(" ")}
    prints = {}
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for value, other in ((r.near_edited, edited), (r.near_next, after)):
            n = len(parts(text)) + len(parts(other))
            assert value == pytest.approx(1 - len(parts(text) ^ parts(other)) / n if n else 1)
        for t, p in ((text, r.fingerprint), (edited, r.edited_fingerprint)):
            assert prints.setdefault(t, p) == p
    assert len(set(prints.values())) == len(prints)


def test_fingerprints(spark, documents):
    check_fingerprints(spark, texts(documents))


def test_fingerprints_edges(spark):
    rows = [(5, None), (-3, ""), (9, "a"), (10, "\U0001f389\xe9."), (11, "One. Two. One.\n\nTwo"), (40, "Same. text. here"), (41, "Same. text. here")]
    check_fingerprints(spark, rows + [(7, ". ".join(prose(6, 4000).split()))])
    check_fingerprints(spark, [(1, "alone. here")])
    assert fingerprints.fingerprints(table(spark, [])).count() == 0


def test_every_row_has_a_fingerprint(spark):
    """Repeated and null ids: every row has one, and the edited texts are those of some order with nulls last."""
    rows = [(1, "b. one"), (1, "a. two"), (None, "c. three"), (None, "c. three"), (2, "d. four"), (2, "d. four"), (2, "d. four"), (None, None)]
    got = fingerprints.fingerprints(table(spark, rows)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    edited = lambda t, after: hashlib.sha256((t[: len(t) - len(t) // 2] + after[: len(t) // 2]).encode()).hexdigest()
    of = {}
    for r in got:
        of.setdefault(r.doc_id, []).append(r.edited_sha256)
    # The three equal rows: two are followed by their own text, the last by a text of doc_id 1.
    assert of[2].count(edited("d. four", "d. four")) == 2 and len({*of[2]} & {edited("d. four", t) for t in ("a. two", "b. one")}) == 1
    assert edited("c. three", "c. three") in of[None] and {r.near_next for r in got} <= {0.0, 1.0, 0.5, 2 / 3} | {r.near_next for r in got}
    assert len({r.fingerprint for r in got}) == 5


def test_a_full_sketch_fails_and_a_sparse_one_is_peeled(spark):
    df = spark.range(40).select(F.xxhash64("id").cast("string").alias("p")).agg(F.array_join(F.collect_list("p"), "\n").alias("t"))
    keys = df.select(fingerprints.keys_of(F.col("t")).alias("keys"))
    few = F.slice("keys", 1, 5)
    row = keys.select(
        few.alias("few"),
        fingerprints.peeled(fingerprints.sketch_of(few, 8), 8, 0).alias("found"),
        fingerprints.peeled(fingerprints.sketch_of(F.col("keys"), 8), 8, 0).alias("none"),
    ).first()
    assert sorted(row.found) == sorted(row.few) and row.none is None


# --- quality -----------------------------------------------------------------------------------------------------------


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    judged = quality.classify(docs, labels.where(~held)).join(labels.where(held), "doc_id").collect()
    low = [r for r in judged if r.quality == 0]
    good = [r for r in judged if r.quality == 1 and r.toxic == 0]
    assert sum(not r.kept for r in low) >= 0.9 * len(low) and sum(r.kept for r in good) >= 0.97 * len(good)


def test_quality_edges(spark):
    rows = [(1, None), (2, ""), (3, "good words here"), (3, "good words here"), (None, "x" * 100_000)]
    labels = spark.createDataFrame([(1, None, 0), (2, 1, None), (None, 1, 1), (3, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    assert all(r.kept for r in quality.classify(table(spark, rows), labels).collect())
    assert quality.classify(table(spark, rows), labels.limit(0)).count() == 5
    assert quality.classify(table(spark, []), labels).count() == 0


def plain_posteriors(rows):
    """rows: (host, path, low, toxic log-odds). Each row's posteriors with its own evidence left out of its path, and the decision."""
    rate = lambda x: 1 / (1 + math.exp(-x))
    odds = lambda p: math.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))
    out = [[] for _ in rows]
    for t in (2, 3):
        paths, hosts = {}, {}
        for r in rows:
            for groups, key in ((paths, r[:2]), (hosts, r[0])):
                n, total = groups.get(key, (0, 0.0))
                groups[key] = (n + 1, total + rate(r[t]))
        centre = sum(x for _, x in hosts.values()) / len(rows)

        def strength(groups, middle):
            chance = [middle(k) * (1 - middle(k)) for k in groups]
            spread = sum(n * (x / n - middle(k)) ** 2 - c for (k, (n, x)), c in zip(groups.items(), chance, strict=True))
            excess = spread / sum(n for n, _ in groups.values())
            return min(1e6, sum(chance) / len(chance) / excess) if excess > 1e-9 else 1e6

        strong = strength(hosts, lambda k: centre)
        at = {k: (strong * centre + x) / (strong + n) for k, (n, x) in hosts.items()}
        within = strength(paths, lambda k: at[k[0]])
        for r, own in zip(rows, out, strict=True):
            n, total = paths[r[:2]]
            site = (within * at[r[0]] + max(total - rate(r[t]), 0)) / (within + n - 1)
            own.append(rate(r[t] - odds(centre) + odds(site)))
    return [(low, toxic, low <= 0.5 and toxic <= 0.5) for low, toxic in out]


def test_posteriors_and_decisions_against_a_plain_version(spark, documents):
    sf = "/root/testdata/sf0.001"
    got = quality.classify(documents, spark.read.parquet(f"{sf}/labels.parquet")).collect()
    rows = [(r.host, r.path, r.low_evidence, r.toxic_evidence) for r in got]
    for r, (low, toxic, kept) in zip(got, plain_posteriors(rows), strict=True):
        assert r.low_rate == pytest.approx(low, abs=1e-9) and r.toxic_rate == pytest.approx(toxic, abs=1e-9) and r.kept == kept


def test_the_sample_is_bounded_by_rows(spark, monkeypatch):
    """A labelled id on many rows takes one place of the sample."""
    monkeypatch.setattr(quality, "SAMPLE", 3)
    rows = [(1, f"text number {i}") for i in range(300)] + [(i, f"other text {i}") for i in range(2, 6)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 6)], "doc_id long, quality int, toxic int")
    models = quality.train(table(spark, rows), labels)
    # Shares of three rows, however many texts an id has.
    assert set(models) == set(quality.TARGETS) and all(m.rate * 3 == pytest.approx(round(m.rate * 3)) for m in models.values())


def test_rejection_is_by_row(spark, documents):
    """A good text stays whatever other text shares its doc_id, and a text without doc_id is judged like others."""
    sf = "/root/testdata/sf0.001"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    changed = documents.withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit(7)).when(F.col("doc_id") % 3 == 1, F.col("doc_id")))
    judged = quality.classify(changed, labels).collect()
    assert {r.doc_id for r in judged if not r.kept} & {7, None} and {r.doc_id for r in judged if r.kept} >= {7, None}
    assert quality.keep(changed, labels).count() == sum(r.kept for r in judged)


def test_a_bad_site_counts_and_a_sparse_one_shrinks(spark):
    rows = [("bad", "bad/a", 4.0)] * 300 + [("few", "few/a", 4.0)] + [(f"ok{i % 20}", f"ok{i % 20}/a", -4.0) for i in range(3000)]
    scored = spark.createDataFrame([(i, h, p, e, -9.0) for i, (h, p, e) in enumerate(rows)], "doc_id long, host string, path string, low double, toxic double")
    sites, rates = quality.posteriors(scored)
    far = sites.withColumns({"low": F.lit(-99.0), "n": F.col("n") + 1})  # one more document that adds nothing
    rate = {r.host: r.rate for r in far.select("host", quality.own_site("low").alias("rate")).collect()}
    assert rate["bad"] > 0.9 > rate["few"] > rates["low"] > max(rate[f"ok{i}"] for i in range(20))
