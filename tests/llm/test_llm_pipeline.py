"""The pipeline's stages, one by one, against plain versions on what the stage before kept."""

import os

import corpus_pipeline
import plain
import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        out = spark.read.parquet(str(tmp_path / str(i)))
        kept[name] = (docs, out)
        if i < 4:
            assert out.columns == columns
        docs = out

    before, after = kept["quality classifier"]
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r.doc_id for r in after.collect()}
    good = [i for i, r in labels.items() if r.quality == 1 and r.toxic == 0]
    bad = [i for i, r in labels.items() if r.quality == 0]
    assert sum(i in left for i in good) >= 0.95 * len(good) and sum(i not in left for i in bad) >= 0.7 * len(bad)

    before, after = ({r.doc_id: r for r in x.collect()} for x in kept["line dedup"])
    for i, r in after.items():
        old = before[i].text.split("\n")
        rest = iter(old)
        assert all(line in rest for line in r.text.split("\n")) and r.n_chars == len(r.text)
    assert sum(len(r.text) for r in after.values()) < sum(len(r.text) for r in before.values())

    before, after = ([(r.doc_id, r.text) for r in x.collect()] for x in kept["MinHash near-dedup"])
    groups = plain.near_components(before, 80)
    assert sorted(i for i, _ in after) == sorted(i for i in groups if groups[i] == i)

    before, after = ([(r.doc_id, r.text) for r in x.collect()] for x in kept["benchmark decontamination"])
    items = [plain.shingles(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [i for i, t in before if not any(q and 100 * len(q & plain.shingles(t)) >= 80 * len(q) for q in items)]
    assert sorted(i for i, _ in after) == sorted(clean)

    before, after = kept["packing"]
    texts = sorted((r.doc_id, r.text) for r in before.collect())
    tokens = dict(zip([i for i, _ in texts], plain.token_ids("byte_bpe_50k.json", [t for _, t in texts], 1), strict=True))
    for r in after.collect():
        assert r.ids_crc32 == plain.crc(tokens[r.doc_id][r.start : r.start + r.length])
    assert sum(r.length for r in after.collect()) == sum(map(len, tokens.values()))


def test_run_is_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns)


def lake(spark, path, rows):
    """A folder with a documents table of these (doc_id, text), the benchmark and labels of the driver tables."""
    kind = "doc_id long, text string, lang string, source string, n_chars long, group string"
    docs = spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), "g") for i, t in rows], kind)
    docs.write.parquet(f"{path}/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_the_pipeline_of_awkward_rows(spark, tmp_path):
    """Null and repeated ids, empty and null texts: every stage keeps the rows that it has nothing against."""
    good = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    rows = [(i % 5, t) for i, t in enumerate(good)] + [(None, good[0]), (None, good[0]), (None, None), (None, None), (3, ""), (3, None)]
    folder = lake(spark, tmp_path / "odd", rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    counts = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        counts.append(docs.count())
        if i < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "group"]
    # Nothing is added by the filters, the empty rows are in nobody's way, and what is left is packed.
    assert len(rows) >= counts[0] >= counts[1] >= counts[2] >= counts[3] > 0 and counts[4] >= 1
    packed = {r.doc_id for r in docs.collect()}
    assert packed == {r.doc_id for r in spark.read.parquet(str(tmp_path / "3")).collect()}


def test_the_pipeline_of_nothing(spark, tmp_path):
    folder = lake(spark, tmp_path / "none", [])
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_line_stage_against_a_plain_version(spark, tmp_path):
    """Groups of similar lines, by comparing all pairs, keep their first line; texts left without a word go."""
    rows = [(1, "alpha beta gamma delta epsilon\nkeep one"), (2, "alpha beta gamma delta zeta\nkeep two of them"), (3, "keep one")]
    rows += [(4, "one two three four five six seven eight nine ten"), (5, "one two three four five six seven EIGHT nine, eleven\n\n"), (6, None)]
    folder = lake(spark, tmp_path / "lines", rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen, expected = [], {}
    for i, text in rows:
        left = []
        for line in (text or "").split("\n"):
            words = [w.strip(",") for w in plain.words(line)]
            same = [s for s in seen if words and 5 * plain.edit_distance(words, s) <= max(len(words), len(s))]
            if not same:
                left.append(line)
            if words:
                seen.append(words)
        expected[i] = "\n".join(left)
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_repeated_lines(spark, docs, folder).collect()}
    for i, text in rows:
        if text is None:
            assert got[i] == (None, None)
        elif expected[i].strip() or expected[i] == text:
            assert got[i] == (expected[i], len(expected[i]))
        else:
            assert i not in got
