"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in DataFrame functions only.

A paragraph (a sentence, or a line without one) has a 64-bit key: 32 bits of digest and 32 bits that check them. A sketch has three
rows of cells; each key is XORed into one cell of each row. The XOR of two sketches is the sketch of the differing keys:
equal ones cancel. A cell whose upper half checks its lower half holds a single key; it is taken out of its other cells, which
leaves more such cells, until all differing keys are recovered (success: every cell is 0) or no cell checks (failure).

A text's fingerprint is its whole hash and its sketch of 3 x ``CELLS`` cells. To compare two texts, the keys of both are dealt over
so many sketches that each expects ``LOAD`` keys. Where a sketch of 3 x ``CELLS`` cells fails, one of twice the size and with other
places is peeled; documents for which that fails as well are compared again with larger ones, until none fails.

* the paragraphs of a text count as a set; blank ones do not count; two texts without paragraphs have likeness 1;
* a null text counts as empty; every row has a row of the result: rows with equal doc_id follow one another by their text's hash,
  equal rows have each other as next ones, and rows without doc_id come after all others; a single document is its own next one;
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.session import written_once

from .common import bounded_broadcast, numbered_texts

#: Cells in each of the three rows, and keys expected in one sketch of a comparison.
CELLS, LOAD = 8, 8
_PARAGRAPH = r"(?<=[.!?])\s+|\n"
_LOW = (1 << 32) - 1


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(7)).bitwiseAND(F.lit(_LOW))


def keys_of(text: Column) -> Column:
    """The distinct self-checking keys of a text's paragraphs."""
    paragraphs = F.filter(F.split(text, _PARAGRAPH), lambda p: F.length(F.trim(p)) > 0)
    digests = F.array_distinct(F.transform(paragraphs, lambda p: F.xxhash64(p).bitwiseAND(F.lit(_LOW))))
    return F.transform(digests, lambda d: F.shiftleft(d, 32).bitwiseOR(_check(d)))


def _place(key: Column, row: int, cells: int, attempt: int) -> Column:
    """The cell of a row that a key belongs to: by the digest's bits in the first two attempts, else by another hash.

    ``cells`` is a power of two: up to 16 in the first attempt and up to 64 in the second.
    """
    last = F.lit(cells - 1)
    if attempt > 1:
        return F.xxhash64(key, F.lit(16 * attempt + row)).bitwiseAND(last)
    return F.shiftrightunsigned(key, 32 + 10 * row + 4 * attempt).bitwiseAND(last)


def _xor(start: Column, keys: Column) -> Column:
    return F.aggregate(keys, start, lambda a, k: a.bitwiseXOR(k))


def _held(keys: Column, row: int, cells: int, attempt: int, at: Column) -> Column:
    """Those of an array of keys whose cell in a row is ``at``."""
    return F.filter(keys, lambda k: _place(k, row, cells, attempt) == at)


def _row_of(keys: Column, row: int, cells: int) -> Column:
    numbers = F.sequence(F.lit(0), F.lit(cells - 1))
    return F.transform(numbers, lambda at: _xor(F.lit(0).cast("long"), _held(keys, row, cells, 0, at)))


def sketch_of(keys: Column, cells: int) -> Column:
    """The cells of a sketch of an array of keys, row after row."""
    return F.concat(*[_row_of(keys, row, cells) for row in range(3)])


def _hex(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda c: F.lpad(F.hex(c), 16, "0")), "")


def fingerprint(text: Column, keys: Column) -> Column:
    return F.concat_ws("-", F.lpad(F.hex(F.xxhash64(text)), 16, "0"), _hex(sketch_of(keys, CELLS)))


def peeled(sketch: Column, cells: int, attempt: int, rounds: int = 7, first: int = 2) -> Column:
    """The keys in a sketch, or null if it could not be emptied.

    Each round looks at the three rows in turn: one step lists the single keys of a row, where each key has one cell, and
    the next takes them out of all rows. After ``first`` rounds most sketches are empty; only the others go on.
    """
    none = F.array().cast("array<bigint>")

    def single(cell: Column) -> Column:
        return (cell != 0) & (cell.bitwiseAND(F.lit(_LOW)) == _check(F.shiftrightunsigned(cell, 32)))

    def step(state: Column, turn: Column) -> Column:
        row = F.floor(turn / 2).cast("int") % 3

        def left(cell: Column, at: Column) -> Column:
            first, second, third = (_held(state["found"], r, cells, attempt, at - r * cells) for r in range(3))
            return _xor(cell, F.when(at < cells, first).when(at < 2 * cells, second).otherwise(third))

        found = F.filter(F.slice(state["cells"], row * cells + 1, cells), single)
        listed = F.struct(state["cells"].alias("cells"), state["keys"].alias("keys"), found.alias("found"))
        taken = F.struct(
            F.transform(state["cells"], left).alias("cells"), F.concat(state["keys"], state["found"]).alias("keys"), none.alias("found")
        )
        return F.when(turn % 2 == 0, listed).when(F.size(state["found"]) > 0, taken).otherwise(state)

    start = F.struct(sketch.alias("cells"), none.alias("keys"), none.alias("found"))
    turns = lambda n: F.sequence(F.lit(0), F.lit(6 * n - 1))

    def emptied(state: Column, otherwise: Column) -> Column:
        return F.when(F.forall(state["cells"], lambda c: c == 0), state["keys"]).otherwise(otherwise)

    def rest(state: Column) -> Column:
        return emptied(state, F.aggregate(turns(rounds - first), state, step, lambda s: emptied(s, F.lit(None))))

    return F.aggregate(turns(first), start, step, rest)


def _named(docs: DataFrame) -> DataFrame:
    """key, doc_id, mark and text of each row; rows with equal key are the same document read again."""
    rows = numbered_texts(docs).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("mark", F.xxhash64("text"))
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.hex("mark"))
    return rows.select(key.alias("key"), "doc_id", "mark", "text")


def following(docs: DataFrame) -> DataFrame:
    """(out, key, next_key, half, times, doc_id): the next document in descending order, after the last the first; half of its length.

    The order is by doc_id, rows without one last, then by the text's hash. Of ``k`` equal rows one has the next document, and
    k - 1 have their own text as next: the same figures ``times`` times, under a number ``out`` of its own. Neighbours are
    found within range partitions; only one row per partition is ordered by a single task.
    """
    own = _named(docs).groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.min("mark").alias("mark"), F.max(F.floor(F.length("text") / 2).cast("int")).alias("half"), F.count("*").alias("copies")
    )
    ranged = written_once(own.repartitionByRange("doc_id", "mark").withColumn("part", F.spark_partition_id()), "order")
    place = F.struct(F.col("doc_id").isNotNull(), "doc_id", "mark")
    ends = ranged.groupBy("part").agg(F.max_by("key", place).alias("last"))
    whole = Window.orderBy("part")
    ends = ends.select(
        "part",
        F.lag("last").over(whole).alias("part_before"),
        F.max_by("last", "part").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("greatest"),
    )
    within = F.lag("key").over(Window.partitionBy("part").orderBy("doc_id", "mark"))
    near = ranged.withColumn("near", within).join(F.broadcast(ends), "part")  # a row per range partition
    near = near.withColumn("next_key", F.coalesce("near", "part_before", "greatest"))
    variants = F.array(
        F.struct("next_key", F.lit(1).cast("long").alias("times")),
        F.struct(F.col("key").alias("next_key"), (F.col("copies") - 1).alias("times")),
    )
    rows = near.select("key", "doc_id", "half", "copies", F.inline(variants)).where("times > 0")
    return written_once(rows.withColumn("out", F.monotonically_increasing_id()), "following")


def _texts(docs: DataFrame, order: DataFrame) -> DataFrame:
    """key and text of each different row."""
    named = _named(docs).select("key", "text")
    again = written_once(order.where("copies > 1").select("key").distinct(), "copied")
    if not again.limit(1).count():
        return named
    copied = bounded_broadcast(again)
    return named.join(copied, "key", "left_anti").unionByName(named.join(copied, "key", "left_semi").dropDuplicates(["key"]))


def _versions(texts: DataFrame, order: DataFrame) -> DataFrame:
    """out, text, edited and the keys of the text, the edited text and the next document, for each row of ``order``."""
    own = texts.join(order.select("key", "out", "half"), "key").drop("key")
    as_next = order.select(F.col("next_key").alias("key"), F.col("out").alias("target"), F.col("half").alias("wanted"))
    nexts = texts.join(as_next, "key").select(
        F.col("target").alias("out"), F.expr("substring(text, 1, wanted)").alias("head"), keys_of(F.col("text")).alias("next_keys")
    )
    both = own.join(nexts.hint("shuffle_merge"), "out")
    edited = F.concat(F.expr("substring(text, 1, length(text) - half)"), F.col("head"))
    both = both.select("out", "text", edited.alias("edited"), "next_keys")
    return both.select("out", "text", "edited", keys_of(F.col("text")).alias("keys"), keys_of(F.col("edited")).alias("edited_keys"), "next_keys")


def _differences(versions: DataFrame, shapes: list[tuple[int, int]], load: int) -> DataFrame:
    """(out, edited_differs, next_differs): how many keys were recovered; null if no sketch could be emptied.

    ``shapes``: (cells in a row, attempt) of the sketches that are tried in turn.
    """

    def marked(pair: int, other: str) -> Column:
        n = F.greatest(F.lit(1), F.ceil((F.size("keys") + F.size(other)) / load)).cast("long")
        return F.transform(
            F.concat("keys", F.col(other)),
            lambda k: F.struct(F.lit(pair).alias("pair"), F.pmod(k.bitwiseAND(F.lit(_LOW)), n).alias("part"), k.alias("key")),
        )

    rows = versions.select("out", F.inline(F.concat(marked(0, "edited_keys"), marked(1, "next_keys"))))
    key, nothing = F.col("key"), F.lit(0).cast("long")
    sums = [
        F.bit_xor(F.when(_place(key, row, cells, attempt) == j, key).otherwise(nothing)).alias(f"c{attempt}_{row * cells + j}")
        for cells, attempt in shapes
        for row in range(3)
        for j in range(cells)
    ]
    sketches = rows.groupBy("out", "pair", "part").agg(*sums)
    tries = [peeled(F.array(*[f"c{a}_{i}" for i in range(3 * cells)]), cells, a) for cells, a in shapes]
    found = sketches.select("out", "pair", F.size(F.coalesce(*tries)).alias("found"))
    counts = []
    for pair, name in enumerate(("edited_differs", "next_differs")):
        mine = F.col("pair") == pair
        failed = F.max(F.when(mine, (F.col("found").isNull() | (F.col("found") < 0)).cast("int")))
        counts.append(F.when(F.coalesce(failed, F.lit(0)) == 0, F.coalesce(F.sum(F.when(mine, F.col("found"))), F.lit(0))).alias(name))
    return found.groupBy("out").agg(*counts)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints, and their likeness to the edited text and to the next document."""
    order = following(docs)
    texts = _texts(docs, order)
    versions = _versions(texts, bounded_broadcast(order))
    main = versions.select(
        "out",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("text"), F.col("keys")).alias("fingerprint"),
        fingerprint(F.col("edited"), F.col("edited_keys")).alias("edited_fingerprint"),
        (F.size("keys") + F.size("edited_keys")).alias("edited_total"),
        (F.size("keys") + F.size("next_keys")).alias("next_total"),
    )
    done = written_once(main.join(_differences(versions, [(CELLS, 0), (2 * CELLS, 1)], LOAD), "out", "left"), "fingerprints")
    totals = [F.when(F.col(f"{x}_total") == 0, 0).otherwise(F.col(f"{x}_differs")).alias(f"{x}_differs") for x in ("edited", "next")]
    known = done.select("out", *totals)
    failed = known.where("edited_differs is null or next_differs is null").select("out")
    kept = [known.where("edited_differs is not null and next_differs is not null")]
    attempt = 2
    while failed.count():
        again = written_once(order.join(bounded_broadcast(failed), "out"), "again")
        tried = _differences(_versions(texts, bounded_broadcast(again)), [(4 * CELLS, attempt)], LOAD)
        got = written_once(tried, "differences")
        kept.append(got.where("edited_differs is not null and next_differs is not null"))
        failed = got.where("edited_differs is null or next_differs is null").select("out")
        attempt += 1
    differs = kept[0]
    for more in kept[1:]:
        differs = differs.unionByName(more)
    rest = done.drop("edited_differs", "next_differs")
    like = lambda x: F.when(F.col(f"{x}_total") == 0, 1.0).otherwise(1 - F.col(f"{x}_differs") / F.col(f"{x}_total"))
    rows = rest.join(differs, "out").join(order.select("out", "doc_id", "times"), "out")
    rows = rows.withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", like("edited").alias("near_edited"), like("next").alias("near_next")
    )
