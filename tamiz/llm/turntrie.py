"""The prefix trie of conversations by truncation peeling: from the deepest turns up, with subtree figures on the way.

A prefix is named by 128 bits, the XOR of hashes of its (turn, position) pairs, so that all prefixes come from running XORs and a
group-by with map-side sums finds the nodes with their members. Nodes that follow one another without a branch or an end have
the same members, that is the same smallest member and the same count; they form a *stretch*, which is stripped at once. Peeling
descends over the depths at which stretches end: the stretches that end there take in what arrives from below (conversations
that ended and survivors that were stripped to this depth), and go on with one row. So the rounds follow the depths at which
conversations part, not the length of the longest, and a tail of one conversation alone takes none.

* turns are ordered by ``turn``, nulls first, then by role and a hash of role and text; equal rows are turns of their own;
* a null role or text is empty; rows without conv_id are one conversation, which is the greatest and has the empty decimal;
* a long conversation is numbered and summed up in parts by many tasks; members of a node are joined to a digest from chunks;
* an empty table has no conversations and gives no node, not even the root; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.session import scratch, written_once

from .sharding import slots

#: Conversations in a row whose first turns are shared, and the number of shares.
FAMILY, SHARES = 5, 9
#: Turns of a conversation that one task sums up.
PART = 1024
#: Members that a chunk of a digest's input joins.
CHUNK = 512

_EMPTY = hashlib.sha256(b"").hexdigest()


def _zero() -> Column:
    return F.lit(0).cast("long")


def _key(conv_id: Column) -> Column:
    return F.coalesce(conv_id.cast("string"), F.lit(""))


def numbered(conversations: DataFrame) -> DataFrame:
    """key, conv_id, p (from 0), x, y (a turn's hashes) and bytes (of its text) of each turn, in a written table."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role, text)
    narrow = turns.select(
        _key(F.col("conv_id")).alias("key"),
        "conv_id",
        "turn",
        "role",
        F.xxhash64("role", "text").alias("x"),
        F.xxhash64(F.lit(7), "text", "role").alias("y"),
        F.octet_length("text").cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("salt"),
    )
    order = ["turn", "role", "x", "salt"]
    placed = slots(narrow.repartitionByRange("key", *order), "key", order, into="p")
    return written_once(placed.select("key", "conv_id", "p", "x", "y", "bytes"), "turns")


def sizes(turns: DataFrame) -> DataFrame:
    """key, conv_id and own (turns) of each conversation."""
    return turns.groupBy("key", "conv_id").agg(F.count(F.lit(1)).alias("own"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as the first of their family does: (convs: key, conv_id, total; steps: a row per turn).

    Conversation c takes the first h turns of c - c % FAMILY, h being the CRC of its decimal modulo SHARES, and then its own
    turns after the first h. A conversation without id keeps its turns.
    """
    own = sizes(turns).withColumns({"skip": F.crc32("key") % SHARES, "base": F.col("conv_id") - F.col("conv_id") % FAMILY})
    bases = own.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    convs = own.join(bases, "base", "left").withColumn("taken", F.least("skip", F.coalesce("there", _zero())))
    convs = convs.withColumn("total", F.col("taken") + F.greatest(F.col("own") - F.col("skip"), _zero()))
    convs = written_once(convs.select("key", "conv_id", "base", "skip", "taken", "total"), "conversations")
    columns = ["key", "conv_id", "total", "pos", "x", "y", "bytes"]
    kept = turns.join(convs.select("key", "skip", "taken", "total"), "key").where("p >= skip")
    kept = kept.withColumn("pos", F.col("taken") + F.col("p") - F.col("skip") + 1)
    firsts = turns.where(F.col("p") < SHARES - 1).select(F.col("conv_id").alias("base"), "p", "x", "y", "bytes")
    shared = firsts.join(convs.where("taken > 0"), "base").where("p < taken").withColumn("pos", F.col("p") + 1)
    return convs.select("key", "conv_id", "total"), kept.select(*columns).unionByName(shared.select(*columns))


def as_they_are(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same of the conversations themselves."""
    convs = written_once(sizes(turns).withColumnRenamed("own", "total"), "conversations")
    return convs, turns.join(convs.select("key", "total"), "key").withColumn("pos", F.col("p") + 1).drop("p")


def _prefixes(steps: DataFrame) -> DataFrame:
    """conv_id, depth, total, (a, b) and (up_a, up_b): the names of a turn's prefix and of the one before; upto, before: bytes."""
    rows = steps.select(
        "key", "conv_id", "total", "pos", "bytes", F.floor((F.col("pos") - 1) / PART).alias("part"),
        F.xxhash64("x", "y", "pos").alias("x"), F.xxhash64("pos", "y", "x").alias("y"),
    )
    rows = written_once(rows, "steps")
    inside = Window.partitionBy("key", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("key", "part").agg(F.bit_xor("x").alias("px"), F.bit_xor("y").alias("py"), F.sum("bytes").alias("pb"))
    parts = parts.select(
        "key", "part",
        F.coalesce(F.bit_xor("px").over(ahead), _zero()).alias("px"),
        F.coalesce(F.bit_xor("py").over(ahead), _zero()).alias("py"),
        F.coalesce(F.sum("pb").over(ahead), _zero()).alias("pb"),
    )
    run = rows.withColumns({"a": F.bit_xor("x").over(inside), "b": F.bit_xor("y").over(inside), "upto": F.sum("bytes").over(inside)})
    run = run.join(parts, ["key", "part"])
    a, b, upto = F.col("a").bitwiseXOR(F.col("px")), F.col("b").bitwiseXOR(F.col("py")), F.col("upto") + F.col("pb")
    return run.select(
        "conv_id", F.col("pos").alias("depth"), "total", a.alias("a"), b.alias("b"),
        a.bitwiseXOR(F.col("x")).alias("up_a"), b.bitwiseXOR(F.col("y")).alias("up_b"),
        upto.alias("upto"), (upto - F.col("bytes")).alias("before"),
    )


def _least(conv_id: str = "conv_id") -> Column:
    return F.min(F.struct(F.col(conv_id).isNull().alias("none"), F.col(conv_id).alias("id")))["id"]


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of a node that follow each other, joined by commas: a, b, depth, none and first (of the first), ids."""
    out: list[tuple] = []
    node, held = None, []

    def close() -> None:
        if held:
            out.append((*node, held[0] is None, held[0], ",".join("" if x is None else str(x) for x in held)))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.string()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "depth", "none", "first", "ids"])

    for batch in batches:
        for *own, conv_id in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "depth", "conv_id")), strict=True):
            if own != node or len(held) == CHUNK:
                close()
                node, held = own, []
            held.append(conv_id)
        if len(out) >= 1000:
            yield batch_of(out)
            out = []
    close()
    if out:
        yield batch_of(out)


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node from its chunks, which come in order; a task holds one chunk and a state."""
    node, state, out = None, None, []
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["a", "b", "depth", "ends_sha256"]
        )

    for batch in batches:
        for *own, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "depth", "ids")), strict=True):
            if own == node:
                state.update(b",")
            else:
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = own, hashlib.sha256()
            state.update(ids.encode())
        if len(out) >= 10_000:
            yield batch_of(out)
            out = []
    if node is not None:
        out.append((*node, state.hexdigest()))
    if out:
        yield batch_of(out)


def _ends(steps: DataFrame, convs: DataFrame) -> DataFrame:
    """a, b, depth and ends_sha256 of each node with conversations that end there; the root is (0, 0, 0)."""
    last = steps.where("depth = total").select("a", "b", "depth", "conv_id")
    bare = convs.where("total = 0").select(_zero().alias("a"), _zero().alias("b"), _zero().alias("depth"), "conv_id")
    members = last.unionByName(bare).withColumn("none", F.col("conv_id").isNull())
    order = ["a", "b", "depth", "none", "conv_id"]
    ranged = members.repartitionByRange(*order).sortWithinPartitions(*order).drop("none")
    chunks = ranged.mapInArrow(_chunks, "a long, b long, depth long, none boolean, first long, ids string")
    by_node = chunks.repartition("a", "b", "depth").sortWithinPartitions("a", "b", "depth", "none", "first")
    return by_node.mapInArrow(_digests, "a long, b long, depth long, ends_sha256 string")


def _stretches(nodes: DataFrame) -> DataFrame:
    """One row per stretch: key and n (its name), its depths, its bytes, the stretch above, and its child nodes, in a written table."""
    own = nodes.groupBy("key", "n").agg(
        F.min("depth").alias("top"),
        F.max("depth").alias("bottom"),
        F.min("before").alias("before"),
        F.max("upto").alias("upto"),
        F.min_by(F.struct("up_a", "up_b"), "depth").alias("up"),
    )
    own = own.select("*", "up.up_a", "up.up_b", (F.col("top") - 1).alias("up_depth")).drop("up")
    above = nodes.select(
        F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("depth").alias("up_depth"),
        F.col("key").alias("up_key"), F.col("n").alias("up_n"), F.col("conv_id").alias("up_conv"),
    )
    own = written_once(own.join(above, ["up_a", "up_b", "up_depth"], "left").drop("up_a", "up_b"), "stretches")
    children = own.where("top > 1").groupBy(F.col("up_key").alias("key"), F.col("up_n").alias("n"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    return written_once(own.join(children, ["key", "n"], "left").fillna(0, ["n_children"]), "stretches-and-children")


def _peeled(stretches: DataFrame) -> DataFrame:
    """``stretches`` with the leaves of the subtree below each, ``below``, the bytes saved there, and ``saved`` with its own."""
    spark = stretches.sparkSession
    own = (F.col("n") - 1) * (F.col("upto") - F.col("before"))
    childless = stretches.where("n_children = 0").withColumns({"leaves": F.lit(1).cast("long"), "below": _zero(), "saved": own})

    def arriving(done: DataFrame) -> DataFrame:
        up = done.where("top > 1").groupBy(F.col("up_key").alias("key"), F.col("up_n").alias("n"))
        return up.agg(F.sum("leaves").alias("came"), F.sum("saved").alias("with_saved"))

    inner = stretches.where("n_children > 0").join(arriving(childless), ["key", "n"], "left")
    inner = inner.withColumns({"leaves": F.coalesce("came", _zero()), "below": F.coalesce("with_saved", _zero())}).drop("came", "with_saved")
    inner = written_once(inner.sortWithinPartitions("bottom"), "inner")
    # A number for each depth at which conversations part.
    depths = sorted((r["bottom"] for r in inner.select("bottom").distinct().collect()), reverse=True)
    path, peeled = scratch(spark, "peeled"), None
    for depth in depths:
        now = inner.where(F.col("bottom") == depth)
        if peeled is not None:
            came = arriving(peeled.where(F.col("up_depth") == depth))
            now = now.join(came, ["key", "n"], "left").withColumns(
                {"leaves": F.col("leaves") + F.coalesce("came", _zero()), "below": F.col("below") + F.coalesce("with_saved", _zero())}
            )
        now = now.select(*inner.columns, (F.col("below") + own).alias("saved"))
        now.drop("bottom").write.parquet(f"{path}/bottom={depth}")
        peeled = spark.read.schema(now.schema).parquet(path)
    return childless if peeled is None else childless.unionByName(peeled.select(*childless.columns))


def trie(convs: DataFrame, steps: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    A node is named by its smallest member and its depth: its text is that of the member's turns up to there. ``convs`` and
    ``steps`` are what ``rebuilt`` or ``as_they_are`` give.
    """
    steps = written_once(_prefixes(steps), "prefixes")
    nodes = steps.groupBy("depth", "a", "b").agg(
        F.count(F.lit(1)).alias("n"), _least().alias("conv_id"), *(F.min(c).alias(c) for c in ("up_a", "up_b", "before", "upto"))
    )
    nodes = written_once(nodes.withColumn("key", _key(F.col("conv_id"))), "nodes")
    stretches = written_once(_peeled(_stretches(nodes)), "subtrees")
    ends = written_once(_ends(steps, convs), "ends")
    everyone = convs.agg(F.count(F.lit(1)).alias("n"), _least().alias("id")).first()
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]

    start, here = F.lit(everyone["id"]).cast("long"), F.col("depth")
    inside = stretches.select("key", "n", "top", "bottom", "up_conv", "n_children", "leaves", "below", F.col("upto").alias("end"))
    known = nodes.join(inside, ["key", "n"]).join(ends, ["a", "b", "depth"], "left")
    parent = F.when(here == 1, start).when(here == F.col("top"), F.col("up_conv")).otherwise(F.col("conv_id"))
    rows = known.select(
        "conv_id", "depth", parent.alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(here < F.col("bottom"), 1).otherwise(F.col("n_children")).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("below") + (F.col("n") - 1) * (F.col("end") - F.col("before"))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )
    under = stretches.where("top = 1").agg(F.count(F.lit(1)).alias("c"), F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
    ended = ends.where("depth = 0").agg(F.max("ends_sha256").alias("e"))
    root = under.join(F.broadcast(ended)).where(F.lit(everyone["n"] > 0)).select(  # one row each
        start.alias("conv_id"), _zero().alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(everyone["n"]).cast("long").alias("n_convs"), F.col("c").alias("n_children"),
        F.coalesce("l", F.lit(1).cast("long")).alias("n_leaves"), F.coalesce("s", _zero()).alias("saved_tokens"),
        F.coalesce("e", F.lit(_EMPTY)).alias("ends_sha256"),
    )
    return rows.select(*columns).unionByName(root)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are."""
    return trie(*as_they_are(numbered(conversations)))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations (see ``rebuilt``)."""
    return trie(*rebuilt(numbered(conversations)))
