"""Weighted rendezvous sharding of stable record keys, in DataFrame functions only.

Every (record key, shard) pair has a hash u in (0, 1); a record goes to the shard with the least ``-ln(u) / weight``. A shard's
share is its weight's share, and adding a shard moves only the records that the new shard wins.

* a null key is a key of its own; equal keys share a shard; ties between shards go to the smaller shard number;
* a null or empty text has size 1 (its end mark) and the CRC of no bytes, 0;
* an empty table gives an empty result; extra columns are carried along untouched by ``assign``.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.session import written_once


def shard_of(keys: Sequence[Column], weights: Mapping[int, float] | int) -> Column:
    """The shard that wins a record. ``weights``: shard number -> weight, or a count of equal shards from 0."""
    shares = weights if isinstance(weights, Mapping) else dict.fromkeys(range(weights), 1.0)
    if not shares or min(shares.values()) <= 0:
        raise ValueError("at least one shard is needed, and weights must be positive")
    bids = []
    for shard, weight in sorted(shares.items()):
        bits = F.shiftrightunsigned(F.xxhash64(*keys, F.lit(shard)), 11)
        cost = -F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 53))) / F.lit(float(weight))
        bids.append(F.struct(cost.alias("cost"), F.lit(shard).cast("int").alias("shard")))
    return bids[0]["shard"] if len(bids) == 1 else F.least(*bids)["shard"]


def assign(df: DataFrame, keys: Sequence[str], weights: Mapping[int, float] | int, into: str = "shard") -> DataFrame:
    """``df`` with the shard of each row; no shuffle."""
    return df.withColumn(into, shard_of([F.col(f"`{k}`") for k in keys], weights))


def slots(df: DataFrame, group: str, order: Sequence[str], into: str = "slot") -> DataFrame:
    """A gapless place from 0 on for each row of its group, ascending in ``order`` within each split of the input.

    Rows are ranked by (group, input split), so a group that holds most of the table is ranked by as many tasks as the
    input has splits. The splits' starts are one running sum over (group, split) counts. The ranked rows are written to
    the shared folder, for both readers must see the same split numbers; pass narrow rows.
    """
    part, rank, start = (f"_{x}_{uuid.uuid4().hex[:8]}" for x in ("part", "rank", "start"))
    within = Window.partitionBy(group, part).orderBy(*order)
    ranked = df.withColumn(part, F.spark_partition_id()).withColumn(rank, F.row_number().over(within).cast("long"))
    ranked = written_once(ranked, "slots")
    before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranked.groupBy(group, part)
        .agg(F.max(rank).alias(start))
        .withColumn(start, F.coalesce(F.sum(start).over(before), F.lit(0).cast("long")))
    )
    placed = ranked.join(starts, [group, part])
    return placed.select(*df.columns, (F.col(start) + F.col(rank) - 1).alias(into))


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and the shard among one more, for each document."""
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b"").cast("binary"))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(raw).cast("long") + 1).alias("size"),
        F.crc32(raw).alias("text_crc32"),
        shard_of([F.col("doc_id")], shards).alias("shard"),
        shard_of([F.col("doc_id")], shards + 1).alias("grown_shard"),
    )
    return slots(narrow, "shard", ["doc_id", "text_crc32", "size"])


def write_shards(df: DataFrame, path: str, keys: Sequence[str], weights: Mapping[int, float] | int) -> None:
    """Writes ``df`` as one folder per shard; tasks write their own files, so no shard passes through one task."""
    assign(df, keys, weights).write.partitionBy("shard").parquet(path)
