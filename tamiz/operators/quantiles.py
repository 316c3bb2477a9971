"""Exact quantiles (linear interpolation) per group, from value counts, without holding a group in one task.

Input is one row per (group, value) with its count. The range that holds a wanted rank is narrowed until it has few enough
distinct values for one task: approximate quantiles cut it (a bounded sketch, fixed as literals so that a rerun task sees the same
cuts), the totals of its parts tell the part of the rank, and so on. Only the last ranges are ranked.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.session import literal_rows, written_once

#: Distinct values of a range that one task ranks, and the parts that a longer range is cut into.
BUCKET = 1 << 20
PARTS = 64

_RANGE = "id int, `{group}` string, lo double, hi double"


def exact_quantiles(
    counts: DataFrame, group: str, value: str, count: str, probabilities: Sequence[float], bucket: int = BUCKET
) -> DataFrame:
    """(group, quantiles ARRAY<DOUBLE>) in the order of `probabilities`; groups (text) without a value have no row."""
    stored = written_once(
        counts.where(F.col(value).isNotNull()).select(
            F.col(group).cast("string").alias(group), F.col(value).cast("double").alias("v"), F.col(count).cast("bigint").alias("n")
        ),
        "numbers",
    )
    # A row per group, that is per profiled column.
    sizes = stored.groupBy(group).agg(F.count(F.lit(1)), F.sum("n")).collect()
    wanted: list[dict[str, Any]] = []
    for name, distinct, total in sizes:
        for i, p in enumerate(probabilities):
            at = (total - 1) * float(p)
            for side, rank in enumerate((math.floor(at), math.ceil(at))):
                wanted.append({group: name, "i": i, "side": side, "rank": rank, "at": at, "lo": None, "hi": None, "below": 0, "size": distinct})
    while any(w["size"] > bucket for w in wanted):
        _narrow(stored, group, [w for w in wanted if w["size"] > bucket])
    return _ranked(stored, group, wanted)


def _ranges(group: str, wanted: Sequence[dict[str, Any]]) -> list[dict[str, Any]]:
    """The distinct ranges (lo, hi] of some ranks, numbered; each rank learns the number of its own."""
    ids: dict[tuple, int] = {}
    for w in wanted:
        w["id"] = ids.setdefault((w[group], w["lo"], w["hi"]), len(ids))
    return [{"id": i, group: g, "lo": lo, "hi": hi} for (g, lo, hi), i in ids.items()]


def _inside(stored: DataFrame, group: str, ranges: Sequence[Mapping[str, Any]], *more: str) -> DataFrame:
    """The values in each range. Ranges are as many as wanted ranks at most."""
    ddl = ", ".join([_RANGE.format(group=group), *more])
    within = "(lo IS NULL OR v > lo) AND (hi IS NULL OR v <= hi)"
    return stored.join(F.broadcast(literal_rows(stored.sparkSession, ranges, ddl)), group).where(within)


def _narrow(stored: DataFrame, group: str, wanted: Sequence[dict[str, Any]]) -> None:
    """Sets each rank's range to the part of it that holds the rank, which has about 1 / PARTS of its values."""
    ranges = _ranges(group, wanted)
    cuts = F.array(*[F.lit(i / PARTS) for i in range(1, PARTS)])
    sketched = _inside(stored, group, ranges).groupBy("id").agg(F.percentile_approx("v", cuts, F.lit(PARTS * 20)).alias("edges"))
    edges = {r["id"]: sorted(set(r["edges"])) for r in sketched.collect()}
    cut = [{**r, "edges": edges[r["id"]]} for r in ranges]
    part = F.size(F.filter("edges", lambda e: e < F.col("v"))).alias("part")
    totals = _inside(stored, group, cut, "edges array<double>").groupBy("id", part)
    found: dict[int, dict[int, tuple[int, int]]] = {}
    for row in totals.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("size")).collect():
        found.setdefault(row["id"], {})[row["part"]] = (row["n"], row["size"])
    for w in wanted:
        own, marks = found[w["id"]], edges[w["id"]]
        for k in sorted(own):
            n, size = own[k]
            if w["rank"] < w["below"] + n:
                w["lo"] = marks[k - 1] if k else w["lo"]
                w["hi"] = marks[k] if k < len(marks) else w["hi"]
                w["size"] = size
                break
            w["below"] += n


def _ranked(stored: DataFrame, group: str, wanted: Sequence[dict[str, Any]]) -> DataFrame:
    ranges = _ranges(group, wanted)
    below = {w["id"]: w["below"] for w in wanted}
    held = _inside(stored, group, [{**r, "below": below[r["id"]]} for r in ranges], "below bigint")
    upto = held.withColumn("upto", F.col("below") + F.expr("sum(n) over (partition by id order by v rows unbounded preceding)"))
    ranks = literal_rows(stored.sparkSession, [{k: w[k] for k in ("id", "i", "side", "rank", "at")} for w in wanted], "id int, i int, side int, rank bigint, at double")
    found = upto.join(F.broadcast(ranks), "id").where("rank < upto AND rank >= upto - n")
    sides = found.groupBy(group, "i").agg(
        F.max(F.when(F.col("side") == 0, F.col("v"))).alias("lo"),
        F.max(F.when(F.col("side") == 1, F.col("v"))).alias("hi"),
        F.max("at").alias("at"),
    )
    share = F.col("at") - F.floor("at")
    each = sides.select(group, "i", (F.col("lo") * (1 - share) + F.col("hi") * share).alias("q"))
    return each.groupBy(group).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "q"))), lambda t: t["q"]).alias("quantiles")
    )
