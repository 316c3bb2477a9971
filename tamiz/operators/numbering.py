"""Gapless numbers for the rows of a table, in an order, without one task seeing all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import column, quoted
from tamiz.session import written_once

_PART, _RANK, _BEFORE = "__part", "__rank", "__before"


def numbered(df: DataFrame, order: Sequence[str], into: str, start: int = 1) -> DataFrame:
    """`df` with the numbers start, start + 1, ... in the order of some columns, which should tell the rows apart.

    Rows are ranked within range partitions; what lies before a partition is a running sum over one count per partition.
    The ranged rows are written once, for the counts and the ranks must see the same partitions.
    """
    ranged = df.repartitionByRange(*[column(c) for c in order]).withColumn(_PART, F.spark_partition_id())
    ranged = written_once(ranged, "numbered")
    counts = ranged.groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))
    before = F.expr(f"coalesce(sum(n) over (order by {_PART} rows between unbounded preceding and 1 preceding), 0)")
    within = F.expr(f"row_number() over (partition by {_PART} order by {', '.join(quoted(c) for c in order)})")
    ranked = ranged.withColumn(_RANK, within).join(counts.select(_PART, before.alias(_BEFORE)), _PART)
    return ranked.withColumn(into, F.col(_BEFORE) + F.col(_RANK) + (start - 1)).drop(_PART, _RANK, _BEFORE)
