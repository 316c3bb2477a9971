"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.text import column
from tamiz.session import written_once


def _first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*[column(k) for k in keys]).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).where(F.col("__rank") == 1).drop("__rank")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column], tie_break: Sequence[Column]) -> DataFrame:
    """One row per key: the first by `order`, then by `tie_break`, which must make the choice unique.

    Keys the table lacks are left out; without any key the table comes back whole. Each map task keeps one row per
    key before the shuffle (Spark's window group limit), so a key with a third of the rows costs one row per task.
    """
    present = [k for k in keys if k in df.columns]
    if not present:
        return df
    return _first_per_key(df, present, [*order, *tie_break])


def repeated_hashes(df: DataFrame, hashed: Column) -> DataFrame:
    """Hash values that occur more than once, as a table in the shared folder (`__h`)."""
    return written_once(df.groupBy(hashed.alias("__h")).count().where("count > 1").select("__h"), "repeated-hashes")


def keep_first_of_few(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], tie_break: Sequence[Column]
) -> DataFrame:
    """Same rows as `keep_first`, for tables where repeated keys are rare.

    A first job counts hashed keys (8 bytes per row through the shuffle, not the row). Only rows with a repeated hash go
    through the window; where the hashes are few, adaptive execution broadcasts them and the other rows never move.
    Hash collisions only send a row through the window for nothing.
    """
    present = [k for k in keys if k in df.columns]
    if not present:
        return df
    hashed = F.xxhash64(*[column(k) for k in present])
    repeated = repeated_hashes(df, hashed)
    marked = df.withColumn("__h", hashed)
    unique = marked.join(repeated, "__h", "left_anti").drop("__h")
    contested = marked.join(repeated, "__h", "left_semi").drop("__h")
    return unique.unionByName(_first_per_key(contested, present, [*order, *tie_break]))


def drop_repeated_rows(df: DataFrame) -> DataFrame:
    return df.distinct()
