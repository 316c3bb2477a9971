"""Writers: raw appends by date, flat and partitioned overwrites, report files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import column

BOM = "\ufeff"
DATE_PARTS = ("year", "month", "day")


def with_date_parts(df: DataFrame, day: dt.date) -> DataFrame:
    return df.withColumns({"year": F.lit(f"{day:%Y}"), "month": F.lit(f"{day:%m}"), "day": F.lit(f"{day:%d}")})


def append_raw(df: DataFrame, root: str, source: str, dataset: str, day: dt.date) -> str:
    """Append below {root}/{source}/{dataset}/year=/month=/day=, as delivered, snappy."""
    path = f"{root}/{source}/{dataset}"
    with_date_parts(df, day).write.mode("append").partitionBy(*DATE_PARTS).option("compression", "snappy").parquet(path)
    return path


def overwrite_flat(df: DataFrame, root: str, source: str, dataset: str) -> str:
    """One table per dataset, replaced as a whole."""
    path = f"{root}/{source}/{dataset}"
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], whole: bool = True, regroup: bool = False) -> str:
    """Partitioned overwrite, idempotent. `whole` replaces the table; otherwise only the partitions that get rows.

    Tasks write one file per partition value they hold. `regroup` shuffles the rows by value first, for inputs whose splits mix
    many values: adaptive execution cuts a large value over several tasks and lets small ones share one.
    """
    if regroup:
        df = df.hint("rebalance", *[column(c) for c in partition_by])
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    writer.option("partitionOverwriteMode", "static" if whole else "dynamic").parquet(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "append") -> str:
    df.write.mode(mode).json(path)
    return path


def write_csv_report(report: DataFrame, path: str, bom: bool = True) -> str:
    """A report table (rows by rules or columns, not by data) as one CSV file with header."""
    first, *rest = report.columns
    named = report.toDF(BOM + first, *rest) if bom else report
    named.coalesce(1).write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
    return path


def write_parquet_report(report: DataFrame, path: str) -> str:
    report.coalesce(1).write.mode("overwrite").parquet(path)
    return path
