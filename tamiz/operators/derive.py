"""Derived, key and lineage columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.casts import as_integer, as_number
from tamiz.functions.text import column

# The sign flag's labels and the text that stands for NULL inside a row hash.
NORMAL, REVERSION = "NORMAL", "REVERSION"
NULL_TEXT = "<NULL>"
LINEAGE = ("source_system", "source_dataset", "silver_processed_at", "_audit_loaded_at", "record_hash")


def geo_code(parts: Sequence[str], width: int = 6) -> Column:
    """Composite code, padded to `width` and never cut; NULL when a part is NULL."""
    code = F.concat(*[column(p).cast("string") for p in parts])
    return F.when(F.length(code) < width, F.lpad(code, width, "0")).otherwise(code)


def month_key(df: DataFrame, year: str, month: str) -> Column:
    """202604 for April 2026."""
    return (as_integer(df, year) * 100 + as_integer(df, month)).cast("int")


def month_label(year: str, month: str) -> Column:
    """'2026-04' for April 2026."""
    return F.concat(column(year).cast("string"), F.lit("-"), F.lpad(column(month).cast("string"), 2, "0"))


def partition_year(df: DataFrame, year: str) -> Column:
    return as_integer(df, year).cast("int")


def sign_flag(df: DataFrame, amount: str) -> Column:
    """A NULL amount counts as a reversion."""
    return F.when(as_number(df, amount) >= 0, NORMAL).otherwise(REVERSION)


def positive_flag(df: DataFrame, amount: str) -> Column:
    return as_number(df, amount) > 0


def period_key(df: DataFrame, left: str, right: str) -> Column:
    """'left-right', NULL when a side is NULL or the table lacks it; whole numbers print without '.0'."""
    if left not in df.columns or right not in df.columns:
        return F.lit(None).cast("string")

    def shown(name: str) -> Column:
        value = column(name)
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            return F.when(value % 1 == 0, value.cast("bigint").cast("string")).otherwise(value.cast("string"))
        return value.cast("string")

    return F.concat(shown(left), F.lit("-"), shown(right))


def _hash_text(df: DataFrame, name: str) -> Column:
    value = column(name)
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        value = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    return F.coalesce(value.cast("string"), F.lit(NULL_TEXT))


def positional_hash(df: DataFrame, names: Sequence[str]) -> Column:
    """SHA-256 of the values joined by '|'. Compatible form; ('a|b','c') and ('a','b|c') hash alike."""
    return F.sha2(F.concat_ws("|", *[_hash_text(df, c) for c in names if c in df.columns]), 256)


def named_hash(df: DataFrame, names: Sequence[str] | None = None) -> Column:
    """SHA-256 of 'column=value' joined by '|', over all columns but the lineage ones."""
    chosen = [c for c in (names or df.columns) if c in df.columns and c not in LINEAGE]
    return F.sha2(F.concat_ws("|", *[F.concat(F.lit(f"{c}="), _hash_text(df, c)) for c in chosen]), 256)


def lineage(source_system: str, source_dataset: str, processed_at: dt.datetime, loaded_at: bool = False) -> dict[str, Column]:
    """Constant columns; the run's start is an argument so a rerun can reproduce it. A naive time is in session time."""
    at = F.lit(processed_at.isoformat(sep=" ")).cast("timestamp")
    columns = {
        "source_system": F.lit(source_system),
        "source_dataset": F.lit(source_dataset),
        "silver_processed_at": at,
    }
    if loaded_at:
        columns["_audit_loaded_at"] = at
    return columns
