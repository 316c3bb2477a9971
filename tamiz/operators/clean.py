"""Row-wise cleaning. Every step is one projection over all its columns, so a chain of steps stays one stage."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.casts import cast_sql, cast_to
from tamiz.functions.missing import SILVER_TOKENS, is_token_sql, text_sql
from tamiz.functions.text import column, header_name, literal, name_text, quoted


#: Text columns from which on their missing tokens are found by one expression over all of them. Written out per column, the
#: steps of a row grow into one generated method that the JVM no longer compiles (8000 bytes) but interprets.
WIDE = 8
_NULLED = "__nulled"


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def replace_columns(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """All replacements in a single select, column order kept."""
    if not new:
        return df
    return df.select(*[new[c].alias(c) if c in new else column(c) for c in df.columns])


def keep_where_equals(df: DataFrame, name: str, value: Any) -> DataFrame:
    """Master filter; rows with NULL in the column go too."""
    return df.where(column(name) == F.lit(value))


def tokens_to_null(df: DataFrame, tokens: Iterable[str] = SILVER_TOKENS, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing tokens become NULL in text columns; other values stay as they are."""
    names = [c for c in string_columns(df) if columns is None or c in columns]
    tokens = tuple(tokens)
    if len(names) < WIDE:
        return replace_columns(
            df, {c: F.expr(f"CASE WHEN NOT {is_token_sql(quoted(c), tokens)} THEN {quoted(c)} END") for c in names}
        )
    texts = ", ".join(quoted(c) for c in names)
    nulled = F.expr(f"transform(array({texts}), x -> CASE WHEN NOT {is_token_sql('x', tokens)} THEN x END)")
    staged = df.withColumn(_NULLED, nulled)
    return staged.select(*[staged[_NULLED][names.index(c)].alias(c) if c in names else column(c) for c in df.columns])


def special_value_sql(df: DataFrame, name: str, values: Iterable[Any]) -> str:
    return f"{text_sql(df, name)} IN ({', '.join(literal(v) for v in values)})"


def special_value(df: DataFrame, name: str, values: Iterable[Any]) -> Column:
    return F.expr(special_value_sql(df, name, values))


def special_values_to_null(df: DataFrame, values: Mapping[str, Iterable[Any]]) -> DataFrame:
    """Values that stand for 'none' in one column, such as date '0'."""
    return replace_columns(
        df,
        {
            c: F.expr(f"CASE WHEN NOT {special_value_sql(df, c, v)} THEN {quoted(c)} END")
            for c, v in values.items()
            if c in df.columns and list(v)
        },
    )


def trim_text(df: DataFrame) -> DataFrame:
    return replace_columns(df, {c: F.trim(column(c)) for c in string_columns(df)})


def pad_codes(df: DataFrame, widths: Mapping[str, tuple[int, str]], truncate: bool = False) -> DataFrame:
    """Fixed-width codes. A value longer than the width is kept whole unless `truncate` asks for plain lpad."""

    def padded(name: str, width: int, fill: str) -> Column:
        code = F.trim(column(name).cast("string"))
        out = F.lpad(code, width, fill)
        return out if truncate else F.when(F.length(code) < width, out).otherwise(code)

    return replace_columns(df, {c: padded(c, w, f) for c, (w, f) in widths.items() if c in df.columns})


def impute(df: DataFrame, constants: Mapping[str, Any]) -> DataFrame:
    """NULL -> constant, per column."""
    return replace_columns(
        df, {c: F.coalesce(column(c), F.lit(v)) for c, v in constants.items() if c in df.columns}
    )


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast to logical types; text that does not fit becomes NULL (counted by `conversion_errors`)."""
    return replace_columns(df, {c: cast_to(df, c, t) for c, t in types.items() if c in df.columns})


def conversion_error(df: DataFrame, name: str, logical_type: str) -> str:
    """SQL condition: the value was there before the cast and is NULL after it."""
    return f"({quoted(name)} IS NOT NULL AND ({cast_sql(df, name, logical_type)}) IS NULL)"


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*[c for c in names if c in df.columns])


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Rows that hold nothing at all."""
    return df.dropna(how="all")


def absent_columns(df: DataFrame, configured: Iterable[str]) -> list[str]:
    return sorted(set(configured) - set(df.columns))


def undeclared_columns(df: DataFrame, configured: Iterable[str]) -> list[str]:
    return [c for c in df.columns if c not in set(configured)]


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[header_name(c) for c in df.columns])


def normalise_names(df: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """New columns (target <- source) with the canonical name text."""
    return df.withColumns({new: name_text(column(old)) for new, old in targets.items() if old in df.columns})
