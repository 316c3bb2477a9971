"""What counts as 'no value': NULL, or text that only says so."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.text import literal, quoted, strip_sql

# The token sets of the quality rules, the null profile, the Silver cleaning step and
# type inference. Values are stripped before the test, so " " is covered by "".
RULE_TOKENS = ("", "nan", "NaN", "None", "none", "NULL", "null", "<NA>", "NaT")
PROFILE_TOKENS = ("", "nan", "NaN", "None", "NULL", "null", "<NA>")
SILVER_TOKENS = ("", "NULL", "null", "None", "none", "NaN", "nan", "N/A", "n/a")
INFERENCE_TOKENS = ("", "nan", "NaN", "None", "null", "NULL")


def is_token_sql(text: str, tokens: Iterable[str] = RULE_TOKENS) -> str:
    """The stripped text is one of the tokens (NULL text gives NULL)."""
    return f"{strip_sql(text)} IN ({', '.join(literal(t) for t in sorted(set(tokens)))})"


def missing_sql(df: DataFrame, name: str, tokens: Iterable[str] = RULE_TOKENS) -> str:
    """NULL or a missing token. Typed columns cannot hold a token (NaN aside), so they skip the text test."""
    value, dtype = quoted(name), df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return f"({value} IS NULL OR {is_token_sql(value, tokens)})"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return f"({value} IS NULL OR isnan({value}))"
    if isinstance(dtype, T.NullType):
        return "true"
    return f"({value} IS NULL)"


def present_sql(df: DataFrame, *names: str, tokens: Iterable[str] = RULE_TOKENS) -> str:
    return "(" + " AND ".join(f"NOT {missing_sql(df, n, tokens)}" for n in names) + ")"


def text_sql(df: DataFrame, name: str) -> str:
    """Value as stripped text."""
    value = quoted(name)
    return strip_sql(value if isinstance(df.schema[name].dataType, T.StringType) else f"CAST({value} AS STRING)")


def missing(df: DataFrame, name: str, tokens: Iterable[str] = RULE_TOKENS) -> Column:
    return F.expr(missing_sql(df, name, tokens))


def present(df: DataFrame, *names: str, tokens: Iterable[str] = RULE_TOKENS) -> Column:
    return F.expr(present_sql(df, *names, tokens=tokens))


def text(df: DataFrame, name: str) -> Column:
    return F.expr(text_sql(df, name))
