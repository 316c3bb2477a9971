"""Casts that turn bad text into NULL.

A failing text cast costs an exception per value inside the JVM, several times the price of the cast
itself, so every cast from text is guarded by a shape test first. The shapes also pin down what is a number
('1d' and hex floats are not) and keep the day-first formats apart.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.missing import text_sql
from tamiz.functions.text import literal, quoted

NUMBER_SHAPE = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
# Whole numbers written without an exponent, and numbers with one.
WHOLE_SHAPE = r"^[+-]?(?:[0-9]+\.?0*|\.0+)$"
EXPONENT_SHAPE = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)[eE][+-]?[0-9]+$"
# Plain whole numbers that BIGINT holds whatever their digits: nearly all whole numbers are met by this shape alone.
DIGITS_SHAPE = r"^[+-]?[0-9]{1,18}$"

# The accepted date layouts, in the order they are tried (name, Spark pattern, text shape).
DATE_FORMATS = (
    ("%d/%m/%Y %H:%M:%S", "d/M/yyyy H:m:s", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"),
    ("%d/%m/%Y", "d/M/yyyy", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"),
    ("%Y-%m-%d %H:%M:%S", "yyyy-M-d H:m:s", r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"),
    ("%Y-%m-%d", "yyyy-M-d", r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"),
    ("%Y/%m/%d", "yyyy/M/d", r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$"),
)

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMERIC = (*_WHOLE, T.FloatType, T.DoubleType, T.DecimalType)


def text_number_sql(text: str) -> str:
    """Stripped text -> DOUBLE or NULL."""
    return f"CASE WHEN {text} RLIKE {literal(NUMBER_SHAPE)} THEN try_cast({text} AS DOUBLE) END"


def text_timestamp_sql(text: str, formats=DATE_FORMATS) -> str:
    """Stripped text -> TIMESTAMP or NULL, by the layout whose shape fits (shapes are disjoint)."""
    branches = " ".join(
        f"WHEN {text} RLIKE {literal(shape)} THEN try_to_timestamp({text}, {literal(pattern)})" for _, pattern, shape in formats
    )
    return f"CASE {branches} END"


def _whole_sql(number: str) -> str:
    return f"CASE WHEN {number} % 1 = 0 AND abs({number}) < 9.0E18D THEN CAST({number} AS BIGINT) END"


def number_sql(df: DataFrame, name: str) -> str:
    if isinstance(df.schema[name].dataType, _NUMERIC):
        return f"CAST({quoted(name)} AS DOUBLE)"
    return f"({text_number_sql(text_sql(df, name))})"


def exact_sql(df: DataFrame, name: str) -> tuple[str, str]:
    """A number and its kind for comparisons: 'whole' (BIGINT) and 'decimal' keep every digit, anything else is 'double'."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, _WHOLE):
        return f"CAST({quoted(name)} AS BIGINT)", "whole"
    if isinstance(dtype, T.DecimalType):
        return quoted(name), "decimal"
    return number_sql(df, name), "double"


def bound_sql(value: object, against: str) -> tuple[str, str]:
    """A declared bound likewise, for a number of the kind ``against``; whole bounds that a double holds stay doubles for doubles."""
    number = Decimal(str(value))
    whole = number == number.to_integral_value() and abs(number) < 1 << 63
    if whole and (against != "double" or abs(number) > 1 << 53):
        return f"{int(number)}L", "whole"
    return f"{float(number)!r}D", "double"


_FLIPPED = {"<": ">", "<=": ">=", ">": "<", ">=": "<=", "=": "=", "<>": "<>"}
#: x op d for a whole x and a fractional d is x op floor(d) or ceil(d).
_ROUNDED = {"<": "ceil", ">=": "ceil", "<=": "floor", ">": "floor"}


def compare_sql(left: tuple[str, str], op: str, right: tuple[str, str]) -> str:
    """``left op right`` without rounding whole numbers to doubles; op is one of < <= > >= = <>.

    Whole and decimal numbers are compared as such. A whole number and a double meet as whole numbers, the double rounded to
    the side that decides; beyond 9e18, and for NaN, as doubles. A decimal meets a double as a double.
    """
    (a, kind_a), (b, kind_b) = left, right
    if kind_a == "double" and kind_b == "whole":
        return compare_sql(right, _FLIPPED[op], left)
    if kind_a == "whole" and kind_b == "double":
        if op in _ROUNDED:
            exact = f"{a} {op} {_ROUNDED[op]}({b})"
        else:
            same = f"({b} = floor({b}) AND {a} = floor({b}))"
            exact = same if op == "=" else f"NOT {same}"
        return f"(CASE WHEN abs({b}) < 9.0E18D THEN {exact} ELSE CAST({a} AS DOUBLE) {op} {b} END)"
    if kind_a != kind_b and "double" in (kind_a, kind_b):
        return f"(CAST({a} AS DOUBLE) {op} CAST({b} AS DOUBLE))"
    return f"({a} {op} {b})"


def integer_sql(df: DataFrame, name: str) -> str:
    """BIGINT or NULL; '12.0' and '1e3' are whole, '1.5' is not.

    Only numbers with an exponent go through DOUBLE; all others keep every digit, and those beyond BIGINT are NULL.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, _WHOLE):
        return f"CAST({quoted(name)} AS BIGINT)"
    if isinstance(dtype, T.DecimalType):
        value = quoted(name)
        return f"(CASE WHEN {value} = floor({value}) THEN try_cast({value} AS BIGINT) END)"
    if isinstance(dtype, _NUMERIC):
        return f"({_whole_sql(number_sql(df, name))})"
    text = text_sql(df, name)
    digits = f"split_part({text}, '.', 1)"
    exact = f"try_cast(CASE WHEN {digits} IN ('', '+', '-') THEN '0' ELSE {digits} END AS BIGINT)"
    whole = _whole_sql(f"try_cast({text} AS DOUBLE)")
    return (
        f"(CASE WHEN {text} RLIKE {literal(DIGITS_SHAPE)} THEN CAST({text} AS BIGINT)"
        f" WHEN {text} RLIKE {literal(WHOLE_SHAPE)} THEN {exact} WHEN {text} RLIKE {literal(EXPONENT_SHAPE)} THEN {whole} END)"
    )


def timestamp_sql(df: DataFrame, name: str, formats=DATE_FORMATS) -> str:
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return f"CAST({quoted(name)} AS TIMESTAMP)"
    return f"({text_timestamp_sql(text_sql(df, name), formats)})"


def cast_sql(df: DataFrame, name: str, logical_type: str) -> str:
    """SQL of a cast to a logical type: string, integer, long, double, decimal, decimal(p,s), datetime, boolean."""
    kind, value = logical_type.strip().lower(), quoted(name)
    if kind in ("integer", "int"):
        return f"try_cast({integer_sql(df, name)} AS INT)"
    if kind in ("long", "bigint"):
        return integer_sql(df, name)
    if kind in ("double", "float", "decimal"):
        return number_sql(df, name)
    if kind.startswith("decimal("):
        if not isinstance(df.schema[name].dataType, T.StringType):
            return f"try_cast({value} AS {kind})"
        text = text_sql(df, name)
        return f"CASE WHEN {text} RLIKE {literal(NUMBER_SHAPE)} THEN try_cast({text} AS {kind}) END"
    if kind in ("datetime", "timestamp", "date"):
        return timestamp_sql(df, name)
    if kind == "string":
        return f"CAST({value} AS STRING)"
    if kind in ("boolean", "bool"):
        return f"try_cast({value} AS BOOLEAN)"
    raise ValueError(f"unknown logical type: {logical_type!r}")


def as_number(df: DataFrame, name: str) -> Column:
    return F.expr(number_sql(df, name))


def as_integer(df: DataFrame, name: str) -> Column:
    return F.expr(integer_sql(df, name))


def as_timestamp(df: DataFrame, name: str, formats=DATE_FORMATS) -> Column:
    return F.expr(timestamp_sql(df, name, formats))


def cast_to(df: DataFrame, name: str, logical_type: str) -> Column:
    return F.expr(cast_sql(df, name, logical_type))
