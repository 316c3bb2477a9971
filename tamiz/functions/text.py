"""Text normalisation (strip, name text, key text, header names) and the quoting of names and values in SQL text.

Conditions are composed as SQL text: a rule file turns into hundreds of them, and one parsed expression costs the
driver far less than a tree of Column calls.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Python-style strip removes. Spark's trim() removes spaces only.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def quoted(name: str) -> str:
    """A column name in SQL text, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def literal(value: object) -> str:
    """A text value in SQL text."""
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return "'" + "".join(c if c.isprintable() else f"\\u{ord(c):04x}" for c in escaped) + "'"


def column(name: str) -> Column:
    return F.col(quoted(name))


def strip_sql(value: str) -> str:
    return f"btrim({value}, {literal(WHITESPACE)})"


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITESPACE))


def name_text(value: Column) -> Column:
    """Canonical display name: inner blanks collapsed, outer blanks gone, upper case."""
    return F.upper(F.trim(F.regexp_replace(value, r"\s+", " ")))


def key_sql(value: str) -> str:
    """Key text for comparisons: stripped, and '2024.0' reads as '2024'."""
    return f"regexp_replace({strip_sql(f'CAST({value} AS STRING)')}, {literal(r'\.0$')}, '')"


def key_text(value: Column) -> Column:
    return F.regexp_replace(strip(value.cast("string")), r"\.0$", "")


def header_name(raw: str) -> str:
    """Column-name form used when a header meets a dictionary: no BOM, blanks to '_', upper case."""
    return re.sub(r"\s+", "_", str(raw).replace("\ufeff", "").strip()).upper()


def header_text(value: Column) -> Column:
    """`header_name` for names held as data (a dictionary's rows)."""
    return F.upper(F.regexp_replace(strip(F.regexp_replace(value, "\ufeff", "")), r"\s+", "_"))
