"""Column-level building blocks: missing tokens, text clean-up, tolerant casts."""

from tamiz.functions.casts import as_integer, as_number, as_timestamp, cast_to
from tamiz.functions.missing import missing, present
from tamiz.functions.text import column, key_text, name_text, strip

__all__ = [
    "as_integer",
    "as_number",
    "as_timestamp",
    "cast_to",
    "column",
    "key_text",
    "missing",
    "name_text",
    "present",
    "strip",
]
