"""Oracle SQL fragments (DuckDB) for missing tokens, tolerant casts and rule counts."""

from __future__ import annotations

TOKENS = "('', 'nan', 'NaN', 'None', 'none', 'NULL', 'null', '<NA>', 'NaT')"


def missing(x: str) -> str:
    return f"({x} IS NULL OR trim({x}) IN {TOKENS})"


def present(*names: str) -> str:
    return "(" + " AND ".join(f"NOT {missing(x)}" for x in names) + ")"


def number(x: str) -> str:
    return f"TRY_CAST(trim({x}) AS DOUBLE)"


def date(x: str) -> str:
    return f"TRY_STRPTIME(trim({x}), '%d/%m/%Y')"


def key(x: str) -> str:
    return f"regexp_replace(trim({x}), '\\.0$', '')"


def scored(counts: str) -> str:
    """rule_id, evaluated_rows, failed_rows -> the scored result columns."""
    return f"""
SELECT rule_id, evaluated_rows, greatest(evaluated_rows - failed_rows, 0) AS passed_rows, failed_rows,
  CASE WHEN evaluated_rows > 0
       THEN round(CAST(greatest(evaluated_rows - failed_rows, 0) AS DOUBLE) / evaluated_rows * 100, 4) END AS score,
  CASE WHEN evaluated_rows = 0 THEN 'No evaluable' WHEN failed_rows = 0 THEN 'Sin observaciones'
       ELSE 'Con observaciones' END AS status
FROM ({counts}) c"""


def row_counts(view: str, rules: list[tuple[str, str, str]], with_clause: str = "WITH ") -> str:
    """One line per (rule_id, evaluable condition, failure condition)."""
    lines = [
        f"SELECT '{rid}' AS rule_id, count(*) FILTER (WHERE {ok}) AS evaluated_rows, "
        f"count(*) FILTER (WHERE ({ok}) AND ({bad})) AS failed_rows FROM v"
        for rid, ok, bad in rules
    ]
    return f"{with_clause}v AS ({view}) " + " UNION ALL ".join(lines)


def row_rules(view: str, rules: list[tuple[str, str, str]]) -> str:
    return scored(row_counts(view, rules))
