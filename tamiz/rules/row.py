"""Row rules: each becomes a pair of SQL conditions on one row, `evaluable` and `failed`.

Three-valued logic is part of the meaning: a condition that is NULL counts as false, so a NULL condition column
is not evaluated and a NULL value compared with a constant does not fail.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.casts import as_number, bound_sql, compare_sql, exact_sql, number_sql, text_number_sql, timestamp_sql
from tamiz.functions.missing import RULE_TOKENS, missing_sql, present_sql, text_sql
from tamiz.functions.text import column, key_sql, literal, quoted
from tamiz.rules.model import Rule

EVERY_ROW = "true"


@dataclass(frozen=True)
class RowCheck:
    """Equal `evaluable` texts are counted once; `failed` implies `evaluable`."""

    evaluable: str
    failed: str


@dataclass(frozen=True)
class RowContext:
    df: DataFrame
    as_of: dt.datetime
    tokens: tuple[str, ...] = RULE_TOKENS
    filters: Mapping[tuple, str] = field(default_factory=dict)

    def missing(self, name: str) -> str:
        return missing_sql(self.df, name, self.tokens)

    def present(self, *names: str) -> str:
        return present_sql(self.df, *names, tokens=self.tokens)

    def number(self, name: str) -> str:
        return number_sql(self.df, name)

    def text(self, name: str, stripped: bool = True) -> str:
        return text_sql(self.df, name) if stripped else f"CAST({quoted(name)} AS STRING)"

    def timestamp(self, name: str) -> str:
        return timestamp_sql(self.df, name)


ROW_RULES: dict[str, Callable[[RowContext, Rule], RowCheck]] = {}


def _row_rule(*names: str):
    def register(build):
        ROW_RULES.update(dict.fromkeys(names, build))
        return build

    return register


def _on_present(ctx: RowContext, names: Iterable[str], bad: str) -> RowCheck:
    ok = ctx.present(*sorted(names))
    return RowCheck(ok, f"{ok} AND ({bad})")


def _unlike(name: str, value: object) -> str:
    return f"(CAST({quoted(name)} AS STRING) <> {literal(value)})"


@_row_rule("not_null", "required_not_empty", "observed_empty", "null_threshold")
def _no_value(ctx: RowContext, rule: Rule) -> RowCheck:
    return RowCheck(EVERY_ROW, ctx.missing(rule.columns[0]))


@_row_rule("conditional_null_allowed", "null_only_when")
def _value_unless(ctx: RowContext, rule: Rule) -> RowCheck:
    name, condition = rule.columns
    expected = _unlike(condition, rule.param("condition_value"))
    return RowCheck(expected, f"{expected} AND {ctx.missing(name)}")


@_row_rule("accepted_values", "allowed_values")
def _in_catalogue(ctx: RowContext, rule: Rule) -> RowCheck:
    values = ", ".join(literal(v) for v in rule.param("values", []))
    if not values:
        return _on_present(ctx, rule.columns, "true")
    return _on_present(ctx, rule.columns, f"{ctx.text(rule.columns[0], rule.param('strip', True))} NOT IN ({values})")


def _numeric(ctx: RowContext, rule: Rule, *bounds: str, beyond: Iterable[str] = ()) -> RowCheck:
    """Fails when no number, beyond a bound, or (by `integer`) not whole."""
    x = ctx.number(rule.columns[0])
    parts = [f"{x} IS NULL", *(f"{x} {b}" for b in bounds), *beyond]
    if rule.param("integer", False):
        parts.append(f"{x} % 1 <> 0")
    return _on_present(ctx, rule.columns, " OR ".join(parts))


@_row_rule("numeric_type", "numeric")
def _is_number(ctx: RowContext, rule: Rule) -> RowCheck:
    return _numeric(ctx, rule)


@_row_rule("accepted_range")
def _in_range(ctx: RowContext, rule: Rule) -> RowCheck:
    x = exact_sql(ctx.df, rule.columns[0])
    ends = (("<", rule.param("min_value")), (">", rule.param("max_value")))
    return _numeric(ctx, rule, beyond=[compare_sql(x, op, bound_sql(v, x[1])) for op, v in ends if v is not None])


@_row_rule("non_negative")
def _not_below_zero(ctx: RowContext, rule: Rule) -> RowCheck:
    return _numeric(ctx, rule, "< 0")


@_row_rule("month_period_between")
def _month_period(ctx: RowContext, rule: Rule) -> RowCheck:
    low, high = int(rule.param("min_value", 1)), int(rule.param("max_value", 13))
    return _numeric(ctx, rule, f"< {low}", f"> {high}", "% 1 <> 0")


@_row_rule("regex")
def _matches(ctx: RowContext, rule: Rule) -> RowCheck:
    """`anchored` reads the pattern as a match from the first character; `skip_when` leaves rows out."""
    name, pattern = rule.columns[0], rule.param("pattern")
    shape = f"^(?:{pattern})" if rule.param("anchored", False) else pattern
    bad = f"NOT {ctx.text(name, rule.param('strip', True))} RLIKE {literal(shape)}"
    skip = rule.param("skip_when")
    if not skip or skip[0] not in ctx.df.columns:
        return _on_present(ctx, [name], bad)
    ok = f"({ctx.present(name)} AND {_unlike(skip[0], skip[1])})"
    return RowCheck(ok, f"{ok} AND {bad}")


@_row_rule("year_4_digits")
def _four_digit_year(ctx: RowContext, rule: Rule) -> RowCheck:
    year = key_sql(quoted(rule.columns[0]))
    low, high = int(rule.param("min_year", 1000)), int(rule.param("max_year", 9999))
    # Four digits are a number below 2**31, so the cast needs no further guard.
    digits = f"{year} RLIKE {literal('^[0-9]{4}$')}"
    return _on_present(ctx, rule.columns, f"NOT {digits} OR try_cast({year} AS INT) NOT BETWEEN {low} AND {high}")


@_row_rule("date_parseable")
def _is_date(ctx: RowContext, rule: Rule) -> RowCheck:
    return _on_present(ctx, rule.columns, f"{ctx.timestamp(rule.columns[0])} IS NULL")


@_row_rule("date_not_future")
def _past_date(ctx: RowContext, rule: Rule) -> RowCheck:
    when = ctx.timestamp(rule.columns[0])
    now = f"TIMESTAMP '{ctx.as_of:%Y-%m-%d %H:%M:%S}'"
    return _on_present(ctx, rule.columns, f"{when} IS NULL OR {when} > {now}")


@_row_rule("conditional_date")
def _date_when(ctx: RowContext, rule: Rule) -> RowCheck:
    condition, date = rule.columns
    applies = f"({ctx.text(condition)} = {literal(rule.param('condition_value'))})"
    return RowCheck(applies, f"{applies} AND {ctx.timestamp(date)} IS NULL")


@_row_rule("conditional_value")
def _value_when(ctx: RowContext, rule: Rule) -> RowCheck:
    condition, expected = rule.columns
    applies = f"({ctx.text(condition, False)} = {literal(rule.param('condition_value'))})"
    return RowCheck(applies, f"{applies} AND {_unlike(expected, rule.param('expected_value'))}")


def bind_filters(df: DataFrame, rules: Iterable[Rule]) -> tuple[DataFrame, dict[tuple, str]]:
    """Add one boolean column per SQL pre-filter.

    The predicate sees the rule's own columns as DOUBLE: on text, `x > 0` would compare as integers and lose 0.50.
    """
    flags: dict[tuple, str] = {}
    for rule in rules:
        key = (rule.param("filter_condition"), rule.columns)
        if not key[0] or key in flags or any(c not in df.columns for c in rule.columns):
            continue
        flags[key] = f"__where_{len(flags)}"
        kept = {f"__raw_{i}": column(c) for i, c in enumerate(rule.columns)}
        numbers = {c: as_number(df, c) for c in rule.columns}
        back = {c: column(f"__raw_{i}") for i, c in enumerate(rule.columns)}
        df = df.withColumns(kept).withColumns(numbers).withColumn(flags[key], F.expr(key[0]))
        df = df.withColumns(back).drop(*kept)
    return df, flags


# Comparison -> its violation. Any other operator is refused, not read as equality.
_VIOLATIONS = {">=": "<", "<=": ">", ">": "<=", "<": ">=", "==": "<>", "=": "<>", "!=": "="}


@_row_rule("column_comparison")
def _compare(ctx: RowContext, rule: Rule) -> RowCheck:
    """Left op right as numbers, over the rows a SQL pre-filter keeps (see `bind_filters`)."""
    left, right = rule.columns[:2]
    violated = _VIOLATIONS.get(rule.param("operator", ">="))
    if violated is None:
        raise ValueError(f"{rule.rule_id}: unknown operator {rule.param('operator')!r}")
    a, b = ctx.number(left), ctx.number(right)
    bad = compare_sql(exact_sql(ctx.df, left), violated, exact_sql(ctx.df, right))
    if rule.param("non_numeric", "pass") == "fail":
        bad = f"{a} IS NULL OR {b} IS NULL OR {bad}"
    prefilter = rule.param("filter_condition")
    if not prefilter:
        return _on_present(ctx, (left, right), bad)
    ok = f"({ctx.present(left, right)} AND {quoted(ctx.filters[(prefilter, rule.columns)])})"
    return RowCheck(ok, f"{ok} AND ({bad})")


@_row_rule("less_or_equal")
def _at_most(ctx: RowContext, rule: Rule) -> RowCheck:
    a, b = ctx.number(rule.columns[0]), ctx.number(rule.columns[1])
    above = compare_sql(exact_sql(ctx.df, rule.columns[0]), ">", exact_sql(ctx.df, rule.columns[1]))
    return _on_present(ctx, rule.columns, f"{a} IS NULL OR {b} IS NULL OR {above}")


@_row_rule("parent_not_zero_if_child_nonzero")
def _parent_set(ctx: RowContext, rule: Rule) -> RowCheck:
    parent, child = rule.columns
    nonzero = f"({ctx.present(child)} AND {ctx.number(child)} <> 0)"
    return RowCheck(nonzero, f"{nonzero} AND {ctx.present(parent)} AND {ctx.number(parent)} = 0")


@_row_rule("year_not_future")
def _past_year(ctx: RowContext, rule: Rule) -> RowCheck:
    """Text that is no number passes or fails by `non_numeric`."""
    name, limit = rule.columns[0], ctx.as_of.year
    if rule.param("non_numeric", "fail") == "pass":
        return _on_present(ctx, [name], f"{ctx.number(name)} >= {limit + 1}")
    number = f"({text_number_sql(key_sql(quoted(name)))})"
    return _on_present(ctx, [name], f"{number} IS NULL OR {number} > {limit}")
