"""Queries over the quality rules: row rules, set rules, samples, summaries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.rules import Rule, evaluate, rule
from tamiz.rules.evaluate import compile_rules, failed_samples, failed_set_samples
from tamiz.rules.sets import coverage_short_years
from tamiz.rules.reports import dimension_cards, quality_summary, run_totals, severity_summary, top_alerts
from tamiz.plans.quality import ledger_quality, survey_quality
from workload.duck import date, key, missing, number, present, row_counts, row_rules, scored
from workload.tables import AS_OF, DUCK_LINES, DUCK_ORDERS, raw_lines, raw_orders, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SCORED = ("rule_id", "evaluated_rows", "passed_rows", "failed_rows", "score", "status")


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return register


def scores(df: DataFrame, rules: Sequence[Rule], dataset: str = "t", **options) -> DataFrame:
    return evaluate(df, rules, dataset=dataset, as_of=AS_OF, **options).select(*SCORED)


def _rows(name: str, view: Callable, duck_view: str, rules: Sequence[Rule], conditions: Sequence[tuple[str, str]]):
    """Register a row-rule query whose oracle lists (evaluable, failure) in the order of the rules."""
    sql = row_rules(duck_view, [(r.rule_id, ok, bad) for r, (ok, bad) in zip(rules, conditions, strict=True)])

    def build(spark: SparkSession, sf: str) -> DataFrame:
        return scores(view(spark, sf), rules)

    query(name, sql)(build)


# --- row rules -------------------------------------------------------------------------------------------------

SCORECARD = [
    rule("not_null", "status", dimension="Completitud", severity="Bloqueante"),
    rule("required_not_empty", "amount", dimension="Completitud", severity="Alta"),
    rule("observed_empty", "order_date", dimension="Completitud", severity="Baja"),
    rule("accepted_values", "status", values=["O", "F", "P"], dimension="Validez", severity="Alta", strip=False),
    rule("allowed_values", "status", values=["O", "F", "P"], dimension="Validez", severity="Media"),
    rule("numeric_type", "amount", dimension="Validez", severity="Alta"),
    rule("accepted_range", "amount", min_value=0, max_value=300000, dimension="Exactitud", severity="Media"),
    rule("regex", "order_year", pattern=r"^\d{4}$", dimension="Conformidad", severity="Media"),
    rule("year_4_digits", "order_year", min_year=1990, max_year=2050, dimension="Exactitud", severity="Alta"),
    rule("date_parseable", "order_date", dimension="Validez", severity="Media"),
    rule("conditional_value", "level", "level_name", condition_value="F", expected_value="FILLED", dimension="Consistencia", severity="Alta"),
    rule("month_period_between", "order_month", min_value=1, max_value=12, dimension="Oportunidad", severity="Media"),
]
_SCORECARD_SQL = [
    ("true", missing("status")),
    ("true", missing("amount")),
    ("true", missing("order_date")),
    (present("status"), "status NOT IN ('O', 'F', 'P')"),
    (present("status"), "trim(status) NOT IN ('O', 'F', 'P')"),
    (present("amount"), f"{number('amount')} IS NULL"),
    (present("amount"), f"{number('amount')} IS NULL OR {number('amount')} < 0 OR {number('amount')} > 300000"),
    (present("order_year"), "NOT regexp_matches(trim(order_year), '^[0-9]{4}$')"),
    (
        present("order_year"),
        f"NOT regexp_matches({key('order_year')}, '^[0-9]{{4}}$') OR TRY_CAST({key('order_year')} AS DOUBLE) NOT BETWEEN 1990 AND 2050",
    ),
    (present("order_date"), f"{date('order_date')} IS NULL"),
    ("level = 'F'", "level_name <> 'FILLED'"),
    (
        present("order_month"),
        f"{number('order_month')} IS NULL OR {number('order_month')} NOT BETWEEN 1 AND 12 OR {number('order_month')} % 1 <> 0",
    ),
]
_rows("quality_scorecard_orders", raw_orders, DUCK_ORDERS, SCORECARD, _SCORECARD_SQL)

_rows(
    "rule_completeness_variants",
    raw_orders,
    DUCK_ORDERS,
    [
        rule("not_null", "sector", rule_id="sector.not_null"),
        rule("not_null", "order_year", rule_id="year.not_null"),
        rule("not_null", "level", rule_id="level.not_null"),
        rule("not_null", "o_orderkey", rule_id="key.not_null"),
    ],
    [("true", missing("sector")), ("true", missing("order_year")), ("true", missing("level")), ("true", "o_orderkey IS NULL")],
)

_rows(
    "rule_conditional_null",
    raw_orders,
    DUCK_ORDERS,
    [rule("conditional_null_allowed", "sector", "level", condition_value="O")],
    [("level <> 'O'", missing("sector"))],
)
_rows(
    "rule_null_only_when",
    raw_orders,
    DUCK_ORDERS,
    [rule("null_only_when", "sector", "level", condition_value="O", dimension="Consistencia")],
    [("level <> 'O'", missing("sector"))],
)
_rows(
    "rule_regex_skip",
    raw_orders,
    DUCK_ORDERS,
    [
        rule("regex", "sector", pattern=r"^[1-3]$", skip_when=("level", "O"), rule_id="sector.regex"),
        rule("regex", "priority", pattern=r"[1-3]-[A-Z]+", anchored=True, rule_id="priority.match"),
        rule("regex", "priority", pattern=r"[A-Z]+$", rule_id="priority.search"),
    ],
    [
        (f"{present('sector')} AND level <> 'O'", "NOT regexp_matches(trim(sector), '^[1-3]$')"),
        (present("priority"), "NOT regexp_matches(trim(priority), '^([1-3]-[A-Z]+)')"),
        (present("priority"), "NOT regexp_matches(trim(priority), '[A-Z]+$')"),
    ],
)
_BRANDS = "SELECT * FROM part"
_rows(
    "rule_regex_part",
    lambda spark, sf: table(spark, sf, "part"),
    _BRANDS,
    [rule("regex", "p_brand", pattern=r"^Brand#\d{2}$"), rule("regex", "p_name", pattern=r"^[a-z ]+$")],
    [(present("p_brand"), "NOT regexp_matches(p_brand, '^Brand#[0-9]{2}$')"), (present("p_name"), "NOT regexp_matches(trim(p_name), '^[a-z ]+$')")],
)
_rows(
    "rule_year_not_future",
    raw_orders,
    DUCK_ORDERS,
    [
        rule("year_not_future", "order_year", rule_id="strict"),
        rule("year_not_future", "order_year", rule_id="lenient", non_numeric="pass"),
    ],
    [
        (present("order_year"), f"TRY_CAST({key('order_year')} AS DOUBLE) IS NULL OR TRY_CAST({key('order_year')} AS DOUBLE) > 1999"),
        (present("order_year"), f"{number('order_year')} >= 2000"),
    ],
)
_rows(
    "rule_dates",
    raw_orders,
    DUCK_ORDERS,
    [
        rule("date_parseable", "order_date"),
        rule("date_not_future", "order_date"),
        rule("conditional_date", "level", "order_date", condition_value="F"),
    ],
    [
        (present("order_date"), f"{date('order_date')} IS NULL"),
        (present("order_date"), f"{date('order_date')} IS NULL OR {date('order_date')} > TIMESTAMP '1999-06-30 12:00:00'"),
        ("trim(level) = 'F'", f"{date('order_date')} IS NULL"),
    ],
)
_rows(
    "rule_non_negative",
    lambda spark, sf: table(spark, sf, "customer"),
    "SELECT * FROM customer",
    [rule("non_negative", "c_acctbal"), rule("non_negative", "c_acctbal", integer=True, rule_id="whole")],
    [("c_acctbal IS NOT NULL", "c_acctbal < 0"), ("c_acctbal IS NOT NULL", "c_acctbal < 0 OR c_acctbal % 1 <> 0")],
)
_rows(
    "rule_non_negative_text",
    raw_lines,
    DUCK_LINES,
    [
        rule("non_negative", "quantity", integer=True),
        rule("non_negative", "price"),
        rule("numeric", "quantity", integer=True, rule_id="quantity.integer"),
        rule("numeric", "price"),
    ],
    [
        (present("quantity"), f"{number('quantity')} IS NULL OR {number('quantity')} < 0 OR {number('quantity')} % 1 <> 0"),
        (present("price"), f"{number('price')} IS NULL OR {number('price')} < 0"),
        (present("quantity"), f"{number('quantity')} IS NULL OR {number('quantity')} % 1 <> 0"),
        (present("price"), f"{number('price')} IS NULL"),
    ],
)
_rows(
    "rule_range_open_ends",
    raw_lines,
    DUCK_LINES,
    [
        rule("accepted_range", "price", min_value=1000, rule_id="from"),
        rule("accepted_range", "price", max_value=50000, rule_id="upto"),
        rule("accepted_range", "quantity", min_value=1, max_value=50, rule_id="between"),
    ],
    [
        (present("price"), f"{number('price')} IS NULL OR {number('price')} < 1000"),
        (present("price"), f"{number('price')} IS NULL OR {number('price')} > 50000"),
        (present("quantity"), f"{number('quantity')} IS NULL OR {number('quantity')} < 1 OR {number('quantity')} > 50"),
    ],
)
_rows(
    "rule_conditional_value",
    raw_lines,
    DUCK_LINES,
    [
        rule("conditional_value", "flag", "line_status", condition_value="N", expected_value="O"),
        rule("conditional_value", "flag", "line_status", condition_value="R", expected_value="F", rule_id="returned"),
    ],
    [("flag = 'N'", "line_status <> 'O'"), ("flag = 'R'", "line_status <> 'F'")],
)
_AMOUNT, _OPENING = number("amount"), number("opening")
_BOTH = present("amount", "opening")
_rows(
    "rule_column_comparison",
    raw_orders,
    DUCK_ORDERS,
    [
        rule("column_comparison", "amount", "opening", operator=">=", rule_id="ge"),
        rule("column_comparison", "amount", "opening", operator="<=", rule_id="le"),
        rule("column_comparison", "amount", "opening", operator=">", rule_id="gt"),
        rule("column_comparison", "amount", "opening", operator="==", rule_id="eq"),
        rule("column_comparison", "amount", "opening", operator=">=", filter_condition="opening > 0", rule_id="ge_where"),
        rule("less_or_equal", "opening", "amount", rule_id="strict_le"),
    ],
    [
        (_BOTH, f"{_AMOUNT} < {_OPENING}"),
        (_BOTH, f"{_AMOUNT} > {_OPENING}"),
        (_BOTH, f"{_AMOUNT} <= {_OPENING}"),
        (_BOTH, f"{_AMOUNT} <> {_OPENING}"),
        (f"{_BOTH} AND {_OPENING} > 0", f"{_AMOUNT} < {_OPENING}"),
        (_BOTH, f"{_AMOUNT} IS NULL OR {_OPENING} IS NULL OR {_OPENING} > {_AMOUNT}"),
    ],
)
_rows(
    "rule_hierarchy",
    raw_lines,
    DUCK_LINES,
    [rule("parent_not_zero_if_child_nonzero", "parent_code", "line_code")],
    [(f"{present('line_code')} AND {number('line_code')} <> 0", f"{present('parent_code')} AND {number('parent_code')} = 0")],
)
_rows(
    "rule_month_period",
    raw_orders,
    DUCK_ORDERS,
    [rule("month_period_between", "order_month")],
    [
        (
            present("order_month"),
            f"{number('order_month')} IS NULL OR {number('order_month')} NOT BETWEEN 1 AND 13 OR {number('order_month')} % 1 <> 0",
        )
    ],
)


@query(
    "rule_null_threshold",
    f"""
WITH v AS ({DUCK_ORDERS}),
n AS (SELECT count(*) AS t, count(*) FILTER (WHERE {missing('status')}) AS a,
             count(*) FILTER (WHERE {missing('amount')}) AS b FROM v),
c AS (SELECT 'loose' AS rule_id, t, a AS m, 50.0 AS lim FROM n
      UNION ALL SELECT 'tight', t, b, 0.1 FROM n)
SELECT rule_id, t AS evaluated_rows, CASE WHEN m * 100.0 / t > lim THEN m ELSE 0 END AS failed_rows,
  'Nulos: ' || printf('%.4f', m * 100.0 / t) || '%. ' ||
  CASE WHEN m * 100.0 / t > lim THEN 'Superado — revisar.' ELSE 'Dentro del umbral esperado.' END AS observation
FROM c""",
)
def _null_threshold(spark, sf):
    rules = [
        rule("null_threshold", "status", threshold_pct=50.0, rule_id="loose", observation="Nulos: {0}%. {1}"),
        rule("null_threshold", "amount", threshold_pct=0.1, rule_id="tight", observation="Nulos: {0}%. {1}"),
    ]
    out = evaluate(raw_orders(spark, sf), rules, dataset="orders", as_of=AS_OF)
    return out.select("rule_id", "evaluated_rows", "failed_rows", "observation")


_PATTERNS = {
    "settings": {"source": "t"},
    "global_rules": {
        "duplicate_full_rows": {"enabled": False},
        "pattern_rules": {
            "monetary_non_negative": {"enabled": True, "startswith": ["pri"], "contains": ["coun"]},
            "count_non_negative_integer": {"enabled": True, "startswith": ["quan", "line"], "skip_contains": ["status"]},
            "year_4_digits": {"enabled": True, "contains": ["year"], "min_year": 1990, "max_year": 2030},
            "date_parseable": {"enabled": True, "contains": ["date"]},
            "one_digit": {"enabled": True, "exact_columns": ["line_code", "supplier"], "regex": r"^\d$"},
            "switched_off": {"enabled": False, "contains": ["a"]},
        },
    },
    "datasets": {"lines": {}},
}


@query(
    "rule_pattern_columns",
    row_rules(
        DUCK_LINES,
        [
            ("lines.price.non_negative", present("price"), f"{number('price')} IS NULL OR {number('price')} < 0"),
            ("lines.discount.non_negative", present("discount"), f"{number('discount')} IS NULL OR {number('discount')} < 0"),
            (
                "lines.quantity.non_negative",
                present("quantity"),
                f"{number('quantity')} IS NULL OR {number('quantity')} < 0 OR {number('quantity')} % 1 <> 0",
            ),
            ("lines.line_code.non_negative", present("line_code"), f"{number('line_code')} < 0"),
            ("lines.ship_year.year_4_digits", present("ship_year"), f"NOT regexp_matches({key('ship_year')}, '^[0-9]{{4}}$')"),
            ("lines.ship_date.date_parseable", present("ship_date"), f"{date('ship_date')} IS NULL"),
            ("lines.line_code.one_digit", present("line_code"), "NOT regexp_matches(trim(line_code), '^[0-9]$')"),
            ("lines.supplier.one_digit", present("supplier"), "NOT regexp_matches(trim(supplier), '^[0-9]$')"),
        ],
    ),
)
def _pattern_columns(spark, sf):
    return survey_quality({"lines": raw_lines(spark, sf)}, _PATTERNS, AS_OF).select(*SCORED)


# --- set rules -------------------------------------------------------------------------------------------------


def _with_copies(spark, sf):
    """The line view, and the lines of every fifth order once more."""
    lines = raw_lines(spark, sf)
    return lines.unionByName(lines.where("l_orderkey % 5 = 0"))


_COPIES = f"SELECT * FROM ({DUCK_LINES}) a UNION ALL SELECT * FROM ({DUCK_LINES}) b WHERE l_orderkey % 5 = 0"


@query(
    "rule_duplicate_rows",
    scored(
        "SELECT 'dup' AS rule_id, count(*) AS evaluated_rows, "
        "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM v)) AS failed_rows FROM v"
    ).replace("FROM (SELECT 'dup'", f"FROM (WITH v AS ({_COPIES}) SELECT 'dup'"),
)
def _duplicate_rows(spark, sf):
    return scores(_with_copies(spark, sf), [rule("duplicate_full_rows", rule_id="dup")])


_BIG = 2**53


@query(
    "rule_exact_numbers",
    row_rules(
        f"SELECT o_orderkey, {_BIG} + o_orderkey AS a, {_BIG} + o_orderkey + o_orderkey % 3 - 1 AS b FROM orders",
        [
            ("at_most", "true", "a > b"),
            ("at_least", "true", "a < b"),
            ("equal", "true", "a <> b"),
            ("decimal", "true", "a > b"),
            ("range", "true", f"a > {_BIG + 2001}"),
        ],
    ),
)
def _exact_numbers(spark, sf):
    """Keys beyond 2^53, which doubles cannot tell apart, against whole numbers and decimals one off."""
    keys = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        f"{_BIG} + o_orderkey AS a",
        f"{_BIG} + o_orderkey + o_orderkey % 3 - 1 AS b",
        f"CAST({_BIG} + o_orderkey + o_orderkey % 3 - 1 AS DECIMAL(20,1)) AS c",
    )
    return scores(
        keys,
        [
            rule("less_or_equal", "a", "b", rule_id="at_most"),
            rule("column_comparison", "a", "b", operator=">=", rule_id="at_least"),
            rule("column_comparison", "a", "b", operator="==", rule_id="equal"),
            rule("column_comparison", "a", "c", operator="<=", rule_id="decimal"),
            rule("accepted_range", "a", max_value=_BIG + 2001, rule_id="range"),
        ],
    )


@query(
    "rule_unique_key",
    scored(
        "SELECT 'line' AS rule_id, count(*) AS evaluated_rows, count(*) - (SELECT count(*) FROM "
        "(SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS failed_rows FROM lineitem UNION ALL "
        "SELECT 'part', count(*), count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_partkey, l_suppkey, l_shipdate "
        "FROM lineitem)) FROM lineitem"
    ),
)
def _unique_key(spark, sf):
    lines = table(spark, sf, "lineitem")
    return scores(
        lines,
        [
            rule("unique_key", "l_orderkey", "l_linenumber", rule_id="line"),
            rule("unique_key", "l_partkey", "l_suppkey", "l_shipdate", rule_id="part"),
        ],
    )


def _dependency_sql(rid: str, view: str, code: str, name: str, ok: str) -> str:
    return f"""
SELECT '{rid}' AS rule_id, CAST(coalesce(sum(r), 0) AS BIGINT) AS evaluated_rows,
  CAST(coalesce(sum(r) FILTER (WHERE n > 1), 0) AS BIGINT) AS failed_rows
FROM (SELECT {code} AS c, count(DISTINCT {name}) AS n, count(*) AS r FROM ({view}) x WHERE {ok} GROUP BY {code}) g"""


@query(
    "rule_code_name",
    scored(
        " UNION ALL ".join(
            [
                _dependency_sql("level", DUCK_ORDERS, "level", "level_name", present("level", "level_name")),
                _dependency_sql("sector", DUCK_ORDERS, "sector", "level", present("sector", "level")),
                _dependency_sql("customer", DUCK_ORDERS, "customer", "level", present("customer", "level")),
            ]
        )
    ),
)
def _code_name(spark, sf):
    return scores(
        raw_orders(spark, sf),
        [
            rule("code_name_consistency", "level", "level_name", rule_id="level"),
            rule("code_name_consistency", "sector", "level", rule_id="sector"),
            rule("code_name_consistency", "customer", "level", rule_id="customer"),
        ],
    )


@query(
    "rule_code_name_part",
    scored(_dependency_sql("brand", "SELECT * FROM part", "p_brand", "p_type", "true")),
)
def _code_name_part(spark, sf):
    return scores(table(spark, sf, "part"), [rule("code_name_consistency", "p_brand", "p_type", rule_id="brand")])


@query(
    "rule_cardinality",
    f"""
WITH v AS ({DUCK_ORDERS}),
d AS (SELECT 'status' AS rule_id, count(DISTINCT status) FILTER (WHERE {present('status')}) AS a, 3 AS lim FROM v
      UNION ALL SELECT 'customer', count(DISTINCT customer) FILTER (WHERE {present('customer')}), 1000000 FROM v
      UNION ALL SELECT 'year', count(DISTINCT order_year) FILTER (WHERE {present('order_year')}), 7 FROM v)
SELECT rule_id, a AS evaluated_rows, greatest(a - lim, 0) AS failed_rows,
  'Observada ' || a || ': ' || CASE WHEN a > lim THEN 'supera' ELSE 'bien' END AS observation
FROM d""",
)
def _cardinality(spark, sf):
    said = {"observation": "Observada {0}: {1}", "verdicts": ("supera", "bien")}
    rules = [
        rule("cardinality_check", "status", limit=3, rule_id="status", **said),
        rule("cardinality_upper_bound", "customer", limit=1000000, rule_id="customer", **said),
        rule("cardinality_check", "order_year", limit=7, rule_id="year", **said),
    ]
    out = evaluate(raw_orders(spark, sf), rules, dataset="orders", as_of=AS_OF)
    return out.select("rule_id", "evaluated_rows", "failed_rows", "observation")


@query(
    "rule_temporal_coverage",
    scored(
        f"""WITH v AS ({DUCK_LINES}),
y AS (SELECT CAST(ship_year AS BIGINT) AS a, count(DISTINCT CAST(ship_month AS BIGINT)) AS m FROM v GROUP BY 1)
SELECT 'coverage' AS rule_id, count(*) AS evaluated_rows, count(*) FILTER (WHERE m < 12 AND a NOT IN (2001)) AS failed_rows FROM y
UNION ALL SELECT 'strict', count(*), count(*) FILTER (WHERE m < 12) FROM y"""
    ),
)
def _temporal_coverage(spark, sf):
    return scores(
        raw_lines(spark, sf),
        [
            rule("temporal_coverage_check", "ship_year", "ship_month", expected_months=12, exception_years=[2001], rule_id="coverage"),
            rule("temporal_coverage_check", "ship_year", "ship_month", expected_months=12, rule_id="strict"),
        ],
    )


@query(
    "rule_referential",
    scored(
        "SELECT 'labels' AS rule_id, count(*) AS evaluated_rows, count(*) FILTER (WHERE NOT EXISTS "
        "(SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)) AS failed_rows FROM documents d"
    ),
)
def _referential(spark, sf):
    return scores(
        table(spark, sf, "documents"),
        [rule("referential_integrity", "doc_id", reference_dataset="labels", reference_columns=["doc_id"], rule_id="labels")],
        catalog={"labels": table(spark, sf, "labels")},
    )


@query(
    "rule_referential_lines",
    scored(
        f"""WITH v AS ({DUCK_LINES}), o AS ({DUCK_ORDERS}),
p AS (SELECT DISTINCT trim(customer) AS k FROM o WHERE {present('customer')} AND level = 'F')
SELECT 'supplier_as_customer' AS rule_id, count(*) FILTER (WHERE {present('supplier')}) AS evaluated_rows,
  count(*) FILTER (WHERE {present('supplier')} AND trim(supplier) NOT IN (SELECT k FROM p)) AS failed_rows FROM v"""
    ),
)
def _referential_lines(spark, sf):
    finished = raw_orders(spark, sf).where("level = 'F'")
    return scores(
        raw_lines(spark, sf),
        [
            rule(
                "referential_integrity",
                "supplier",
                reference_dataset="finished",
                reference_columns=["customer"],
                rule_id="supplier_as_customer",
            )
        ],
        catalog={"finished": finished},
    )


@query(
    "rule_temporal_catalog",
    scored(
        f"""WITH v AS ({DUCK_LINES}), o AS ({DUCK_ORDERS}),
p AS (SELECT DISTINCT {key('order_year')} AS a, {key('order_month')} AS b FROM o WHERE {present('order_year', 'order_month')})
SELECT 'period' AS rule_id, count(*) AS evaluated_rows,
  count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.a = {key('v.ship_year')} AND p.b = {key('v.ship_month')})) AS failed_rows
FROM v WHERE {present('ship_year', 'ship_month')}"""
    ),
)
def _temporal_catalog(spark, sf):
    return scores(
        raw_lines(spark, sf),
        [
            rule(
                "temporal_catalog_exists",
                "ship_year",
                "ship_month",
                reference_dataset="orders",
                reference_columns=["order_year", "order_month"],
                rule_id="period",
            )
        ],
        catalog={"orders": raw_orders(spark, sf)},
    )


# --- samples and summaries ---------------------------------------------------------------------------------------

_SAMPLED = [
    rule("not_null", "status", rule_id="status"),
    rule("numeric_type", "amount", rule_id="amount"),
    rule("accepted_range", "order_month", min_value=1, max_value=12, rule_id="month"),
]


def _sample_sql(i: int, bad: str, column: str) -> str:
    return (
        f"SELECT CAST({i} AS INTEGER) AS pos, CAST(row_number() OVER (ORDER BY o_orderkey) AS INTEGER) AS rank, "
        f"coalesce({column}, '') AS value FROM v WHERE {bad}"
    )


@query(
    "failed_samples",
    f"WITH v AS ({DUCK_ORDERS}) SELECT * FROM ("
    + " UNION ALL ".join(
        [
            _sample_sql(0, missing("status"), "status"),
            _sample_sql(1, f"{present('amount')} AND {number('amount')} IS NULL", "amount"),
            _sample_sql(
                2,
                f"{present('order_month')} AND ({number('order_month')} IS NULL OR {number('order_month')} NOT BETWEEN 1 AND 12)",
                "order_month",
            ),
        ]
    )
    + ") s WHERE rank <= 10",
)
def _samples(spark, sf):
    bound, checks = compile_rules(raw_orders(spark, sf), list(enumerate(_SAMPLED)), AS_OF)
    picked = failed_samples(bound, checks, ["o_orderkey"])
    return picked.select("pos", "rank", F.map_values("values")[0].alias("value"))


_SET_SAMPLED = [
    rule("unique_key", "l_orderkey", "l_linenumber", rule_id="key"),
    rule("duplicate_full_rows", rule_id="rows"),
    rule("code_name_consistency", "supplier", "line_status", rule_id="names"),
    rule("referential_integrity", "supplier", reference_dataset="open", reference_columns=("customer",), rule_id="open"),
    rule("temporal_catalog_exists", "ship_year", "ship_month", reference_dataset="early", reference_columns=("order_year", "order_month"), rule_id="period"),
]
_SET_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "supplier", "line_status")


def _set_sample_sql() -> str:
    by, ok = ", ".join(_SET_ORDER), present("supplier", "line_status")
    parts = [
        ("key", "concat_ws('|', l_orderkey, l_linenumber)", f"(SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {by}) AS nth FROM w) x WHERE nth > 1"),
        ("rows", f"concat_ws('|', {by})", f"(SELECT *, row_number() OVER (PARTITION BY {', '.join(_LINE_COLUMNS)}) AS nth FROM w) x WHERE nth > 1"),
        ("names", "concat_ws('|', supplier, line_status)", f"w WHERE {ok} AND supplier IN (SELECT supplier FROM w WHERE {ok} GROUP BY 1 HAVING count(DISTINCT line_status) > 1)"),
        ("open", "supplier", f"w WHERE {present('supplier')} AND trim(supplier) NOT IN (SELECT trim(customer) FROM o WHERE level = 'O' AND {present('customer')})"),
        (
            "period",
            "concat_ws('|', ship_year, ship_month)",
            f"w WHERE NOT EXISTS (SELECT 1 FROM o WHERE o_orderkey % 7 = 0 AND {present('order_year', 'order_month')} "
            f"AND {key('o.order_year')} = w.ship_year AND {key('o.order_month')} = w.ship_month)",
        ),
    ]
    ranked = [
        f"SELECT {i} AS pos, CAST(row_number() OVER (ORDER BY {by}) AS INTEGER) AS rank, {shown} AS shown FROM {rows}"
        for i, (_, shown, rows) in enumerate(parts)
    ]
    return f"WITH w AS ({_COPIES}), o AS ({DUCK_ORDERS}) SELECT * FROM ({' UNION ALL '.join(ranked)}) s WHERE rank <= 10"


_LINE_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "quantity", "price", "discount", "tax", "flag", "line_status", "ship_date", "ship_year",
    "ship_month", "line_code", "parent_code", "supplier",
)


@query("failed_samples_sets", _set_sample_sql())
def _set_samples(spark, sf):
    """The first ten failing rows of set rules: repeated keys and rows, codes with several names, keys without a parent."""
    orders = raw_orders(spark, sf)
    catalog = {"open": orders.where("level = 'O'"), "early": orders.where("o_orderkey % 7 = 0")}
    picked = failed_set_samples(_with_copies(spark, sf), list(enumerate(_SET_SAMPLED)), _SET_ORDER, 10, catalog=catalog)
    return picked.select("pos", "rank", F.array_join(F.map_values("values"), "|").alias("shown"))


def _detail(spark, sf) -> DataFrame:
    return evaluate(raw_orders(spark, sf), SCORECARD, dataset="orders", as_of=AS_OF)


_META = ", ".join(f"('{r.rule_id}', '{r.dimension}', '{r.severity}')" for r in SCORECARD)
_DETAIL_SQL = (
    f"SELECT s.*, m.dimension, m.severity, 'orders' AS dataset FROM ({ORACLES['quality_scorecard_orders']}) s "
    f"JOIN (VALUES {_META}) m(rule_id, dimension, severity) ON s.rule_id = m.rule_id"
)
_DIMS = ("Completitud", "Validez", "Exactitud", "Consistencia", "Oportunidad", "Conformidad", "Unicidad")


@query(
    "quality_summary",
    f"""
WITH d AS ({_DETAIL_SQL}),
m AS (SELECT dimension, avg(score) AS s FROM d GROUP BY dimension)
SELECT 'orders' AS dataset, count(*) AS rules_evaluated, count(*) FILTER (WHERE failed_rows > 0) AS rules_with_observations,
  CAST(sum(failed_rows) AS BIGINT) AS observations_total, CAST(sum(evaluated_rows) AS BIGINT) AS evaluated_rows_total,
  {", ".join(f"round((SELECT s FROM m WHERE dimension = '{x}'), 4) AS score_{x.lower()}" for x in _DIMS)},
  round((SELECT avg(s) FROM m), 4) AS score_general, 'Con observaciones' AS estado_descriptivo
FROM d""",
)
def _quality_summary(spark, sf):
    return quality_summary(_detail(spark, sf), _DIMS)


@query(
    "severity_summary",
    f"""SELECT severity, count(*) AS rules_with_observations, CAST(sum(failed_rows) AS BIGINT) AS observations_total
FROM ({_DETAIL_SQL}) d WHERE failed_rows > 0 GROUP BY severity""",
)
def _severity_summary(spark, sf):
    return severity_summary(_detail(spark, sf))


@query(
    "top_alerts",
    f"SELECT rule_id, severity, failed_rows FROM ({_DETAIL_SQL}) d WHERE failed_rows > 0 ORDER BY failed_rows DESC, rule_id LIMIT 5",
)
def _top_alerts(spark, sf):
    return top_alerts(_detail(spark, sf), 5).select("rule_id", "severity", "failed_rows")


@query(
    "dimension_cards",
    f"""
WITH d AS ({_DETAIL_SQL}), l(dimension) AS (VALUES {", ".join(f"('{x}')" for x in _DIMS)})
SELECT l.dimension, round(avg(d.score), 4) AS score, count(d.rule_id) AS rules,
  CAST(coalesce(sum(d.failed_rows), 0) AS BIGINT) AS observations,
  CASE WHEN count(d.rule_id) = 0 THEN 'No evaluable' WHEN sum(d.failed_rows) = 0 THEN 'Sin observaciones'
       ELSE 'Con observaciones' END AS status
FROM l LEFT JOIN d ON l.dimension = d.dimension GROUP BY l.dimension""",
)
def _dimension_cards(spark, sf):
    return dimension_cards(_detail(spark, sf), _DIMS)


@query(
    "run_totals",
    f"""SELECT count(*) AS rules_evaluated, count(*) FILTER (WHERE failed_rows > 0) AS rules_with_observations,
  CAST(sum(failed_rows) AS BIGINT) AS observations_total,
  count(*) FILTER (WHERE failed_rows > 0 AND severity IN ('Bloqueante', 'Alta')) AS severe_observations,
  CASE WHEN count(*) FILTER (WHERE failed_rows > 0 AND severity IN ('Bloqueante', 'Alta')) > 0 THEN 'warning' ELSE 'success' END AS status
FROM ({_DETAIL_SQL}) d""",
)
def _run_totals(spark, sf):
    return run_totals(_detail(spark, sf))


# --- whole rule files --------------------------------------------------------------------------------------------

LEDGER_CONFIG = {
    "settings": {"source": "ledger", "dataset_name": "lines", "max_failed_samples_per_rule": 10},
    "missing_tokens": ["", " ", "NULL", "N/A"],
    "completitud": {
        "criticas": {"rule_type": "not_null", "severity": "Bloqueante", "source": "p", "columns": ["quantity", "price", "flag"]},
        "casi": {"rule_type": "null_threshold", "threshold_pct": 0.5, "severity": "Media", "columns": ["flag", "ship_date"]},
        "estructural": {
            "rule_type": "conditional_null_allowed",
            "severity": "Informativo",
            "columns": ["flag"],
            "null_allowed_when": {"column": "line_status", "value": "O"},
        },
    },
    "validez": {
        "flag": {"rule_type": "accepted_values", "column": "flag", "accepted": ["A", "N", "R"], "severity": "Alta"},
        "numericas": {"rule_type": "numeric_type", "columns": ["quantity", "price", "discount"], "severity": "Alta"},
    },
    "exactitud": {
        "precio": {"rule_type": "accepted_range", "column": "price", "min_value": 0.0, "max_value": 90000.0},
        "anio": {"rule_type": "regex", "column": "ship_year", "pattern": r"^\d{4}$"},
    },
    "consistencia": {
        "n_o": {
            "rule_type": "conditional_value",
            "condition_column": "flag",
            "condition_value": "N",
            "expected_column": "line_status",
            "expected_value": "O",
        },
        "pares": {
            "rule_type": "code_name_consistency",
            "pairs": [{"code": "flag", "name": "line_status"}, {"code": "supplier", "name": "parent_code"}],
        },
        "tasa": {
            "rule_type": "column_comparison",
            "left_column": "discount",
            "operator": ">=",
            "right_column": "tax",
            "filter_condition": "tax > 0",
        },
    },
    "unicidad": {
        "filas": {"rule_type": "duplicate_full_rows", "severity": "Media"},
        "clave": {"rule_type": "unique_key", "severity": "Alta", "columns": ["l_orderkey", "l_linenumber"]},
    },
    "integridad": {
        "padre": {"rule_type": "parent_not_zero_if_child_nonzero", "parent_column": "parent_code", "child_column": "line_code"},
        "catalogo": {"rule_type": "cardinality_check", "expected_cardinality": {"flag": 3, "line_code": 4}},
    },
    "oportunidad": {
        "futuro": {"rule_type": "year_not_future", "column": "ship_year"},
        "mes": {"rule_type": "accepted_range", "column": "ship_month", "min_value": 1, "max_value": 12},
        "cobertura": {"rule_type": "temporal_coverage_check", "columns": ["ship_year", "ship_month"], "exception_years": [2001]},
    },
    "conformidad": {
        "linea": {"rule_type": "regex", "column": "line_code", "pattern": r"^\d$"},
        "proveedor": {"rule_type": "cardinality_upper_bound", "column": "supplier", "max_cardinality": 50},
    },
}
_NA = "('', 'nan', 'NaN', 'None', 'none', 'NULL', 'null', '<NA>', 'NaT', 'N/A')"


def _gone(x: str) -> str:
    return f"({x} IS NULL OR trim({x}) IN {_NA})"


def _ledger_sql() -> str:
    rows = [
        ("ledger.quantity.not_null", "true", _gone("quantity")),
        ("ledger.price.not_null", "true", _gone("price")),
        ("ledger.flag.not_null", "true", _gone("flag")),
        ("ledger.flag.null_threshold", "true", _gone("flag")),
        ("ledger.ship_date.null_threshold", "true", _gone("ship_date")),
        ("ledger.flag.conditional_null", "line_status <> 'O'", _gone("flag")),
        ("ledger.flag.accepted_values", f"NOT {_gone('flag')}", "flag NOT IN ('A', 'N', 'R')"),
        ("ledger.quantity.numeric", f"NOT {_gone('quantity')}", f"{number('quantity')} IS NULL"),
        ("ledger.price.numeric", f"NOT {_gone('price')}", f"{number('price')} IS NULL"),
        ("ledger.discount.numeric", f"NOT {_gone('discount')}", f"{number('discount')} IS NULL"),
        ("ledger.price.range", f"NOT {_gone('price')}", f"{number('price')} IS NULL OR {number('price')} NOT BETWEEN 0 AND 90000"),
        ("ledger.ship_year.regex", f"NOT {_gone('ship_year')}", "NOT regexp_matches(ship_year, '^[0-9]{4}$')"),
        ("ledger.n_o.conditional_value", "flag = 'N'", "line_status <> 'O'"),
        ("ledger.tasa.column_comparison", f"{number('tax')} > 0", f"{number('discount')} < {number('tax')}"),
        ("ledger.parent_code_line_code.hierarchy", f"{number('line_code')} <> 0", f"{number('parent_code')} = 0"),
        ("ledger.ship_year.year_not_future", f"NOT {_gone('ship_year')}", f"{number('ship_year')} >= 2000"),
        ("ledger.ship_month.range", f"NOT {_gone('ship_month')}", f"{number('ship_month')} NOT BETWEEN 1 AND 12"),
        ("ledger.line_code.regex", f"NOT {_gone('line_code')}", "NOT regexp_matches(line_code, '^[0-9]$')"),
    ]
    counts = row_counts(DUCK_LINES, rows)
    sets = [
        _dependency_sql("ledger.flag_line_status.code_name", "SELECT * FROM v", "flag", "line_status", f"NOT {_gone('flag')}"),
        _dependency_sql("ledger.supplier_parent_code.code_name", "SELECT * FROM v", "supplier", "parent_code", "true"),
        "SELECT 'ledger.full_row_duplicates', count(*), count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM v)) FROM v",
        "SELECT 'ledger.unique_key.2cols', count(*), count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM v)) FROM v",
        f"SELECT 'ledger.flag.cardinality', count(DISTINCT flag), greatest(count(DISTINCT flag) - 3, 0) FROM v WHERE NOT {_gone('flag')}",
        "SELECT 'ledger.line_code.cardinality', count(DISTINCT line_code), greatest(count(DISTINCT line_code) - 4, 0) FROM v",
        "SELECT 'ledger.temporal_coverage', count(*), count(*) FILTER (WHERE m < 12 AND a <> '2001') FROM "
        "(SELECT ship_year AS a, count(DISTINCT ship_month) AS m FROM v GROUP BY 1) y",
        "SELECT 'ledger.supplier.cardinality_upper', count(DISTINCT supplier), greatest(count(DISTINCT supplier) - 50, 0) FROM v",
    ]
    return scored(" UNION ALL ".join([counts, *sets]))


@query("quality_ledger_file", _ledger_sql())
def _ledger_file(spark, sf):
    return ledger_quality(raw_lines(spark, sf), LEDGER_CONFIG, AS_OF).select(*SCORED)


SURVEY_CONFIG = {
    "settings": {"source": "survey"},
    "missing_tokens": ["", "NULL"],
    "global_rules": {
        "duplicate_full_rows": {"enabled": True, "severity": "Media"},
        "pattern_rules": {"year_4_digits": {"enabled": True, "contains": ["_year"], "min_year": 1000, "max_year": 9999}},
    },
    "datasets": {
        "orders": {
            "required_columns": {"columns": ["status", "amount", "ghost"]},
            "observed_empty_columns": {"columns": ["sector"]},
            "allowed_values": {"status": {"values": ["O", "F"]}},
            "numeric_columns": {"columns": ["amount", "order_year"]},
            "date_columns": {"columns": ["order_date"]},
            "unique_keys": [{"columns": ["customer", "order_date"]}],
            "consistency_rules": [{"rule_type": "less_or_equal", "left_column": "opening", "right_column": "amount"}],
            "conditional_date_rules": [{"condition_column": "level", "condition_value": "F", "date_column": "order_date"}],
            "timeliness_rules": [
                {"rule_type": "year_not_future", "columns": ["order_year"]},
                {"rule_type": "month_period_between", "columns": ["order_month"], "min_value": 1, "max_value": 13},
                {"rule_type": "date_not_future", "columns": ["order_date"]},
            ],
        },
        "lines": {
            "required_columns": {"columns": ["flag"]},
            "timeliness_rules": [
                {
                    "rule_type": "temporal_catalog_exists",
                    "columns": ["ship_year", "ship_month"],
                    "reference_dataset": "orders",
                    "reference_columns": ["order_year", "order_month"],
                }
            ],
        },
    },
    "referential_integrity": [
        {"dataset": "lines", "column": "supplier", "reference_dataset": "orders", "reference_column": "customer"}
    ],
}


def _survey_sql() -> str:
    year = f"TRY_CAST({key('order_year')} AS DOUBLE)"
    bad_year = f"NOT regexp_matches({key('{c}')}, '^[0-9]{{{{4}}}}$')"
    orders = [
        ("orders.status.required", "true", missing("status")),
        ("orders.amount.required", "true", missing("amount")),
        ("orders.sector.observed_empty", "true", missing("sector")),
        ("orders.status.allowed_values", present("status"), "trim(status) NOT IN ('O', 'F')"),
        ("orders.amount.numeric", present("amount"), f"{number('amount')} IS NULL"),
        ("orders.order_year.numeric", present("order_year"), f"{number('order_year')} IS NULL"),
        ("orders.order_date.date_parseable", present("order_date"), f"{date('order_date')} IS NULL"),
        ("orders.opening_le_amount", _BOTH, f"{_AMOUNT} IS NULL OR {_OPENING} IS NULL OR {_OPENING} > {_AMOUNT}"),
        ("orders.order_date.conditional_date", "trim(level) = 'F'", f"{date('order_date')} IS NULL"),
        ("orders.order_year.year_not_future", present("order_year"), f"{year} IS NULL OR {year} > 1999"),
        (
            "orders.order_month.month_period_between",
            present("order_month"),
            f"{number('order_month')} NOT BETWEEN 1 AND 13 OR {number('order_month')} % 1 <> 0",
        ),
        (
            "orders.order_date.date_not_future",
            present("order_date"),
            f"{date('order_date')} IS NULL OR {date('order_date')} > TIMESTAMP '1999-06-30 12:00:00'",
        ),
        ("orders.order_year.year_4_digits", present("order_year"), bad_year.format(c="order_year")),
    ]
    lines = [
        ("lines.flag.required", "true", missing("flag")),
        ("lines.ship_year.year_4_digits", present("ship_year"), bad_year.format(c="ship_year")),
    ]
    tail = [
        "SELECT 'orders.ghost.required', 1, 1",
        "SELECT 'orders.full_row_duplicates', count(*), count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM v)) FROM v",
        "SELECT 'orders.unique_key.customer+order_date', count(*), count(*) - (SELECT count(*) FROM (SELECT DISTINCT customer, order_date FROM v)) FROM v",
        "SELECT 'lines.full_row_duplicates', count(*), count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM w)) FROM w",
        f"SELECT 'lines.ship_year+ship_month.temporal_catalog_exists', count(*), count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM p "
        f"WHERE p.a = w.ship_year AND p.b = w.ship_month)) FROM w",
        "SELECT 'lines.supplier.ref_integrity', count(*), count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM v o WHERE o.customer = w.supplier)) FROM w",
    ]
    with_clause = (
        f"WITH w AS ({DUCK_LINES}), o AS ({DUCK_ORDERS}), p AS (SELECT DISTINCT {key('order_year')} AS a, {key('order_month')} AS b "
        f"FROM o WHERE {present('order_year', 'order_month')}), "
    )
    head = row_counts(DUCK_ORDERS, orders, with_clause)
    line_rows = [
        f"SELECT '{rid}', count(*) FILTER (WHERE {ok}), count(*) FILTER (WHERE ({ok}) AND ({bad})) FROM w" for rid, ok, bad in lines
    ]
    return scored(" UNION ALL ".join([head, *line_rows, *tail]))


@query("quality_survey_file", _survey_sql())
def _survey_file(spark, sf):
    tables = {"orders": raw_orders(spark, sf), "lines": raw_lines(spark, sf)}
    return survey_quality(tables, SURVEY_CONFIG, AS_OF).select(*SCORED)


@query(
    "coverage_short_years",
    """SELECT 'short' AS rule_id, CAST(o_custkey AS VARCHAR) AS year, count(DISTINCT month(o_orderdate)) AS months
FROM orders GROUP BY 1, 2 HAVING count(DISTINCT month(o_orderdate)) < 12""",
)
def _short_years(spark, sf):
    """Customers in place of years, so that there are many: all short ones are listed."""
    orders = table(spark, sf, "orders").selectExpr("CAST(o_custkey AS STRING) AS y", "CAST(month(o_orderdate) AS STRING) AS m")
    return coverage_short_years(orders, [rule("temporal_coverage_check", "y", "m", expected_months=12, rule_id="short")])
