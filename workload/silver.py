"""Queries over cleaning, casting, derivation, hashing, deduplication and the whole Silver transformations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tamiz.functions.casts import as_integer, as_timestamp
from tamiz.functions.text import column, key_text
from tamiz.operators import clean, dedup, derive
from tamiz.operators.wide import per_column
from tamiz.plans import silver as plans
from workload.duck import number
from workload.tables import DUCK_LINES, DUCK_ORDERS, raw_lines, raw_orders, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

RUN_AT = dt.datetime(2001, 5, 1, 8, 30, 0)
_TOKENS = "('', 'NULL', 'null', 'None', 'none', 'NaN', 'nan', 'N/A', 'n/a')"


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return register


def _nulled(x: str) -> str:
    return f"CASE WHEN trim({x}) NOT IN {_TOKENS} THEN {x} END"


def _date(x: str) -> str:
    return f"TRY_STRPTIME(trim({x}), '%d/%m/%Y')"


@query(
    "master_filter",
    f"SELECT level, count(*) AS n, count(DISTINCT customer) AS customers FROM ({DUCK_ORDERS}) v WHERE level = 'F' GROUP BY level",
)
def _master_filter(spark, sf):
    kept = clean.keep_where_equals(raw_orders(spark, sf), "level", "F")
    return kept.groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("customer").alias("customers"))


@query(
    "null_tokens",
    f"SELECT o_orderkey, {_nulled('status')} AS status, {_nulled('amount')} AS amount, {_nulled('sector')} AS sector FROM ({DUCK_ORDERS}) v",
)
def _null_tokens(spark, sf):
    return clean.tokens_to_null(raw_orders(spark, sf)).select("o_orderkey", "status", "amount", "sector")


@query(
    "special_values_null",
    f"""SELECT count(*) AS n, count(*) FILTER (WHERE trim(order_date) IN ('0', '31/13/2020')) AS handled,
count(CASE WHEN trim(order_date) IN ('0', '31/13/2020') THEN NULL ELSE order_date END) AS kept FROM ({DUCK_ORDERS}) v""",
)
def _special_values(spark, sf):
    raw = raw_orders(spark, sf)
    rules = {"order_date": ["0", "31/13/2020"], "ghost": ["x"]}
    marked = raw.withColumn("hit", clean.special_value(raw, "order_date", rules["order_date"]))
    out = clean.special_values_to_null(marked, rules)
    return out.agg(
        F.count(F.lit(1)).alias("n"), F.count_if("hit").alias("handled"), F.count("order_date").alias("kept")
    )


@query("trim_text", f"SELECT o_orderkey, trim(status) AS status, trim(priority) AS priority FROM ({DUCK_ORDERS}) v")
def _trim(spark, sf):
    return clean.trim_text(raw_orders(spark, sf)).select("o_orderkey", "status", "priority")


@query(
    "lpad_codes",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, lpad(supplier, 2, '0') AS cut,
CASE WHEN length(supplier) < 2 THEN lpad(supplier, 2, '0') ELSE supplier END AS kept FROM ({DUCK_LINES}) v""",
)
def _lpad(spark, sf):
    raw = raw_lines(spark, sf).withColumns({"cut": column("supplier"), "kept": column("supplier")})
    out = clean.pad_codes(raw, {"cut": (2, "0")}, truncate=True)
    out = clean.pad_codes(out, {"kept": (2, "0"), "ghost": (3, "0")})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "cut", "kept")


@query(
    "impute_constants",
    f"""SELECT status, sector, count(*) AS n FROM (SELECT coalesce({_nulled('status')}, 'SIN DATO') AS status,
coalesce({_nulled('sector')}, '00') AS sector FROM ({DUCK_ORDERS}) v) x GROUP BY status, sector""",
)
def _impute(spark, sf):
    out = clean.impute(clean.tokens_to_null(raw_orders(spark, sf)), {"status": "SIN DATO", "sector": "00", "ghost": "x"})
    return out.groupBy("status", "sector").agg(F.count(F.lit(1)).alias("n"))


_WHOLE = f"CASE WHEN {number('order_month')} % 1 = 0 THEN CAST({number('order_month')} AS BIGINT) END"


@query(
    "cast_columns",
    f"""SELECT o_orderkey, {number('amount')} AS amount, {_WHOLE} AS order_month,
CAST(epoch({_date('order_date')}) AS BIGINT) AS order_epoch, TRY_CAST(trim(amount) AS DECIMAL(18,2))::VARCHAR AS money
FROM ({DUCK_ORDERS}) v""",
)
def _cast(spark, sf):
    raw = raw_orders(spark, sf).withColumn("money", column("amount"))
    out = clean.cast_columns(
        raw, {"amount": "double", "order_month": "long", "order_date": "datetime", "money": "decimal(18,2)"}
    )
    return out.select(
        "o_orderkey",
        "amount",
        "order_month",
        F.unix_timestamp("order_date").alias("order_epoch"),
        column("money").cast("string").alias("money"),
    )


_TYPES = {"amount": "double", "order_month": "integer", "order_date": "datetime", "order_year": "long", "status": "string"}


@query(
    "cast_errors",
    f"""WITH v AS ({DUCK_ORDERS})
SELECT 'amount' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE {number('amount')} IS NULL) AS errors FROM v
UNION ALL SELECT 'order_month', count(*), count(*) FILTER (WHERE {_WHOLE} IS NULL) FROM v
UNION ALL SELECT 'order_date', count(*), count(*) FILTER (WHERE {_date('order_date')} IS NULL) FROM v
UNION ALL SELECT 'order_year', count(*), count(*) FILTER (WHERE {number('order_year')} IS NULL) FROM v
UNION ALL SELECT 'status', count(*), 0 FROM v""",
)
def _cast_errors(spark, sf):
    raw = raw_orders(spark, sf)
    return per_column(raw, list(_TYPES), lambda c: {"errors": f"count_if({clean.conversion_error(raw, c, _TYPES[c])})"})


@query(
    "drop_empty_rows",
    f"""SELECT count(*) AS n, count(a) AS a, count(s) AS s FROM (SELECT {_nulled('amount')} AS a, {_nulled('status')} AS s
FROM ({DUCK_ORDERS}) v) x WHERE a IS NOT NULL OR s IS NOT NULL""",
)
def _drop_empty(spark, sf):
    few = clean.tokens_to_null(raw_orders(spark, sf).select("amount", "status", "sector"))
    out = clean.drop_empty_rows(clean.drop_columns(few, ["sector", "ghost"]))
    return out.agg(F.count(F.lit(1)).alias("n"), F.count("amount").alias("a"), F.count("status").alias("s"))


@query(
    "normalize_names",
    """SELECT p_partkey, upper(trim(regexp_replace(concat(' ', p_name, '  x '), '\\s+', ' ', 'g'))) AS name,
regexp_replace(trim(concat(p_size, '.0')), '\\.0$', '') AS size_key FROM part""",
)
def _names(spark, sf):
    part = table(spark, sf, "part").withColumn("noisy", F.concat(F.lit(" "), "p_name", F.lit("  x ")))
    out = clean.normalise_names(part, {"name": "noisy"})
    return out.select("p_partkey", "name", key_text(F.concat(F.col("p_size").cast("string"), F.lit(".0"))).alias("size_key"))


@query(
    "normalize_headers",
    "SELECT count(*) AS \"N\", sum(p_size)::BIGINT AS \"P_SIZE_TOTAL\" FROM part",
)
def _headers(spark, sf):
    renamed = table(spark, sf, "part").select(F.col("p_partkey").alias("\ufeff n "), F.col("p_size").alias(" p_size  total"))
    out = clean.normalise_headers(renamed)
    return out.agg(F.count("N").alias("N"), F.sum("P_SIZE_TOTAL").alias("P_SIZE_TOTAL"))


@query(
    "derived_columns",
    f"""WITH v AS ({DUCK_LINES})
SELECT l_orderkey, l_linenumber, l_partkey, lpad(concat(parent_code, line_code, flag), 6, '0') AS geo,
  CAST(ship_year AS INTEGER) * 100 + CAST(ship_month AS INTEGER) AS month_key,
  concat(ship_year, '-', lpad(ship_month, 2, '0')) AS month_label, CAST(ship_year AS INTEGER) AS part_year,
  CASE WHEN {number('price')} >= 0 THEN 'NORMAL' ELSE 'REVERSION' END AS sign, {number('quantity')} > 0 AS positive,
  concat(ship_year, '-', ship_month) AS period_key
FROM v""",
)
def _derived(spark, sf):
    raw = raw_lines(spark, sf)
    return raw.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        derive.geo_code(["parent_code", "line_code", "flag"]).alias("geo"),
        derive.month_key(raw, "ship_year", "ship_month").alias("month_key"),
        derive.month_label("ship_year", "ship_month").alias("month_label"),
        derive.partition_year(raw, "ship_year").alias("part_year"),
        derive.sign_flag(raw, "price").alias("sign"),
        derive.positive_flag(raw, "quantity").alias("positive"),
        derive.period_key(raw, "ship_year", "ship_month").alias("period_key"),
    )


@query(
    "record_hash_positional",
    """SELECT p_partkey, sha256(concat_ws('|', CAST(p_partkey AS VARCHAR), coalesce(p_name, '<NULL>'), coalesce(p_brand, '<NULL>'),
CAST(p_size AS VARCHAR))) AS record_hash FROM part""",
)
def _hash_positional(spark, sf):
    part = table(spark, sf, "part")
    return part.select("p_partkey", derive.positional_hash(part, ["p_partkey", "p_name", "p_brand", "p_size", "ghost"]).alias("record_hash"))


@query(
    "record_hash_named",
    f"""SELECT o_orderkey, sha256(concat_ws('|', concat('o_orderkey=', o_orderkey), concat('status=', coalesce(status, '<NULL>')),
concat('level=', coalesce(level, '<NULL>')), concat('order_date=', coalesce(strftime({_date('order_date')}, '%Y-%m-%dT%H:%M:%S'), '<NULL>'))))
AS record_hash FROM ({DUCK_ORDERS}) v""",
)
def _hash_named(spark, sf):
    raw = raw_orders(spark, sf)
    few = raw.select("o_orderkey", "status", "level", as_timestamp(raw, "order_date").alias("order_date"))
    return few.select("o_orderkey", derive.named_hash(few).alias("record_hash"))


_FIRST = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(epoch(l_shipdate) AS BIGINT) AS shipped FROM (
SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) AS rn
FROM lineitem) x WHERE rn = 1"""


def _keep(spark, sf, keep):
    lines = table(spark, sf, "lineitem")
    out = keep(
        lines,
        ["l_orderkey", "l_linenumber", "ghost"],
        [F.col("l_shipdate").desc()],
        [F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice")],
    )
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.unix_timestamp("l_shipdate").alias("shipped"))


@query("dedup_keep_first", _FIRST)
def _dedup(spark, sf):
    return _keep(spark, sf, dedup.keep_first)


@query("dedup_keep_first_two_step", _FIRST)
def _dedup_two_step(spark, sf):
    return _keep(spark, sf, dedup.keep_first_of_few)


# --- whole transformations -----------------------------------------------------------------------------------------

LEDGER = {
    "source_system": "ledger",
    "source_dataset": "lines",
    "filtering": {"master_filter": {"column": "line_status", "value": "F"}},
    "cleaning": {
        "global_trim": {"apply": True},
        "lpad_codes": [
            {"column": "supplier", "length": 4, "fill_char": "0"},
            {"column": "line_code", "length": 2, "fill_char": "0"},
            {"column": "ghost", "length": 2},
        ],
        "null_tokens": {"convert_to_null": True},
    },
    "imputations": {
        "codes": {"columns": ["flag"], "impute_value": "00"},
        "nested": {"inner": {"columns": ["parent_code"], "impute_value": "SIN DATO"}},
    },
    "derived_columns": {
        "ubigeo_ejecutora": {"output_column": "ubigeo_ejecutora", "source_columns": ["parent_code", "line_code", "flag"]},
        "sk_tiempo_mensual": {"output_column": "sk_tiempo_mensual", "source_columns": ["ship_year", "ship_month"]},
        "anio_mes_key": {"output_column": "anio_mes_key", "source_columns": ["ship_year", "ship_month"]},
        "ano_particion": {"output_column": "ano_particion", "source_columns": ["ship_year"]},
        "flag_tipo_transaccion": {"output_column": "flag_tipo_transaccion", "source_columns": ["price"]},
        "flag_monto_pia_activo": {"output_column": "flag_monto_pia_activo", "source_columns": ["quantity"]},
        "declarada": {"output_column": "declarada", "source_columns": ["flag"], "spark_expression": "concat(flag, line_status)"},
    },
    "deduplication": {
        "enabled": True,
        "key_columns": ["l_orderkey", "l_linenumber"],
        "window_order": [{"column": "ship_year", "direction": "desc"}, {"column": "ship_month", "direction": "desc"}],
    },
    "output_schema": {
        "partition_by": ["ano_particion"],
        "columns": [
            {"name": "l_orderkey", "type": "long", "nullable": False},
            {"name": "l_linenumber", "type": "integer", "nullable": False},
            {"name": "ship_year", "type": "integer", "nullable": False},
            {"name": "ship_month", "type": "integer", "nullable": False},
            {"name": "supplier", "type": "string"},
            {"name": "line_code", "type": "string"},
            {"name": "parent_code", "type": "string", "imputed_value": "SIN DATO"},
            {"name": "flag", "type": "string", "imputed_value": "00"},
            {"name": "quantity", "type": "decimal(18,2)"},
            {"name": "price", "type": "decimal(18,2)"},
            {"name": "silver_processed_at", "type": "timestamp"},
        ],
    },
}
_LEDGER_SQL = f"""
WITH v AS (SELECT * FROM ({DUCK_LINES}) r WHERE line_status = 'F'),
c AS (SELECT l_orderkey, l_linenumber, CAST(ship_year AS INTEGER) AS ship_year, CAST(ship_month AS INTEGER) AS ship_month,
        line_status,
        CASE WHEN length(supplier) < 4 THEN lpad(supplier, 4, '0') ELSE supplier END AS supplier,
        lpad(line_code, 2, '0') AS line_code, coalesce({_nulled('parent_code')}, 'SIN DATO') AS parent_code,
        coalesce(trim({_nulled('flag')}), '00') AS flag,
        TRY_CAST(trim({_nulled('quantity')}) AS DECIMAL(18,2)) AS quantity,
        TRY_CAST(trim({_nulled('price')}) AS DECIMAL(18,2)) AS price FROM v),
h AS (SELECT *, sha256(concat_ws('|', l_orderkey::VARCHAR, l_linenumber::VARCHAR, ship_year::VARCHAR, ship_month::VARCHAR,
        supplier, line_code, parent_code, flag, coalesce(quantity::VARCHAR, '<NULL>'), coalesce(price::VARCHAR, '<NULL>')))
        AS record_hash FROM c),
d AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY ship_year DESC, ship_month DESC, record_hash) AS rn FROM h)
"""
_LEDGER_TABLE = _LEDGER_SQL + """
SELECT l_orderkey, l_linenumber, ship_year, ship_month, supplier, line_code, flag, quantity::VARCHAR AS quantity, price::VARCHAR AS price,
  lpad(concat(parent_code, line_code, flag), 6, '0') AS ubigeo_ejecutora, ship_year * 100 + ship_month AS sk_tiempo_mensual,
  concat(ship_year::VARCHAR, '-', lpad(ship_month::VARCHAR, 2, '0')) AS anio_mes_key, ship_year AS ano_particion,
  CASE WHEN price >= 0 THEN 'NORMAL' ELSE 'REVERSION' END AS flag_tipo_transaccion, quantity > 0 AS flag_monto_pia_activo,
  concat(flag, line_status) AS declarada, 'ledger' AS source_system, 'lines' AS source_dataset,
  CAST(epoch(TIMESTAMP '2001-05-01 08:30:00') AS BIGINT) AS processed, record_hash
FROM d WHERE rn = 1"""


@query("silver_ledger", _LEDGER_TABLE)
def _silver_ledger(spark, sf):
    out = plans.ledger_silver(raw_lines(spark, sf), LEDGER, RUN_AT)
    return out.select(
        "l_orderkey",
        "l_linenumber",
        "ship_year",
        "ship_month",
        "supplier",
        "line_code",
        "flag",
        column("quantity").cast("string").alias("quantity"),
        column("price").cast("string").alias("price"),
        "ubigeo_ejecutora",
        "sk_tiempo_mensual",
        "anio_mes_key",
        "ano_particion",
        "flag_tipo_transaccion",
        "flag_monto_pia_activo",
        "declarada",
        "source_system",
        "source_dataset",
        F.unix_timestamp("silver_processed_at").alias("processed"),
        "record_hash",
    )


_CAST_NULLS = {"quantity": "quantity", "price": "price"}


@query(
    "silver_ledger_summary",
    _LEDGER_SQL
    + f"""
SELECT (SELECT count(*) FROM lineitem) AS bronze_rows, (SELECT count(*) FROM v) AS filtered_rows,
  (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM v) AS rows_filtered_out,
  count(*) AS silver_rows, (SELECT count(*) FROM v) - count(*) AS duplicates_removed, 0::BIGINT AS nulls_before,
  (SELECT count(*) FILTER (WHERE {_nulled('quantity')} IS NOT NULL AND {number('quantity')} IS NULL)
     + count(*) FILTER (WHERE {_nulled('price')} IS NOT NULL AND {number('price')} IS NULL) FROM v) AS conversion_errors,
  count(*) FILTER (WHERE quantity IS NULL) * 2 + count(*) FILTER (WHERE price IS NULL)
     + count(*) FILTER (WHERE {_nulled('discount')} IS NULL) * 0 AS nulls_after,
  'WITH_CONVERSION_ERRORS' AS status
FROM (SELECT d.*, '0' AS discount FROM d WHERE rn = 1) s""",
)
def _silver_ledger_summary(spark, sf):
    raw = raw_lines(spark, sf)
    report = plans.ledger_report(raw, plans.ledger_silver(raw, LEDGER, RUN_AT), LEDGER)
    return report.summary.select(
        "bronze_rows",
        "filtered_rows",
        "rows_filtered_out",
        "silver_rows",
        "duplicates_removed",
        "nulls_before",
        "conversion_errors",
        "nulls_after",
        "status",
    )


@query(
    "silver_ledger_detail",
    f"""WITH v AS (SELECT * FROM ({DUCK_LINES}) r WHERE line_status = 'F')
SELECT * FROM (SELECT 'quantity' AS column_name, 'cast_to_decimal(18,2)' AS kind,
  count(*) FILTER (WHERE {_nulled('quantity')} IS NOT NULL AND {number('quantity')} IS NULL) AS conversion_errors FROM v
UNION ALL SELECT 'price', 'cast_to_decimal(18,2)', count(*) FILTER (WHERE {_nulled('price')} IS NOT NULL AND {number('price')} IS NULL) FROM v
UNION ALL SELECT x, y, 0 FROM (VALUES ('l_orderkey', 'cast_to_long'), ('l_linenumber', 'cast_to_integer'), ('ship_year', 'cast_to_integer'),
 ('ship_month', 'cast_to_integer'), ('supplier', 'cast_to_string'), ('line_code', 'cast_to_string'), ('parent_code', 'cast_to_string'),
 ('flag', 'cast_to_string')) t(x, y)) z""",
)
def _silver_ledger_detail(spark, sf):
    raw = raw_lines(spark, sf)
    report = plans.ledger_report(raw, plans.ledger_silver(raw, LEDGER, RUN_AT), LEDGER)
    return report.detail.select("column_name", F.concat(F.lit("cast_to_"), "silver_type").alias("kind"), "conversion_errors")


SURVEY = {
    "source_system": "survey",
    "silver_defaults": {
        "add_technical_columns": True,
        "row_policy": {"drop_empty_rows": True},
        "null_handling": {"convert_missing_tokens_to_null": True},
        "technical_columns": {"record_hash": {"description": "Huella del registro."}},
    },
}
SURVEY_ORDERS = {
    "integer_columns": ["o_orderkey", "order_year", "order_month", "ghost"],
    "decimal_columns": ["amount"],
    "datetime_columns": {"order_date": {"reason": "parsed"}},
    "string_columns": ["status", "level", "priority"],
    "drop_columns": {"opening": {"reason": "constant by design"}},
    "special_values_to_null": {"order_date": {"values": ["0"], "reason": "0 means none"}},
    "documented_null_columns": {"status": {"reason": "partly empty"}, "order_date": {"reason": "partly empty"}},
    "derived_columns": {"anio_periodo_key": {"enabled": True, "source_columns": ["order_year", "order_month"]}},
}


def _whole(x: str) -> str:
    return f"CASE WHEN {number(x)} % 1 = 0 THEN CAST({number(x)} AS BIGINT) END"


_SURVEY_SQL = f"""
WITH n AS (SELECT o_orderkey, {_nulled('customer')} AS customer, {_nulled('status')} AS status, {_nulled('amount')} AS amount,
   CASE WHEN trim(order_date) <> '0' THEN order_date END AS order_date, {_nulled('order_year')} AS order_year,
   {_nulled('order_month')} AS order_month, {_nulled('level')} AS level, {_nulled('level_name')} AS level_name,
   {_nulled('sector')} AS sector, priority FROM ({DUCK_ORDERS}) r),
c AS (SELECT o_orderkey, customer, status, {number('amount')} AS amount, {_date('order_date')} AS order_date,
   {_whole('order_year')} AS order_year, {_whole('order_month')} AS order_month, level, level_name, sector, priority FROM n)
"""


@query(
    "silver_survey",
    _SURVEY_SQL
    + """SELECT o_orderkey, status, amount, CAST(epoch(order_date) AS BIGINT) AS order_epoch, order_year, order_month, level,
  CASE WHEN order_year IS NOT NULL AND order_month IS NOT NULL THEN concat(order_year, '-', order_month) END AS anio_periodo_key,
  'survey' AS source_system, 'orders' AS source_dataset FROM c""",
)
def _silver_survey(spark, sf):
    out = plans.survey_silver(raw_orders(spark, sf), "orders", SURVEY_ORDERS, SURVEY, RUN_AT)
    return out.select(
        "o_orderkey",
        "status",
        "amount",
        F.unix_timestamp("order_date").alias("order_epoch"),
        "order_year",
        "order_month",
        "level",
        "anio_periodo_key",
        "source_system",
        "source_dataset",
    )


_WHOLE_COLUMNS = ("o_orderkey", "order_year", "order_month")
_TEXT_COLUMNS = ("status", "level", "priority")
_ASIS_COLUMNS = ("customer", "level_name", "sector")


def _detail_sql(c: str) -> str:
    """A line of the detail table: the column before and after its cast."""
    how, bronze, silver, cast = "kept_without_explicit_rule", "string", "string", c
    if c in _WHOLE_COLUMNS:
        how, silver, cast = "cast_to_integer_nullable", "bigint", c if c == "o_orderkey" else _whole(c)
    elif c == "amount":
        how, silver, cast = "cast_to_decimal_nullable", "double", number(c)
    elif c == "order_date":
        how, silver, cast = "cast_to_datetime_nullable", "timestamp", _date(c)
    elif c in _TEXT_COLUMNS:
        how = "cast_to_string_nullable"
    bronze = "bigint" if c == "o_orderkey" else bronze
    why = {"status": "documented_null_columns: partly empty", "order_date": "documented_null_columns: partly empty | special_values_to_null: 0 means none"}
    errors = f"(SELECT count(*) FROM n WHERE {c} IS NOT NULL AND {cast} IS NULL)"
    special = "(SELECT count(*) FROM raw WHERE trim(order_date) = '0')" if c == "order_date" else "0"
    return f"""SELECT 'orders' AS dataset, '{c}' AS column_name, '{bronze}' AS bronze_type, '{silver}' AS silver_type, '{how}' AS transformation,
  (SELECT count(*) FROM n WHERE {c} IS NULL) AS nulls_before, (SELECT count(*) FROM c WHERE {c} IS NULL) AS nulls_after, {errors} AS conversion_errors,
  {special} AS special_values_handled, CASE WHEN {errors} = 0 THEN 'OK' ELSE 'CONVERSION_ERRORS' END AS status, '{why.get(c, "")}' AS reason"""


_KEPT_COLUMNS = (*_WHOLE_COLUMNS, *_TEXT_COLUMNS, *_ASIS_COLUMNS, "amount", "order_date")
_SURVEY_DETAIL = (
    _SURVEY_SQL
    + f", raw AS ({DUCK_ORDERS}) "
    + " UNION ALL ".join(_detail_sql(c) for c in _KEPT_COLUMNS)
    + """ UNION ALL SELECT 'orders', 'opening', 'string', 'dropped', 'drop_column', (SELECT count(*) FROM raw WHERE opening IS NULL), NULL, 0, 0, 'DROPPED',
  'constant by design'
UNION ALL SELECT 'orders', 'ghost', 'missing', 'missing', 'configured_column_not_found', NULL, NULL, 0, 0, 'WARNING',
  'Columna declarada en YAML, pero no existe en el Parquet Bronze.'"""
)


@query("silver_survey_detail", _SURVEY_DETAIL)
def _silver_survey_detail(spark, sf):
    raw = raw_orders(spark, sf)
    out = plans.survey_silver(raw, "orders", SURVEY_ORDERS, SURVEY, RUN_AT)
    found = plans.survey_metrics(raw, SURVEY_ORDERS, SURVEY["silver_defaults"])
    return plans.survey_detail(raw, out, "orders", SURVEY_ORDERS, found)


#: The same table under a row policy that imputes, with the columns to keep listed.
_FILLED = {**SURVEY, "silver_defaults": {**SURVEY["silver_defaults"], "row_policy": {"drop_empty_rows": True, "impute_missing_values": True}}}
_FILLED_ORDERS = {
    **{k: v for k, v in SURVEY_ORDERS.items() if k != "derived_columns"},
    "keep_columns": ["o_orderkey", "status", "order_year", "level"],
    "imputations": {"codes": {"columns": ["status", "level"], "impute_value": "?"}, "years": {"columns": ["order_year"], "impute_value": "0"}},
}


@query(
    "survey_row_policy",
    _SURVEY_SQL
    + f"""SELECT o_orderkey, coalesce(status, '?') AS status, coalesce(level, '?') AS level,
  {_whole("coalesce(order_year, '0')")} AS order_year, 'orders' AS source_dataset FROM n""",
)
def _row_policy(spark, sf):
    """Listed columns only, and constants for missing values."""
    out = plans.survey_silver(raw_orders(spark, sf), "orders", _FILLED_ORDERS, _FILLED, RUN_AT)
    return out.drop("source_system", "silver_processed_at", "record_hash")


@query(
    "survey_row_policy_detail",
    _SURVEY_SQL
    + f""", raw AS ({DUCK_ORDERS})
SELECT 'status' AS column_name, 'string' AS silver_type, (SELECT count(*) FROM n WHERE status IS NULL) AS nulls_before, 0::BIGINT AS nulls_after, 'OK' AS status
UNION ALL SELECT 'level', 'string', (SELECT count(*) FROM n WHERE level IS NULL), 0, 'OK'
UNION ALL SELECT 'o_orderkey', 'bigint', 0, 0, 'OK'
UNION ALL SELECT 'order_year', 'bigint', (SELECT count(*) FROM n WHERE order_year IS NULL), (SELECT count(*) FROM n WHERE order_year IS NOT NULL
  AND {_whole('order_year')} IS NULL), 'CONVERSION_ERRORS'
UNION ALL SELECT 'ghost', 'missing', NULL, NULL, 'WARNING'
"""
    + " ".join(
        f"UNION ALL SELECT '{c}', 'dropped', (SELECT count(*) FROM raw WHERE {c} IS NULL), NULL, 'DROPPED'"
        for c in ("customer", "amount", "opening", "order_date", "order_month", "level_name", "sector", "priority")
    ),
)
def _row_policy_detail(spark, sf):
    raw = raw_orders(spark, sf)
    rules = {**_FILLED_ORDERS, "integer_columns": ["o_orderkey", "order_year", "ghost"], "decimal_columns": [], "datetime_columns": []}
    rules["string_columns"] = ["status", "level"]
    out = plans.survey_silver(raw, "orders", rules, _FILLED, RUN_AT)
    detail = plans.survey_report(raw, out, "orders", rules, _FILLED).detail
    return detail.select("column_name", "silver_type", "nulls_before", "nulls_after", "status")


@query(
    "silver_survey_summary",
    _SURVEY_SQL
    + f""", raw AS ({DUCK_ORDERS})
SELECT (SELECT count(*) FROM raw) AS bronze_rows, count(*) AS silver_rows, 12 AS bronze_columns, 16 AS silver_columns,
  8::BIGINT AS columns_converted, 1::BIGINT AS date_columns_converted, 4::BIGINT AS numeric_columns_converted, 1 AS columns_dropped, 'opening' AS dropped_columns,
  (SELECT count(*) FROM n WHERE amount IS NOT NULL AND {number('amount')} IS NULL)
   + (SELECT count(*) FROM n WHERE order_date IS NOT NULL AND {_date('order_date')} IS NULL)
   + (SELECT count(*) FROM n WHERE order_year IS NOT NULL AND {_whole('order_year')} IS NULL)
   + (SELECT count(*) FROM n WHERE order_month IS NOT NULL AND {_whole('order_month')} IS NULL) AS conversion_errors,
  (SELECT count(*) FROM raw WHERE level IS NULL) AS nulls_before,
  'WITH_CONVERSION_ERRORS' AS status, 'Columna configurada no encontrada en Bronze: ghost' AS notes
FROM c""",
)
def _silver_survey_summary(spark, sf):
    raw = raw_orders(spark, sf)
    out = plans.survey_silver(raw, "orders", SURVEY_ORDERS, SURVEY, RUN_AT)
    return plans.survey_report(raw, out, "orders", SURVEY_ORDERS, SURVEY).summary.select(
        "bronze_rows",
        "silver_rows",
        "bronze_columns",
        "silver_columns",
        "columns_converted",
        "date_columns_converted",
        "numeric_columns_converted",
        "columns_dropped",
        "dropped_columns",
        "conversion_errors",
        "nulls_before",
        "status",
        "notes",
    )


_ADDED = ("source_system", "source_dataset", "silver_processed_at", "record_hash", "anio_periodo_key")


@query(
    "silver_dictionary",
    f"""WITH d AS ({_SURVEY_DETAIL})
SELECT dataset, column_name, column_name AS business_name, reason AS description, bronze_type, silver_type, transformation AS transformation_applied,
  CASE WHEN status <> 'DROPPED' THEN coalesce(nulls_after > 0, false) END AS nullable, false AS is_technical_column, reason AS notes FROM d
"""
    + " ".join(
        f"UNION ALL SELECT 'orders', '{c}', '{c}', '{text}', 'not_in_bronze', 'technical', 'added_technical_column', {c == 'anio_periodo_key'}, true, '{text}'"
        for c, text in ((c, "Huella del registro." if c == "record_hash" else "Columna técnica de trazabilidad Silver.") for c in _ADDED)
    ),
)
def _silver_dictionary(spark, sf):
    raw = raw_orders(spark, sf)
    out = plans.survey_silver(raw, "orders", SURVEY_ORDERS, SURVEY, RUN_AT)
    return plans.survey_report(raw, out, "orders", SURVEY_ORDERS, SURVEY).dictionary


_CENSUS_TEXTS = ("customer", "status", "amount", "opening", "order_date", "order_year", "order_month", "level", "level_name", "sector", "priority")


@query(
    "null_census",
    f"WITH v AS ({DUCK_ORDERS}) SELECT 'o_orderkey' AS column_name, count(*) AS n_rows, 0::BIGINT AS nulls FROM v "
    + " ".join(f"UNION ALL SELECT '{c}', count(*), count(*) FILTER (WHERE {_nulled(c)} IS NULL) FROM v" for c in _CENSUS_TEXTS),
)
def _null_census(spark, sf):
    return plans.null_census(clean.tokens_to_null(raw_orders(spark, sf)))


@query(
    "cast_whole_long",
    """SELECT o_orderkey, 9000000000000000000 + o_orderkey AS k, 9000000000000000000 + o_orderkey AS d,
CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN o_orderkey END AS m FROM orders""",
)
def _cast_whole(spark, sf):
    """Whole numbers of 19 digits, as text and as decimals, keep every digit; beyond BIGINT and fractions are NULL."""
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "concat(CAST(9000000000000000000 + o_orderkey AS STRING), if(o_orderkey % 2 = 0, '.0', '')) AS k",
        "CAST(9000000000000000000 + o_orderkey AS DECIMAL(20,0)) AS d",
        """CASE o_orderkey % 3 WHEN 0 THEN concat(CAST(o_orderkey AS STRING), '.5')
           WHEN 1 THEN concat(CAST(o_orderkey AS STRING), '.') ELSE concat('9', CAST(9000000000000000000 + o_orderkey AS STRING)) END AS m""",
    )
    return orders.select("o_orderkey", *[as_integer(orders, c).alias(c) for c in ("k", "d", "m")])


@query(
    "drop_repeated_rows",
    "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_shipdate FROM lineitem",
)
def _drop_repeated(spark, sf):
    return dedup.drop_repeated_rows(table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_shipdate"))
