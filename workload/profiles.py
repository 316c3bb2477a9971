"""Queries over the profile sections and the rich column profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamiz.operators.quantiles import exact_quantiles
from tamiz.plans.profiling import profile_all
from tamiz.profile import columns as rich
from tamiz.profile import sections as s
from workload.duck import TOKENS, missing
from workload.tables import DUCK_LINES, DUCK_ORDERS, raw_lines, raw_orders, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return register


_PROFILE_TOKENS = "('', 'nan', 'NaN', 'None', 'NULL', 'null', '<NA>')"
_LINE_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "quantity", "price", "discount", "tax", "flag", "line_status", "ship_date", "ship_year",
    "ship_month", "line_code", "parent_code", "supplier",
)
_ORDER_COLUMNS = (
    "o_orderkey customer status amount opening order_date order_year order_month level level_name sector priority".split()
)


def _text(c: str) -> str:
    return f"trim(CAST({c} AS VARCHAR))"


@query(
    "profile_nulls",
    f"""WITH v AS ({DUCK_ORDERS}), c AS ("""
    + " UNION ALL ".join(
        f"SELECT '{c}' AS columna, count(*) AS n, count(*) FILTER (WHERE {c} IS NULL) AS nulos, "
        f"count(*) FILTER (WHERE {c} IS NULL OR {_text(c)} IN {_PROFILE_TOKENS}) AS gone FROM v"
        for c in _ORDER_COLUMNS
    )
    + """)
SELECT 'orders' AS dataset, columna, n AS total_filas, nulos AS nulos_reales, round(nulos * 100.0::DOUBLE / n, 4) AS pct_nulos,
  gone AS faltantes_like, round(gone * 100.0::DOUBLE / n, 4) AS pct_faltantes, round((1 - gone::DOUBLE / n) * 100, 4) AS completitud_pct,
  CASE WHEN gone::DOUBLE / n > 0.05 THEN 'REVISAR' ELSE 'OK' END AS alerta FROM c""",
)
def _nulls(spark, sf):
    return s.null_profile(raw_orders(spark, sf), "orders")


@query(
    "profile_duplicates",
    f"""WITH l AS ({DUCK_LINES}), v AS (SELECT * FROM l UNION ALL SELECT * FROM l WHERE l_orderkey % 5 = 0),
e AS (SELECT count(*) AS n, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM v)) AS found FROM v),
g AS (SELECT count(*) AS n FROM v GROUP BY ship_year, supplier),
k AS (SELECT CAST(sum(n) AS BIGINT) AS n, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS found,
  count(*) FILTER (WHERE n > 1) AS shared FROM g)
SELECT 'lines' AS dataset, 'Filas exactas duplicadas' AS tipo_duplicado, found AS conteo, round(found::DOUBLE / n * 100, 4) AS pct,
  'Filas con todos los campos idénticos' AS descripcion, CASE WHEN found > 0 THEN 'REVISAR' ELSE 'OK' END AS alerta FROM e
UNION ALL SELECT 'lines', 'Duplicados por clave de negocio', found, round(found::DOUBLE / n * 100, 4),
  'Clave: ship_year + supplier | grupos afectados: ' || shared, CASE WHEN found > 0 THEN 'REVISAR' ELSE 'OK' END FROM k""",
)
def _duplicates(spark, sf):
    """The line view, and the lines of every fifth order once more."""
    lines = raw_lines(spark, sf)
    return s.duplicate_profile(lines.unionByName(lines.where("l_orderkey % 5 = 0")), "lines", ["ship_year", "supplier"])


def _class(u: str, n: str) -> str:
    return (
        f"CASE WHEN {u} <= 2 THEN 'binaria' WHEN {u} * 100.0::DOUBLE / {n} > 90 THEN 'identificador' "
        f"WHEN {u} * 100.0::DOUBLE / {n} > 50 THEN 'alta' WHEN {u} * 100.0::DOUBLE / {n} > 5 THEN 'media' ELSE 'baja_categorica' END"
    )


_CATS = ["p_brand", "p_type", "p_size", "p_name"]


def _top(view: str, c: str, ok: str, k: int = 10, text: str | None = None) -> str:
    return (
        f"SELECT value, n, row_number() OVER (ORDER BY n DESC, value) AS rank FROM (SELECT {text or f'CAST({c} AS VARCHAR)'} AS value, "
        f"count(*) AS n FROM ({view}) x WHERE {ok} GROUP BY 1) y QUALIFY rank <= {k}"
    )


@query(
    "profile_categoricals",
    " UNION ALL ".join(
        f"""SELECT 'part' AS dataset, '{c}' AS columna, u AS cardinalidad_aprox, {_class('u', 'n')} AS clase_cardinalidad,
'{{' || (SELECT string_agg('"' || value || '":' || n, ',' ORDER BY rank) FROM ({_top('SELECT * FROM part', c, f'{c} IS NOT NULL')}) t) || '}}' AS top10_valores,
round((SELECT sum(n) FROM ({_top('SELECT * FROM part', c, f'{c} IS NOT NULL')}) t)::DOUBLE / n * 100, 2) AS cobertura_top10_pct,
CASE WHEN u > 500 THEN 'REVISAR' ELSE 'OK' END AS alerta,
CASE WHEN u > 500 THEN 'Alta cardinalidad inesperada para columna categórica' ELSE '' END AS nota
FROM (SELECT count(DISTINCT {c}) AS u, count(*) AS n FROM part) d"""
        for c in _CATS
    ),
)
def _categoricals(spark, sf):
    return s.categorical_profile(table(spark, sf, "part"), "part", [*_CATS, "ghost"], exact=True)


def _bound(approx, exact, key: str, size: str):
    """Approximate next to exact counts: the exact one, and whether the error is within three times the stated one."""
    exact = exact.select(F.col(key), F.col(size).alias("exact"))
    off = F.abs(F.col(size) - F.col("exact"))
    return approx.join(exact, key).select("*", (off <= F.ceil(3 * s.APPROX_ERROR * F.col("exact"))).alias("within"))


_APPROX_CATS = ("flag", "line_status", "ship_month")


@query(
    "profile_categoricals_approx",
    f"WITH v AS ({DUCK_LINES}) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS columna, u AS exact, true AS within,
'{{' || (SELECT string_agg('"' || value || '":' || n, ',' ORDER BY rank) FROM ({_top('SELECT * FROM v', c, f'{c} IS NOT NULL')}) t) || '}}' AS top10_valores,
round((SELECT sum(n) FROM ({_top('SELECT * FROM v', c, f'{c} IS NOT NULL')}) t)::DOUBLE / n * 100, 2) AS cobertura_top10_pct
FROM (SELECT count(DISTINCT {c}) AS u, count(*) AS n FROM v) d"""
        for c in _APPROX_CATS
    ),
)
def _categoricals_approx(spark, sf):
    lines = raw_lines(spark, sf)
    forms = [s.categorical_profile(lines, "lines", _APPROX_CATS, exact=e) for e in (False, True)]
    out = _bound(*forms, "columna", "cardinalidad_aprox")
    return out.select("columna", "exact", "within", "top10_valores", "cobertura_top10_pct")


@query(
    "top_values",
    " UNION ALL ".join(f"SELECT '{c}' AS columna, CAST(rank AS INTEGER) AS rank, value, n FROM ({_top('SELECT * FROM part', c, 'true', 3)}) t" for c in _CATS),
)
def _top_values(spark, sf):
    return s.top_values(s.value_counts(table(spark, sf, "part"), _CATS), 3)


@query(
    "profile_temporal",
    f"""WITH v AS ({DUCK_LINES}),
y AS (SELECT DISTINCT CAST(ship_year AS BIGINT) AS a FROM v), m AS (SELECT DISTINCT CAST(ship_month AS BIGINT) AS a FROM v)
SELECT 'lines' AS dataset, 'ship_year' AS variable, min(a) AS valor_minimo, max(a) AS valor_maximo, count(*) AS valores_distintos, 0::BIGINT AS nulos,
  coalesce('[' || (SELECT string_agg(CAST(g AS VARCHAR), ', ' ORDER BY g) FROM range((SELECT min(a) FROM y), (SELECT max(a) + 1 FROM y)) r(g)
     WHERE g NOT IN (SELECT a FROM y)) || ']', 'ninguno') AS gaps_en_rango,
  coalesce('[' || (SELECT string_agg(CAST(a AS VARCHAR), ', ' ORDER BY a) FROM y WHERE a NOT BETWEEN 1996 AND 2000) || ']', 'ninguno') AS valores_fuera_rango_esperado,
  CASE WHEN (SELECT count(*) FROM y WHERE a NOT BETWEEN 1996 AND 2000) > 0 THEN 'REVISAR' ELSE 'OK' END AS alerta FROM y
UNION ALL
SELECT 'lines', 'ship_month', min(a), max(a), count(*), 0::BIGINT,
  coalesce('[' || (SELECT string_agg(CAST(g AS VARCHAR), ', ' ORDER BY g) FROM range(1, 13) r(g) WHERE g NOT IN (SELECT a FROM m)) || ']', 'ninguno'),
  coalesce('[' || (SELECT string_agg(CAST(a AS VARCHAR), ', ' ORDER BY a) FROM m WHERE a NOT BETWEEN 1 AND 12) || ']', 'ninguno'),
  CASE WHEN count(*) < 12 THEN 'REVISAR' ELSE 'OK' END FROM m""",
)
def _temporal(spark, sf):
    domains = {"ship_year": (1996, 2000, False), "ship_month": (1, 12, True)}
    return s.temporal_summary(raw_lines(spark, sf), "lines", domains)


@query(
    "profile_evolution",
    f"""WITH v AS ({DUCK_LINES})
SELECT 'lines' AS dataset, CAST(ship_year AS BIGINT) AS ano, count(*) AS registros, round(sum(TRY_CAST(trim(price) AS DOUBLE)), 2) AS sum_monto,
  round(avg(TRY_CAST(trim(price) AS DOUBLE)), 2) AS avg_monto, count(DISTINCT ship_month) AS meses_con_datos FROM v GROUP BY 2""",
)
def _evolution(spark, sf):
    return s.yearly_evolution(raw_lines(spark, sf), "lines", "ship_year", "ship_month", "price")


@query(
    "profile_cardinality",
    f"WITH v AS ({DUCK_ORDERS}) "
    + " UNION ALL ".join(
        f"SELECT 'orders' AS dataset, '{c}' AS columna, u AS cardinalidad_aprox, round(u::DOUBLE / n * 100, 4) AS pct_unicidad, "
        f"{_class('u', 'n')} AS clase FROM (SELECT count(DISTINCT {c}) AS u, count(*) AS n FROM v) d"
        for c in _ORDER_COLUMNS
    ),
)
def _cardinality(spark, sf):
    return s.cardinality_profile(raw_orders(spark, sf), "orders", exact=True)


@query(
    "profile_cardinality_approx",
    f"WITH v AS ({DUCK_LINES}) "
    + " UNION ALL ".join(f"SELECT 'lines' AS dataset, '{c}' AS columna, count(DISTINCT {c}) AS exact, true AS within FROM v" for c in _LINE_COLUMNS),
)
def _cardinality_approx(spark, sf):
    """Every column of the largest table: what is derived from an approximate count is left to `profile_cardinality`."""
    lines = raw_lines(spark, sf)
    out = _bound(s.cardinality_profile(lines, "lines"), s.cardinality_profile(lines, "lines", exact=True), "columna", "cardinalidad_aprox")
    return out.select("dataset", "columna", "exact", "within")


_PAIRS = [("level", "level_name"), ("sector", "level"), ("customer", "level")]


@query(
    "profile_consistency",
    f"WITH v AS ({DUCK_ORDERS}) "
    + " UNION ALL ".join(
        f"""SELECT 'orders' AS dataset, '{c}' AS columna_codigo, '{n}' AS columna_nombre,
(SELECT count(DISTINCT {c}) FROM v) AS cardinalidad_codigo, (SELECT count(DISTINCT {n}) FROM v) AS cardinalidad_nombre,
b AS codigos_con_multiples_nombres, CASE WHEN b > 0 THEN 'INCONSISTENTE' ELSE 'OK' END AS consistencia,
CASE WHEN b > 0 THEN b || ' código(s) tienen más de un nombre asociado' ELSE 'Relación 1→1 correcta' END AS nota
FROM (SELECT count(*) AS b FROM (SELECT {c} FROM v WHERE {c} IS NOT NULL AND {n} IS NOT NULL GROUP BY {c} HAVING count(DISTINCT {n}) > 1) x) y"""
        for c, n in _PAIRS
    ),
)
def _consistency(spark, sf):
    return s.consistency_profile(raw_orders(spark, sf), "orders", [*_PAIRS, ("ghost", "level")])


_AMOUNTS = ["price", "quantity", "discount"]


def _sign_sql(c: str) -> str:
    x = f"TRY_CAST(trim({c}) AS DOUBLE)"
    return f"""SELECT 'lines' AS dataset, '{c}' AS columna, count(*) AS total_filas, count(*) FILTER (WHERE {x} < 0) AS negativos,
round(count(*) FILTER (WHERE {x} < 0)::DOUBLE / count(*) * 100, 4) AS pct_negativos, count(*) FILTER (WHERE {x} = 0) AS ceros,
round(count(*) FILTER (WHERE {x} = 0)::DOUBLE / count(*) * 100, 4) AS pct_ceros, count(*) FILTER (WHERE {x} > 0) AS positivos,
round(count(*) FILTER (WHERE {x} > 0)::DOUBLE / count(*) * 100, 4) AS pct_positivos, count(*) FILTER (WHERE {x} IS NULL) AS nulos,
round(min({x}), 2) AS valor_minimo, round(max({x}), 2) AS valor_maximo, round(sum({x}), 2) AS suma_total, round(avg({x}), 4) AS promedio,
CASE WHEN count(*) FILTER (WHERE {x} < 0) > 0 THEN 'REVISAR' ELSE 'OK' END AS alerta_negativos,
CASE WHEN count(*) FILTER (WHERE {x} = 0)::DOUBLE / count(*) > 0.30 THEN 'REVISAR' ELSE 'OK' END AS alerta_ceros,
CASE WHEN count(*) FILTER (WHERE {x} < 0) > 0 THEN format('{{:,}}', count(*) FILTER (WHERE {x} < 0)) ||
 ' valores negativos detectados — ingresos negativos son inusuales' ELSE 'Sin valores negativos' END AS nota FROM v"""


@query("profile_signs", f"WITH v AS ({DUCK_LINES}) " + " UNION ALL ".join(_sign_sql(c) for c in _AMOUNTS))
def _signs(spark, sf):
    return s.sign_profile(raw_lines(spark, sf), "lines", _AMOUNTS)


_CUSTOMER = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_mktsegment": "string"}


@query(
    "profile_generic",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "Columna", '{t}' AS "Tipo_Spark", count(*) FILTER (WHERE {c} IS NULL) AS "Nulos",
round(count(*) FILTER (WHERE {c} IS NULL)::DOUBLE / count(*) * 100, 4) AS "Porcentaje_Nulos", count(DISTINCT {c}) AS "Cardinalidad_Aprox",
CAST(min({c}) AS VARCHAR) AS "Min", CAST(max({c}) AS VARCHAR) AS "Max", count(*) AS "Total_Filas" FROM customer"""
        for c, t in _CUSTOMER.items()
    ),
)
def _generic(spark, sf):
    return s.generic_profile(table(spark, sf, "customer").select(*_CUSTOMER), exact=True)


_LINEITEM = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate".split()


@query(
    "profile_generic_approx",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "Columna", count(*) FILTER (WHERE {c} IS NULL) AS "Nulos", count(DISTINCT {c}) AS exact, true AS within,
count(*) AS "Total_Filas" FROM lineitem"""
        for c in _LINEITEM
    ),
)
def _generic_approx(spark, sf):
    lines = table(spark, sf, "lineitem").select(*_LINEITEM)
    out = _bound(s.generic_profile(lines), s.generic_profile(lines, exact=True), "Columna", "Cardinalidad_Aprox")
    return out.select("Columna", "Nulos", "exact", "within", "Total_Filas")


@query(
    "profile_generic_summary",
    """WITH d AS (SELECT count(*) AS n, count(DISTINCT c_custkey) + count(DISTINCT c_name) + count(DISTINCT c_nationkey)
+ count(DISTINCT c_mktsegment) AS u FROM customer)
SELECT n AS total_filas, 4::BIGINT AS total_columnas, 0::BIGINT AS columnas_con_nulos, 4::BIGINT AS columnas_sin_nulos, 100.0::DOUBLE AS completitud_columnas_pct,
CAST(floor(u / 4.0) AS BIGINT) AS cardinalidad_promedio FROM d""",
)
def _generic_summary(spark, sf):
    return s.generic_summary(s.generic_profile(table(spark, sf, "customer").select(*_CUSTOMER), exact=True))


@query(
    "profile_alerts",
    f"""WITH w AS ({DUCK_LINES})
SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM w)) AS BIGINT) AS duplicados_exactos,
  CAST({" + ".join(f"(SELECT CAST(count(*) FILTER (WHERE {c} IS NULL OR {_text(c)} IN {_PROFILE_TOKENS})::DOUBLE / count(*) > 0.05 AS BIGINT) FROM w)" for c in _LINE_COLUMNS)} AS BIGINT)
    AS columnas_con_faltantes, 1::BIGINT AS montos_con_negativos, 1::BIGINT AS pares_inconsistentes, 'REVISAR' AS estado FROM w""",
)
def _alerts(spark, sf):
    lines = raw_lines(spark, sf)
    return s.alert_totals(
        s.null_profile(lines, "lines"),
        s.duplicate_profile(lines, "lines", ["flag"]),
        s.sign_profile(lines, "lines", ["price", "discount"]),
        s.consistency_profile(lines, "lines", [("flag", "line_status")]),
    )


@query(
    "profile_metadata",
    "SELECT 'orders' AS dataset, count(*) AS total_filas, 6 AS total_columnas, 1 AS archivos_combinados, 'orders.parquet' AS rutas, 'OK' AS estado FROM orders",
)
def _metadata(spark, sf):
    return s.profile_metadata(table(spark, sf, "orders"), "orders", ["orders.parquet"])


# --- rich profile ---------------------------------------------------------------------------------------------------

def _rich_sql(c: str) -> str:
    text = f"CAST({c} AS VARCHAR)"
    t, here = f"trim({text})", f"NOT {missing(text)}"
    x = f"TRY_CAST({t} AS DOUBLE)"
    d = f"TRY_STRPTIME({t}, '%d/%m/%Y')"
    top = _top("SELECT * FROM v", text, here, 10, t)
    few = f"SELECT DISTINCT {t} AS value FROM v WHERE {here} ORDER BY 1 LIMIT 5"
    kind = "bigint" if c == "o_orderkey" else "string"
    return f"""
SELECT 'orders' AS dataset, '{c}' AS column_name, '{kind}' AS parquet_type, {_KIND_SQL} AS inferred_type, n AS row_count, nulls AS null_count,
  round(nulls::DOUBLE / n * 100, 4) AS null_pct, blank AS empty_string_count, round(blank::DOUBLE / n * 100, 4) AS empty_string_pct,
  n - h AS missing_like_count, round((n - h)::DOUBLE / n * 100, 4) AS missing_like_pct, h AS non_missing_count, u AS unique_count,
  round(u::DOUBLE / n * 100, 4) AS unique_pct,
  CASE WHEN round(u::DOUBLE / n * 100, 4) > 95 THEN 'alta_posible_identificador' WHEN round(u::DOUBLE / n * 100, 4) > 50 THEN 'media_alta'
       WHEN round(u::DOUBLE / n * 100, 4) > 5 THEN 'media' ELSE 'baja_categorica' END AS cardinality_class,
  lo_len AS min_length, hi_len AS max_length, round(sum_len::DOUBLE / h, 4) AS avg_length, k AS numeric_valid_count,
  round(k::DOUBLE / h * 100, 4) AS numeric_valid_pct, lo AS numeric_min, hi AS numeric_max, round(total / nullif(k, 0), 4) AS numeric_mean,
  round(q1, 4) AS q1, round(q3, 4) AS q3, round(q3 - q1, 4) AS iqr, o AS outlier_count_iqr, round(o::DOUBLE / nullif(k, 0) * 100, 4) AS outlier_pct_iqr,
  CASE WHEN d > 0 THEN round(d::DOUBLE / h * 100, 4) ELSE 0.0 END AS datetime_valid_pct,
  CASE WHEN d > 0 THEN '%d/%m/%Y' ELSE '' END AS datetime_detected_format,
  coalesce(strftime(dlo, '%Y-%m-%d %H:%M:%S'), '') AS datetime_min, coalesce(strftime(dhi, '%Y-%m-%d %H:%M:%S'), '') AS datetime_max,
  coalesce('[' || (SELECT string_agg('"' || value || '"', ',' ORDER BY value) FROM ({few}) f) || ']', '[]') AS sample_values,
  coalesce('{{' || (SELECT string_agg('"' || value || '":' || n, ',' ORDER BY rank) FROM ({top}) t) || '}}', '{{}}') AS top_values
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) FILTER (WHERE {c} IS NULL OR {t} = '') AS blank,
  count(*) FILTER (WHERE {here}) AS h, count(DISTINCT {t}) FILTER (WHERE {here}) AS u,
  min(length({t})) FILTER (WHERE {here}) AS lo_len, max(length({t})) FILTER (WHERE {here}) AS hi_len,
  sum(length({t})) FILTER (WHERE {here}) AS sum_len, count({x}) FILTER (WHERE {here}) AS k, min({x}) FILTER (WHERE {here}) AS lo,
  max({x}) FILTER (WHERE {here}) AS hi, sum({x}) FILTER (WHERE {here}) AS total,
  quantile_cont({x}, 0.25) FILTER (WHERE {here}) AS q1, quantile_cont({x}, 0.75) FILTER (WHERE {here}) AS q3,
  coalesce(bool_and(upper({t}) IN ('0', '1', 'S', 'N', 'SI', 'NO', 'TRUE', 'FALSE', 'A', 'I')) FILTER (WHERE {here}), false) AS ind,
  coalesce(bool_and({x} % 1 = 0) FILTER (WHERE {here} AND {x} IS NOT NULL), false) AS whole, 0 AS e,
  count({d}) FILTER (WHERE {here}) AS d, min({d}) FILTER (WHERE {here}) AS dlo, max({d}) FILTER (WHERE {here}) AS dhi FROM v) a,
LATERAL (SELECT CASE WHEN a.q3 - a.q1 > 0 THEN count(*) FILTER (WHERE {here} AND ({x} < a.q1 - 1.5 * (a.q3 - a.q1) OR {x} > a.q3 + 1.5 * (a.q3 - a.q1))) END AS o FROM v) b"""


#: The class of a column of h present values, k of them numbers, d dates, e e-mails and u of them different.
_KIND_SQL = """CASE WHEN h = 0 THEN 'empty_or_null' WHEN ind THEN 'categorical_indicator'
WHEN k::DOUBLE / h >= 0.98 THEN CASE WHEN whole THEN 'integer' ELSE 'decimal' END WHEN d::DOUBLE / h >= 0.90 THEN 'datetime_or_date'
WHEN e::DOUBLE / h >= 0.80 THEN 'email' WHEN u::DOUBLE / h <= 0.10 THEN 'categorical_text' ELSE 'text' END"""


@query("profile_columns_rich", f"WITH v AS ({DUCK_ORDERS}) " + " UNION ALL ".join(_rich_sql(c) for c in _ORDER_COLUMNS))
def _columns_rich(spark, sf):
    return rich.column_profile(raw_orders(spark, sf), "orders")


_INFER = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]


def _infer_sql(view: str, c: str) -> str:
    t, here = f"trim(CAST({c} AS VARCHAR))", f"NOT {missing(f'CAST({c} AS VARCHAR)')}"
    x = f"TRY_CAST({t} AS DOUBLE)"
    dates = ", ".join(
        f"count(TRY_STRPTIME({t}, '{f}')) FILTER (WHERE {here})" for f in ("%d/%m/%Y %H:%M:%S", "%d/%m/%Y", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%Y/%m/%d")
    )
    return f"""SELECT '{c}' AS column_name, {_KIND_SQL} AS inferred_type, n AS row_count
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {here}) AS h, count(DISTINCT {t}) FILTER (WHERE {here}) AS u,
 coalesce(bool_and(upper({t}) IN ('0', '1', 'S', 'N', 'SI', 'NO', 'TRUE', 'FALSE', 'A', 'I')) FILTER (WHERE {here}), false) AS ind,
 count({x}) FILTER (WHERE {here}) AS k, coalesce(bool_and({x} % 1 = 0) FILTER (WHERE {here} AND {x} IS NOT NULL), false) AS whole,
 greatest({dates}) AS d, count(*) FILTER (WHERE {here} AND regexp_matches({t}, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$')) AS e FROM ({view}) x) y"""


@query(
    "infer_types",
    " UNION ALL ".join(
        [
            *[_infer_sql(DUCK_ORDERS, c) for c in ("customer", "status", "amount", "order_date", "order_year", "sector", "priority", "level_name")],
            *[_infer_sql(DUCK_LINES, c) for c in ("flag", "price", "ship_date", "line_code")],
        ]
    ),
)
def _infer(spark, sf):
    orders = rich.infer_types(
        raw_orders(spark, sf), ["customer", "status", "amount", "order_date", "order_year", "sector", "priority", "level_name"]
    )
    return orders.unionByName(rich.infer_types(raw_lines(spark, sf), ["flag", "price", "ship_date", "line_code"]))


@query(
    "best_date_format",
    f"""WITH v AS (SELECT order_date AS a, CASE WHEN o_orderkey % 3 = 0 THEN strftime(TRY_STRPTIME(order_date, '%d/%m/%Y'), '%Y-%m-%d %H:%M:%S')
  ELSE strftime(TRY_STRPTIME(order_date, '%d/%m/%Y'), '%Y-%m-%d') END AS b FROM ({DUCK_ORDERS}) r)
SELECT 'a' AS column_name, round(count(TRY_STRPTIME(a, '%d/%m/%Y'))::DOUBLE / count(a) * 100, 4) AS datetime_valid_pct,
  '%d/%m/%Y' AS datetime_detected_format, strftime(min(TRY_STRPTIME(a, '%d/%m/%Y')), '%Y-%m-%d %H:%M:%S') AS datetime_min,
  strftime(max(TRY_STRPTIME(a, '%d/%m/%Y')), '%Y-%m-%d %H:%M:%S') AS datetime_max FROM v
UNION ALL SELECT 'b', round(count(*) FILTER (WHERE length(b) = 10)::DOUBLE / count(b) * 100, 4), '%Y-%m-%d',
  min(b) FILTER (WHERE length(b) = 10) || ' 00:00:00', max(b) FILTER (WHERE length(b) = 10) || ' 00:00:00' FROM v""",
)
def _best_date(spark, sf):
    raw = raw_orders(spark, sf)
    parsed = F.when(F.col("order_date").rlike("^../../....$"), F.try_to_timestamp("order_date", F.lit("d/M/yyyy")))
    mixed = F.when(F.col("o_orderkey") % 3 == 0, F.date_format(parsed, "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format(parsed, "yyyy-MM-dd")
    )
    return rich.best_date_layout(raw.select(F.col("order_date").alias("a"), mixed.alias("b")))


@query(
    "sample_values",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '[' || string_agg('\"' || value || '\"', ',' ORDER BY value) || ']' AS sample_values FROM "
        f"(SELECT DISTINCT CAST({c} AS VARCHAR) AS value FROM part WHERE CAST({c} AS VARCHAR) NOT IN {TOKENS} ORDER BY 1 LIMIT 5) x"
        for c in _CATS
    ),
)
def _sample_values(spark, sf):
    return rich.sample_values(table(spark, sf, "part"), _CATS)


@query(
    "profile_summary",
    f"""WITH p AS ({ORACLES['profile_columns_rich']}), v AS ({DUCK_ORDERS})
SELECT 'orders' AS dataset, max(row_count) AS row_count, count(*) AS column_count,
 (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM v)) FROM v) AS duplicate_rows,
 round((SELECT (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM v)))::DOUBLE / count(*) * 100 FROM v), 4) AS duplicate_rows_pct,
 count(*) FILTER (WHERE missing_like_count > 0) AS columns_with_missing, count(*) FILTER (WHERE missing_like_pct = 100) AS columns_all_missing,
 count(*) FILTER (WHERE missing_like_pct >= 50) AS columns_high_missing_50pct, round(avg(missing_like_pct), 4) AS avg_missing_pct,
 round(avg(unique_pct), 4) AS avg_unique_pct, count(*) FILTER (WHERE numeric_valid_pct >= 98) AS numeric_like_columns,
 count(*) FILTER (WHERE datetime_valid_pct >= 90) AS datetime_like_columns, count(*) FILTER (WHERE non_missing_count = 0) AS empty_or_null_columns,
 'OK' AS profile_status FROM p""",
)
def _summary(spark, sf):
    raw = raw_orders(spark, sf)
    return rich.profile_summary(rich.column_profile(raw, "orders"), raw, "orders")


_DATASETS = {
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "region": ("r_regionkey", "r_name"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"),
}


@query(
    "profile_all_datasets",
    " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, count({c}) AS non_missing_count, "
        f"count(DISTINCT {c}) AS unique_count, round(count(DISTINCT {c})::DOUBLE / count(*) * 100, 4) AS unique_pct, "
        f"count(TRY_CAST({c} AS DOUBLE)) AS numeric_valid_count, min(TRY_CAST({c} AS DOUBLE)) AS numeric_min, max(TRY_CAST({c} AS DOUBLE)) AS numeric_max, "
        f"round(quantile_cont(TRY_CAST({c} AS DOUBLE), 0.25), 4) AS q1, round(quantile_cont(TRY_CAST({c} AS DOUBLE), 0.75), 4) AS q3 FROM {d}"
        for d, columns in _DATASETS.items()
        for c in columns
    ),
)
def _all_datasets(spark, sf):
    stacked = profile_all({name: table(spark, sf, name).select(*columns) for name, columns in _DATASETS.items()})
    return stacked.select(
        "dataset", "column_name", "row_count", "null_count", "non_missing_count", "unique_count", "unique_pct",
        "numeric_valid_count", "numeric_min", "numeric_max", "q1", "q3",
    )


_QUANTILES = """SELECT 'price' AS column_name, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS q2,
quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem
UNION ALL SELECT 'quantity', quantile_cont(l_quantity, 0.25), quantile_cont(l_quantity, 0.5), quantile_cont(l_quantity, 0.75) FROM lineitem"""


def _quantile_counts(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"))
    return lines.unpivot([], ["price", "quantity"], "column_name", "x").groupBy("column_name", "x").agg(F.count(F.lit(1)).alias("n"))


def _quartiles(found):
    return found.select("column_name", *[F.round(F.col("quantiles")[i], 6).alias(f"q{i + 1}") for i in range(3)])


@query("exact_quantiles", f"SELECT column_name, round(q1, 6) AS q1, round(q2, 6) AS q2, round(q3, 6) AS q3 FROM ({_QUANTILES}) q")
def _exact_quantiles(spark, sf):
    return _quartiles(exact_quantiles(_quantile_counts(spark, sf), "column_name", "x", "n", (0.25, 0.5, 0.75)))


@query("exact_quantiles_bucketed", ORACLES["exact_quantiles"])
def _exact_quantiles_bucketed(spark, sf):
    """Ranges are narrowed until a task ranks a hundred values at most."""
    return _quartiles(exact_quantiles(_quantile_counts(spark, sf), "column_name", "x", "n", (0.25, 0.5, 0.75), bucket=100))


@query(
    "temporal_gap_ranges",
    """WITH k AS (SELECT DISTINCT o_orderkey * 1000 AS a FROM orders UNION SELECT 40000000000)
SELECT 'k' AS variable, 'gap' AS kind, a + 1 AS first, b - 1 AS last, b - a - 1 AS n
FROM (SELECT a, lead(a) OVER (ORDER BY a) AS b FROM k) x WHERE b > a + 1
UNION ALL SELECT 'k', 'stray', 40000000000, 40000000000, 1""",
)
def _gap_ranges(spark, sf):
    """Keys a thousand apart and one far off: every gap is a range, however long."""
    keys = table(spark, sf, "orders").select((F.col("o_orderkey") * 1000).alias("k"))
    far = keys.limit(1).select(F.lit(40_000_000_000).alias("k"))
    return s.temporal_gaps(keys.unionByName(far), {"k": (0, 39_999_999_999, False)})


_MANY = 160


@query(
    "null_profile_wide_empty",
    f"""SELECT 'c' || i AS columna, 0::BIGINT AS total_filas, 0::BIGINT AS nulos_reales, 'SIN_DATOS' AS alerta FROM range({_MANY}) r(i)
UNION ALL SELECT 'full_c' || i, (SELECT count(*) FROM orders), CASE WHEN i % 2 = 0 THEN (SELECT count(*) FROM orders) ELSE 0 END,
  CASE WHEN i % 2 = 0 THEN 'REVISAR' ELSE 'OK' END FROM range({_MANY}) r(i)""",
)
def _wide_empty(spark, sf):
    """A table of many columns with all its rows, and one without any: a line per column either way."""
    orders = table(spark, sf, "orders")
    wide = orders.select(*[(F.lit(None).cast("string") if i % 2 == 0 else F.col("o_orderstatus")).alias(f"c{i}") for i in range(_MANY)])
    none = s.null_profile(wide.where("1 = 0"), "none")
    full = s.null_profile(wide, "full").withColumn("columna", F.concat(F.lit("full_"), "columna"))
    return none.unionByName(full).select("columna", "total_filas", "nulos_reales", "alerta")


@query(
    "profile_duplicates_full_rows",
    """SELECT 'Filas exactas duplicadas' AS tipo_duplicado, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM documents)) AS conteo FROM documents
UNION ALL SELECT 'Duplicados por clave de negocio', CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM documents GROUP BY lang, source HAVING count(*) > 1) g""",
)
def _duplicates_full(spark, sf):
    """Whole rows with long texts: only their hashes are shuffled."""
    return s.duplicate_profile(table(spark, sf, "documents"), "documents", ["lang", "source"]).select("tipo_duplicado", "conteo")
