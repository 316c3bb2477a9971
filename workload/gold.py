"""Queries over the Gold model: annual totals, canonical names, star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamiz.functions.casts import cast_to
from tamiz.plans import gold
from tamiz.session import scratch
from workload.duck import number
from workload.tables import DUCK_LINES, raw_lines, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return register


_PARTIAL = f"""cover AS (SELECT CAST(ship_year AS BIGINT) AS ano, count(DISTINCT CAST(ship_month AS BIGINT)) AS meses FROM ({DUCK_LINES}) r GROUP BY 1)"""


@query(
    "annual_totals",
    f"""WITH v AS (SELECT CAST(ship_year AS BIGINT) AS ano, CAST(ship_month AS BIGINT) AS mes, supplier, flag, {number("price")} AS price,
  {number("quantity")} AS quantity FROM ({DUCK_LINES}) r),
{_PARTIAL}
SELECT CASE grouping(v.ano, supplier, flag) WHEN 0 THEN 'entidad' WHEN 3 THEN 'ano' ELSE 'total' END AS nivel, v.ano, supplier, flag,
  count(*) AS registros, round(coalesce(sum(price), 0), 2) AS total_price, round(coalesce(sum(quantity), 0), 2) AS total_quantity,
  count(DISTINCT mes) AS meses_con_datos,
  CASE WHEN grouping(v.ano, supplier, flag) < 7 THEN (SELECT meses < 12 FROM cover WHERE cover.ano = v.ano) END AS ano_parcial
FROM v GROUP BY GROUPING SETS ((v.ano, supplier, flag), (v.ano), ())""",
)
def _annual(spark, sf):
    return gold.annual_totals(raw_lines(spark, sf), ["supplier", "flag"], "ship_year", "ship_month", ["price", "quantity"])


@query(
    "partial_years",
    f"""WITH {_PARTIAL}
SELECT ano_parcial, meses_con_datos, count(*) AS rows FROM (
  SELECT meses < 12 AS ano_parcial, meses AS meses_con_datos FROM ({DUCK_LINES}) r JOIN cover ON cover.ano = CAST(r.ship_year AS BIGINT)) x GROUP BY ALL""",
)
def _partial(spark, sf):
    marked = gold.mark_partial_years(raw_lines(spark, sf), "ship_year", "ship_month")
    return marked.groupBy("ano_parcial", "meses_con_datos").agg(F.count(F.lit(1)).alias("rows"))


#: Names with uneven blanks and case, several per customer and year.
_NAMED = "SELECT o_custkey, concat('  ', {low}(o_orderpriority), '   of ', o_orderstatus, ' ') AS name, year(o_orderdate) AS y FROM orders"


@query(
    "canonical_names",
    f"""WITH v AS ({_NAMED.format(low="lower")}),
n AS (SELECT o_custkey, upper(trim(regexp_replace(name, '\\s+', ' ', 'g'))) AS nombre_canonico, y, count(*) AS n FROM v GROUP BY ALL)
SELECT o_custkey, nombre_canonico, CAST(y AS BIGINT) AS ultimo_ano FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY y DESC, n DESC, nombre_canonico) AS rn FROM n) x WHERE rn = 1""",
)
def _names(spark, sf):
    orders = spark.sql(_NAMED.format(low="lower").replace("FROM orders", "FROM {src}"), src=table(spark, sf, "orders"))
    return gold.canonical_names(orders, ["o_custkey"], "name", "y")


def _star(spark, sf) -> gold.Star:
    """Facts of the line view: prices by month, by supplier with its latest flag, and by a code that is missing at times."""
    lines = raw_lines(spark, sf)
    facts = lines.select("*", cast_to(lines, "price", "decimal(18,2)").alias("amount")).withColumns(
        {"code": F.when(F.trim("flag") != "", F.col("flag")), "seen": F.col("ship_year").cast("int") * 100 + F.col("ship_month").cast("int")}
    )
    dimensions = [
        gold.month_dimension(facts, "ship_year", "ship_month"),
        gold.Dimension("proveedor", ("supplier",), attributes=("line_status",), latest=("seen",)),
        gold.Dimension("codigo", ("code", "parent_code")),
    ]
    return gold.star_schema(facts, dimensions, ["l_orderkey", "amount"])


_FACTS = f"""v AS (SELECT *, CAST({number("price")} AS DECIMAL(18,2)) AS amount, CASE WHEN trim(flag) <> '' THEN flag END AS code,
  CAST(ship_year AS BIGINT) * 100 + CAST(ship_month AS BIGINT) AS seen FROM ({DUCK_LINES}) r),
s AS (SELECT supplier, line_status, row_number() OVER (ORDER BY supplier) AS sk FROM (
  SELECT supplier, line_status, row_number() OVER (PARTITION BY supplier ORDER BY seen DESC, line_status) AS rn FROM v) x WHERE rn = 1),
c AS (SELECT code, parent_code, row_number() OVER (ORDER BY code, parent_code) AS sk FROM (SELECT DISTINCT code, parent_code FROM v WHERE code IS NOT NULL) x)"""


@query(
    "star_schema",
    f"""WITH {_FACTS}
SELECT v.seen AS month, s.sk AS supplier_key, s.line_status AS supplier_status, coalesce(c.sk, 0) AS code_key,
  count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount
FROM v JOIN s ON s.supplier = v.supplier LEFT JOIN c ON c.code = v.code AND c.parent_code = v.parent_code GROUP BY ALL""",
)
def _star_totals(spark, sf):
    star = _star(spark, sf)
    suppliers = star.dimensions["proveedor"].select("sk_proveedor", F.col("line_status").alias("supplier_status"))
    joined = star.fact.join(suppliers, "sk_proveedor")
    return joined.groupBy(
        F.col("sk_tiempo").alias("month"), F.col("sk_proveedor").alias("supplier_key"), "supplier_status", F.col("sk_codigo").alias("code_key")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("amount"))


@query(
    "star_schema_check",
    f"""WITH {_FACTS}
SELECT 'tiempo' AS dimension, (SELECT count(DISTINCT seen) + 1 FROM v) AS members, (SELECT count(*) FROM v) AS facts, 0::BIGINT AS unknown, 0::BIGINT AS orphans
UNION ALL SELECT 'proveedor', (SELECT count(*) + 1 FROM s), (SELECT count(*) FROM v), 0, 0
UNION ALL SELECT 'codigo', (SELECT count(*) + 1 FROM c), (SELECT count(*) FROM v), (SELECT count(*) FROM v WHERE code IS NULL), 0""",
)
def _star_check(spark, sf):
    """The star is written and read back; its keys are checked on what is stored."""
    star = _star(spark, sf)
    paths = gold.write_star(star, scratch(spark, "gold"), "lines", ["sk_tiempo"])
    stored = gold.Star(spark.read.parquet(paths["fact"]), {n: spark.read.parquet(paths[f"dim_{n}"]) for n in star.dimensions})
    return gold.star_check(stored)
