"""The driver tables, and raw text views of them.

The tables are clean. The raw views write every value as text, the way a Bronze landing holds it, and spoil some cells
by arithmetic on the row's key, so that the missing, invalid and inconsistent branches are met. Every row of the
table is in its view; no row is left out. The same expressions, in both SQL dialects, feed Spark and the oracle.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession

AS_OF = dt.datetime(1999, 6, 30, 12, 0, 0)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf, f"{name}.parquet"))


# {text(x)}: x as text; {money(x)}: two decimals as text; {day(x)}: dd/MM/yyyy; {int(x)}: whole number as text.
_ORDERS = """
SELECT o_orderkey,
  {text:o_custkey} AS customer,
  CASE WHEN o_orderkey % 17 = 0 THEN ' ' WHEN o_orderkey % 19 = 0 THEN 'NULL'
       WHEN o_orderkey % 23 = 0 THEN concat(' ', o_orderstatus, ' ') ELSE o_orderstatus END AS status,
  CASE WHEN o_orderkey % 29 = 0 THEN 'abc' WHEN o_orderkey % 31 = 0 THEN ''
       WHEN o_orderkey % 13 = 0 THEN concat('-', {money:o_totalprice}) ELSE {money:o_totalprice} END AS amount,
  CASE WHEN o_orderkey % 11 = 0 THEN '0' WHEN o_orderkey % 7 = 0 THEN '0.50' ELSE {money:o_totalprice} END AS opening,
  CASE WHEN o_orderkey % 37 = 0 THEN '0' WHEN o_orderkey % 41 = 0 THEN '31/13/2020'
       ELSE {day:o_orderdate} END AS order_date,
  CASE WHEN o_orderkey % 43 = 0 THEN concat({int:year(o_orderdate)}, '.0') WHEN o_orderkey % 47 = 0 THEN '2099'
       WHEN o_orderkey % 53 = 0 THEN 'n/d' ELSE {int:year(o_orderdate)} END AS order_year,
  CASE WHEN o_orderkey % 59 = 0 THEN '13' WHEN o_orderkey % 61 = 0 THEN '7.5'
       ELSE {int:month(o_orderdate)} END AS order_month,
  CASE WHEN o_orderkey % 67 = 0 THEN NULL ELSE o_orderstatus END AS level,
  CASE WHEN o_orderstatus = 'O' THEN 'OPEN' WHEN o_orderstatus = 'F' AND o_orderkey % 73 = 0 THEN 'FINISHED'
       WHEN o_orderstatus = 'F' THEN 'FILLED' ELSE 'PENDING' END AS level_name,
  CASE WHEN o_orderstatus = 'O' THEN ' ' WHEN o_orderkey % 71 = 0 THEN ' '
       ELSE substring(o_orderpriority, 1, 1) END AS sector,
  concat(' ', o_orderpriority, '  ') AS priority
FROM orders
"""

_LINES = """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_partkey % 89 = 0 THEN 'x' WHEN l_partkey % 83 = 0 THEN ' ' ELSE {money:l_quantity} END AS quantity,
  CASE WHEN l_partkey % 97 = 0 THEN concat('-', {money:l_extendedprice}) WHEN l_partkey % 101 = 0 THEN 'N/A'
       ELSE {money:l_extendedprice} END AS price,
  {money:l_discount} AS discount,
  {money:l_tax} AS tax,
  CASE WHEN l_suppkey % 31 = 0 THEN ' ' ELSE l_returnflag END AS flag,
  l_linestatus AS line_status,
  CASE WHEN l_suppkey % 37 = 0 THEN '0' ELSE {day:l_shipdate} END AS ship_date,
  {int:year(l_shipdate)} AS ship_year,
  {int:month(l_shipdate)} AS ship_month,
  {int:l_linenumber} AS line_code,
  {int:l_suppkey % 5} AS parent_code,
  {int:l_suppkey} AS supplier
FROM lineitem
"""

_SPARK = {
    "text": "CAST(%s AS STRING)",
    "money": "CAST(CAST(%s AS DECIMAL(18,2)) AS STRING)",
    "day": "date_format(%s, 'dd/MM/yyyy')",
    "int": "CAST(%s AS STRING)",
}
_DUCK = {
    "text": "CAST(%s AS VARCHAR)",
    "money": "CAST(CAST(%s AS DECIMAL(18,2)) AS VARCHAR)",
    "day": "strftime(%s, '%%d/%%m/%%Y')",
    "int": "CAST(CAST(%s AS BIGINT) AS VARCHAR)",
}


def _render(template: str, dialect: dict[str, str]) -> str:
    out, rest = "", template
    while "{" in rest:
        head, rest = rest.split("{", 1)
        body, rest = rest.split("}", 1)
        kind, expr = body.split(":", 1)
        out += head + dialect[kind] % expr
    return out + rest


DUCK_ORDERS = _render(_ORDERS, _DUCK)
DUCK_LINES = _render(_LINES, _DUCK)


def _view(df: DataFrame, name: str, template: str) -> DataFrame:
    return df.sparkSession.sql(_render(template, _SPARK).replace(f"FROM {name}", "FROM {src}"), src=df)


def raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _view(table(spark, sf, "orders"), "orders", _ORDERS)


def raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _view(table(spark, sf, "lineitem"), "lineitem", _LINES)
