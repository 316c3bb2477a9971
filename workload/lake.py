"""Queries over sources, sinks, schema validation and the jobs that write.

Landings are written by Spark from the driver tables into a fresh folder of the session's shared work folder, then read
with the library's sources. Every row of the table is landed.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.contract import Contract, ContractError, compare_dictionary, contract_check, contract_summary, dictionary_summary, physical_columns
from tamiz.contract.dictionary import first_dictionary
from tamiz.functions.text import column
from tamiz.plans.config import load_rules
from tamiz.plans.ingest import Landed, ingest
from tamiz.plans.profiling import LedgerColumns, run_ledger_profile
from tamiz.plans.quality import ledger_quality, publish_quality
from tamiz.plans.run_silver import run_ledger_silver, run_survey_silver
from tamiz.plans.schema_validation import audit_validation, validate_contract, validate_dictionaries
from tamiz.session import scratch
from tamiz.sinks import tables as sinks
from tamiz.sinks.audit import run_metadata
from tamiz.sources import pages, parquet, text
from workload.profiles import ORACLES as PROFILE_ORACLES
from workload.quality import LEDGER_CONFIG
from workload.quality import ORACLES as QUALITY_ORACLES
from workload.silver import LEDGER, RUN_AT, SURVEY, SURVEY_ORDERS
from workload.tables import AS_OF, DUCK_LINES, DUCK_ORDERS, raw_lines, raw_orders, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

DAY = dt.date(2001, 5, 27)


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return register


# --- landings --------------------------------------------------------------------------------------------------------


def _land_lines(df: DataFrame, path: str, header: str, line: str) -> str:
    """Ready-made CSV lines, with their header in every file."""
    out = df.select(F.expr(line).alias(header))
    out.write.option("header", "true").option("sep", "\x01").option("quote", "").option("emptyValue", "").csv(path)
    return path


def _land_pages(df: DataFrame, path: str, page: str, flag: str = "success") -> str:
    """One page per line: records of one value of `page` (at most 500 rows), the flag and the declared total."""
    total = df.agg(F.count(F.lit(1)).alias("total"))
    told = total.select(F.struct(F.col("total").alias("include_total")).alias("result"), F.lit(True).alias(flag))
    record = F.struct(*[column(c) for c in df.columns if c != page])
    grouped = df.groupBy(page).agg(F.collect_list(record).alias("records")).withColumn(flag, F.lit(True))
    grouped.join(told, flag).drop(page).write.json(path)
    return path


def _land_files(df: DataFrame, path: str, files: int) -> None:
    """A table in a given number of files. Where every split holds rows, a file takes whole splits and nothing is shuffled."""
    splits = df.select(F.spark_partition_id().alias("split")).groupBy("split").agg(F.count(F.lit(1)))
    whole = files == 1 or files <= splits.count() == df.rdd.getNumPartitions()
    (df.coalesce(files) if whole else df.repartition(files)).write.parquet(path)


_RAGGED_HEADER = "o_orderkey,status,amount,level_name"
_RAGGED_LINE = (
    "concat_ws(',', o_orderkey, status, amount, if(level_name = 'PENDING', null, level_name), "
    "if(level_name = 'FINISHED', 'extra', null))"
)


def _ragged(spark, sf) -> text.Landing:
    """Lines of one level land with a field too few (padded), of another with one too many (quarantined)."""
    return text.read_csv(spark, _land_lines(raw_orders(spark, sf), scratch(spark, "csv"), _RAGGED_HEADER, _RAGGED_LINE))


@query(
    "csv_landing",
    f"""SELECT o_orderkey::VARCHAR AS o_orderkey, status, amount, CASE WHEN level_name = 'PENDING' THEN '' ELSE level_name END AS level_name
FROM ({DUCK_ORDERS}) v WHERE level_name <> 'FINISHED'""",
)
def _csv_landing(spark, sf):
    return _ragged(spark, sf).rows


@query("csv_quarantine", f"SELECT count(*) AS lines FROM ({DUCK_ORDERS}) v WHERE level_name = 'FINISHED'")
def _csv_quarantine(spark, sf):
    return _ragged(spark, sf).quarantine.agg(F.count(F.lit(1)).alias("lines"))


@query(
    "csv_mixed_headers",
    f"""SELECT o_orderkey::VARCHAR AS k, level_name AS level, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE sector END AS sector
FROM ({DUCK_ORDERS}) v""",
)
def _csv_mixed(spark, sf):
    """Files whose columns differ in order and number are matched by name."""
    path = scratch(spark, "mixed")
    orders = raw_orders(spark, sf).selectExpr("o_orderkey AS k", "level_name AS level", "sector")
    some = orders.where("k % 2 = 0").select("level", "k")
    some.write.option("header", "true").csv(f"{path}/some")
    orders.where("k % 2 = 1").write.option("header", "true").option("ignoreLeadingWhiteSpace", "false").option(
        "ignoreTrailingWhiteSpace", "false"
    ).csv(f"{path}/others")
    return text.read_csv(spark, f"{path}/some", f"{path}/others").rows


@query(
    "csv_path_with_blank",
    f"SELECT concat('año ', level_name) AS name, count(*) AS n FROM ({DUCK_ORDERS}) v GROUP BY 1",
)
def _csv_blank(spark, sf):
    """A Latin-1 landing below a folder whose name has a blank, a plus and a percent sign."""
    path = f"{scratch(spark, 'blank')}/two words+5%"
    named = raw_orders(spark, sf).select("o_orderkey", F.concat(F.lit("año "), "level_name").alias("name"))
    named.write.option("header", "true").option("encoding", "ISO-8859-1").csv(path)
    return text.read_csv(spark, path).rows.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "csv_latin1",
    f"SELECT concat('año ', level_name) AS name, count(*) AS n FROM ({DUCK_ORDERS}) v GROUP BY 1",
)
def _csv_latin(spark, sf):
    path = scratch(spark, "latin")
    named = raw_orders(spark, sf).select("o_orderkey", F.concat(F.lit("año "), "level_name").alias("name"))
    named.write.option("header", "true").option("encoding", "ISO-8859-1").csv(path)
    return text.read_csv(spark, path).rows.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query("csv_sniffed", f"SELECT trim(priority) AS priority, level_name, count(*) AS n FROM ({DUCK_ORDERS}) v GROUP BY 1, 2")
def _csv_sniffed(spark, sf):
    path = scratch(spark, "sniff")
    raw_orders(spark, sf).select("priority", "level_name").write.option("header", "true").option("sep", ";").csv(path)
    rows = text.read_csv_sniffed(spark, path).rows
    return rows.groupBy(F.trim("priority").alias("priority"), "level_name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "paged_json_events",
    """SELECT event_type, count(*) AS n, round(sum(value), 4) AS total, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS k
FROM events GROUP BY event_type""",
)
def _paged_events(spark, sf):
    events = table(spark, sf, "events").withColumn("page", F.floor(F.col("event_id") / 500))
    path = _land_pages(events, scratch(spark, "pages"), "page", "sucess")
    rows = pages.read_pages(spark, path, multi_line=False).records
    k = F.get_json_object("props", "$.k").cast("bigint")
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.col("value").cast("double")), 4).alias("total"),
        F.sum(k).alias("k"),
    )


@query(
    "pages_reconciled",
    """SELECT count(DISTINCT floor(event_id / 500)) AS pages_fetched, 0::BIGINT AS failed_pages, count(*) AS rows, count(*) AS declared_total,
true AS complete FROM events""",
)
def _reconciled(spark, sf):
    events = table(spark, sf, "events").withColumn("page", F.floor(F.col("event_id") / 500))
    path = _land_pages(events, scratch(spark, "pages"), "page")
    out = pages.reconcile_pages(pages.read_pages(spark, path, multi_line=False).pages)
    return out.select("pages_fetched", "failed_pages", "rows", "declared_total", "complete")


@query("pages_fallback", "SELECT event_type, count(*) AS n, 'csv_fallback' AS origin FROM events GROUP BY event_type")
def _fallback(spark, sf):
    events = table(spark, sf, "events")
    dump, empty = scratch(spark, "dump"), scratch(spark, "pages")
    events.select("event_id", "event_type", "value").write.option("header", "true").csv(dump)
    told = events.agg(F.count(F.lit(1)).alias("total"))
    told.select(
        F.lit(True).alias("success"),
        F.array().cast("array<struct<event_id:string>>").alias("records"),
        F.struct("total").alias("result"),
    ).write.json(empty)
    rows, origin = pages.read_pages_or_dump(spark, empty, dump, multi_line=False)
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.lit(origin).alias("origin"))


# --- Parquet histories -------------------------------------------------------------------------------------------------


def _history(spark: SparkSession, sf: str) -> str:
    """One folder per half of the calendar; the later one has a column more; a daily copy that must not count."""
    root = scratch(spark, "bronze")
    orders = raw_orders(spark, sf).withColumn("y", F.regexp_replace("order_year", r"\.0$", ""))
    early, late = orders.where("y < '1998'"), orders.where("y >= '1998'")
    early.select("o_orderkey", "y", "amount").write.parquet(f"{root}/early_mensual")
    late.select("amount", "y", "o_orderkey", "level").write.parquet(f"{root}/late_mensual")
    late.select("o_orderkey", "y").write.parquet(f"{root}/Late_DIARIO")
    return root


@query(
    "history_scan",
    f"""WITH v AS (SELECT *, regexp_replace(order_year, '\\.0$', '') AS y FROM ({DUCK_ORDERS}) r)
SELECT y, count(*) AS n, count(amount) AS amounts, count(CASE WHEN y >= '1998' THEN level END) AS levels FROM v GROUP BY y""",
)
def _history_scan(spark, sf):
    out = parquet.read_history(spark, _history(spark, sf))
    return out.groupBy("y").agg(
        F.count(F.lit(1)).alias("n"), F.count("amount").alias("amounts"), F.count("level").alias("levels")
    )


@query("history_excluded_columns", "SELECT 'amount,level,o_orderkey,y' AS columns, count(*) AS n FROM orders")
def _history_columns(spark, sf):
    """A daily copy with a column of its own adds neither rows nor columns."""
    root = _history(spark, sf)
    table(spark, sf, "orders").select("o_orderkey", F.lit(1).alias("only_daily")).write.parquet(f"{root}/extra_diario")
    out = parquet.read_history(spark, root)
    return out.agg(F.lit(",".join(sorted(out.columns))).alias("columns"), F.count(F.lit(1)).alias("n"))


@query(
    "one_file_per_dataset",
    "SELECT 'customer' AS dataset, count(*) AS rows FROM customer UNION ALL SELECT 'part', count(*) FROM part",
)
def _one_file(spark, sf):
    """Dated copies below one dataset, a copy in the folder itself below the other, a daily folder left out."""
    root = scratch(spark, "bronze")
    customer, part = table(spark, sf, "customer"), table(spark, sf, "part")
    customer.coalesce(1).write.parquet(f"{root}/customer/year=2001/month=05")
    customer.limit(3).coalesce(1).write.parquet(f"{root}/customer_diario")
    part.coalesce(1).write.parquet(f"{root}/part")
    part.limit(5).coalesce(1).write.mode("append").parquet(f"{root}/part/year=2001")
    picked = parquet.one_file_per_dataset(spark, root).collect()
    frames = [
        parquet.read_parquet(spark, r["path"]).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(r["dataset"]).alias("dataset"), "rows")
        for r in picked
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@query("latest_snapshot", "SELECT count(*) AS rows, count(DISTINCT c_nationkey) AS nations FROM customer")
def _latest(spark, sf):
    root = scratch(spark, "snap")
    table(spark, sf, "supplier").coalesce(1).write.parquet(f"{root}/a")
    table(spark, sf, "customer").coalesce(1).write.parquet(f"{root}/b")
    newest = parquet.read_parquet(spark, parquet.latest_file(spark, root))
    return newest.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("c_nationkey").alias("nations"))


@query(
    "file_inventory",
    "SELECT 4::BIGINT AS files, 0::BIGINT AS unreadable, (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem) AS rows, true AS sized",
)
def _inventory(spark, sf):
    root = scratch(spark, "files")
    # Four files, the larger table in more of them.
    _land_files(table(spark, sf, "orders"), f"{root}/orders", 1)
    _land_files(table(spark, sf, "lineitem"), f"{root}/lineitem", 3)
    totals = parquet.inventory_totals(parquet.file_inventory(spark, root))
    return totals.select("files", "unreadable", "rows", (F.col("bytes") > 0).alias("sized"))


@query(
    "file_inventory_columns",
    """SELECT 'lineitem' AS name, count(*) AS rows, 2 AS columns, true AS readable FROM lineitem
UNION ALL SELECT 'orders', count(*), 3, true FROM orders UNION ALL SELECT 'none', 0, 1, true""",
)
def _inventory_columns(spark, sf):
    """Rows and columns of each file below a folder with a blank in its name; one file is an empty table."""
    root = f"{scratch(spark, 'files')}/all files"
    frames = {
        "orders": table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"),
        "lineitem": table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"),
        "none": table(spark, sf, "customer").select("c_custkey").where("c_custkey < 0"),
    }
    for name, df in frames.items():
        df.coalesce(1).write.parquet(f"{root}/{name}")
    found = parquet.file_inventory(spark, root)
    return found.select(F.element_at(F.split("path", "/"), -2).alias("name"), "rows", "columns", "readable")


@query("catalog_tables", "SELECT (SELECT count(*) FROM customer) AS customers, (SELECT count(*) FROM part) AS parts, 'supplier' AS missing")
def _catalog(spark, sf):
    """Datasets by name, each opened once; one that is not there is an error."""
    root = scratch(spark, "catalog")
    for name in ("customer", "part"):
        table(spark, sf, name).write.parquet(f"{root}/{name}")
    catalog = parquet.Catalog(spark, root, ["customer", "part", "supplier"])
    try:
        missing = "none" if catalog["supplier"] is None else "found"
    except FileNotFoundError:
        missing = "supplier"
    n = F.count(F.lit(1))
    customers, parts = catalog["customer"].agg(n.alias("customers")), catalog["part"].agg(n.alias("parts"))
    return customers.crossJoin(parts).withColumn("missing", F.lit(missing))  # one row each


@query(
    "dictionary_semicolon",
    """SELECT 'parts' AS dataset, upper(p_brand) AS official_column, count(*) AS n FROM part GROUP BY p_brand""",
)
def _semicolon(spark, sf):
    """A `;` dictionary with known headers, whose entries repeat; joined back to what it describes."""
    path = scratch(spark, "book")
    part = table(spark, sf, "part")
    part.select(F.col("p_brand").alias("COLUMNA"), F.col("p_type").alias("TIPO")).write.option("header", "true").option("sep", ";").csv(path)
    book = text.read_catalogue(spark, path, "parts", "COLUMNA", ["TIPO"]).select("dataset", "official_column")
    used = part.select(F.upper("p_brand").alias("official_column"))
    return book.join(used, "official_column").groupBy("dataset", "official_column").agg(F.count(F.lit(1)).alias("n"))


@query("report_parquet", "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def _report_parquet(spark, sf):
    report = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return spark.read.parquet(sinks.write_parquet_report(report, scratch(spark, "report")))


# --- writers -----------------------------------------------------------------------------------------------------------


@query(
    "raw_append",
    "SELECT year, month, day, n FROM (SELECT 2001 AS year, 5 AS month, 27 AS day, count(*) AS n FROM orders "
    "UNION ALL SELECT 2001, 5, 28, 2 * count(*) FROM orders) x",
)
def _raw_append(spark, sf):
    root, orders = scratch(spark, "raw"), table(spark, sf, "orders")
    path = sinks.append_raw(orders, root, "shop", "orders", DAY)
    for _ in range(2):
        sinks.append_raw(orders, root, "shop", "orders", DAY + dt.timedelta(days=1))
    return spark.read.parquet(path).groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"))


@query("flat_overwrite", "SELECT count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders")
def _flat(spark, sf):
    root, orders = scratch(spark, "flat"), table(spark, sf, "orders")
    sinks.overwrite_flat(orders.limit(7), root, "shop", "orders")
    path = sinks.overwrite_flat(orders, root, "shop", "orders")
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("customers"))


@query(
    "partitioned_overwrite",
    "SELECT o_orderstatus, count(*) AS n, count(*) * 2 AS twice FROM orders GROUP BY 1",
)
def _partitioned(spark, sf):
    """The whole table twice (idempotent), then one partition again with other values."""
    path, orders = scratch(spark, "part"), table(spark, sf, "orders").withColumn("factor", F.lit(2))
    for _ in range(2):
        sinks.overwrite_partitions(orders, path, ["o_orderstatus"])
    again = orders.where("o_orderstatus = 'F'").withColumn("factor", F.lit(2))
    sinks.overwrite_partitions(again, path, ["o_orderstatus"], whole=False, regroup=True)
    stored = spark.read.parquet(path)
    return stored.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("factor").alias("twice"))


@query(
    "run_metadata",
    "SELECT 'orders' AS dataset, count(*) AS rows, 3::BIGINT AS pages_fetched FROM orders UNION ALL SELECT 'part', count(*), 1 FROM part",
)
def _metadata(spark, sf):
    root = scratch(spark, "meta")
    for name, n_pages in (("orders", 3), ("part", 1)):
        df = table(spark, sf, name)
        for rows in (df.limit(1).count(), df.count()):  # the later document counts
            doc = run_metadata(
                spark, source="shop", dataset=name, resource=name, rows=rows, columns=df.columns, pages=n_pages, at=RUN_AT
            )
            sinks.write_json(doc.coalesce(1), f"{root}/{name}")
    return pages.latest_metadata(spark, root)


@query(
    "report_csv",
    "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1",
)
def _report(spark, sf):
    report = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    path = sinks.write_csv_report(report, scratch(spark, "report"))
    back = text.read_csv(spark, path).rows
    return back.select("o_orderpriority", F.col("n").cast("bigint").alias("n"))


# --- schema validation ---------------------------------------------------------------------------------------------------

CONTRACT = Contract.from_config(
    {
        "expected_columns": ["o_orderkey", "customer", "status", "amount", "vanished"],
        "critical_columns": ["o_orderkey", "status"],
        "column_types": {"amount": {"logical_type": "decimal", "nullable": False, "source": "dictionary_csv"}},
        "extra_columns_policy": {"action": "warn"},
    }
)


@query(
    "contract_check",
    """WITH n AS (SELECT count(*) AS rows FROM orders),
e(columna, critical, kind) AS (VALUES ('O_ORDERKEY', true, ''), ('CUSTOMER', false, ''), ('STATUS', true, ''), ('AMOUNT', false, 'decimal'), ('VANISHED', false, '')),
p(columna, tipo) AS (VALUES ('O_ORDERKEY', 'bigint'), ('CUSTOMER', 'string'), ('STATUS', 'string'), ('AMOUNT', 'string'), ('OPENING', 'string'),
 ('ORDER_DATE', 'string'), ('ORDER_YEAR', 'string'), ('ORDER_MONTH', 'string'), ('LEVEL', 'string'), ('LEVEL_NAME', 'string'), ('SECTOR', 'string'), ('PRIORITY', 'string'))
SELECT coalesce(e.columna, p.columna) AS columna, coalesce(kind, '') AS tipo_logico_esperado, coalesce(critical, false) AS es_critica,
 p.columna IS NOT NULL AS presente_en_parquet, CASE WHEN e.columna IS NOT NULL AND p.columna IS NOT NULL THEN 'OK'
 WHEN p.columna IS NULL THEN 'FALTA_EN_PARQUET' ELSE 'EXTRA_EN_PARQUET_WARN' END AS estado, coalesce(tipo, '') AS tipo_parquet,
 (SELECT rows FROM n) AS total_filas FROM e FULL JOIN p ON e.columna = p.columna""",
)
def _contract(spark, sf):
    """Each line also carries the rows of the table it was checked for."""
    raw = raw_orders(spark, sf)
    detail, summary = validate_contract(raw, CONTRACT, source="shop", dataset="orders")
    counted = summary.select("dataset", "total_filas")
    tagged = detail.withColumn("dataset", F.lit("orders")).join(counted, "dataset")
    return tagged.select(
        "columna", "tipo_logico_esperado", "es_critica", "presente_en_parquet", "estado", "tipo_parquet", "total_filas"
    )


@query(
    "contract_summary",
    """SELECT 'shop' AS fuente, 'orders' AS dataset, 'REVISAR' AS estado_validacion, 5::BIGINT AS columnas_esperadas, 12::BIGINT AS columnas_en_parquet,
4::BIGINT AS columnas_ok, 1::BIGINT AS columnas_faltantes, 8::BIGINT AS columnas_extras, 0::BIGINT AS columnas_criticas_faltantes,
count(*) AS total_filas, 1 AS archivos_procesados, 'warn' AS politica_columnas_extra FROM orders""",
)
def _contract_summary(spark, sf):
    raw = raw_orders(spark, sf)
    return contract_summary(contract_check(raw, CONTRACT), "shop", "orders", raw, ["orders.parquet"], CONTRACT.extra_policy)


def _dictionary(spark: SparkSession, df: DataFrame) -> str:
    """A dictionary file of the table's own columns, one left out, one invented, one listed twice."""
    names = [c for c in df.columns if c != "sector"] + ["invented", "status"]
    rows = df.sparkSession.createDataFrame([(f" {n} ", "texto", f"col {n}") for n in names], "VARIABLE string, TIPO string, DESCRIPCION string")
    path = scratch(spark, "dictionary")
    rows.coalesce(1).write.option("header", "true").csv(path)
    return path


#: The inferred type of each column of the order view.
_TYPES_SQL = f"SELECT column_name, inferred_type FROM ({PROFILE_ORACLES['profile_columns_rich']}) r"


@query(
    "dictionary_compare",
    f"""WITH t AS ({_TYPES_SQL})
SELECT 'orders' AS dataset, CASE WHEN column_name <> 'sector' THEN upper(column_name) END AS official_column, upper(column_name) AS downloaded_column,
 CASE WHEN column_name = 'sector' THEN 'EXTRA_EN_PARQUET' ELSE 'OK' END AS comparison_status, inferred_type FROM t
UNION ALL SELECT 'orders', 'INVENTED', NULL, 'FALTA_EN_PARQUET', NULL""",
)
def _compare(spark, sf):
    """Every column of the table and every entry of its dictionary."""
    raw = raw_orders(spark, sf)
    book = text.read_dictionary(spark, _dictionary(spark, raw), "orders")
    out = compare_dictionary(book, physical_columns(raw, "orders"))
    return out.select("dataset", "official_column", "downloaded_column", "comparison_status", "inferred_type")


@query(
    "dictionary_from_fields",
    """SELECT 'orders' AS dataset, 'api_fields_fallback' AS dictionary_source, 3::BIGINT AS official_columns, 3::BIGINT AS downloaded_columns,
1::BIGINT AS missing_in_parquet, 1::BIGINT AS extra_in_parquet, count(*) AS local_rows_parquet, 'REVISAR' AS validation_status FROM orders""",
)
def _from_fields(spark, sf):
    """The dictionary file cannot be read, so the fields that the interface declares take its place."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    told = orders.limit(1).selectExpr(
        "true AS success",
        "named_struct('total', 1, 'fields', array(named_struct('id', '_id', 'type', 'int'), named_struct('id', 'o_orderkey', 'type', 'int'),"
        " named_struct('id', ' o_custkey ', 'type', 'int'), named_struct('id', 'o_clerk', 'type', 'text'))) AS result",
    )
    path, nowhere = scratch(spark, "fields"), scratch(spark, "nowhere")
    told.write.json(path)
    sources = [
        ("dictionary_csv", lambda: text.read_dictionary(spark, nowhere, "orders")),
        ("api_fields_fallback", lambda: pages.api_fields(spark, path, "orders")),
    ]
    _, summary = validate_dictionaries({"orders": orders}, {"orders": sources}, infer=False)
    return summary.select(
        "dataset", "dictionary_source", "official_columns", "downloaded_columns", "missing_in_parquet", "extra_in_parquet",
        "local_rows_parquet", "validation_status",
    )


@query(
    "critical_stop",
    """SELECT 'stopped' AS outcome, count(*) AS rows FROM orders UNION ALL SELECT 'FALLA_CRITICA', count(*) FROM orders
UNION ALL SELECT 'FALTA_EN_PARQUET', count(*) FROM orders""",
)
def _critical(spark, sf):
    """An absent critical column ends the job before any scan; without the stop it is the verdict."""
    raw = raw_orders(spark, sf)
    contract = Contract(expected=("O_ORDERKEY", "GONE"), critical=frozenset({"GONE"}), extra_policy="ignore")
    try:
        validate_contract(raw, contract, source="s", dataset="orders")
        outcome = "went on"
    except ContractError:
        outcome = "stopped"
    detail, summary = validate_contract(raw, contract, source="s", dataset="orders", stop_on_critical=False)
    rows = summary.select(F.col("estado_validacion").alias("outcome"), F.col("total_filas").alias("rows"))
    state = detail.where("columna = 'GONE'").select(F.col("estado").alias("outcome"))
    counted = raw.agg(F.count(F.lit(1)).alias("rows"))
    return rows.unionByName(counted.select(F.lit(outcome).alias("outcome"), "rows")).unionByName(state.join(counted))  # one row each


@query("validation_audit", "SELECT 'schema_validation' AS job, 'warning' AS status, 'bronze' AS layer, count(*) AS rows FROM orders")
def _validation_audit(spark, sf):
    raw, root = raw_orders(spark, sf), scratch(spark, "audit")
    _, summary = validate_contract(raw, CONTRACT, source="shop", dataset="orders")
    audit_validation(summary, source="shop", audit_root=root, started_at=RUN_AT)
    return spark.read.json(root).select("job", "status", "layer").join(summary.select(F.col("total_filas").alias("rows")))  # one row each


@query("head_sample", "SELECT 5::BIGINT AS rows, 6 AS columns, count(*) AS all_known FROM (SELECT * FROM part LIMIT 5) x")
def _head(spark, sf):
    """Five rows, whichever, with all columns, and all from the table."""
    part = table(spark, sf, "part")
    picked = parquet.head(part, 5)
    known = picked.join(part.select("p_partkey"), "p_partkey", "left_semi").agg(F.count(F.lit(1)).alias("all_known"))
    return picked.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(picked.columns)).alias("columns")).join(known)  # one row each


@query(
    "dictionary_summary",
    """SELECT 'orders' AS dataset, 'dictionary_csv' AS dictionary_source, 12::BIGINT AS official_columns, 12::BIGINT AS downloaded_columns,
1::BIGINT AS missing_in_parquet, 1::BIGINT AS extra_in_parquet, count(*) AS local_rows_parquet, count(*) AS local_rows_metadata_json,
true AS rows_match, 'REVISAR' AS validation_status FROM orders""",
)
def _dictionary_summary(spark, sf):
    raw = raw_orders(spark, sf)
    physical = physical_columns(raw, "orders", infer=False)
    missing = scratch(spark, "nowhere")
    path = _dictionary(spark, raw)
    chain = [
        ("broken", lambda: text.read_dictionary(spark, missing, "orders")),
        ("dictionary_csv", lambda: text.read_dictionary(spark, path, "orders")),
    ]
    official, source, errors = first_dictionary("orders", physical, chain)
    meta = run_metadata(spark, source="s", dataset="orders", resource="r", rows=raw.count(), columns=raw.columns, pages=1, at=RUN_AT)
    out = dictionary_summary(compare_dictionary(official, physical), raw, "orders", source, errors, meta)
    return out.select(
        "dataset",
        "dictionary_source",
        "official_columns",
        "downloaded_columns",
        "missing_in_parquet",
        "extra_in_parquet",
        "local_rows_parquet",
        "local_rows_metadata_json",
        "rows_match",
        "validation_status",
    )


@query(
    "dictionary_last_resort",
    """SELECT 'part' AS dataset, 'parquet_only_no_official_dictionary' AS dictionary_source, 6::BIGINT AS official_columns,
0::BIGINT AS missing_in_parquet, 0::BIGINT AS extra_in_parquet, count(*) AS local_rows_parquet, 'OK' AS validation_status FROM part""",
)
def _last_resort(spark, sf):
    _, summary = validate_dictionaries({"part": table(spark, sf, "part")}, {}, infer=False)
    return summary.select(
        "dataset",
        "dictionary_source",
        "official_columns",
        "missing_in_parquet",
        "extra_in_parquet",
        "local_rows_parquet",
        "validation_status",
    )


# --- jobs that write -------------------------------------------------------------------------------------------------------


@query(
    "ingestion_log",
    """SELECT 'orders' AS dataset, 'success' AS status, count(*) AS rows_extracted, 0::BIGINT AS pages FROM orders
UNION ALL SELECT 'events', 'success', count(*), count(DISTINCT floor(event_id / 500)) FROM events
UNION ALL SELECT 'lost', 'error', 0, 0""",
)
def _ingestion(spark, sf):
    csv, root = scratch(spark, "landing"), scratch(spark, "lake")
    raw_orders(spark, sf).select("o_orderkey", "status", "amount").write.option("header", "true").csv(csv)
    events = table(spark, sf, "events").withColumn("page", F.floor(F.col("event_id") / 500))
    json = _land_pages(events, scratch(spark, "pages"), "page")
    landings = {
        "orders": Landed("csv", csv),
        "lost": Landed("csv", scratch(spark, "nowhere")),
        "events": Landed("pages", json, page_per_line=True),
    }
    out = ingest(spark, "shop", landings, f"{root}/bronze", f"{root}/audit", RUN_AT)
    return out.select("dataset", "status", "rows_extracted", "pages")


@query(
    "silver_job",
    f"""WITH v AS (SELECT * FROM ({DUCK_LINES}) r WHERE line_status = 'F'), k AS (SELECT DISTINCT l_orderkey, l_linenumber FROM v)
SELECT 'lines' AS dataset, (SELECT count(*) FROM lineitem) AS bronze_rows, (SELECT count(*) FROM v) AS filtered_rows,
 (SELECT count(*) FROM k) AS silver_rows, (SELECT count(*) FROM v) - (SELECT count(*) FROM k) AS duplicates_removed,
 'WITH_CONVERSION_ERRORS' AS status""",
)
def _silver_job(spark, sf):
    root = scratch(spark, "silver")
    report = run_ledger_silver(
        raw_lines(spark, sf), LEDGER, RUN_AT, silver_path=f"{root}/lines", reports_root=f"{root}/reports", audit_root=f"{root}/audit"
    )
    return report.summary.select("dataset", "bronze_rows", "filtered_rows", "silver_rows", "duplicates_removed", "status")


@query(
    "silver_survey_job",
    "SELECT 'orders' AS dataset, count(*) AS bronze_rows, count(*) AS silver_rows, 'WITH_CONVERSION_ERRORS' AS status FROM orders",
)
def _silver_survey_job(spark, sf):
    root = scratch(spark, "silver")
    config = {**SURVEY, "datasets": {"orders": SURVEY_ORDERS}}
    report = run_survey_silver(
        {"orders": raw_orders(spark, sf)},
        config,
        RUN_AT,
        silver_root=f"{root}/silver",
        reports_root=f"{root}/reports",
        audit_root=f"{root}/audit",
    )
    return report.summary.select("dataset", "bronze_rows", "silver_rows", "status")


_LEDGER_SCORES = QUALITY_ORACLES["quality_ledger_file"]
#: Rules of the ledger file without failing rows to show.
_UNSAMPLED = "rule_id NOT LIKE '%.code_name' AND rule_id NOT LIKE '%column_comparison' AND rule_id NOT LIKE '%cardinality%' AND rule_id NOT LIKE '%coverage' AND rule_id NOT LIKE '%full_row%'"


def _published(spark, sf) -> dict[str, str]:
    """The whole quality job of the ledger file: detail, samples, reports and audit below one folder."""
    root = scratch(spark, "quality")
    detail = ledger_quality(raw_lines(spark, sf), {**LEDGER_CONFIG}, AS_OF, ("l_orderkey", "l_linenumber", "l_partkey"))
    run = publish_quality(
        detail,
        source="ledger",
        reports_root=f"{root}/reports",
        tables_root=f"{root}/tables",
        audit_root=f"{root}/audit",
        started_at=RUN_AT,
        finished_at=RUN_AT + dt.timedelta(seconds=5),
    )
    return {**run.outputs, "audit": f"{root}/audit"}


@query(
    "quality_job_audit",
    f"""WITH d AS ({_LEDGER_SCORES})
SELECT 'ledger' AS source, 'quality' AS job, 'warning' AS status, 5.0::DOUBLE AS duration_seconds, count(*)::DOUBLE AS rules,
  count(*) FILTER (WHERE failed_rows > 0)::DOUBLE AS observed, sum(failed_rows)::DOUBLE AS failed_rows,
  sum(CASE WHEN {_UNSAMPLED} THEN least(failed_rows, 10) ELSE 0 END)::DOUBLE AS samples FROM d""",
)
def _quality_job(spark, sf):
    counted = {"rules": "rules_evaluated", "observed": "rules_with_observations", "failed_rows": "observations_total", "samples": "failed_samples_total"}
    record = spark.read.json(_published(spark, sf)["audit"])
    return record.select("source", "job", "status", "duration_seconds", *[F.col(f"counters.{c}").alias(n) for n, c in counted.items()])


@query(
    "quality_job_samples",
    f"""SELECT rule_id, least(failed_rows, 10) AS samples, least(failed_rows, 10) AS last_rank, least(failed_rows, 10) AS in_csv
FROM ({_LEDGER_SCORES}) d WHERE failed_rows > 0 AND {_UNSAMPLED}""",
)
def _quality_samples(spark, sf):
    """The stored report of failed rows, as a table and as a CSV file."""
    paths = _published(spark, sf)
    stored = spark.read.parquet(paths["failed_samples_parquet"]).groupBy("rule_id")
    csv = text.read_csv(spark, paths["failed_samples_csv"]).rows.groupBy("rule_id").agg(F.count(F.lit(1)).alias("in_csv"))
    return stored.agg(F.count(F.lit(1)).alias("samples"), F.max("sample_rank").cast("bigint").alias("last_rank")).join(csv, "rule_id")


@query("quality_from_rule_file", _LEDGER_SCORES)
def _from_file(spark, sf):
    """The rules are read from a file on the driver."""
    with tempfile.TemporaryDirectory() as folder:
        path = os.path.join(folder, "rules.json")
        with open(path, "w", encoding="utf-8") as f:
            json.dump(LEDGER_CONFIG, f)
        config = load_rules(path, ("settings",))
    return ledger_quality(raw_lines(spark, sf), config, AS_OF).select(
        "rule_id", "evaluated_rows", "passed_rows", "failed_rows", "score", "status"
    )


@query(
    "profile_job",
    "SELECT 'montos' AS section, count(*) AS total_filas FROM lineitem UNION ALL SELECT 'nulos', count(*) FROM lineitem",
)
def _profile_job(spark, sf):
    """One section is given a column the table lacks, and fails without stopping the others."""
    root = scratch(spark, "profile")
    parts = LedgerColumns(
        amounts=("price", "quantity"),
        business_key=("l_orderkey", "l_linenumber"),
        categorical=("flag",),
        year="no_such_column",
    )
    tables, errors = run_ledger_profile(
        raw_lines(spark, sf), "lines", parts, reports_root=f"{root}/reports", audit_root=f"{root}/audit", started_at=RUN_AT
    )
    if set(errors) != {"temporal_evolucion"}:
        raise AssertionError(f"unexpected section errors: {errors}")
    rows = [
        tables[name].agg(F.max("total_filas").alias("total_filas")).select(F.lit(name).alias("section"), "total_filas")
        for name in ("montos", "nulos")
    ]
    return rows[0].unionByName(rows[1])
