"""Landed pages of a paged JSON interface, and run metadata documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.text import column, header_text
from tamiz.sources.text import read_csv

# Spellings of the success flag and of the declared total, rows per page.
SUCCESS_FIELDS = ("success", "sucess")
TOTAL_FIELDS = ("include_total", "total")
PAGE_SIZE = 500


@dataclass(frozen=True)
class Pages:
    records: DataFrame
    pages: DataFrame


def _field(schema: T.StructType, name: str) -> T.StructField | None:
    return next((f for f in schema if f.name == name), None)


def _succeeded(schema: T.StructType) -> Column:
    flags = [F.lower(column(f).cast("string")) == "true" for f in SUCCESS_FIELDS if f in schema.names]
    if not flags:
        return F.lit(True)
    return F.coalesce(*flags, F.lit(False)) if len(flags) > 1 else F.coalesce(flags[0], F.lit(False))


def _declared(schema: T.StructType) -> Column:
    result = _field(schema, "result")
    if result is None or not isinstance(result.dataType, T.StructType):
        return F.lit(None).cast("bigint")
    totals = [F.col(f"result.{t}").cast("string").try_cast("bigint") for t in TOTAL_FIELDS if t in result.dataType.names]
    return F.coalesce(*totals) if totals else F.lit(None).cast("bigint")


def read_pages(spark: SparkSession, path: str, multi_line: bool = True) -> Pages:
    """Records of all successful pages, unified by name, values as text; and one row per page for reconciliation.

    A file is one page, small and parsed whole; with `multi_line` off it holds one page per line and is split.
    """
    options = {"multiLine": str(multi_line).lower(), "primitivesAsString": "true", "recursiveFileLookup": "true"}
    raw = spark.read.options(**options).json(path)
    schema = raw.schema
    records = _field(schema, "records")
    listed = records is not None and isinstance(records.dataType, T.ArrayType)
    typed = listed and isinstance(records.dataType.elementType, T.StructType)
    size = F.greatest(F.size("records"), F.lit(0)) if listed else F.lit(0)
    pages = raw.select(
        F.col("_metadata.file_path").alias("path"),
        _succeeded(schema).alias("ok"),
        size.cast("bigint").alias("records"),
        _declared(schema).alias("declared_total"),
    )
    if typed:
        rows = raw.where(_succeeded(schema)).select(F.explode("records").alias("r")).select("r.*")
    else:
        rows = raw.where(F.lit(False)).select()
    return Pages(rows, pages)


def reconcile_pages(pages: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """One row: pages, failed pages, rows fetched against the declared total, and whether the run is whole."""
    fetched = F.coalesce(F.sum(F.when(F.col("ok"), F.col("records"))), F.lit(0)).cast("bigint")
    totals = pages.agg(
        F.count(F.lit(1)).alias("pages_fetched"),
        F.count_if(~F.col("ok")).alias("failed_pages"),
        fetched.alias("rows"),
        F.max("declared_total").alias("declared_total"),
        F.count_if(F.col("ok") & (F.col("records") < page_size)).alias("short_pages"),
    )
    whole = F.when(F.col("declared_total").isNotNull(), F.col("rows") >= F.col("declared_total")).otherwise(
        F.col("short_pages") > 0
    )
    return totals.withColumn("complete", whole & (F.col("failed_pages") == 0))


def read_pages_or_dump(
    spark: SparkSession, pages_path: str, dump_path: str, sep: str = ",", multi_line: bool = True
) -> tuple[DataFrame, str]:
    """The pages' records; the CSV dump instead when pages came empty although they declare rows."""
    landed = read_pages(spark, pages_path, multi_line)
    told = landed.pages.agg(F.sum("records").alias("n"), F.max("declared_total").alias("t")).first()
    if (told["n"] or 0) == 0 and (told["t"] or 0) > 0:
        return read_csv(spark, dump_path, sep=sep).rows, "csv_fallback"
    return landed.records, "api_pages"


def api_fields(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Column names and types that the interface declares, as a dictionary of last resort but one."""
    raw = spark.read.options(multiLine="true", primitivesAsString="true", recursiveFileLookup="true").json(path)
    fields = raw.select(F.explode("result.fields").alias("f")).select("f.*")
    name = F.coalesce(*[column(c) for c in ("id", "name") if c in fields.columns])
    kind = column("type") if "type" in fields.columns else F.lit("")
    return (
        fields.select(
            F.lit(dataset).alias("dataset"),
            name.alias("raw"),
            header_text(name).alias("official_column"),
            F.coalesce(kind, F.lit("")).alias("official_type"),
            F.lit("").alias("official_description"),
            F.lit("api_fields_fallback").alias("dictionary_source"),
        )
        .where(F.col("raw").isNotNull() & (F.col("raw") != "") & ~F.col("raw").startswith("_"))
        .drop("raw")
        .dropDuplicates(["dataset", "official_column"])
    )


def latest_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The newest run document of each dataset: (dataset, rows, pages_fetched)."""
    docs = spark.read.options(recursiveFileLookup="true", primitivesAsString="true", pathGlobFilter="*.json").json(path)
    stamped = docs.select(
        "dataset",
        F.col("rows").try_cast("bigint").alias("rows") if "rows" in docs.columns else F.lit(None).cast("bigint").alias("rows"),
        F.col("pages_fetched").try_cast("bigint").alias("pages_fetched")
        if "pages_fetched" in docs.columns
        else F.lit(None).cast("bigint").alias("pages_fetched"),
        F.struct("_metadata.file_modification_time", "_metadata.file_path").alias("at"),
    )
    newest = stamped.groupBy("dataset").agg(F.max_by(F.struct("rows", "pages_fetched"), "at").alias("m"))
    return newest.select("dataset", "m.rows", "m.pages_fetched")
