"""Physical columns against an official dictionary, with provenance."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.contract.contract import ABSENT, EXTRA, OK, PRESENT, REVIEW, schema_rows
from tamiz.functions.missing import INFERENCE_TOKENS
from tamiz.functions.text import header_text
from tamiz.profile.columns import INDICATORS, infer_types

# How the last resort of the dictionary chain is marked.
NO_DICTIONARY = "parquet_only_no_official_dictionary"

# (dataset, official_column, official_type, official_description, dictionary_source)
DICTIONARY_COLUMNS = ("dataset", "official_column", "official_type", "official_description", "dictionary_source")


def physical_columns(df: DataFrame, dataset: str, infer: bool = True, indicators: Sequence[str] = INDICATORS) -> DataFrame:
    """One row per physical column: name, type, and the logical type its values suggest."""
    schema = schema_rows(df, "column_name")
    if infer:
        schema = schema.join(infer_types(df, tokens=INFERENCE_TOKENS, indicators=indicators), "column_name", "left")
    else:
        schema = schema.withColumn("inferred_type", F.lit("")).withColumn("row_count", F.lit(None).cast("bigint"))
    return schema.select(
        F.lit(dataset).alias("dataset"),
        header_text(F.col("column_name")).alias("downloaded_column"),
        F.col("physical_type").alias("parquet_type"),
        F.coalesce("inferred_type", F.lit("empty_or_null")).alias("inferred_type"),
    )


def first_dictionary(
    dataset: str, physical: DataFrame, sources: Sequence[tuple[str, Callable[[], DataFrame | None]]]
) -> tuple[DataFrame, str, str]:
    """The first dictionary source that yields rows: (dictionary, source, errors of those before it).

    Sources are tried in order; one that fails is noted and passed over. The last resort is the table itself.
    """
    errors = []
    for name, read in sources:
        try:
            found = read()
            if found is not None and not found.isEmpty():
                return found, name, "; ".join(errors)
            errors.append(f"{name}: empty")
        except Exception as exc:  # a broken source must not hide the ones after it
            errors.append(f"{name}: {type(exc).__name__}: {str(exc).splitlines()[0] if str(exc) else ''}")
    own = physical.select(
        "dataset",
        F.col("downloaded_column").alias("official_column"),
        F.lit("").alias("official_type"),
        F.lit("").alias("official_description"),
        F.lit(NO_DICTIONARY).alias("dictionary_source"),
    )
    return own, NO_DICTIONARY, "; ".join(errors)


def compare_dictionary(dictionary: DataFrame, physical: DataFrame) -> DataFrame:
    """Full outer join of dictionary and physical columns with the state of each."""
    official = dictionary.select(*DICTIONARY_COLUMNS).withColumn("column_key", F.col("official_column"))
    actual = physical.withColumn("column_key", F.col("downloaded_column"))
    listed, stored = F.col("official_column").isNotNull(), F.col("downloaded_column").isNotNull()
    state = F.when(listed & stored, PRESENT).when(listed, ABSENT).otherwise(EXTRA)
    return official.join(actual, ["dataset", "column_key"], "full_outer").select(
        "dataset",
        "official_column",
        "official_type",
        "official_description",
        "dictionary_source",
        "downloaded_column",
        "parquet_type",
        "inferred_type",
        state.alias("comparison_status"),
    )


def dictionary_summary(
    comparison: DataFrame, df: DataFrame, dataset: str, source: str, errors: str = "", metadata: DataFrame | None = None
) -> DataFrame:
    """One row: column counts, row counts in the table and in the run metadata, verdict."""
    totals = comparison.agg(
        F.count_distinct("official_column").alias("official_columns"),
        F.count_distinct("downloaded_column").alias("downloaded_columns"),
        F.count_if(F.col("comparison_status") == ABSENT).alias("missing_in_parquet"),
        F.count_if(F.col("comparison_status") == EXTRA).alias("extra_in_parquet"),
    ).withColumn("dataset", F.lit(dataset))
    rows = df.agg(F.count(F.lit(1)).alias("local_rows_parquet")).withColumn("dataset", F.lit(dataset))
    merged = totals.join(rows, "dataset")
    if metadata is not None:
        told = metadata.select(
            "dataset",
            F.col("rows").cast("bigint").alias("local_rows_metadata_json"),
            F.col("pages_fetched").cast("bigint").alias("pages_fetched_metadata_json"),
        )
        merged = merged.join(told, "dataset", "left")
    else:
        merged = merged.withColumns(
            {c: F.lit(None).cast("bigint") for c in ("local_rows_metadata_json", "pages_fetched_metadata_json")}
        )
    clean = (F.col("missing_in_parquet") == 0) & (F.col("extra_in_parquet") == 0)
    return merged.select(
        "dataset",
        F.lit(source).alias("dictionary_source"),
        F.lit(errors).alias("dictionary_error"),
        "official_columns",
        "downloaded_columns",
        "missing_in_parquet",
        "extra_in_parquet",
        "local_rows_parquet",
        "local_rows_metadata_json",
        "pages_fetched_metadata_json",
        (F.col("local_rows_parquet") == F.col("local_rows_metadata_json")).alias("rows_match"),
        F.when(clean, OK).otherwise(REVIEW).alias("validation_status"),
    )
