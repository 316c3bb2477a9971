"""Bronze -> Silver: filter, clean, impute, cast, derive, sign with lineage, deduplicate, write, report.

The transformation is one lazy plan. Its figures come from one scan of the Bronze table and one of the written table, each
stored and read by all reports; they are not collected as a side effect of the write, because counters gathered in a
stage that is rerun after an executor loss may count twice.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.missing import SILVER_TOKENS
from tamiz.functions.text import column, name_text, quoted
from tamiz.operators import clean, dedup, derive
from tamiz.operators.wide import flag_counts, side_by_side, stack
from tamiz.session import literal_rows

_KEPT = "__kept"


# --- ledger flavour ------------------------------------------------------------------------------------------


def ledger_clean(df: DataFrame, config: Mapping[str, Any], truncate_codes: bool = False) -> DataFrame:
    rules = config.get("cleaning") or {}
    tokens = rules.get("null_tokens") or {}
    if tokens.get("convert_to_null", True):
        df = clean.tokens_to_null(df, tokens.get("tokens", SILVER_TOKENS))
    if (rules.get("global_trim") or {}).get("apply", True):
        df = clean.trim_text(df)
    widths = {r["column"]: (int(r["length"]), str(r.get("fill_char", "0"))) for r in rules.get("lpad_codes") or []}
    return clean.pad_codes(df, widths, truncate=truncate_codes)


def ledger_imputations(config: Mapping[str, Any]) -> dict[str, str]:
    """column -> constant, over all groups of the section, nested groups included."""
    found: dict[str, str] = {}

    def walk(node: Any) -> None:
        if not isinstance(node, Mapping):
            return
        if "columns" in node and "impute_value" in node:
            found.update(dict.fromkeys(node["columns"], node["impute_value"]))
        for child in node.values():
            walk(child)

    walk(config.get("imputations") or {})
    return found


def ledger_types(df: DataFrame, config: Mapping[str, Any]) -> dict[str, str]:
    declared = (config.get("output_schema") or {}).get("columns") or []
    return {c["name"]: c["type"] for c in declared if "type" in c and c.get("name") in df.columns}


def ledger_derived(df: DataFrame, config: Mapping[str, Any]) -> dict[str, Column]:
    """Derived columns by their declared sources; a column without a rule of its own uses its declared expression."""
    builders = {
        "ubigeo_ejecutora": lambda s: derive.geo_code(s),
        "nombre_municipalidad_normalizado": lambda s: name_text(column(s[0])),
        "sk_tiempo_mensual": lambda s: derive.month_key(df, s[0], s[1]),
        "anio_mes_key": lambda s: derive.month_label(s[0], s[1]),
        "ano_particion": lambda s: derive.partition_year(df, s[0]),
        "flag_tipo_transaccion": lambda s: derive.sign_flag(df, s[0]),
        "flag_monto_pia_activo": lambda s: derive.positive_flag(df, s[0]),
    }
    out: dict[str, Column] = {}
    for key, meta in (config.get("derived_columns") or {}).items():
        name, sources = meta.get("output_column", key), list(meta.get("source_columns", []))
        if any(s not in df.columns for s in sources):
            continue
        if name in builders:
            out[name] = builders[name](sources)
        elif "spark_expression" in meta:
            out[name] = F.expr(meta["spark_expression"])
        else:
            raise ValueError(f"derived column {name!r} has neither a rule nor an expression")
    return out


def ledger_prepared(df: DataFrame, config: Mapping[str, Any], truncate_codes: bool = False) -> DataFrame:
    """Cleaned and imputed, still text."""
    return clean.impute(ledger_clean(df, config, truncate_codes), ledger_imputations(config))


def ledger_silver(
    bronze: DataFrame,
    config: Mapping[str, Any],
    processed_at: dt.datetime,
    truncate_codes: bool = False,
    rare_duplicates: bool = False,
) -> DataFrame:
    """The whole ledger transformation as one plan; the deduplication is its only shuffle.

    `rare_duplicates` runs the two-step deduplication, which leaves unrepeated rows where they are.
    """
    master = (config.get("filtering") or {}).get("master_filter")
    df = clean.keep_where_equals(bronze, master["column"], master["value"]) if master else bronze
    df = ledger_prepared(df, config, truncate_codes)
    df = clean.cast_columns(df, {c: t for c, t in ledger_types(df, config).items() if t not in ("boolean", "timestamp")})
    df = df.withColumns(ledger_derived(df, config))
    declared = [c["name"] for c in (config.get("output_schema") or {}).get("columns") or [] if "name" in c]
    hashed = [c for c in (declared or bronze.columns) if c in bronze.columns]
    signed = derive.lineage(config["source_system"], config["source_dataset"], processed_at, loaded_at=True)
    df = df.withColumns({**signed, "record_hash": derive.positional_hash(df, hashed)})
    rules = config.get("deduplication") or {}
    keys = list(rules.get("key_columns") or [])
    if not rules.get("enabled", True) or not keys:
        return df
    order = [
        column(o["column"]).desc() if o.get("direction", "asc") == "desc" else column(o["column"]).asc()
        for o in rules.get("window_order") or []
        if o["column"] in df.columns
    ]
    keep = dedup.keep_first_of_few if rare_duplicates else dedup.keep_first
    return keep(df, keys, order, [column("record_hash")])


@dataclass(frozen=True)
class SilverReport:
    """Report tables of one Silver run; all small, all DataFrames."""

    summary: DataFrame
    detail: DataFrame
    dictionary: DataFrame


def ledger_metrics(bronze: DataFrame, config: Mapping[str, Any], truncate_codes: bool = False) -> DataFrame:
    """Per Bronze column: rows, rows kept by the filter, NULLs, cast errors among kept rows. One scan, stored."""
    master = (config.get("filtering") or {}).get("master_filter")
    kept = F.coalesce(column(master["column"]) == F.lit(master["value"]), F.lit(False)) if master else F.lit(True)
    flags = {f"__null_{i}": column(c).isNull() for i, c in enumerate(bronze.columns)}
    staged = ledger_prepared(bronze.withColumns({_KEPT: kept, **flags}), config, truncate_codes)
    types = ledger_types(bronze, config)
    position = {c: i for i, c in enumerate(bronze.columns)}

    def metrics(name: str) -> dict[str, str]:
        wrong = clean.conversion_error(staged, name, types[name]) if name in types else "false"
        return {"nulls_before": f"__null_{position[name]}", "conversion_errors": f"{_KEPT} AND {wrong}"}

    return flag_counts(staged, bronze.columns, metrics, {"filtered_rows": _KEPT})


def null_census(df: DataFrame) -> DataFrame:
    """NULLs of every column: (column_name, n_rows, nulls). One scan, stored."""
    return flag_counts(df, df.columns, lambda c: {"nulls": f"{quoted(c)} IS NULL"}, {})


# How a cast is named in the detail table, and how its result is judged.
_LEDGER_CASTS = {"integer": "cast_to_integer", "double": "cast_to_double", "string": "cast_to_string"}
_BUILT = {"boolean": "built_in_derived", "timestamp": "built_in_audit"}


def ledger_report(
    bronze: DataFrame, silver: DataFrame, config: Mapping[str, Any], files: int = 0, path: str = "", **options: Any
) -> SilverReport:
    """Reports from the Bronze table and the Silver table (pass the written one, read back)."""
    spark = bronze.sparkSession
    dataset = config["source_dataset"]
    types = ledger_types(bronze, config)
    census = null_census(silver).select("column_name", F.col("nulls").alias("nulls_after"), F.col("n_rows").alias("silver_rows"))
    found = ledger_metrics(bronze, config, **options)
    declared = [
        {
            "column_name": f.name,
            "bronze_type": f.dataType.simpleString(),
            "silver_type": types[f.name],
            "transformation": _LEDGER_CASTS.get(types[f.name], _BUILT.get(types[f.name], "unchanged")),
        }
        for f in bronze.schema
        if f.name in types
    ]
    described = literal_rows(
        spark, declared, "column_name string, bronze_type string, silver_type string, transformation string"
    )
    detail = (
        described.join(found, "column_name")
        .join(census, "column_name", "left")
        .select(
            F.lit(dataset).alias("dataset"),
            "column_name",
            "bronze_type",
            "silver_type",
            "transformation",
            "nulls_before",
            "nulls_after",
            "conversion_errors",
            F.when(F.col("conversion_errors") == 0, "OK").otherwise("CONVERSION_ERRORS").alias("status"),
            F.lit("").alias("reason"),
        )
    )
    derived = len(ledger_derived(bronze, config))
    before = found.agg(
        F.coalesce(F.max("n_rows"), F.lit(0)).cast("bigint").alias("bronze_rows"),
        F.coalesce(F.max("filtered_rows"), F.lit(0)).cast("bigint").alias("filtered_rows"),
        F.sum("nulls_before").alias("nulls_before"),
        F.sum("conversion_errors").alias("conversion_errors"),
    )
    after = census.agg(F.max("silver_rows").alias("silver_rows"), F.sum("nulls_after").alias("nulls_after"))
    casts = [d["transformation"] for d in declared if d["transformation"].startswith("cast_to")]
    summary = side_by_side([before, after]).select(
        F.lit(dataset).alias("dataset"),
        F.lit(files).alias("bronze_files"),
        "bronze_rows",
        "filtered_rows",
        (F.col("bronze_rows") - F.col("filtered_rows")).alias("rows_filtered_out"),
        "silver_rows",
        (F.col("filtered_rows") - F.col("silver_rows")).alias("duplicates_removed"),
        F.lit(len(bronze.columns)).alias("bronze_columns"),
        F.lit(len(silver.columns)).alias("silver_columns"),
        F.lit(len(casts)).alias("columns_converted"),
        F.lit(sum(c != "cast_to_string" for c in casts)).alias("numeric_columns_converted"),
        F.lit(len(derive.LINEAGE)).alias("technical_columns_added"),
        F.lit(derived).alias("derived_columns_added"),
        "conversion_errors",
        "nulls_before",
        "nulls_after",
        F.when(F.col("conversion_errors") == 0, "OK").otherwise("WITH_CONVERSION_ERRORS").alias("status"),
        F.lit("").alias("notes"),
        F.lit(path).alias("silver_path"),
    )
    return SilverReport(summary, detail, ledger_dictionary(silver, bronze.columns, config))


def ledger_dictionary(silver: DataFrame, bronze_columns: Sequence[str], config: Mapping[str, Any]) -> DataFrame:
    """One row per Silver column: type, origin, imputed value, note."""
    declared = {c["name"]: c for c in (config.get("output_schema") or {}).get("columns") or [] if "name" in c}
    imputed = ledger_imputations(config)

    def origin(name: str) -> str:
        if name in derive.LINEAGE:
            return "audit_column"
        return "bronze_original" if name in bronze_columns else "derived_column"

    rows = [
        {
            "dataset": config["source_dataset"],
            "column_name": f.name,
            "silver_type": f.dataType.simpleString(),
            "nullable": declared.get(f.name, {}).get("nullable", True),
            "origin": origin(f.name),
            "imputed_value": str(declared.get(f.name, {}).get("imputed_value", imputed.get(f.name, ""))),
            "note": declared.get(f.name, {}).get("note", ""),
        }
        for f in silver.schema
    ]
    return literal_rows(
        silver.sparkSession,
        rows,
        "dataset string, column_name string, silver_type string, nullable boolean, origin string, "
        "imputed_value string, note string",
    )


# --- survey flavour ------------------------------------------------------------------------------------------

# Declared section -> logical type -> name of the transformation.
_SURVEY_TYPES = {
    "integer_columns": ("long", "cast_to_integer_nullable"),
    "decimal_columns": ("double", "cast_to_decimal_nullable"),
    "datetime_columns": ("datetime", "cast_to_datetime_nullable"),
    "string_columns": ("string", "cast_to_string_nullable"),
}
REASON_SECTIONS = (
    "documented_null_columns",
    "preserve_as_string",
    "preserve_zero_values",
    "special_values",
    "special_values_to_null",
)
PERIOD_KEY = "anio_periodo_key"
NOT_KEPT = "No incluida en keep_columns."


def _names(section: Any) -> list[str]:
    """A section lists columns as a list or as a mapping to their reasons."""
    return list(section or [])


def survey_types(rules: Mapping[str, Any]) -> dict[str, tuple[str, str]]:
    return {c: t for section, t in _SURVEY_TYPES.items() for c in _names(rules.get(section))}


def _reason(section: Any, name: str) -> str:
    if not isinstance(section, Mapping) or name not in section:
        return ""
    entry = section[name]
    return str(entry.get("reason", "")) if isinstance(entry, Mapping) else str(entry)


def reasons(rules: Mapping[str, Any], name: str) -> str:
    """Documented reasons for a column, over all rule sections that may carry one."""
    found = ((s, _reason(rules.get(s), name)) for s in REASON_SECTIONS)
    return " | ".join(f"{s}: {why}" for s, why in found if why)


def _special_values(rules: Mapping[str, Any]) -> dict[str, list[Any]]:
    return {c: list((r or {}).get("values", [])) for c, r in (rules.get("special_values_to_null") or {}).items()}


def _survey_nulled(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    policy = defaults.get("null_handling") or {}
    if not policy.get("convert_missing_tokens_to_null", True):
        return df
    return clean.tokens_to_null(df, policy.get("missing_tokens", SILVER_TOKENS))


def dropped_columns(columns: Sequence[str], rules: Mapping[str, Any]) -> list[str]:
    """The table's columns that `drop_columns` names or that `keep_columns`, unless it is 'all', leaves out."""
    kept, named = rules.get("keep_columns") or "all", _names(rules.get("drop_columns"))
    if kept != "all" and isinstance(kept, str):
        raise ValueError(f"keep_columns is 'all' or a list, not {kept!r}")
    return [c for c in columns if c in named or (kept != "all" and c not in kept)]


def survey_imputations(rules: Mapping[str, Any], defaults: Mapping[str, Any]) -> dict[str, Any]:
    """column -> constant if the row policy asks to impute; the constants are declared as in a ledger file."""
    if not (defaults.get("row_policy") or {}).get("impute_missing_values", False):
        return {}
    constants = ledger_imputations(rules)
    if not constants:
        raise ValueError("impute_missing_values needs an imputations section with columns and impute_value")
    return constants


def _survey_staged(df: DataFrame, rules: Mapping[str, Any], defaults: Mapping[str, Any]) -> DataFrame:
    staged = clean.special_values_to_null(_survey_nulled(df, defaults), _special_values(rules))
    return clean.drop_columns(staged, dropped_columns(df.columns, rules))


def survey_silver(
    bronze: DataFrame, dataset: str, rules: Mapping[str, Any], config: Mapping[str, Any], processed_at: dt.datetime
) -> DataFrame:
    """One survey table: tokens and special values to NULL, drop, impute, cast, period key, lineage. No shuffle.

    Rows that hold nothing are dropped before constants are put in.
    """
    defaults = config.get("silver_defaults") or {}
    policy = defaults.get("row_policy") or {}
    df = _survey_staged(bronze, rules, defaults)
    if policy.get("drop_empty_rows", True):
        df = clean.drop_empty_rows(df)
    if policy.get("drop_duplicate_rows", False):
        df = dedup.drop_repeated_rows(df)
    df = clean.impute(df, survey_imputations(rules, defaults))
    df = clean.cast_columns(df, {c: t for c, (t, _) in survey_types(rules).items()})
    key = (rules.get("derived_columns") or {}).get(PERIOD_KEY) or {}
    if key.get("enabled", False):
        left, right = key.get("source_columns", ["ANO_APLICACION", "PERIODO"])[:2]
        df = df.withColumn(PERIOD_KEY, derive.period_key(df, left, right))
    if defaults.get("add_technical_columns", True):
        record = derive.named_hash(df)
        df = df.withColumns({**derive.lineage(config["source_system"], dataset, processed_at), "record_hash": record})
    return df


def survey_metrics(bronze: DataFrame, rules: Mapping[str, Any], defaults: Mapping[str, Any]) -> DataFrame:
    """Per Bronze column: raw NULLs, special values, NULLs before the cast, cast errors. One scan, stored."""
    raw = {f"__null_{i}": column(c).isNull() for i, c in enumerate(bronze.columns)}
    nulled = _survey_nulled(bronze.withColumns(raw), defaults)
    special = {c: v for c, v in _special_values(rules).items() if c in bronze.columns}
    hits = {f"__special_{bronze.columns.index(c)}": clean.special_value(nulled, c, v) for c, v in special.items()}
    staged = clean.special_values_to_null(nulled.withColumns(hits) if hits else nulled, special)
    dropped = set(dropped_columns(bronze.columns, rules))
    held = [column(c).isNotNull() for c in bronze.columns if c not in dropped]
    if (defaults.get("row_policy") or {}).get("drop_empty_rows", True) and held:
        keep = held[0]
        for h in held[1:]:
            keep = keep | h
    else:
        keep = F.lit(True)
    staged = staged.withColumn(_KEPT, keep)
    types = survey_types(rules)
    position = {c: i for i, c in enumerate(bronze.columns)}

    def metrics(name: str) -> dict[str, str]:
        wrong = clean.conversion_error(staged, name, types[name][0]) if name in types else "false"
        handled = f"__special_{position[name]}" if name in special else "false"
        return {
            "raw_nulls": f"__null_{position[name]}",
            "special_values_handled": handled,
            "nulls_before": f"{_KEPT} AND {quoted(name)} IS NULL",
            "conversion_errors": f"{_KEPT} AND {wrong}",
        }

    return flag_counts(staged, bronze.columns, metrics, {"kept_rows": _KEPT})


def survey_detail(
    bronze: DataFrame, silver: DataFrame, dataset: str, rules: Mapping[str, Any], found: DataFrame, defaults: Mapping[str, Any] | None = None
) -> DataFrame:
    """One row per column: kept, dropped, or configured but absent. `defaults` tell whether NULLs are imputed."""
    types, dropped = survey_types(rules), set(dropped_columns(bronze.columns, rules))
    filled, named = survey_imputations(rules, defaults or {}), _names(rules.get("drop_columns"))
    silver_types = {f.name: f.dataType.simpleString() for f in silver.schema}
    known = []
    for f in bronze.schema:
        gone = f.name in dropped
        why = _reason(rules.get("drop_columns"), f.name) if gone else reasons(rules, f.name)
        if gone and f.name not in named:
            why = NOT_KEPT
        how = "drop_column" if gone else types.get(f.name, ("", "kept_without_explicit_rule"))[1]
        known.append(
            {
                "column_name": f.name,
                "bronze_type": f.dataType.simpleString(),
                "silver_type": "dropped" if gone else silver_types.get(f.name, ""),
                "transformation": how,
                "reason": why,
            }
        )
    ddl = "column_name string, bronze_type string, silver_type string, transformation string, reason string"
    was_dropped = F.col("transformation") == "drop_column"
    imputed = F.col("column_name").isin(list(filled))
    errors = F.when(was_dropped, F.lit(0)).otherwise(F.col("conversion_errors"))
    kept = literal_rows(bronze.sparkSession, known, ddl).join(found, "column_name").select(
        F.lit(dataset).alias("dataset"),
        "column_name",
        "bronze_type",
        "silver_type",
        "transformation",
        F.when(was_dropped, F.col("raw_nulls")).otherwise(F.col("nulls_before")).alias("nulls_before"),
        F.when(~was_dropped, F.when(imputed, 0).otherwise(F.col("nulls_before")) + F.col("conversion_errors")).alias("nulls_after"),
        errors.cast("bigint").alias("conversion_errors"),
        F.when(was_dropped, F.lit(0)).otherwise(F.col("special_values_handled")).cast("bigint").alias("special_values_handled"),
        F.when(was_dropped, "DROPPED").when(errors == 0, "OK").otherwise("CONVERSION_ERRORS").alias("status"),
        "reason",
    )
    absent = [
        {
            "dataset": dataset,
            "column_name": c,
            "bronze_type": "missing",
            "silver_type": "missing",
            "transformation": "configured_column_not_found",
            "conversion_errors": 0,
            "special_values_handled": 0,
            "status": "WARNING",
            "reason": "Columna declarada en YAML, pero no existe en el Parquet Bronze.",
        }
        for c in clean.absent_columns(bronze, types)
    ]
    if not absent:
        return kept
    ddl = (
        "dataset string, column_name string, bronze_type string, silver_type string, transformation string, "
        "conversion_errors bigint, special_values_handled bigint, status string, reason string"
    )
    return stack([kept, literal_rows(bronze.sparkSession, absent, ddl)])


def survey_report(
    bronze: DataFrame, silver: DataFrame, dataset: str, rules: Mapping[str, Any], config: Mapping[str, Any], path: str = ""
) -> SilverReport:
    """Reports of one survey table; `silver` is the written table, read back."""
    defaults = config.get("silver_defaults") or {}
    found = survey_metrics(bronze, rules, defaults)
    detail = survey_detail(bronze, silver, dataset, rules, found, defaults)
    census = null_census(silver)
    dropped = dropped_columns(bronze.columns, rules)
    absent = clean.absent_columns(bronze, survey_types(rules))
    notes = [f"Columna configurada no encontrada en Bronze: {c}" for c in absent]
    before = found.agg(F.max("n_rows").alias("bronze_rows"), F.sum("raw_nulls").alias("nulls_before"))
    totals = detail.agg(
        F.count_if(F.col("transformation").startswith("cast_to")).alias("columns_converted"),
        F.count_if(F.col("transformation") == "cast_to_datetime_nullable").alias("date_columns_converted"),
        F.count_if(F.col("transformation").isin("cast_to_integer_nullable", "cast_to_decimal_nullable")).alias(
            "numeric_columns_converted"
        ),
        F.sum("conversion_errors").alias("conversion_errors"),
    )
    after = census.agg(F.max("n_rows").alias("silver_rows"), F.sum("nulls").alias("nulls_after"))
    technical = len([c for c in silver.columns if c in derive.LINEAGE or c == PERIOD_KEY])
    emptied = F.col("bronze_rows") - F.col("silver_rows")
    empty_note = F.when(emptied > 0, F.concat(F.lit("Filas completamente vacías eliminadas: "), emptied.cast("string")))
    summary = side_by_side([before, totals, after]).select(
        F.lit(dataset).alias("dataset"),
        "bronze_rows",
        "silver_rows",
        F.lit(len(bronze.columns)).alias("bronze_columns"),
        F.lit(len(silver.columns)).alias("silver_columns"),
        "columns_converted",
        "date_columns_converted",
        "numeric_columns_converted",
        F.lit(technical).alias("technical_columns_added"),
        F.lit(len(dropped)).alias("columns_dropped"),
        F.lit(", ".join(dropped)).alias("dropped_columns"),
        "conversion_errors",
        "nulls_before",
        "nulls_after",
        F.when(F.col("conversion_errors") == 0, "OK").otherwise("WITH_CONVERSION_ERRORS").alias("status"),
        F.concat_ws(" | ", empty_note, *[F.lit(n) for n in notes]).alias("notes"),
        F.lit(path).alias("silver_path"),
    )
    return SilverReport(summary, detail, survey_dictionary(detail, silver, dataset, defaults))


def survey_dictionary(detail: DataFrame, silver: DataFrame, dataset: str, defaults: Mapping[str, Any]) -> DataFrame:
    """Detail rows as dictionary entries, then the technical columns the table really has."""
    dropped = F.col("status") == "DROPPED"
    entries = detail.select(
        "dataset",
        "column_name",
        F.col("column_name").alias("business_name"),
        F.col("reason").alias("description"),
        "bronze_type",
        "silver_type",
        F.col("transformation").alias("transformation_applied"),
        F.when(~dropped, F.coalesce(F.col("nulls_after") > 0, F.lit(False))).alias("nullable"),
        F.lit(False).alias("is_technical_column"),
        F.col("reason").alias("notes"),
    )
    described = defaults.get("technical_columns") or {}
    added = [c for c in silver.columns if c in derive.LINEAGE or c == PERIOD_KEY]
    rows = []
    for c in added:
        text = (described.get(c) or {}).get("description", "Columna técnica de trazabilidad Silver.")
        rows.append(
            {
                "dataset": dataset,
                "column_name": c,
                "business_name": c,
                "description": text,
                "bronze_type": "not_in_bronze",
                "silver_type": "technical",
                "transformation_applied": "added_technical_column",
                "nullable": c == PERIOD_KEY,
                "is_technical_column": True,
                "notes": text,
            }
        )
    ddl = (
        "dataset string, column_name string, business_name string, description string, bronze_type string, "
        "silver_type string, transformation_applied string, nullable boolean, is_technical_column boolean, notes string"
    )
    return stack([entries, literal_rows(detail.sparkSession, rows, ddl)]) if rows else entries
