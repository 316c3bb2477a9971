"""Rules of a survey-style rule file: global rules, rules per dataset, reference rules between datasets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from tamiz.rules.model import Rule

# The report texts of each rule type: (rule name, expected value, observation).
# {d} dataset, {c} column, {a}/{b} first and second column, {all} the column list, {p[...]} settings.
TEXTS = {
    "duplicate_full_rows": (
        "Filas completamente duplicadas",
        "sin duplicados completos",
        "Filas idénticas repetidas en el dataset.",
    ),
    "required_not_empty": (
        "Columna requerida no vacía: {c}",
        "no nulo/no vacío",
        "Registros vacíos o nulos en {c}.",
    ),
    "observed_empty": (
        "Columna con ausencia observada: {c}",
        "revisar ausencia",
        "Columna reportada por profiling como potencialmente vacía o incompleta.",
    ),
    "allowed_values": (
        "Valores permitidos en {c}",
        "{p[values]}",
        "Valores fuera del catálogo permitido {p[values]}. Los vacíos se evalúan en Completitud.",
    ),
    "numeric": (
        "Columna convertible a número: {c}",
        "numérico",
        "Valores no convertibles a número. Los vacíos se evalúan en Completitud.",
    ),
    "date_parseable": (
        "Fecha parseable: {c}",
        "fecha válida",
        "Valores no convertibles a fecha. Los vacíos se evalúan en Completitud.",
    ),
    "unique_key": ("Clave candidata única: {all}", "{all}", "Registros duplicados según clave candidata inferida."),
    "less_or_equal": (
        "Consistencia: {a} <= {b}",
        "{a}<={b}",
        "Registros donde {a} no es menor o igual que {b}.",
    ),
    "conditional_date": (
        "Fecha válida en {b} cuando {a} = {p[condition_value]}",
        "{b} fecha válida si {a}={p[condition_value]}",
        "Registros donde {a}={p[condition_value]} pero {b} no es fecha válida.",
    ),
    "year_not_future": (
        "Año no futuro: {c}",
        "<= {p[year]}",
        "Años posteriores al año de ejecución del pipeline.",
    ),
    "month_period_between": (
        "Periodo estadístico válido: {c}",
        "{p[min_value]}-{p[max_value]}; 13=periodo especial observado",
        "Valores fuera del rango de periodo estadístico permitido. Se acepta 13 como periodo especial observado.",
    ),
    "date_not_future": (
        "Fecha no futura: {c}",
        "<= {p[date]}",
        "Fechas posteriores a la ejecución del pipeline o no convertibles a fecha.",
    ),
    "temporal_catalog_exists": (
        "Año/periodo reconocido en catálogo temporal",
        "{p[reference_dataset]}.{p[reference_list]}",
        "Combinaciones {all} que no existen en {p[reference_dataset]}.{p[reference_columns]}.",
    ),
    "year_4_digits": (
        "Año con formato de 4 dígitos: {c}",
        "{p[min_year]}-{p[max_year]}",
        "Valores que no tienen 4 dígitos. La vigencia temporal se evalúa en Oportunidad.",
    ),
    "non_negative": (
        "Valor no negativo: {c}",
        ">=0",
        "Valores negativos o no numéricos en campo cuantitativo.",
    ),
    "regex": (
        "Formato esperado en {c}",
        "{p[pattern]}",
        "Valores que no cumplen el patrón {p[pattern]}. Los vacíos se evalúan en Completitud.",
    ),
    "referential_integrity": (
        "Integridad referencial {d}.{c} → {p[reference_dataset]}.{p[reference_list]}",
        "{p[reference_dataset]}.{p[reference_list]}",
        "Valores de {d}.{c} que no existen en {p[reference_dataset]}.{p[reference_list]}.",
    ),
}
# Dimension, severity and source where the file gives none.
DEFAULTS = {
    "duplicate_full_rows": ("Unicidad", "Media", "profiling_based"),
    "required_not_empty": ("Completitud", "Alta", "dictionary_csv"),
    "observed_empty": ("Completitud", "Baja", "profiling_based"),
    "allowed_values": ("Validez", "Media", "dictionary_csv"),
    "numeric": ("Validez", "Alta", "dictionary_csv"),
    "date_parseable": ("Validez", "Media", "dictionary_csv"),
    "unique_key": ("Unicidad", "Media", "inferred_business_key"),
    "less_or_equal": ("Consistencia", "Alta", "dictionary_csv"),
    "conditional_date": ("Consistencia", "Media", "embedded_dictionary"),
    "year_not_future": ("Oportunidad", "Media", "dictionary_csv"),
    "month_period_between": ("Oportunidad", "Media", "dictionary_csv_plus_profiling"),
    "date_not_future": ("Oportunidad", "Baja", "dictionary_csv"),
    "temporal_catalog_exists": ("Oportunidad", "Media", "internal_temporal_catalog"),
    "year_4_digits": ("Exactitud", "Alta", "naming_pattern"),
    "non_negative": ("Razonabilidad", "Alta", "naming_pattern"),
    "regex": ("Validez", "Media", "naming_pattern"),
    "referential_integrity": ("Integridad", "Media", "referential_rule"),
}


def _build(dataset: str, kind: str, columns: Sequence[str], suffix: str, meta: Mapping[str, Any], **params) -> Rule:
    name, expected, observed = TEXTS[kind]
    dimension, severity, source = DEFAULTS[kind]
    columns = tuple(columns)
    first = columns[0] if columns else "*"
    slots = {"d": dataset, "c": first, "a": first, "b": columns[-1] if columns else "", "all": list(columns), "p": params}
    return Rule(
        rule_type=kind,
        columns=columns,
        dimension=meta.get("dimension", dimension),
        severity=meta.get("severity", severity),
        source=meta.get("source", source),
        rule_id=f"{dataset}.{suffix}",
        rule_name=name.format(**slots),
        column_name=",".join(columns) or "*",
        expected_value=expected.format(**slots),
        observation=observed.format(**slots),
        absent_observation="La columna no existe en el Parquet Bronze." if len(columns) == 1 else "No existen columnas requeridas.",
        sample_columns=columns,
        params=params,
    )


def columns_by_name(columns: Sequence[str], pattern: Mapping[str, Any]) -> list[str]:
    """Columns that a naming pattern selects: by prefix, by part or by exact name, minus the skipped parts."""
    prefixes = tuple(pattern.get("startswith", ()))
    parts, exact, skipped = pattern.get("contains", ()), pattern.get("exact_columns", ()), pattern.get("skip_contains", ())
    return sorted(
        c
        for c in set(columns)
        if ((prefixes and c.startswith(prefixes)) or c in exact or any(p in c for p in parts))
        and not any(p in c for p in skipped)
    )


def _pattern_rules(dataset: str, columns: Sequence[str], patterns: Mapping[str, Mapping[str, Any]]) -> list[Rule]:
    rules = []
    for name, meta in patterns.items():
        if not meta.get("enabled", False):
            continue
        for c in columns_by_name(columns, meta):
            if name == "year_4_digits":
                span = {"min_year": int(meta.get("min_year", 1000)), "max_year": int(meta.get("max_year", 9999))}
                rules.append(_build(dataset, "year_4_digits", [c], f"{c}.year_4_digits", meta, **span))
            elif name == "date_parseable":
                rules.append(_build(dataset, "date_parseable", [c], f"{c}.date_parseable", meta))
            elif name in ("monetary_non_negative", "count_non_negative_integer"):
                integer = name.startswith("count")
                rules.append(_build(dataset, "non_negative", [c], f"{c}.non_negative", meta, integer=integer))
            elif "regex" in meta:
                rules.append(_build(dataset, "regex", [c], f"{c}.{name}", meta, pattern=meta["regex"], anchored=True))
            else:
                raise ValueError(f"unknown pattern rule {name!r}")
    return rules


def _timeliness(dataset: str, meta: Mapping[str, Any], as_of: dt.datetime) -> list[Rule]:
    kind, columns = meta.get("rule_type"), list(meta.get("columns", []))
    if kind == "year_not_future":
        return [_build(dataset, kind, [c], f"{c}.{kind}", meta, year=as_of.year) for c in columns]
    if kind == "month_period_between":
        span = {"min_value": int(meta.get("min_value", 1)), "max_value": int(meta.get("max_value", 13))}
        return [_build(dataset, kind, [c], f"{c}.{kind}", meta, **span) for c in columns]
    if kind == "date_not_future":
        return [_build(dataset, kind, [c], f"{c}.{kind}", meta, date=as_of.date().isoformat()) for c in columns]
    if kind == "temporal_catalog_exists":
        return [_reference(dataset, kind, columns, f"{'+'.join(columns)}.{kind}", meta, meta["reference_columns"])]
    raise ValueError(f"unknown timeliness rule {kind!r} for {dataset!r}")


def _reference(dataset, kind, columns, suffix, meta, parent_columns) -> Rule:
    return _build(
        dataset,
        kind,
        columns,
        suffix,
        meta,
        reference_dataset=meta["reference_dataset"],
        reference_columns=list(parent_columns),
        reference_list=",".join(parent_columns),
    )


def survey_rules(config: Mapping[str, Any], dataset: str, columns: Sequence[str], as_of: dt.datetime) -> list[Rule]:
    """All rules of one dataset, reference rules last. `columns` are the table's columns (naming patterns need them)."""
    own = (config.get("datasets") or {}).get(dataset) or {}
    shared = config.get("global_rules") or {}
    rules: list[Rule] = []

    duplicates = shared.get("duplicate_full_rows", {})
    if duplicates.get("enabled", True):
        rules.append(_build(dataset, "duplicate_full_rows", [], "full_row_duplicates", duplicates))

    lists = (
        ("required_columns", "required_not_empty", "required"),
        ("observed_empty_columns", "observed_empty", "observed_empty"),
        ("numeric_columns", "numeric", "numeric"),
        ("date_columns", "date_parseable", "date_parseable"),
    )
    listed = {}
    for section, kind, suffix in lists:
        meta = own.get(section) or {}
        listed[section] = [_build(dataset, kind, [c], f"{c}.{suffix}", meta) for c in meta.get("columns", [])]

    rules += listed["required_columns"] + listed["observed_empty_columns"]
    for c, meta in (own.get("allowed_values") or {}).items():
        values = [str(v) for v in meta.get("values", [])]
        rules.append(_build(dataset, "allowed_values", [c], f"{c}.allowed_values", meta, values=values))
    rules += listed["numeric_columns"] + listed["date_columns"]

    for meta in own.get("unique_keys", []):
        rules.append(_build(dataset, "unique_key", meta["columns"], f"unique_key.{'+'.join(meta['columns'])}", meta))
    for meta in own.get("consistency_rules", []):
        if meta.get("rule_type") != "less_or_equal":
            raise ValueError(f"unknown consistency rule {meta.get('rule_type')!r} for {dataset!r}")
        left, right = meta["left_column"], meta["right_column"]
        rules.append(_build(dataset, "less_or_equal", [left, right], f"{left}_le_{right}", meta))
    for meta in own.get("conditional_date_rules", []):
        pair = [meta["condition_column"], meta["date_column"]]
        value = str(meta["condition_value"])
        suffix = f"{pair[1]}.conditional_date"
        rules.append(_build(dataset, "conditional_date", pair, suffix, meta, condition_value=value))
    for meta in own.get("timeliness_rules", []):
        rules += _timeliness(dataset, meta, as_of)
    rules += _pattern_rules(dataset, columns, shared.get("pattern_rules") or {})

    for meta in config.get("referential_integrity") or []:
        if meta["dataset"] == dataset:
            c = meta["column"]
            rules.append(
                _reference(dataset, "referential_integrity", [c], f"{c}.ref_integrity", meta, [meta["reference_column"]])
            )
    return rules
