"""Rules of a ledger-style rule file: sections per dimension, each rule with its rule_type.

Every rule in a section is read by its own rule_type, whatever the section; a type that is not known raises.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from tamiz.rules.model import Rule

SECTIONS = (
    "completitud",
    "validez",
    "exactitud",
    "consistencia",
    "unicidad",
    "integridad",
    "oportunidad",
    "conformidad",
)

# The report texts of each rule type:
# (id suffix, rule name, expected value, observation). {c} column, {a}/{b} first and second column, {p[...]} settings;
# {{0}} and {{1}} are filled by the evaluator.
TEXTS = {
    "not_null": ("{c}.not_null", "No nulo: {c}", "no nulo", "Registros nulos o vacíos en {c}."),
    "null_threshold": (
        "{c}.null_threshold",
        "Nulos bajo umbral ({p[threshold_pct]}%): {c}",
        "< {p[threshold_pct]}% nulos",
        "Nulos en {c}: {{0}}% (umbral: {p[threshold_pct]}%). {{1}}",
    ),
    "conditional_null_allowed": (
        "{c}.conditional_null",
        "Vacío estructural válido: {a} (solo cuando {b}={p[condition_value]})",
        "vacío solo cuando {b}={p[condition_value]}",
        "{a} vacío cuando {b} ≠ {p[condition_value]}: {{0}} casos. "
        "Cuando {b}={p[condition_value]} el vacío es esperado.",
    ),
    "null_only_when": (
        "{c}.null_only_when",
        "Nulo solo cuando {b}={p[condition_value]}: {a}",
        "nulo solo cuando {b}={p[condition_value]}",
        "{a} vacío cuando {b} ≠ {p[condition_value]}: {{0}} casos inesperados.",
    ),
    "accepted_values": (
        "{c}.accepted_values",
        "Catálogo válido: {c}",
        "{p[values]}",
        "Valores fuera del catálogo {p[values]} en {c}.",
    ),
    "numeric_type": ("{c}.numeric", "Tipo numérico: {c}", "numérico", "Valores no convertibles a número en {c}."),
    "accepted_range": (
        "{c}.range",
        "Rango numérico: {c}",
        "[{p[min_value]}, {p[max_value]}]",
        "Valores fuera del rango [{p[min_value]}, {p[max_value]}] en {c}.",
    ),
    "regex": (
        "{c}.regex",
        "Formato regex: {c}",
        "{p[pattern]}",
        "Valores que no cumplen el patrón {p[pattern]} en {c}.",
    ),
    "conditional_value": (
        "{key}.conditional_value",
        "{a}={p[condition_value]} → {b}={p[expected_value]}",
        "{p[expected_value]}",
        "Inconsistencias entre {a} y {b}.",
    ),
    "code_name_consistency": (
        "{a}_{b}.code_name",
        "Consistencia código-nombre: {a} → {b}",
        "1 nombre por código",
        "{{0}} código(s) de {a} con múltiples nombres en {b}. "
        "Puede indicar renombramientos institucionales sin homologar.",
    ),
    "column_comparison": (
        "{key}.column_comparison",
        "Comparación: {a} {p[operator]} {b}",
        "{a} {p[operator]} {b}",
        "Registros donde {a} no cumple {p[operator]} {b}. {p[filter_note]}",
    ),
    "duplicate_full_rows": (
        "full_row_duplicates",
        "Filas completamente duplicadas",
        "0 duplicados exactos",
        "{{0}} filas exactamente duplicadas detectadas.",
    ),
    "unique_key": (
        "unique_key.{n}cols",
        "Clave de negocio única ({n} columnas clasificador completo)",
        "sin duplicados por clave",
        "{{0}} filas duplicadas según clave de {n} columnas. "
        "Puede indicar solapamiento entre archivos anuales al consolidar el histórico.",
    ),
    "parent_not_zero_if_child_nonzero": (
        "{a}_{b}.hierarchy",
        "Jerarquía clasificador: {a} padre de {b}",
        "{a} ≠ 0 cuando {b} ≠ 0",
        "Filas donde {b} ≠ 0 pero {a} = 0 (rompería la jerarquía).",
    ),
    "cardinality_check": (
        "{c}.cardinality",
        "Cardinalidad catálogo: {c}",
        "{p[limit]}",
        "Cardinalidad observada: {{0}} | esperada: {p[limit]}. {{1}}",
    ),
    "cardinality_upper_bound": (
        "{c}.cardinality_upper",
        "Cardinalidad máxima: {c}",
        "<= {p[limit]}",
        "Cardinalidad actual: {{0}} | límite: {p[limit]}. {{1}}",
    ),
    "year_not_future": (
        "{c}.year_not_future",
        "Año no futuro: {c}",
        "<= {p[year]}",
        "Años posteriores al año de ejecución ({p[year]}).",
    ),
    "temporal_coverage_check": (
        "temporal_coverage",
        "Cobertura temporal: {p[expected_months]} meses por año",
        "{p[expected_months]} meses/año",
        "Años con cobertura incompleta (< {p[expected_months]} meses): {{0}}. "
        "Excepciones permitidas: {p[exception_years]}.",
    ),
}
VERDICTS = {
    "cardinality_check": ("Supera el catálogo del profiling — revisar versión.", "Dentro del rango esperado."),
    "cardinality_upper_bound": ("Supera el máximo — posible versión nueva del catálogo.", "OK."),
}
# Rule types whose result always carries one dimension, whatever the section declares.
DIMENSIONS = {"regex": "Conformidad"}
# Rule types that report no failing rows.
UNSAMPLED = ("code_name_consistency", "column_comparison", *VERDICTS)


class _Quiet(dict):
    def __missing__(self, key):
        return ""


def _build(prefix: str, key: str, rule_type: str, columns, meta: Mapping[str, Any], params: dict[str, Any]) -> Rule:
    if rule_type not in TEXTS:
        raise ValueError(f"unknown rule type {rule_type!r} in rule {key!r}")
    columns = tuple(columns)
    suffix, name, expected, observed = TEXTS[rule_type]
    first = columns[0] if columns else "*"
    slots = {
        "c": first,
        "a": first,
        "b": columns[1] if len(columns) > 1 else "",
        "n": len(columns),
        "key": key,
        "p": _Quiet(params),
    }
    two_named = rule_type in (
        "conditional_value",
        "code_name_consistency",
        "column_comparison",
        "parent_not_zero_if_child_nonzero",
        "unique_key",
        "temporal_coverage_check",
    )
    return Rule(
        rule_type=rule_type,
        columns=columns,
        dimension=DIMENSIONS.get(rule_type, meta.get("dimension", "")),
        severity=meta.get("severity", "Media"),
        source=meta.get("source", ""),
        rule_id=f"{prefix}.{suffix.format(**slots)}",
        rule_name=name.format(**slots),
        column_name=",".join(columns) if two_named else first,
        expected_value=expected.format(**slots),
        observation=observed.format(**slots).rstrip(),
        absent_observation=f"Columna {first} no existe." if len(columns) == 1 else "Columnas requeridas no existen.",
        sample_columns=() if rule_type in UNSAMPLED else columns,
        params=params,
    )


def _columns_of(rule: Mapping[str, Any]) -> list[str]:
    if "columns" in rule:
        return list(rule["columns"])
    return [rule["column"]] if rule.get("column") else []


def _expand(prefix: str, key: str, meta: Mapping[str, Any], as_of_year: int, period: tuple[str, str], level: str):
    """All rules of one YAML entry."""
    kind = meta.get("rule_type", "")

    def make(columns, **params):
        return _build(prefix, key, kind, columns, meta, params)

    if kind == "not_null" or kind == "numeric_type":
        return [make([c], strip=False) for c in _columns_of(meta)]
    if kind == "null_threshold":
        return [make([c], threshold_pct=meta["threshold_pct"]) for c in _columns_of(meta)]
    if kind == "conditional_null_allowed":
        when = meta["null_allowed_when"]
        return [make([c, when["column"]], condition_value=when["value"]) for c in _columns_of(meta)]
    if kind == "null_only_when":
        value = meta["null_only_when_value"]
        return [make([c, meta["null_only_when_column"]], condition_value=value) for c in _columns_of(meta)]
    if kind == "accepted_values":
        return [make([c], values=[str(v) for v in meta["accepted"]], strip=False) for c in _columns_of(meta)]
    if kind == "accepted_range":
        return [make([c], min_value=meta.get("min_value"), max_value=meta.get("max_value")) for c in _columns_of(meta)]
    if kind == "regex":
        skip = (level, meta["null_when_nivel_gobierno"]) if "null_when_nivel_gobierno" in meta else meta.get("skip_when")
        return [make([c], pattern=meta["pattern"], strip=False, skip_when=skip) for c in _columns_of(meta)]
    if kind == "conditional_value":
        pair = [meta["condition_column"], meta["expected_column"]]
        return [make(pair, condition_value=meta["condition_value"], expected_value=meta["expected_value"])]
    if kind == "code_name_consistency":
        return [make([p["code"], p["name"]]) for p in meta.get("pairs", [])]
    if kind == "column_comparison":
        where = meta.get("filter_condition")
        note = f"Filtro aplicado: {where}." if where else ""
        pair = [meta["left_column"], meta["right_column"]]
        return [make(pair, operator=meta["operator"], filter_condition=where, filter_note=note)]
    if kind == "duplicate_full_rows":
        return [make([])]
    if kind == "unique_key":
        return [make(meta["columns"])]
    if kind == "parent_not_zero_if_child_nonzero":
        return [make([meta["parent_column"], meta["child_column"]])]
    if kind == "cardinality_check":
        return [make([c], limit=int(n), verdicts=VERDICTS[kind]) for c, n in meta["expected_cardinality"].items()]
    if kind == "cardinality_upper_bound":
        return [make([c], limit=int(meta["max_cardinality"]), verdicts=VERDICTS[kind]) for c in _columns_of(meta)]
    if kind == "year_not_future":
        return [make([c], year=as_of_year, non_numeric="pass") for c in _columns_of(meta)]
    if kind == "temporal_coverage_check":
        months, exceptions = meta.get("expected_months_per_year", 12), list(meta.get("exception_years", []))
        return [make(meta.get("columns", period), expected_months=months, exception_years=exceptions)]
    raise ValueError(f"unknown rule type {kind!r} in rule {key!r}")


def ledger_rules(
    config: Mapping[str, Any],
    as_of_year: int,
    period: tuple[str, str] = ("ANO_DOC", "MES_DOC"),
    level: str = "NIVEL_GOBIERNO",
) -> list[Rule]:
    """All rules of a sectioned rule file, in file order. `period` names the year and month columns."""
    prefix = config["settings"]["source"]
    rules: list[Rule] = []
    for section in SECTIONS:
        for key, meta in (config.get(section) or {}).items():
            meta = {"dimension": section.capitalize(), **meta}
            rules += _expand(prefix, key, meta, as_of_year, period, level)
    return rules
