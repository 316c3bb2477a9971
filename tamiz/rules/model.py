"""The rule declaration and the fixed shape of a rule result."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

# Result columns, states, severities and dimensions of the quality detail table.
RESULT_COLUMNS = (
    "dataset",
    "dimension",
    "rule_id",
    "rule_name",
    "column_name",
    "rule_type",
    "expected_value",
    "evaluated_rows",
    "passed_rows",
    "failed_rows",
    "score",
    "severity",
    "source",
    "status",
    "observation",
    "sample_failed_rows",
)
STATUS_CLEAN = "Sin observaciones"
STATUS_OBSERVED = "Con observaciones"
STATUS_NOT_EVALUABLE = "No evaluable"
SEVERITIES = ("Bloqueante", "Alta", "Media", "Baja", "Informativo")
SEVERE = ("Bloqueante", "Alta")
SURVEY_DIMENSIONS = (
    "Completitud",
    "Exactitud",
    "Consistencia",
    "Integridad",
    "Razonabilidad",
    "Oportunidad",
    "Unicidad",
    "Validez",
)
LEDGER_DIMENSIONS = (
    "Completitud",
    "Validez",
    "Exactitud",
    "Consistencia",
    "Unicidad",
    "Integridad",
    "Oportunidad",
    "Conformidad",
)
ALL_DIMENSIONS = (*SURVEY_DIMENSIONS, "Conformidad")


@dataclass(frozen=True)
class Rule:
    """One declared rule.

    `columns` are the columns the rule reads; a rule on a column the table lacks scores 0 over one evaluated
    row. `observation` may hold the placeholders {0}, {1} that the evaluator fills with its findings.
    """

    rule_type: str
    columns: tuple[str, ...]
    dimension: str = ""
    severity: str = "Media"
    source: str = ""
    rule_id: str = ""
    rule_name: str = ""
    column_name: str = ""
    expected_value: str = ""
    observation: str = ""
    absent_observation: str = "No existen columnas requeridas."
    sample_columns: tuple[str, ...] = ()
    params: Mapping[str, Any] = field(default_factory=dict)

    def param(self, name: str, default: Any = None) -> Any:
        return self.params.get(name, default)


def rule(rule_type: str, *columns: str, **options: Any) -> Rule:
    """Short form for rules written in code; unknown options become rule parameters."""
    known = {f for f in Rule.__dataclass_fields__ if f not in ("rule_type", "columns", "params")}
    own = {k: v for k, v in options.items() if k in known}
    params = {k: v for k, v in options.items() if k not in known or k == "expected_value"}
    own["expected_value"] = str(options.get("expected_value", ""))
    own.setdefault("rule_id", f"{'+'.join(columns) or '*'}.{rule_type}")
    own.setdefault("rule_name", own["rule_id"])
    own.setdefault("column_name", ",".join(columns) or "*")
    own.setdefault("sample_columns", tuple(columns))
    return Rule(rule_type=rule_type, columns=tuple(columns), params=params, **own)
