"""Schema-validation job: contract or dictionary, over one or several datasets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from tamiz.contract.contract import Contract, check_critical, contract_check, contract_summary
from tamiz.contract.dictionary import compare_dictionary, dictionary_summary, first_dictionary, physical_columns
from tamiz.operators.wide import stack
from tamiz.sinks.audit import Stopwatch, append_audit, audit_record

# Verdict -> status of the audit record.
STATUS = {"FALLA_CRITICA": "critical", "REVISAR": "warning", "OK": "success"}

Sources = Sequence[tuple[str, Callable[[], DataFrame | None]]]


def validate_contract(
    df: DataFrame, contract: Contract, *, source: str, dataset: str, paths: Sequence[str] = (), stop_on_critical: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(detail, summary). With `stop_on_critical`, an absent critical column ends the job before any scan."""
    if stop_on_critical:
        check_critical(df, contract)
    detail = contract_check(df, contract)
    return detail, contract_summary(detail, source, dataset, df, paths, contract.extra_policy)


def validate_dictionaries(
    tables: Mapping[str, DataFrame],
    dictionaries: Mapping[str, Sources],
    metadata: DataFrame | None = None,
    infer: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(detail, summary) of all datasets."""
    details, summaries = [], []
    for name, df in tables.items():
        physical = physical_columns(df, name, infer)
        official, source, errors = first_dictionary(name, physical, dictionaries.get(name, ()))
        comparison = compare_dictionary(official, physical)
        details.append(comparison)
        summaries.append(dictionary_summary(comparison, df, name, source, errors, metadata))
    return stack(details), stack(summaries)


def audit_validation(
    summary: DataFrame, *, source: str, audit_root: str, started_at: dt.datetime, finished_at: dt.datetime | None = None
) -> str:
    """Append the audit record; the worst verdict of the summary decides its status."""
    watch = Stopwatch(started_at)
    column = "estado_validacion" if "estado_validacion" in summary.columns else "validation_status"
    verdicts = {r[0] for r in summary.select(column).distinct().collect()}
    status = next((STATUS[v] for v in STATUS if v in verdicts), "success")
    finished = finished_at or watch.now()
    record = audit_record(
        summary.sparkSession,
        source=source,
        layer="bronze",
        job="schema_validation",
        status=status,
        started_at=started_at,
        finished_at=finished,
    )
    append_audit(record, audit_root, finished.date())
    return status
