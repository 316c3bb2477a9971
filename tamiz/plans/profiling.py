"""Profiling job: independent sections; one that fails leaves an empty table and a note, the others go on."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tamiz.operators.wide import stack
from tamiz.profile import columns as rich
from tamiz.profile import sections as s
from tamiz.sinks.audit import Stopwatch, append_audit, audit_record
from tamiz.sinks.tables import write_csv_report, write_parquet_report

log = logging.getLogger(__name__)

CONCURRENT_SECTIONS = 4


@dataclass(frozen=True)
class LedgerColumns:
    """Which columns play which part in a ledger profile."""

    categorical: Sequence[str] = ()
    business_key: Sequence[str] = ()
    pairs: Sequence[tuple[str, str]] = ()
    amounts: Sequence[str] = ()
    time: Mapping[str, tuple[int, int, bool]] = field(default_factory=dict)
    year: str | None = None
    month: str | None = None
    amount: str | None = None


def ledger_sections(df: DataFrame, dataset: str, parts: LedgerColumns, exact: bool = False) -> dict[str, Callable[[], DataFrame]]:
    """Section name -> how to build its table."""
    out: dict[str, Callable[[], DataFrame]] = {
        "nulos": lambda: s.null_profile(df, dataset),
        "duplicados": lambda: s.duplicate_profile(df, dataset, parts.business_key),
        "cardinalidad": lambda: s.cardinality_profile(df, dataset, exact),
    }
    if parts.categorical:
        out["categoricas"] = lambda: s.categorical_profile(df, dataset, parts.categorical, exact)
    if parts.time:
        out["temporal_resumen"] = lambda: s.temporal_summary(df, dataset, parts.time)
    if parts.year:
        out["temporal_evolucion"] = lambda: s.yearly_evolution(df, dataset, parts.year, parts.month, parts.amount)
    if parts.pairs:
        out["consistencia"] = lambda: s.consistency_profile(df, dataset, parts.pairs)
    if parts.amounts:
        out["montos"] = lambda: s.sign_profile(df, dataset, parts.amounts)
    return out


def run_sections(
    sections: Mapping[str, Callable[[], DataFrame]], reports_root: str
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Write every section as Parquet and CSV; returns the stored tables and the errors of those that failed.

    Sections are independent jobs, so a few run at a time and one's tail does not leave the cluster idle.
    """

    def run(name: str) -> DataFrame | str:
        try:
            table = sections[name]()
            stored = table.sparkSession.read.schema(table.schema).parquet(
                write_parquet_report(table, f"{reports_root}/{name}.parquet")
            )
            write_csv_report(stored, f"{reports_root}/{name}")
            return stored
        except Exception as exc:  # a failing section must not take the others with it
            log.error("profile section %s failed: %s", name, exc)
            return str(exc).splitlines()[0] if str(exc) else type(exc).__name__

    with ThreadPoolExecutor(max_workers=CONCURRENT_SECTIONS) as pool:
        outcomes = dict(zip(sections, pool.map(run, sections), strict=True))
    tables = {k: v for k, v in outcomes.items() if not isinstance(v, str)}
    return tables, {k: v for k, v in outcomes.items() if isinstance(v, str)}


def run_ledger_profile(
    df: DataFrame,
    dataset: str,
    parts: LedgerColumns,
    *,
    reports_root: str,
    audit_root: str,
    started_at: dt.datetime,
    finished_at: dt.datetime | None = None,
    exact: bool = False,
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    watch = Stopwatch(started_at)
    tables, errors = run_sections(ledger_sections(df, dataset, parts, exact), reports_root)
    finished = finished_at or watch.now()
    record = audit_record(
        df.sparkSession,
        source=dataset,
        layer="bronze",
        job="profiling",
        status="success" if not errors else "warning",
        started_at=started_at,
        finished_at=finished,
        counters={"sections": len(tables), "failed_sections": len(errors)},
        outputs={name: f"{reports_root}/{name}" for name in tables},
        notes=[f"{k}: {v}" for k, v in errors.items()],
    )
    append_audit(record, audit_root, finished.date())
    return tables, errors


def profile_all(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rich column profiles of several datasets, stacked."""
    return stack([rich.column_profile(df, name) for name, df in tables.items()])
