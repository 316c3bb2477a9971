"""One audit record per run, all jobs in one shape, appended by date."""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tamiz.session import literal_rows
from tamiz.sinks.tables import DATE_PARTS, with_date_parts

AUDIT_DDL = (
    "source string, layer string, job string, status string, started_at string, finished_at string, "
    "duration_seconds double, counters map<string,double>, outputs map<string,string>, notes array<string>, details string"
)
INGESTION_DDL = (
    "timestamp string, source string, dataset string, status string, rows_extracted bigint, pages bigint, "
    "files_written array<string>, error string"
)


def audit_record(
    spark: SparkSession,
    *,
    source: str,
    layer: str,
    job: str,
    status: str,
    started_at: dt.datetime,
    finished_at: dt.datetime,
    counters: Mapping[str, float] | None = None,
    outputs: Mapping[str, str] | None = None,
    notes: Sequence[str] = (),
    details: Any = None,
) -> DataFrame:
    row = {
        "source": source,
        "layer": layer,
        "job": job,
        "status": status,
        "started_at": started_at.isoformat(),
        "finished_at": finished_at.isoformat(),
        "duration_seconds": round((finished_at - started_at).total_seconds(), 3),
        "counters": {k: float(v) for k, v in (counters or {}).items() if v is not None},
        "outputs": dict(outputs or {}),
        "notes": list(notes),
        "details": json.dumps(details, ensure_ascii=False, default=str) if details is not None else None,
    }
    return literal_rows(spark, [row], AUDIT_DDL)


class Stopwatch:
    """When a job ended: its start, as the caller gave it, plus the seconds since; no clock or time zone of the driver."""

    def __init__(self, started_at: dt.datetime):
        self.started_at, self._begun = started_at, time.monotonic()

    def now(self) -> dt.datetime:
        return self.started_at + dt.timedelta(seconds=time.monotonic() - self._begun)


def append_audit(record: DataFrame, root: str, day: dt.date) -> str:
    """Append below {root}/year=/month=/day=."""
    with_date_parts(record, day).coalesce(1).write.mode("append").partitionBy(*DATE_PARTS).json(root)
    return root


def ingestion_record(
    spark: SparkSession,
    *,
    at: dt.datetime,
    source: str,
    dataset: str,
    status: str,
    rows: int = 0,
    pages: int = 0,
    files: Sequence[str] = (),
    error: str | None = None,
) -> DataFrame:
    row = {
        "timestamp": at.isoformat(),
        "source": source,
        "dataset": dataset,
        "status": status,
        "rows_extracted": rows,
        "pages": pages,
        "files_written": list(files),
        "error": error,
    }
    return literal_rows(spark, [row], INGESTION_DDL)


def run_metadata(
    spark: SparkSession, *, source: str, dataset: str, resource: str, rows: int, columns: Sequence[str], pages: int, at: dt.datetime
) -> DataFrame:
    """The metadata document that a landing leaves beside its data."""
    row = {
        "source": source,
        "dataset": dataset,
        "resource_id": resource,
        "rows": rows,
        "columns": list(columns),
        "pages_fetched": pages,
        "extraction_ts": at.isoformat(),
    }
    ddl = (
        "source string, dataset string, resource_id string, rows bigint, columns array<string>, "
        "pages_fetched bigint, extraction_ts string"
    )
    return literal_rows(spark, [row], ddl)
