"""Bronze job: landed CSV files or JSON pages -> raw Parquet, with metadata and audit; datasets fail one by one."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tamiz.operators.wide import stack
from tamiz.sinks.audit import append_audit, ingestion_record, run_metadata
from tamiz.sinks.tables import append_raw, overwrite_flat, write_json
from tamiz.sources.pages import read_pages, read_pages_or_dump, reconcile_pages
from tamiz.sources.text import read_csv, read_csv_sniffed

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Landed:
    """Where a dataset was landed: `kind` is csv, csv_sniffed or pages (with an optional CSV dump)."""

    kind: str
    path: str
    dump: str | None = None
    sep: str = ","
    page_per_line: bool = False


def _read(spark: SparkSession, what: Landed) -> tuple[DataFrame, int]:
    if what.kind == "csv":
        return read_csv(spark, what.path, sep=what.sep).rows, 0
    if what.kind == "csv_sniffed":
        return read_csv_sniffed(spark, what.path).rows, 0
    if what.kind == "pages":
        whole = not what.page_per_line
        landed = read_pages(spark, what.path, whole)
        pages = reconcile_pages(landed.pages).first()["pages_fetched"]
        if what.dump:
            return read_pages_or_dump(spark, what.path, what.dump, what.sep, whole)[0], pages
        return landed.records, pages
    raise ValueError(f"unknown landing kind: {what.kind!r}")


def ingest(
    spark: SparkSession, source: str, landings: Mapping[str, Landed], bronze_root: str, audit_root: str, at: dt.datetime, flat: bool = False
) -> DataFrame:
    """Ingest every dataset; a failing one is audited and passed over. Returns the run log."""
    log_rows = []
    for dataset, what in landings.items():
        try:
            df, pages = _read(spark, what)
            path = overwrite_flat(df, bronze_root, source, dataset) if flat else append_raw(df, bronze_root, source, dataset, at.date())
            # Counted at the landing: the day's folder may hold earlier appends too.
            rows = df.count()
            meta = run_metadata(
                spark, source=source, dataset=dataset, resource=what.path, rows=rows, columns=df.columns, pages=pages, at=at
            )
            write_json(meta.coalesce(1), f"{bronze_root}/{source}/_metadata/{dataset}")
            status = "success" if rows else "empty"
            record = ingestion_record(
                spark, at=at, source=source, dataset=dataset, status=status, rows=rows, pages=pages, files=[path]
            )
        except Exception as exc:  # one dataset must not stop the others
            log.error("ingestion of %s failed: %s", dataset, exc)
            first = str(exc).splitlines()[0] if str(exc) else type(exc).__name__
            record = ingestion_record(spark, at=at, source=source, dataset=dataset, status="error", error=first)
        log_rows.append(record)
    run_log = stack(log_rows)
    append_audit(run_log, audit_root, at.date())
    return run_log
