"""Quality job: rules -> detail -> summary -> report files -> audit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from tamiz.functions.missing import RULE_TOKENS
from tamiz.operators.wide import stack
from tamiz.plans.config import check_sections
from tamiz.rules.evaluate import evaluate
from tamiz.rules.ledger import SECTIONS, ledger_rules
from tamiz.rules.model import ALL_DIMENSIONS
from tamiz.rules.reports import failed_sample_rows, quality_summary, run_totals, severity_summary, top_alerts
from tamiz.rules.survey import survey_rules
from tamiz.sinks.audit import Stopwatch, append_audit, audit_record
from tamiz.sinks.tables import write_csv_report, write_parquet_report


@dataclass(frozen=True)
class QualityRun:
    detail: DataFrame
    summary: DataFrame
    status: str
    outputs: Mapping[str, str]


def _tokens(config: Mapping[str, Any]) -> tuple[str, ...]:
    return tuple(sorted({str(t).strip() for t in config.get("missing_tokens") or ()} | set(RULE_TOKENS)))


def _samples(config: Mapping[str, Any]) -> int:
    return int((config.get("settings") or {}).get("max_failed_samples_per_rule", 10))


def ledger_quality(
    df: DataFrame,
    config: Mapping[str, Any],
    as_of: dt.datetime,
    sample_key: tuple[str, ...] | None = None,
) -> DataFrame:
    """Quality detail of one ledger table from a sectioned rule file."""
    check_sections(config, ("settings",))
    if not any(s in config for s in SECTIONS):
        raise ValueError("the rule file holds no rule section")
    settings = config["settings"]
    name = "_".join(str(settings[k]) for k in ("source", "dataset_name") if settings.get(k))
    return evaluate(
        df,
        ledger_rules(config, as_of.year),
        dataset=name,
        as_of=as_of,
        tokens=_tokens(config),
        sample_key=sample_key,
        max_samples=_samples(config),
    )


def survey_quality(
    tables: Mapping[str, DataFrame],
    config: Mapping[str, Any],
    as_of: dt.datetime,
    sample_keys: Mapping[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """Quality detail of all datasets of a survey rule file, reference rules included."""
    check_sections(config, ("settings", "datasets"))
    keys = sample_keys or {}
    return stack(
        [
            evaluate(
                tables[name],
                survey_rules(config, name, tables[name].columns, as_of),
                dataset=name,
                as_of=as_of,
                tokens=_tokens(config),
                catalog=tables,
                sample_key=keys.get(name),
                max_samples=_samples(config),
            )
            for name in config["datasets"]
        ]
    )


def publish_quality(
    detail: DataFrame,
    *,
    source: str,
    reports_root: str,
    tables_root: str,
    audit_root: str,
    started_at: dt.datetime,
    finished_at: dt.datetime | None = None,
    dimensions=ALL_DIMENSIONS,
) -> QualityRun:
    """Write detail, summary, failed samples, severity and alerts, then the audit record.

    The detail is written first and read back, so the rules run once however many reports follow.
    """
    spark, watch = detail.sparkSession, Stopwatch(started_at)
    kept = write_parquet_report(detail, f"{tables_root}/quality_detail")
    stored = spark.read.parquet(kept)
    summary, samples = quality_summary(stored, dimensions), failed_sample_rows(stored)
    outputs = {
        "detail_parquet": kept,
        "summary_parquet": write_parquet_report(summary, f"{tables_root}/quality_summary"),
        "failed_samples_parquet": write_parquet_report(samples, f"{tables_root}/quality_failed_samples"),
        "failed_samples_csv": write_csv_report(samples, f"{reports_root}/quality_failed_samples"),
        "detail_csv": write_csv_report(stored, f"{reports_root}/quality_detail"),
        "summary_csv": write_csv_report(summary, f"{reports_root}/quality_summary"),
        "severity_csv": write_csv_report(severity_summary(stored), f"{reports_root}/quality_severity"),
        "alerts_csv": write_csv_report(top_alerts(stored), f"{reports_root}/quality_alerts"),
    }
    totals = run_totals(stored).first().asDict() | {"failed_samples_total": samples.count()}
    status = totals.pop("status")
    finished = finished_at or watch.now()
    record = audit_record(
        spark,
        source=source,
        layer="bronze",
        job="quality",
        status=status,
        started_at=started_at,
        finished_at=finished,
        counters=totals,
        outputs=outputs,
    )
    append_audit(record, audit_root, finished.date())
    return QualityRun(stored, summary, status, outputs)
