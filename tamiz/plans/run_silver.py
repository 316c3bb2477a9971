"""Silver jobs that write: transformation, partitioned table, reports, audit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tamiz.operators.wide import stack
from tamiz.plans.silver import SilverReport, ledger_report, ledger_silver, survey_report, survey_silver
from tamiz.sinks.audit import Stopwatch, append_audit, audit_record
from tamiz.session import written_once
from tamiz.sinks.tables import overwrite_flat, overwrite_partitions, write_csv_report


def _publish(spark: SparkSession, report: SilverReport, source: str, reports_root: str, audit_root: str, watch: Stopwatch) -> SilverReport:
    """Writes the reports, each computed once, and the audit record; returns the stored reports."""
    report = SilverReport(*[written_once(table, "silver-report") for table in (report.summary, report.detail, report.dictionary)])
    outputs = {
        name: write_csv_report(table, f"{reports_root}/silver_{name}")
        for name, table in (("summary", report.summary), ("detail", report.detail), ("data_dictionary", report.dictionary))
    }
    stored = [r.asDict() for r in report.summary.collect()]  # a row per dataset
    status = "OK" if all(r["status"] == "OK" for r in stored) else "WITH_CONVERSION_ERRORS"
    counted = ("bronze_rows", "silver_rows", "conversion_errors", "nulls_before", "nulls_after", "duplicates_removed")
    counters = {c: sum(r.get(c) or 0 for r in stored) for c in counted if c in stored[0]}
    finished = watch.now()
    record = audit_record(
        spark,
        source=source,
        layer="silver",
        job="silver",
        status=status,
        started_at=watch.started_at,
        finished_at=finished,
        counters=counters,
        outputs=outputs,
    )
    append_audit(record, audit_root, finished.date())
    return report


def run_ledger_silver(
    bronze: DataFrame,
    config: Mapping[str, Any],
    processed_at: dt.datetime,
    *,
    silver_path: str,
    reports_root: str,
    audit_root: str,
    files: int = 0,
    rare_duplicates: bool = True,
    regroup: bool = True,
) -> SilverReport:
    """Writes the Silver table and its reports. `regroup` moves the rows to their partitions first, so that a partition has few files."""
    spark, watch = bronze.sparkSession, Stopwatch(processed_at)
    table = ledger_silver(bronze, config, processed_at, rare_duplicates=rare_duplicates)
    partition_by = (config.get("output_schema") or {}).get("partition_by") or ["ano_particion"]
    overwrite_partitions(table, silver_path, partition_by, regroup=regroup)
    stored = spark.read.parquet(silver_path).select(*table.columns)
    report = ledger_report(bronze, stored, config, files, silver_path)
    return _publish(spark, report, config["source_system"], reports_root, audit_root, watch)


def run_survey_silver(
    tables: Mapping[str, DataFrame],
    config: Mapping[str, Any],
    processed_at: dt.datetime,
    *,
    silver_root: str,
    reports_root: str,
    audit_root: str,
) -> SilverReport:
    reports = []
    watch = Stopwatch(processed_at)
    spark = next(iter(tables.values())).sparkSession
    source = config["source_system"]
    for dataset, rules in config["datasets"].items():
        table = survey_silver(tables[dataset], dataset, rules, config, processed_at)
        path = overwrite_flat(table, silver_root, source, dataset)
        reports.append(survey_report(tables[dataset], spark.read.parquet(path), dataset, rules, config, path))
    merged = SilverReport(*[stack([getattr(r, name) for r in reports]) for name in ("summary", "detail", "dictionary")])
    return _publish(spark, merged, source, reports_root, audit_root, watch)
