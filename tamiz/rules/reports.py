"""Summaries over the quality detail (one row per rule): per dataset, severity, dimension and run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.rules.model import (
    ALL_DIMENSIONS,
    SEVERE,
    STATUS_CLEAN,
    STATUS_NOT_EVALUABLE,
    STATUS_OBSERVED,
)
from tamiz.session import literal_rows


def _observed() -> Column:
    return F.col("failed_rows") > 0


def _mean_score(dimension: str) -> Column:
    return F.avg(F.when(F.col("dimension") == dimension, F.col("score")))


def quality_summary(detail: DataFrame, dimensions: Sequence[str] = ALL_DIMENSIONS) -> DataFrame:
    """Per dataset: rule counts, totals, mean score per dimension and the mean of those means."""
    means = {d: f"score_{d.lower()}" for d in dimensions}
    table = detail.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("rules_evaluated"),
        F.count_if(_observed()).alias("rules_with_observations"),
        F.sum("failed_rows").alias("observations_total"),
        F.sum("evaluated_rows").alias("evaluated_rows_total"),
        *[_mean_score(d).alias(name) for d, name in means.items()],
    )
    scored = F.array_compact(F.array(*means.values()))
    total = F.aggregate(scored, F.lit(0.0), lambda a, b: a + b)
    state = F.when(F.col("rules_with_observations") == 0, STATUS_CLEAN).otherwise(STATUS_OBSERVED)
    return table.select(
        "dataset",
        "rules_evaluated",
        "rules_with_observations",
        "observations_total",
        "evaluated_rows_total",
        *[F.round(name, 4).alias(name) for name in means.values()],
        F.when(F.size(scored) > 0, F.round(total / F.size(scored), 4)).alias("score_general"),
        state.alias("estado_descriptivo"),
    )


def severity_summary(detail: DataFrame) -> DataFrame:
    """Rules with observations and observed rows per severity, largest first."""
    return (
        detail.where(_observed())
        .groupBy("severity")
        .agg(F.count(F.lit(1)).alias("rules_with_observations"), F.sum("failed_rows").alias("observations_total"))
        .orderBy(F.desc("observations_total"), "severity")
    )


def top_alerts(detail: DataFrame, k: int = 10) -> DataFrame:
    """The k rules with most failed rows."""
    return detail.where(_observed()).orderBy(F.desc("failed_rows"), "rule_id").limit(k)


def dimension_cards(detail: DataFrame, dimensions: Sequence[str] = ALL_DIMENSIONS) -> DataFrame:
    """One row per dimension, also for those without rules."""
    listed = literal_rows(detail.sparkSession, [{"dimension": d} for d in dimensions], "dimension string")
    found = detail.groupBy("dimension").agg(
        F.round(F.avg("score"), 4).alias("score"),
        F.count(F.lit(1)).alias("rules"),
        F.sum("failed_rows").alias("observations"),
    )
    empty = F.col("rules").isNull()
    status = (
        F.when(empty, STATUS_NOT_EVALUABLE)
        .when(F.col("observations") == 0, STATUS_CLEAN)
        .otherwise(STATUS_OBSERVED)
    )
    return listed.join(found, "dimension", "left").select(
        "dimension",
        "score",
        F.coalesce("rules", F.lit(0)).cast("bigint").alias("rules"),
        F.coalesce("observations", F.lit(0)).cast("bigint").alias("observations"),
        status.alias("status"),
    )


def run_totals(detail: DataFrame) -> DataFrame:
    """One row for the audit record: rules, observed rules, observed rows, severe observed rules, run status."""
    totals = detail.agg(
        F.count(F.lit(1)).alias("rules_evaluated"),
        F.count_if(_observed()).alias("rules_with_observations"),
        F.coalesce(F.sum("failed_rows"), F.lit(0)).cast("bigint").alias("observations_total"),
        F.count_if(_observed() & F.col("severity").isin(*SEVERE)).alias("severe_observations"),
    )
    return totals.withColumn("status", F.when(F.col("severe_observations") > 0, "warning").otherwise("success"))


SAMPLE_COLUMNS = ("dataset", "rule_id", "dimension", "column_name", "sample_rank", "expected_value", "row")


def failed_sample_rows(detail: DataFrame) -> DataFrame:
    """The sampled failing rows of a detail table, one per row: SAMPLE_COLUMNS, `row` as a JSON object of the shown columns."""
    rows = F.from_json("sample_failed_rows", "array<map<string,string>>")
    each = detail.where(_observed()).select("*", F.posexplode(rows).alias("at", "shown"))
    each = each.withColumns({"sample_rank": F.col("at") + 1, "row": F.to_json("shown")})
    return each.select(*SAMPLE_COLUMNS)
