"""Physical columns against a declared contract. Works on schema rows; reads no data but for the row count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.operators.wide import side_by_side
from tamiz.session import literal_rows

# Column states and verdicts of the validation report.
PRESENT, ABSENT, EXTRA = "OK", "FALTA_EN_PARQUET", "EXTRA_EN_PARQUET"
CRITICAL, REVIEW, OK = "FALLA_CRITICA", "REVISAR", "OK"
POLICIES = ("warn", "fail", "ignore")


class ContractError(RuntimeError):
    """A critical column is absent, or extra columns are forbidden and there are some."""


@dataclass(frozen=True)
class Contract:
    expected: tuple[str, ...]
    critical: frozenset[str] = frozenset()
    types: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)
    extra_policy: str = "warn"

    @classmethod
    def from_config(cls, config: Mapping[str, Any]) -> Contract:
        policy = str((config.get("extra_columns_policy") or {}).get("action", "warn")).lower()
        if policy not in POLICIES:
            raise ValueError(f"unknown policy for extra columns: {policy!r}")
        return cls(
            expected=tuple(c.strip().upper() for c in config["expected_columns"]),
            critical=frozenset(c.strip().upper() for c in config.get("critical_columns") or ()),
            types={k.strip().upper(): v for k, v in (config.get("column_types") or {}).items()},
            extra_policy=policy,
        )


def schema_rows(df: DataFrame, label: str = "column_name") -> DataFrame:
    """The physical schema as rows: name, type, nullable, position."""
    rows = [
        {label: f.name, "physical_type": f.dataType.simpleString(), "nullable": f.nullable, "position": i}
        for i, f in enumerate(df.schema)
    ]
    return literal_rows(df.sparkSession, rows, f"{label} string, physical_type string, nullable boolean, position int")


def check_critical(df: DataFrame, contract: Contract) -> None:
    """Stop before any data is read."""
    actual = {c.strip().upper() for c in df.columns}
    gone = sorted(contract.critical & (set(contract.expected) - actual))
    if gone:
        raise ContractError(f"critical columns are absent: {gone}")
    extra = sorted(actual - set(contract.expected))
    if extra and contract.extra_policy == "fail":
        raise ContractError(f"columns outside the contract: {extra}")


def contract_check(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per expected or physical column with its state. Under `ignore`, extra columns are left out."""
    declared = [
        {
            "columna": c,
            "tipo_logico_esperado": contract.types.get(c, {}).get("logical_type", ""),
            "nullable_esperado": contract.types.get(c, {}).get("nullable", True),
            "es_critica": c in contract.critical,
            "fuente_regla": contract.types.get(c, {}).get("source", "contract"),
        }
        for c in contract.expected
    ]
    ddl = (
        "columna string, tipo_logico_esperado string, nullable_esperado boolean, es_critica boolean, fuente_regla string"
    )
    wanted = literal_rows(df.sparkSession, declared, ddl)
    actual = schema_rows(df, "name").select(F.upper(F.trim("name")).alias("columna"), F.col("physical_type").alias("tipo_parquet"))
    here, expected = F.col("tipo_parquet").isNotNull(), F.col("es_critica").isNotNull()
    policy = contract.extra_policy
    state = F.when(here & expected, PRESENT).when(expected, ABSENT).otherwise(f"{EXTRA}_{policy.upper()}")
    joined = wanted.join(actual, "columna", "full_outer").select(
        "columna",
        F.coalesce("tipo_logico_esperado", F.lit("")).alias("tipo_logico_esperado"),
        "nullable_esperado",
        F.coalesce("es_critica", F.lit(False)).alias("es_critica"),
        here.alias("presente_en_parquet"),
        state.alias("estado"),
        F.coalesce("tipo_parquet", F.lit("")).alias("tipo_parquet"),
        F.coalesce("fuente_regla", F.lit(f"extra_columns_policy={policy}")).alias("fuente_regla"),
    )
    return joined.where(~F.col("estado").startswith(EXTRA)) if policy == "ignore" else joined


def _extra() -> Column:
    return F.col("estado").startswith(EXTRA)


def contract_summary(
    detail: DataFrame, source: str, dataset: str, rows: DataFrame | None = None, paths: Sequence[str] = (), policy: str = "warn"
) -> DataFrame:
    """One row: column counts and verdict. `rows` is the table whose rows are counted."""
    gone = F.col("estado") == ABSENT
    totals = detail.agg(
        F.count_if(~_extra()).alias("columnas_esperadas"),
        F.count_if("presente_en_parquet").alias("columnas_en_parquet"),
        F.count_if(F.col("estado") == PRESENT).alias("columnas_ok"),
        F.count_if(gone).alias("columnas_faltantes"),
        F.count_if(_extra()).alias("columnas_extras"),
        F.count_if(gone & F.col("es_critica")).alias("columnas_criticas_faltantes"),
    )
    counted = rows.agg(F.count(F.lit(1)).alias("total_filas")) if rows is not None else None
    verdict = (
        F.when(F.col("columnas_criticas_faltantes") > 0, CRITICAL).when(F.col("columnas_faltantes") > 0, REVIEW).otherwise(OK)
    )
    if counted is not None:
        both = side_by_side([totals, counted])
    else:
        both = totals.withColumn("total_filas", F.lit(0).cast("bigint"))
    return both.select(
        F.lit(source).alias("fuente"),
        F.lit(dataset).alias("dataset"),
        verdict.alias("estado_validacion"),
        *totals.columns,
        "total_filas",
        F.lit(len(paths)).alias("archivos_procesados"),
        F.lit(policy).alias("politica_columnas_extra"),
    )
