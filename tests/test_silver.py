import datetime as dt
import hashlib
import re

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tamiz.operators import clean, dedup, derive
from tamiz.plans.config import ConfigError, load_rules
from tamiz.plans.run_silver import run_ledger_silver
from tamiz.plans.silver import ledger_silver, survey_report, survey_silver
from tamiz.sinks.tables import overwrite_partitions

RUN_AT = dt.datetime(2026, 6, 11, 10, 0, 0)


def test_codes_longer_than_the_width(spark):
    df = spark.createDataFrame([("1234",), ("1234567",), (None,)], "c string").coalesce(1)
    assert [r[0] for r in clean.pad_codes(df, {"c": (6, "0")}).collect()] == ["001234", "1234567", None]
    assert [r[0] for r in clean.pad_codes(df, {"c": (6, "0")}, truncate=True).collect()] == ["001234", "123456", None]


def test_row_hashes(spark):
    df = spark.createDataFrame([("a|b", "c", None), ("a", "b|c", None)], "x string, y string, z int")
    named = [r[0] for r in df.select(derive.named_hash(df)).collect()]
    positional = [r[0] for r in df.select(derive.positional_hash(df, ["x", "y", "z"])).collect()]
    assert hashlib.sha256(b"x=a|b|y=c|z=<NULL>").hexdigest() in named
    assert len(set(named)) == 2 and len(set(positional)) == 1


def test_null_amount_is_a_reversion(spark):
    df = spark.createDataFrame([("5",), ("-5.10",), (None,)], "m string").coalesce(1)
    found = df.select(derive.sign_flag(df, "m"), derive.positive_flag(df, "m")).collect()
    assert [tuple(r) for r in found] == [("NORMAL", True), ("REVERSION", False), ("REVERSION", None)]


def test_period_key_of_doubles_and_absent_columns(spark):
    df = spark.createDataFrame([(2024.0, 1), (None, 2)], "a double, b int").coalesce(1)
    assert [r[0] for r in df.select(derive.period_key(df, "a", "b")).collect()] == ["2024-1", None]
    assert [r[0] for r in df.select(derive.period_key(df, "a", "zz")).collect()] == [None, None]


def test_both_deduplications_agree_on_a_hot_key(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 700 AS STRING) END AS k", "id AS v")
    order, tie = [F.col("v").desc()], [F.col("v")]
    want = {r["k"]: r["v"] for r in df.groupBy("k").agg(F.max("v").alias("v")).collect()}
    for keep in (dedup.keep_first, dedup.keep_first_of_few):
        assert {r["k"]: r["v"] for r in keep(df, ["k", "ghost"], order, tie).collect()} == want
    assert dedup.keep_first(df, ["ghost"], order, tie).count() == 3000


LEDGER = {
    "source_system": "ledger",
    "source_dataset": "ingresos",
    "filtering": {"master_filter": {"column": "NIVEL", "value": "M"}},
    "cleaning": {"lpad_codes": [{"column": "SEC", "length": 6, "fill_char": "0"}], "null_tokens": {"tokens": ["", "NULL"]}},
    "imputations": {"codes": {"columns": ["SECTOR"], "impute_value": "00"}},
    "derived_columns": {"ano_particion": {"source_columns": ["ANO"]}, "flag_tipo_transaccion": {"source_columns": ["MONTO"]}},
    "deduplication": {"key_columns": ["ANO", "SEC"], "window_order": [{"column": "ANO", "direction": "desc"}]},
    "output_schema": {
        "partition_by": ["ano_particion"],
        "columns": [
            {"name": "ANO", "type": "integer"},
            {"name": "SEC", "type": "string"},
            {"name": "MONTO", "type": "double"},
            {"name": "SECTOR", "type": "string"},
        ],
    },
}
LEDGER_ROWS = [
    ("2024", "M", " 1234 ", " ", "10"),
    ("2024", "M", "1234", "", "11"),
    ("2024", "M", "1234567", "NULL", "abc"),
    ("2025", "M", "9", "7", "-1"),
    ("2025", "R", "9", "7", "-1"),
    ("2025", None, "9", "7", "-1"),
]


@pytest.fixture
def ledger(spark):
    return spark.createDataFrame(LEDGER_ROWS, "ANO string, NIVEL string, SEC string, SECTOR string, MONTO string")


def test_ledger_silver(ledger):
    found = rows(ledger_silver(ledger, LEDGER, RUN_AT), "ANO", "SEC")
    assert [(r["SEC"], r["SECTOR"], r["ano_particion"]) for r in found] == [
        ("001234", "00", 2024),
        ("1234567", "00", 2024),
        ("000009", "7", 2025),
    ]
    assert [r["flag_tipo_transaccion"] for r in found] == ["NORMAL", "REVERSION", "REVERSION"]
    assert {"source_system", "silver_processed_at", "_audit_loaded_at", "record_hash"} <= set(found[0])
    again = rows(ledger_silver(ledger.repartition(5), LEDGER, RUN_AT, rare_duplicates=True), "ANO", "SEC")
    assert again == found


def test_ledger_job_writes_partitions_reports_and_audit(spark, ledger, tmp_path):
    report = run_ledger_silver(
        ledger,
        LEDGER,
        RUN_AT,
        silver_path=str(tmp_path / "silver"),
        reports_root=str(tmp_path / "reports"),
        audit_root=str(tmp_path / "audit"),
        files=1,
    )
    one = rows(report.summary)[0]
    assert (one["bronze_rows"], one["filtered_rows"], one["silver_rows"], one["duplicates_removed"]) == (6, 4, 3, 1)
    assert (one["conversion_errors"], one["status"]) == (1, "WITH_CONVERSION_ERRORS")
    assert sorted(p.name for p in (tmp_path / "silver").iterdir() if p.is_dir()) == ["ano_particion=2024", "ano_particion=2025"]
    audit = rows(spark.read.json(str(tmp_path / "audit")))[0]
    assert audit["job"] == "silver" and audit["counters"]["silver_rows"] == 3.0
    origins = {r["column_name"]: r["origin"] for r in rows(report.dictionary)}
    assert (origins["ANO"], origins["ano_particion"], origins["record_hash"]) == ("bronze_original", "derived_column", "audit_column")


def test_partition_overwrites(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    overwrite_partitions(df, path, ["p"])
    overwrite_partitions(df.where("p = 'b'").withColumn("v", F.lit(9)), path, ["p"], whole=False)
    assert {(r["v"], r["p"]) for r in spark.read.parquet(path).collect()} == {(1, "a"), (9, "b")}
    overwrite_partitions(df.where("p = 'b'"), path, ["p"], regroup=True)
    assert {(r["v"], r["p"]) for r in spark.read.parquet(path).collect()} == {(2, "b")}


SURVEY = {"source_system": "survey", "silver_defaults": {"null_handling": {}, "row_policy": {"drop_empty_rows": True}}}
TABLE = {
    "integer_columns": ["ANO", "PERIODO", "ghost"],
    "datetime_columns": ["FECHA"],
    "decimal_columns": [],
    "drop_columns": {"VACIA": {"reason": "empty"}},
    "special_values_to_null": {"FECHA": {"values": ["0"], "reason": "none"}},
    "derived_columns": {"anio_periodo_key": {"enabled": True, "source_columns": ["ANO", "PERIODO"]}},
}


def test_survey_silver_and_reports(spark):
    bronze = spark.createDataFrame(
        [("2024", "1.0", "1/2/2024", "01", "x"), ("n/a", "2", "0", "02", None), ("nan", "", " ", None, "y"), ("2x", "1", "zz", "", None)],
        "ANO string, PERIODO string, FECHA string, ORDEN string, VACIA string",
    )
    out = survey_silver(bronze, "t", TABLE, SURVEY, RUN_AT)
    found = rows(out, "ORDEN", "PERIODO")
    assert "VACIA" not in out.columns and len(found) == 3
    assert {r["anio_periodo_key"] for r in found} == {"2024-1", None}
    assert {r["ORDEN"] for r in found} == {"01", "02", None}
    report = survey_report(bronze, out, "t", TABLE, SURVEY)
    detail = {r["column_name"]: r for r in rows(report.detail)}
    assert (detail["ANO"]["nulls_before"], detail["ANO"]["nulls_after"], detail["ANO"]["conversion_errors"]) == (1, 2, 1)
    assert detail["FECHA"]["special_values_handled"] == 1 and detail["FECHA"]["reason"] == "special_values_to_null: none"
    assert detail["VACIA"]["status"] == "DROPPED" and detail["ghost"]["status"] == "WARNING"
    summary = rows(report.summary)[0]
    assert (summary["bronze_rows"], summary["silver_rows"], summary["conversion_errors"]) == (4, 3, 2)
    assert "Filas completamente vacías eliminadas: 1" in summary["notes"] and "ghost" in summary["notes"]
    technical = [r["column_name"] for r in rows(report.dictionary) if r["is_technical_column"]]
    assert set(technical) == {"source_system", "source_dataset", "silver_processed_at", "record_hash", "anio_periodo_key"}


def test_rule_files(tmp_path):
    (tmp_path / "r.json").write_text('{"settings": {}}')
    assert load_rules(tmp_path / "r.json", ["settings"]) == {"settings": {}}
    with pytest.raises(ConfigError, match="datasets"):
        load_rules(tmp_path / "r.json", ["settings", "datasets"])
    with pytest.raises(FileNotFoundError):
        load_rules(tmp_path / "none.yaml")
    pytest.importorskip("yaml")
    (tmp_path / "r.yaml").write_text("settings: {source: s}\n")
    assert load_rules(tmp_path / "r.yaml")["settings"]["source"] == "s"


def test_a_wide_row_is_cleaned_and_cast_by_methods_that_the_jvm_compiles(spark, capsys):
    """HotSpot interprets methods beyond 8000 bytes."""
    names = [f"c{i}" for i in range(14)]
    wide = spark.range(1, 4).selectExpr("id", *[f"CASE WHEN id = 2 THEN ' NULL ' ELSE concat(id, ' ') END AS {c}" for c in names])
    nulled = clean.tokens_to_null(wide)
    assert nulled.columns == ["id", *names] and nulled.schema["c3"].dataType.simpleString() == "string"
    assert [tuple(r)[1:] for r in nulled.orderBy("id").collect()] == [("1 ",) * 14, (None,) * 14, ("3 ",) * 14]
    types = {**dict.fromkeys(names[:2], "integer"), **dict.fromkeys(names[2:4], "decimal(18,2)")}
    out = clean.cast_columns(clean.trim_text(nulled), types)
    assert [r["c0"] for r in out.orderBy("id").collect()] == [1, None, 3]
    out.explain("codegen")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000
