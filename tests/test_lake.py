import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tamiz.contract import Contract, ContractError, check_critical, contract_check, contract_summary
from tamiz.plans.ingest import Landed, ingest
from tamiz.plans.profiling import run_sections
from tamiz.plans.schema_validation import audit_validation, validate_dictionaries
from tamiz.sinks.tables import write_csv_report
from tamiz.sources import pages, parquet, text

AT = dt.datetime(2026, 5, 27, 2, 31, 54)


def land(path, body, encoding="utf-8"):
    path.write_bytes(body.encode(encoding))
    return str(path)


def test_csv_keeps_blanks_pads_short_lines_and_quarantines_long_ones(spark, tmp_path):
    path = land(tmp_path / "a.csv", "﻿a,b,c\n1,,x\n2,y\n3,y,z,extra\n")
    landing = text.read_csv(spark, path)
    assert landing.rows.columns == ["a", "b", "c"]
    assert [tuple(r.values()) for r in rows(landing.rows, "a")] == [("1", "", "x"), ("2", "y", "")]
    assert landing.quarantine.count() == 1


def test_csv_encoding_is_chosen_per_file(spark, tmp_path):
    land(tmp_path / "u.csv", "n\nPeñas\n")
    land(tmp_path / "l.csv", "n\nAño\n", "latin-1")
    found = text.read_csv(spark, str(tmp_path / "u.csv"), str(tmp_path / "l.csv")).rows
    assert {r["n"] for r in rows(found)} == {"Peñas", "Año"}


def test_csv_rows_of_both_encodings_in_one_file(spark, tmp_path):
    """The bytes of a row decide, in the scan itself; a header's own bytes name its columns."""
    path = tmp_path / "m.csv"
    path.write_bytes("a\u00f1o,n\n".encode("latin-1") + "Pe\u00f1as,\u20ac\n".encode() + "A\u00f1o,x\n".encode("latin-1") + b'"a ""b"" c",\n')
    landing = text.read_csv(spark, str(path))
    assert landing.rows.columns == ["a\u00f1o", "n"]
    assert {tuple(r) for r in landing.rows.collect()} == {("Pe\u00f1as", "\u20ac"), ("A\u00f1o", "x"), ('a "b" c', "")}
    plan = landing.rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_csv_headers_differ_by_file(spark, tmp_path):
    land(tmp_path / "a.csv", "\ufeffx,y\n1,2\n")
    land(tmp_path / "b.csv", "y,z\n3,4\n5,6,7\n")
    land(tmp_path / "c.csv", "")
    landing = text.read_csv(spark, str(tmp_path))
    assert {tuple(r) for r in landing.rows.select("x", "y", "z").collect()} == {("1", "2", None), (None, "3", "4")}
    bad = landing.quarantine.first()
    assert bad.path.endswith("b.csv") and '"7"' in bad.line


def test_delimiter_sniffing(spark, tmp_path):
    assert text.sniff_delimiter(spark, land(tmp_path / "s.csv", "a;b,x\n1;2\n"))[1] == ";"
    assert text.sniff_delimiter(spark, land(tmp_path / "t.csv", "a\tb\n1\t2\n"))[1] == "\t"
    with pytest.raises(ValueError, match="no delimiter"):
        text.read_csv_sniffed(spark, land(tmp_path / "n.csv", "abc\n1\n"))


def test_dictionaries(spark, tmp_path):
    path = land(tmp_path / "d.csv", "Campo , Tipo\n ano doc ,N\nANO DOC,N\n,N\n")
    found = rows(text.read_dictionary(spark, path, "t"))
    assert [(r["official_column"], r["official_type"], r["official_description"]) for r in found] == [("ANO_DOC", "N", "")]
    path = land(tmp_path / "c.csv", "nombre_campo;descripcion\nP1;x\nP1;y\n")
    assert text.read_catalogue(spark, path, "t", "nombre_campo", ["descripcion"]).count() == 1
    with pytest.raises(ValueError, match="modulo"):
        text.read_catalogue(spark, path, "t", "nombre_campo", ["modulo"])


def test_pages_and_fallback(spark, tmp_path):
    folder = tmp_path / "p"
    folder.mkdir()
    land(folder / "1.json", '{"sucess": true, "records": [{"a": 1, "b": "x"}], "result": {"total": 2}}')
    land(folder / "2.json", '{"success": true, "records": [{"b": "y", "a": 2}], "result": {"include_total": "2"}}')
    land(folder / "3.json", '{"success": false, "records": []}')
    landed = pages.read_pages(spark, str(folder))
    assert [(r["a"], r["b"]) for r in rows(landed.records, "a")] == [("1", "x"), ("2", "y")]
    check = rows(pages.reconcile_pages(landed.pages))[0]
    assert (check["pages_fetched"], check["failed_pages"], check["rows"], check["declared_total"]) == (3, 1, 2, 2)
    empty = tmp_path / "e"
    empty.mkdir()
    land(empty / "1.json", '{"success": true, "records": [], "result": {"total": 7}}')
    dump = land(tmp_path / "dump.csv", "a\n5\n")
    found, origin = pages.read_pages_or_dump(spark, str(empty), dump)
    assert origin == "csv_fallback" and [r["a"] for r in rows(found)] == ["5"]


def test_api_fields(spark, tmp_path):
    path = land(tmp_path / "f.json", '{"result": {"fields": [{"id": "_id", "type": "int"}, {"id": "MES DOC", "type": "text"}]}}')
    assert [r["official_column"] for r in rows(pages.api_fields(spark, path, "t"))] == ["MES_DOC"]


def test_history_leaves_out_daily_files_and_merges_columns(spark, tmp_path):
    spark.createDataFrame([("1",)], "a string").write.parquet(str(tmp_path / "2023"))
    spark.createDataFrame([("2", "x")], "a string, b string").write.parquet(str(tmp_path / "2024_mensual"))
    spark.createDataFrame([("9", "z")], "a string, c string").write.parquet(str(tmp_path / "2024_DIARIO"))
    found = parquet.read_history(spark, str(tmp_path))
    assert found.columns == ["a", "b"] and sorted(r["a"] for r in rows(found)) == ["1", "2"]
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        parquet.read_history(spark, str(tmp_path / "none"))


def test_catalog_opens_each_dataset_once(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "d"))
    catalog = parquet.Catalog(spark, str(tmp_path), ["d", "lost"])
    assert catalog["d"] is catalog["d"] and catalog["d"].count() == 3
    with pytest.raises(FileNotFoundError):
        catalog["lost"]
    with pytest.raises(KeyError):
        catalog["unknown"]


def test_inventory_lists_unreadable_files(spark, tmp_path):
    spark.range(4).coalesce(1).write.parquet(str(tmp_path / "ok"))
    land(tmp_path / "broken.parquet", "not parquet")
    good = parquet.inventory_totals(parquet.file_inventory(spark, str(tmp_path / "ok")))
    assert (rows(good)[0]["rows"], rows(good)[0]["unreadable"]) == (4, 0)
    every = rows(parquet.inventory_totals(parquet.file_inventory(spark, str(tmp_path))))[0]
    assert (every["files"], every["rows"], every["unreadable"]) == (2, 4, 1)
    assert parquet.head(spark.range(9), 2).count() == 2


def test_untyped_columns_read_as_text(spark):
    df = parquet.all_text(spark.sql("SELECT 1 AS a, NULL AS b"))
    assert dict(df.dtypes) == {"a": "int", "b": "string"}


CONTRACT = {
    "expected_columns": ["A", "B", "C"],
    "critical_columns": ["A"],
    "column_types": {"A": {"logical_type": "integer", "nullable": False}},
}


@pytest.mark.parametrize(("policy", "states"), [("warn", {"OK", "FALTA_EN_PARQUET", "EXTRA_EN_PARQUET_WARN"}), ("ignore", {"OK", "FALTA_EN_PARQUET"})])
def test_contract_states(spark, policy, states):
    df = spark.createDataFrame([("1", "2", "3")], "a string, b string, z string")
    contract = Contract.from_config({**CONTRACT, "extra_columns_policy": {"action": policy}})
    detail = contract_check(df, contract)
    assert {r["estado"] for r in rows(detail)} == states
    one = rows(contract_summary(detail, "s", "t", df))[0]
    assert (one["estado_validacion"], one["columnas_ok"], one["columnas_faltantes"], one["total_filas"]) == ("REVISAR", 2, 1, 1)


def test_contract_failures(spark):
    df = spark.createDataFrame([("2",)], "b string")
    with pytest.raises(ContractError, match="critical"):
        check_critical(df, Contract.from_config(CONTRACT))
    strict = Contract.from_config({"expected_columns": [], "extra_columns_policy": {"action": "fail"}})
    with pytest.raises(ContractError, match="outside"):
        check_critical(df, strict)


def test_dictionary_chain_and_audit(spark, tmp_path):
    df = spark.createDataFrame([("1", "x")], "ano string, nombre string")
    book = spark.createDataFrame(
        [("t", "ANO", "N", "", "dictionary_csv"), ("t", "LOST", "N", "", "dictionary_csv")],
        "dataset string, official_column string, official_type string, official_description string, dictionary_source string",
    )

    def broken():
        raise OSError("no network")

    detail, summary = validate_dictionaries({"t": df, "u": df}, {"t": [("first", broken), ("second", lambda: book)]})
    states = {(r["dataset"], r["official_column"], r["comparison_status"]) for r in rows(detail)}
    assert ("t", "LOST", "FALTA_EN_PARQUET") in states and ("t", None, "EXTRA_EN_PARQUET") in states
    verdicts = {r["dataset"]: (r["dictionary_source"], r["validation_status"]) for r in rows(summary)}
    assert verdicts == {"t": ("second", "REVISAR"), "u": ("parquet_only_no_official_dictionary", "OK")}
    assert audit_validation(summary, source="s", audit_root=str(tmp_path / "audit"), started_at=AT) == "warning"


def test_ingestion_goes_on_after_a_failing_dataset(spark, tmp_path):
    good = land(tmp_path / "g.csv", "a,b\n1,2\n")
    bare = land(tmp_path / "h.csv", "a,b\n")
    landings = {"lost": Landed("csv", str(tmp_path / "nope.csv")), "good": Landed("csv", good), "bare": Landed("csv", bare)}
    log = rows(ingest(spark, "s", landings, str(tmp_path / "lake"), str(tmp_path / "audit"), AT), "dataset")
    assert [(r["dataset"], r["status"], r["rows_extracted"]) for r in log] == [("bare", "empty", 0), ("good", "success", 1), ("lost", "error", 0)]
    assert spark.read.json(str(tmp_path / "audit")).count() == 3
    stored = spark.read.parquet(str(tmp_path / "lake" / "s" / "good"))
    assert [(r["year"], r["month"], r["day"]) for r in rows(stored)] == [(2026, 5, 27)]
    meta = pages.latest_metadata(spark, str(tmp_path / "lake" / "s" / "_metadata"))
    assert {r["dataset"]: r["rows"] for r in rows(meta)} == {"good": 1, "bare": 0}


def test_a_failing_section_does_not_stop_the_others(spark, tmp_path):
    def broken():
        raise ValueError("boom")

    tables, errors = run_sections({"bad": broken, "fine": lambda: spark.range(2)}, str(tmp_path))
    assert set(tables) == {"fine"} and errors == {"bad": "boom"}


def test_csv_report_has_a_bom_and_one_file(spark, tmp_path):
    write_csv_report(spark.range(3).select(F.col("id").alias("n")), str(tmp_path / "r"))
    files = list((tmp_path / "r").glob("*.csv"))
    assert len(files) == 1 and files[0].read_bytes().startswith(b"\xef\xbb\xbfn\n")


def test_a_table_lands_in_the_given_number_of_files(spark, tmp_path):
    from workload.lake import _land_files

    for name, df in (("full", spark.range(0, 60, 1, 6)), ("sparse", spark.range(0, 60, 1, 6).where("id < 10")), ("one", spark.range(0, 60, 1, 6))):
        _land_files(df, str(tmp_path / name), 1 if name == "one" else 3)
    found = parquet.file_inventory(spark, str(tmp_path))
    per_folder = found.groupBy(F.element_at(F.split("path", "/"), -2).alias("name")).agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("n"))
    assert {r["name"]: (r["files"], r["n"]) for r in rows(per_folder)} == {"full": (3, 60), "sparse": (3, 10), "one": (1, 60)}


def test_a_file_path_is_decoded_once_per_file(spark, tmp_path):
    folder = str(tmp_path / "a+b c%41")
    spark.range(0, 5000, 1, 2).write.parquet(folder)
    found = parquet.file_inventory(spark, str(tmp_path))
    assert sorted((r["rows"], r["columns"]) for r in rows(found)) == [(2500, 1), (2500, 1)]
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
    # A plan lists parents first: what the lines below the counting aggregation do is done per row.
    below = plan[plan.rindex("aggregate") :].split("\n", 1)[1]
    assert "urlcodec" in plan and "urlcodec" not in below
