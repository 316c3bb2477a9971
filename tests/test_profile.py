import json

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from tamiz.operators import quantiles
from tamiz.operators.quantiles import exact_quantiles
from tamiz.profile import columns as rich
from tamiz.profile import sections as s
from tamiz.rules import evaluate, rule
import datetime as dt


@pytest.fixture
def messy(spark):
    data = [("a", "1", "01/02/2020", "2020", "1"), ("a", "2", "x", "2022", "2"), (" ", "-3", None, "2022", "13"), (None, "abc", "", None, "2")]
    return spark.createDataFrame(data, "k string, m string, d string, y string, mo string")


def test_null_profile_and_rules_agree(messy):
    profile = {r["columna"]: r for r in rows(s.null_profile(messy, "t"))}
    assert (profile["k"]["nulos_reales"], profile["k"]["faltantes_like"], profile["k"]["alerta"]) == (1, 2, "REVISAR")
    detail = evaluate(messy, [rule("not_null", c) for c in messy.columns], dataset="t", as_of=dt.datetime(2026, 1, 1))
    for r in rows(detail):
        assert r["failed_rows"] == profile[r["column_name"]]["faltantes_like"]


def test_empty_table_profiles(messy):
    empty = messy.where("false")
    assert {r["alerta"] for r in rows(s.null_profile(empty, "t"))} == {"SIN_DATOS"}
    assert {r["clase"] for r in rows(s.cardinality_profile(empty, "t"))} == {"sin_datos"}
    assert rows(s.sign_profile(empty, "t", ["m"]))[0]["alerta_ceros"] == "SIN_DATOS"
    assert [r["conteo"] for r in rows(s.duplicate_profile(empty, "t", ["k"]))] == [0, 0]


def test_duplicates_count_whole_groups_for_the_business_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    exact, key = sorted(rows(s.duplicate_profile(df, "t", ["k"])), key=lambda r: r["tipo_duplicado"], reverse=True)
    assert (exact["conteo"], key["conteo"]) == (1, 3) and key["descripcion"].endswith("grupos afectados: 1")
    assert rows(s.duplicate_profile(df.repartition(3), "t", ["k"]), "tipo_duplicado") == sorted(
        [exact, key], key=lambda r: r["tipo_duplicado"]
    )


def test_temporal_summary(messy):
    found = {r["variable"]: r for r in rows(s.temporal_summary(messy, "t", {"y": (2012, 2026, False), "mo": (1, 12, True)}))}
    assert found["y"]["gaps_en_rango"] == "[2021]" and found["y"]["nulos"] == 1 and found["y"]["alerta"] == "REVISAR"
    assert found["mo"]["valores_fuera_rango_esperado"] == "[13]" and found["mo"]["gaps_en_rango"].startswith("[3..")


def test_a_garbled_year_gives_one_range(spark):
    df = spark.createDataFrame([("2020",), ("20240101",), (None,)], "y string")
    found = rows(s.temporal_summary(df, "t", {"y": (2012, 2026, False)}))[0]
    assert found["gaps_en_rango"] == "[2021..20240100]"
    assert found["valores_fuera_rango_esperado"] == "[20240101]" and found["nulos"] == 1


def test_gaps_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        values = sorted({(i * i) % 997 * 3 for i in range(400)} | {5000})
        df = spark.createDataFrame([(v, v % 7 + 1, None) for v in values], "a long, b long, c long")
        found = s.temporal_gaps(df, {"a": (0, 4000, False), "b": (0, 9, True), "c": (1, 2, True), "ghost": (1, 2, True)})
        got = {(r.variable, r.kind, r.first, r.last, r.n) for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    between = {("a", "gap", x + 1, y - 1, y - x - 1) for x, y in zip(values, values[1:]) if y > x + 1}
    assert got == between | {("a", "stray", 5000, 5000, 1), ("b", "gap", 0, 0, 1), ("b", "gap", 8, 9, 2), ("c", "gap", 1, 2, 2)}
    assert "collect_list" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_listed_gaps_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(s, "LISTED", 2)
    df = spark.createDataFrame([(v,) for v in (1, 3, 5, 7, 9)], "a long")
    assert rows(s.temporal_summary(df, "t", {"a": (1, 8, False)}))[0]["gaps_en_rango"] == "[2, 4] y 2 más"


def test_evolution_and_signs(messy):
    years = {r["ano"]: r for r in rows(s.yearly_evolution(messy, "t", "y", "mo", "m"))}
    assert years[2022]["registros"] == 2 and years[2022]["sum_monto"] == -1.0 and years[2022]["meses_con_datos"] == 2
    assert years[0]["registros"] == 1
    signs = rows(s.sign_profile(messy, "t", ["m", "ghost"]))[0]
    assert (signs["negativos"], signs["positivos"], signs["nulos"]) == (1, 2, 1)


def test_consistency_counts_codes_with_several_names(spark):
    df = spark.createDataFrame([("1", "x"), ("1", "y"), ("2", "z"), (None, "z"), ("2", None)], "c string, n string")
    found = rows(s.consistency_profile(df, "t", [("c", "n"), ("c", "ghost")]))
    assert [(r["cardinalidad_codigo"], r["cardinalidad_nombre"], r["codigos_con_multiples_nombres"]) for r in found] == [(2, 3, 1)]


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in "ccbbad"], "x string")
    top = rows(s.top_values(s.value_counts(df, ["x"]), 3), "rank")
    assert [(r["value"], r["n"]) for r in top] == [("b", 2), ("c", 2), ("a", 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_match_numpy_with_a_hot_value(spark, seed):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.lognormal(size=2000), np.full(1000, 1.0), rng.normal(size=5)])
    df = spark.createDataFrame([("g", float(v)) for v in x] + [("one", 4.0)], "g string, v double")
    counts = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    probabilities = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)
    want = np.quantile(x, probabilities)
    for bucket in (1 << 20, 300, 2):
        got = {r["g"]: r["quantiles"] for r in exact_quantiles(counts, "g", "v", "n", probabilities, bucket=bucket).collect()}
        assert np.allclose(got["g"], want) and np.allclose(got["one"], [4.0] * 7)


def test_quantile_ranges_are_bounded(spark, monkeypatch):
    """What the last step ranks never has more distinct values than a task is meant to rank."""
    seen = []
    ranked = quantiles._ranked
    monkeypatch.setattr(quantiles, "_ranked", lambda stored, group, wanted: seen.append([w["size"] for w in wanted]) or ranked(stored, group, wanted))
    counts = spark.range(50_000).selectExpr("'g' AS g", "CAST(id * id AS DOUBLE) AS v", "1L + id % 3 AS n")
    got = exact_quantiles(counts, "g", "v", "n", (0.25, 0.999), bucket=500).first()["quantiles"]
    values = np.repeat(np.arange(50_000.0) ** 2, 1 + np.arange(50_000) % 3)
    assert np.allclose(got, np.quantile(values, (0.25, 0.999))) and max(seen[0]) <= 500


def test_a_group_without_values_has_no_quantiles(spark):
    counts = spark.createDataFrame([("g", None, 3)], "g string, v double, n long")
    assert exact_quantiles(counts, "g", "v", "n", (0.5,)).collect() == []


def test_rich_profile_of_one_column(spark):
    df = spark.createDataFrame([(v,) for v in ["10", "20", " 20 ", "30", "1000", "", None, "n"]], "x string")
    one = rows(rich.column_profile(df, "t"))[0]
    assert (one["row_count"], one["null_count"], one["empty_string_count"], one["missing_like_count"]) == (8, 1, 2, 2)
    assert (one["unique_count"], one["numeric_valid_count"], one["min_length"], one["max_length"]) == (5, 5, 1, 4)
    assert (one["q1"], one["q3"], one["outlier_count_iqr"]) == (20.0, 30.0, 1)
    assert one["sample_values"] == '["10","1000","20","30","n"]' and one["top_values"].startswith('{"20":2,')


def test_long_texts_are_shown_whole(spark):
    long = ["x" * 100, "x" * 100 + "y", "x" * 100]
    df = spark.createDataFrame([(v, "1" + "0" * 70) for v in [*long, "a"]], "t string, number string")
    found = {r["column_name"]: r for r in rows(rich.column_profile(df, "t"))}
    text, number = found["t"], found["number"]
    assert json.loads(text["top_values"]) == {"x" * 100: 2, "a": 1, "x" * 100 + "y": 1} and text["unique_count"] == 3
    assert sorted(json.loads(text["sample_values"])) == sorted({*long, "a"}) and text["max_length"] == 101
    assert number["numeric_valid_count"] == 4 and number["q1"] == 1e70 and json.loads(number["sample_values"]) == ["1" + "0" * 70]


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        (["", None], "empty_or_null"),
        (["S", "n", "si"], "categorical_indicator"),
        (["5", "7.0"], "integer"),
        (["5", "7.5"], "decimal"),
        (["1/2/2020", "3/4/2021"], "datetime_or_date"),
        (["a@b.pe", "c@d.com"], "email"),
        (["red"] * 20 + ["blue"] * 20, "categorical_text"),
        (["red", "blue"], "text"),
    ],
)
def test_type_inference(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    assert rows(rich.infer_types(df))[0]["inferred_type"] == expected


def test_wide_table_profile(spark):
    names = [f"P19_{i}" for i in range(160)]
    df = spark.range(30).selectExpr(*[f"CAST((id * {i}) % 5 AS STRING) AS {n}" for i, n in enumerate(names)])
    assert s.null_profile(df, "t").count() == 160
    found = {r["column_name"]: r["unique_count"] for r in rows(rich.column_profile(df, "t"))}
    assert len(found) == 160 and found["P19_0"] == 1 and found["P19_1"] == 5


def test_an_exact_generic_profile_counts_each_column_by_itself(messy):
    exact = s.generic_profile(messy, exact=True)
    assert "Expand" not in exact._jdf.queryExecution().optimizedPlan().toString()
    found = {r["Columna"]: r for r in rows(exact)}
    assert {c: r["Cardinalidad_Aprox"] for c, r in found.items()} == {"k": 2, "m": 4, "d": 3, "y": 2, "mo": 3}
    assert (found["k"]["Nulos"], found["k"]["Min"], found["k"]["Max"], found["k"]["Total_Filas"]) == (1, " ", "a", 4)
    empty = rows(s.generic_profile(messy.where("false"), exact=True))
    assert [(r["Cardinalidad_Aprox"], r["Total_Filas"]) for r in empty] == [(0, 0)] * 5
