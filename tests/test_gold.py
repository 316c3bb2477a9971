import pytest
from helpers import rows
from pyspark.sql import functions as F

from tamiz.operators.numbering import numbered
from tamiz.plans import gold

LINES = "y string, m string, code string, name string, amount string"
DATA = [
    ("2024", "1", "a", " Lima ", "1.5"),
    ("2024", "2", "a", "lima", "2"),
    ("2025", "1", "a", "CALLAO  x", None),
    ("2025", "1", "a", "otra", "x"),
    ("2025", "13", "b", " ", "4"),
    (None, "1", "b", None, "5"),
    ("2024", "1", None, "Z", "6"),
]


@pytest.fixture
def lines(spark):
    return spark.createDataFrame(DATA, LINES)


def test_numbers_are_gapless_and_ordered(spark):
    df = spark.range(1000).selectExpr("id * 7 % 1000 AS k").repartition(9)
    out = sorted((r.n, r.k) for r in numbered(df, ["k"], "n", start=5).collect())
    assert out == [(i + 5, i) for i in range(1000)]
    assert numbered(df.where("k < 0"), ["k"], "n").collect() == []


def test_annual_totals(lines):
    found = {(r["nivel"], r["ano"], r["code"]): r for r in rows(gold.annual_totals(lines, ["code"], "y", "m", ["amount"], 2))}
    assert len(found) == 9
    assert found["entidad", 2024, "a"]["total_amount"] == 3.5 and found["entidad", 2024, "a"]["meses_con_datos"] == 2
    assert (found["ano", 2024, None]["ano_parcial"], found["ano", 2025, None]["ano_parcial"]) == (False, True)
    assert found["entidad", 2025, "b"]["meses_con_datos"] == 0 and found["entidad", None, "b"]["ano_parcial"] is True
    whole = found["total", None, None]
    assert (whole["registros"], whole["total_amount"], whole["ano_parcial"]) == (7, 18.5, None)


def test_partial_years_keep_every_row(lines):
    found = gold.mark_partial_years(lines, "y", "m", 2)
    assert found.columns[:5] == lines.columns and found.count() == len(DATA)
    assert {(r.y, r.ano_parcial) for r in found.collect()} == {("2024", False), ("2025", True), (None, None)}


def test_canonical_names(lines):
    found = {r["code"]: r for r in rows(gold.canonical_names(lines, ["code"], "name", "y"))}
    assert {k: (v["nombre_canonico"], v["ultimo_ano"]) for k, v in found.items()} == {"a": ("CALLAO X", 2025), None: ("Z", 2024)}
    joined = gold.with_canonical_names(lines, ["code"], "name", "y")
    assert joined.count() == len(DATA) and {(r.code, r.nombre_canonico) for r in joined.collect()} == {("a", "CALLAO X"), ("b", None), (None, "Z")}


def test_star_schema(lines):
    by_code = gold.Dimension("code", ("code",), attributes=("name",), latest=("y", "m"))
    star = gold.star_schema(lines, [gold.month_dimension(lines, "y", "m"), by_code], ["amount"])
    checked = {r["dimension"]: r for r in rows(gold.star_check(star))}
    assert (checked["tiempo"]["members"], checked["tiempo"]["unknown"], checked["tiempo"]["orphans"]) == (5, 1, 0)
    assert (checked["code"]["members"], checked["code"]["facts"], checked["code"]["unknown"]) == (3, 7, 1)
    members = {r["sk_code"]: (r["code"], r["name"]) for r in rows(star.dimensions["code"])}
    assert members == {0: (None, "DESCONOCIDO"), 1: ("a", "CALLAO  x"), 2: ("b", " ")}
    assert sorted(r.amount or "" for r in star.fact.collect()) == sorted(r[4] or "" for r in DATA)


def test_keys_that_collide_are_refused(lines):
    clash = gold.Dimension("code", ("code",), surrogate="1")
    with pytest.raises(ValueError, match="2 members, 1 keys"):
        gold.star_schema(lines, [clash], [])
    taken = gold.Dimension("code", ("code",), surrogate="ascii(code) - ascii('a')")
    with pytest.raises(ValueError, match="1 of them"):
        gold.star_schema(lines, [taken], [])


def test_star_of_an_empty_table(lines):
    star = gold.star_schema(lines.where("1 = 0"), [gold.Dimension("code", ("code",))], ["amount"])
    assert star.fact.count() == 0 and star.dimensions["code"].count() == 1
    assert star.dimensions["code"].where(F.col("sk_code") == 0).count() == 1
