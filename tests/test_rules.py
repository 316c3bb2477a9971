import datetime as dt
import json
import operator
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tamiz.rules import evaluate, failed_set_samples, rule
from tamiz.rules.evaluate import COUNTERS_PER_PASS, _passes, compile_rules
from tamiz.rules.ledger import ledger_rules
from tamiz.rules.reports import dimension_cards, quality_summary, run_totals, severity_summary, top_alerts
from tamiz.rules.survey import columns_by_name, survey_rules

AS_OF = dt.datetime(2026, 6, 1)

LEDGER = "id int, level string, sector string, code string, name string, year string, month string, pia string, pim string, gen string, sub string"
DATA = [
    (1, "M", " ", "001", "X", "2024", "1", "0", "10", "1", "2"),
    (2, "R", " ", "001", "Y", "2024", "2", "0.50", "0.20", "0", "3"),
    (3, "R", "05", "002", "Z", "2099", "13", "5", "7", "1", "0"),
    (4, None, None, "002", "Z", "24", "7.5", "abc", "1", "1", "1"),
    (5, "Q", "05", " ", "Z", "2024.0", "12", "-1", "-2", "x", "4"),
    (5, "Q", "05", " ", "Z", "2024.0", "12", "-1", "-2", "x", "4"),
]


@pytest.fixture
def ledger(spark):
    return spark.createDataFrame(DATA, LEDGER)


def outcome(df, *rules, **options):
    found = rows(evaluate(df, rules, dataset="t", as_of=AS_OF, **options), "rule_id")
    return {r["rule_id"]: (r["evaluated_rows"], r["failed_rows"]) for r in found}


@pytest.mark.parametrize(
    ("declared", "expected"),
    [
        (rule("not_null", "sector"), (6, 3)),
        (rule("null_threshold", "sector", threshold_pct=60), (6, 0)),
        (rule("null_threshold", "sector", threshold_pct=40), (6, 3)),
        (rule("conditional_null_allowed", "sector", "level", condition_value="M"), (4, 1)),
        (rule("accepted_values", "level", values=["M", "R"]), (5, 2)),
        (rule("numeric_type", "pia"), (6, 1)),
        (rule("accepted_range", "pia", min_value=0, max_value=4), (6, 4)),
        (rule("accepted_range", "month", min_value=1, max_value=12), (6, 1)),
        (rule("regex", "year", pattern=r"^\d{4}$"), (6, 3)),
        (rule("regex", "code", pattern=r"^\d{3}$", skip_when=("level", "M")), (2, 0)),
        (rule("year_4_digits", "year"), (6, 1)),
        (rule("year_not_future", "year"), (6, 1)),
        (rule("month_period_between", "month"), (6, 1)),
        (rule("non_negative", "pia"), (6, 3)),
        (rule("conditional_value", "level", "code", condition_value="R", expected_value="001"), (2, 1)),
        (rule("column_comparison", "pim", "pia", operator=">="), (6, 3)),
        (rule("column_comparison", "pim", "pia", operator=">=", filter_condition="pia > 0"), (2, 1)),
        (rule("less_or_equal", "pia", "pim"), (6, 4)),
        (rule("parent_not_zero_if_child_nonzero", "gen", "sub"), (5, 1)),
        (rule("duplicate_full_rows"), (6, 1)),
        (rule("unique_key", "code"), (6, 3)),
        (rule("code_name_consistency", "code", "name"), (4, 2)),
        (rule("cardinality_check", "code", limit=1), (2, 1)),
        (rule("cardinality_upper_bound", "code", limit=9), (2, 0)),
        (rule("temporal_coverage_check", "year", "month", expected_months=2, exception_years=[2099]), (3, 1)),
    ],
    ids=lambda v: getattr(v, "rule_type", ""),
)
def test_rule_counts(ledger, declared, expected):
    assert list(outcome(ledger, declared).values()) == [expected]


def test_a_fraction_below_one_passes_a_sql_prefilter(ledger):
    """Row 2 has 0.50 > 0; compared as integers it would be lost."""
    found = outcome(ledger.where("id = 2"), rule("column_comparison", "pim", "pia", operator=">=", filter_condition="pia > 0"))
    assert list(found.values()) == [(1, 1)]


def test_absent_column_scores_zero_over_one_row(ledger):
    found = rows(evaluate(ledger, [rule("not_null", "ghost")], dataset="t", as_of=AS_OF))[0]
    assert (found["evaluated_rows"], found["failed_rows"], found["score"]) == (1, 1, 0.0)


def test_nothing_evaluable(ledger):
    empty = ledger.where("id < 0")
    every = [rule("not_null", "level"), rule("numeric_type", "pia"), rule("duplicate_full_rows"), rule("code_name_consistency", "code", "name")]
    for found in rows(evaluate(empty, every, dataset="t", as_of=AS_OF)):
        assert (found["evaluated_rows"], found["score"], found["status"]) == (0, None, "No evaluable")


def test_unknown_rule_types_and_operators_are_refused(ledger):
    with pytest.raises(ValueError, match="unknown rule type"):
        evaluate(ledger, [rule("no_such_rule", "level")], dataset="t", as_of=AS_OF)
    with pytest.raises(ValueError, match="unknown operator"):
        evaluate(ledger, [rule("column_comparison", "pia", "pim", operator="~")], dataset="t", as_of=AS_OF)


def test_more_than_500_ambiguous_codes_all_count(spark):
    df = spark.range(2000).selectExpr("CAST(id % 1000 AS STRING) AS code", "CAST(id AS STRING) AS name")
    assert list(outcome(df, rule("code_name_consistency", "code", "name")).values()) == [(2000, 2000)]


def test_repeated_keys_with_nulls(spark):
    df = spark.range(900).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE id % 500 END AS k", "CAST(id % 2 AS STRING) AS v")
    found = outcome(df, rule("duplicate_full_rows"), rule("unique_key", "k"))
    seen = [(r.k, r.v) for r in df.collect()]
    assert list(found.values()) == [(900, 900 - len(set(seen))), (900, 900 - len({k for k, _ in seen}))]
    # A NULL in one column is not a NULL in the other.
    swapped = spark.createDataFrame([("a", None), (None, "a"), (None, "a"), (None, None)], "k string, v string")
    assert list(outcome(swapped, rule("duplicate_full_rows")).values()) == [(4, 1)]


def test_set_rules_are_sampled(spark):
    data = [(i, i % 7, "x" if i % 2 else "y", str(i % 3)) for i in range(40)] + [(99, None, "x", "9"), (98, 8, " ", "9")]
    df = spark.createDataFrame(data, "id int, k int, name string, ref string")
    parent = spark.createDataFrame([("0",), ("1",)], "code string")
    declared = [
        rule("unique_key", "k", rule_id="key"),
        rule("duplicate_full_rows", rule_id="rows"),
        rule("code_name_consistency", "k", "name", rule_id="pair"),
        rule("referential_integrity", "ref", reference_dataset="p", reference_columns=("code",), rule_id="ref"),
        rule("cardinality_upper_bound", "k", limit=2, verdicts=("", ""), rule_id="many"),
        rule("not_null", "k", rule_id="null"),
    ]
    found = rows(evaluate(df, declared, dataset="t", as_of=AS_OF, sample_key=["id"], max_samples=3, catalog={"p": parent}), "rule_id")
    samples = {r["rule_id"]: json.loads(r["sample_failed_rows"]) for r in found}
    assert samples["key"] == [{"k": "0"}, {"k": "1"}, {"k": "2"}]
    assert samples["rows"] == samples["many"] == []
    assert samples["pair"] == [{"k": "0", "name": "y"}, {"k": "1", "name": "x"}, {"k": "2", "name": "y"}]
    assert samples["ref"] == [{"ref": "2"}, {"ref": "2"}, {"ref": "2"}]
    assert samples["null"] == [{"k": ""}]
    twice = evaluate(df.unionByName(df), declared[1:2], dataset="t", as_of=AS_OF, sample_key=["id"], max_samples=2).first()
    assert (twice.failed_rows, json.loads(twice.sample_failed_rows)) == (42, [{"id": "0"}, {"id": "1"}])


def test_a_hot_key_is_sampled_within_each_task(spark):
    df = spark.range(30000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k")
    rules = [(0, rule("unique_key", "k"))]
    picked = failed_set_samples(df, rules, ["id"], 4)
    assert "WindowGroupLimit" in picked._jdf.queryExecution().executedPlan().toString()
    assert [r.rank for r in sorted(picked.collect())] == [1, 2, 3, 4] and {r.values["k"] for r in picked.collect()} == {"-1"}


def test_short_years_beyond_the_listed_ones_are_counted(spark, monkeypatch):
    monkeypatch.setattr("tamiz.rules.sets.LISTED", 2)
    df = spark.range(2000, 2005).selectExpr("CAST(id AS STRING) AS y", "'1' AS m")
    declared = rule("temporal_coverage_check", "y", "m", expected_months=2, observation="{0}")
    assert evaluate(df, [declared], dataset="t", as_of=AS_OF).first().observation == (
        "[{'ano': 2000, 'n_meses': 1}, {'ano': 2001, 'n_meses': 1}] y 3 más"
    )


def test_whole_numbers_are_compared_exactly(spark):
    big = 2**53
    data = [(big + 1, big, float(big), Decimal(big), "x"), (big, big + 1, float(big), Decimal(big + 1), "y"), (3, 3, 3.5, Decimal("3.5"), "z")]
    df = spark.createDataFrame(data, "a long, b long, d double, e decimal(20,1), s string")
    ops = {op: rule("column_comparison", "a", "b", operator=op, rule_id=op) for op in ("<=", ">=", "<", ">", "==", "!=")}
    assert {k: v[1] for k, v in outcome(df, *ops.values()).items()} == {"<=": 1, ">=": 1, "<": 2, ">": 2, "==": 2, "!=": 1}
    for other in ("d", "e"):
        mixed = [rule("column_comparison", "a", other, operator=op, rule_id=op) for op in ops]
        flipped = [rule("column_comparison", other, "a", operator=op, rule_id=op) for op in ops]
        for declared, swap in ((mixed, False), (flipped, True)):
            pairs = [(r[0], r[2 if other == "d" else 3]) for r in data]
            pairs = [(Decimal(y), x) if swap else (x, Decimal(y)) for x, y in pairs]
            does = {"<=": operator.le, ">=": operator.ge, "<": operator.lt, ">": operator.gt, "==": operator.eq, "!=": operator.ne}
            want = {op: sum(not does[op](x, y) for x, y in pairs) for op in ops}
            assert {k: v[1] for k, v in outcome(df, *declared).items()} == want
    nan = spark.createDataFrame([(1, float("inf")), (1, -1e300), (1, 0.5)], "a long, d double")
    assert list(outcome(nan, rule("less_or_equal", "a", "d")).values()) == [(3, 2)]
    ranged = [rule("accepted_range", c, min_value=0, max_value=big, rule_id=c) for c in "abde"]
    assert {k: v[1] for k, v in outcome(df, *ranged).items()} == {"a": 1, "b": 1, "d": 0, "e": 1}
    assert list(outcome(df, rule("accepted_range", "a", min_value=3.5)).values()) == [(3, 1)]


def test_coverage_lists_short_years(spark):
    df = spark.createDataFrame([("2020", "1"), ("2021", "1"), ("2021", "2"), ("x", "1")], "y string, m string")
    declared = rule("temporal_coverage_check", "y", "m", expected_months=2, observation="{0}")
    found = rows(evaluate(df, [declared], dataset="t", as_of=AS_OF))[0]
    assert (found["evaluated_rows"], found["failed_rows"]) == (3, 2) and "{'ano': 2020, 'n_meses': 1}" in found["observation"]


def test_hot_key_reference(spark):
    """A third of the rows share one key that the parent lacks."""
    child = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 50 AS STRING) END AS k")
    parent = spark.range(50).selectExpr("concat(' ', id, ' ') AS k")
    declared = rule("referential_integrity", "k", reference_dataset="p", reference_columns=["k"])
    assert list(outcome(child, declared, catalog={"p": parent}).values()) == [(9000, 3000)]


def test_catalog_keys_ignore_a_trailing_zero_fraction(spark):
    child = spark.createDataFrame([("2024.0", "1"), ("2024", "2"), (None, "1")], "y string, p string")
    parent = spark.createDataFrame([("2024", "1"), ("2024|1", "")], "y string, p string")
    declared = rule("temporal_catalog_exists", "y", "p", reference_dataset="c", reference_columns=["y", "p"])
    assert list(outcome(child, declared, catalog={"c": parent}).values()) == [(2, 1)]


def test_samples_are_bounded_ordered_and_only_for_failures(ledger):
    declared = [rule("numeric_type", "pia"), rule("not_null", "id"), rule("accepted_values", "level", values=["M"])]
    found = rows(evaluate(ledger, declared, dataset="t", as_of=AS_OF, sample_key=["id"], max_samples=2), "rule_id")
    samples = {r["rule_id"]: json.loads(r["sample_failed_rows"]) for r in found}
    assert samples["pia.numeric_type"] == [{"pia": "abc"}]
    assert samples["id.not_null"] == []
    assert samples["level.accepted_values"] == [{"level": "R"}, {"level": "R"}]


def test_many_rules_are_cut_into_passes(spark):
    names = [f"c{i}" for i in range(120)]
    df = spark.range(20).selectExpr(*[f"CASE WHEN id % 7 = 0 THEN ' ' ELSE CAST(id AS STRING) END AS {c}" for c in names])
    declared = [rule("non_negative", c, integer=True) for c in names] + [rule("not_null", c) for c in names]
    _, checks = compile_rules(df, list(enumerate(declared)), AS_OF)
    passes = _passes(checks)
    assert len(passes) > 2 and sum(len(p) for p in passes) == 240
    assert all(1 + len(p) + len({c.evaluable for _, _, c in p}) <= COUNTERS_PER_PASS + 2 for p in passes)
    found = outcome(df, *declared)
    assert found["c7.not_null"] == (20, 3) and found["c119.non_negative"] == (17, 0)


def test_passed_plus_failed_is_evaluated(ledger):
    every = [rule("not_null", c) for c in ledger.columns] + [rule("numeric_type", c) for c in ledger.columns]
    for r in rows(evaluate(ledger, every, dataset="t", as_of=AS_OF)):
        assert r["passed_rows"] + r["failed_rows"] == r["evaluated_rows"]


def test_names_outside_ascii(spark):
    df = spark.createDataFrame([("2022",), ("x",)], "`Año` string").withColumnRenamed("Año", "Año `raro`")
    assert list(outcome(df, rule("regex", "Año `raro`", pattern=r"^\d{4}$")).values()) == [(2, 1)]


def test_reports(spark):
    columns = "dataset string, dimension string, rule_id string, severity string, evaluated_rows bigint, failed_rows bigint, score double"
    detail = spark.createDataFrame(
        [
            ("d", "Validez", "a", "Alta", 10, 5, 50.0),
            ("d", "Validez", "b", "Media", 0, 0, None),
            ("d", "Unicidad", "c", "Baja", 10, 1, 90.0),
            ("d", "Conformidad", "e", "Baja", 10, 0, 100.0),
        ],
        columns,
    )
    one = rows(quality_summary(detail))[0]
    assert (one["score_validez"], one["score_unicidad"], one["score_conformidad"]) == (50.0, 90.0, 100.0)
    assert one["score_general"] == 80.0 and one["score_integridad"] is None and one["observations_total"] == 6
    assert rows(quality_summary(detail, ["Validez", "Unicidad"]))[0]["score_general"] == 70.0
    assert [r["severity"] for r in severity_summary(detail).collect()] == ["Alta", "Baja"]
    assert [r["rule_id"] for r in top_alerts(detail, 1).collect()] == ["a"]
    cards = {r["dimension"]: r for r in rows(dimension_cards(detail))}
    assert cards["Integridad"]["status"] == "No evaluable" and cards["Validez"]["rules"] == 2
    assert rows(run_totals(detail))[0]["status"] == "warning"


def test_ledger_file_reads_every_section_by_rule_type():
    config = {
        "settings": {"source": "s"},
        "validez": {"tipo": {"rule_type": "not_null", "column": "T", "severity": "Baja"}},
        "exactitud": {"anio": {"rule_type": "regex", "column": "Y", "pattern": "x"}},
        "oportunidad": {"mes": {"rule_type": "accepted_range", "column": "M", "min_value": 1, "max_value": 12}},
    }
    built = ledger_rules(config, 2026)
    assert [r.rule_id for r in built] == ["s.T.not_null", "s.Y.regex", "s.M.range"]
    assert [r.dimension for r in built] == ["Validez", "Conformidad", "Oportunidad"]
    assert built[2].expected_value == "[1, 12]"
    config["validez"]["otra"] = {"rule_type": "surprise", "column": "T"}
    with pytest.raises(ValueError, match="surprise"):
        ledger_rules(config, 2026)


def test_survey_file_order_and_name_patterns():
    columns = ["ANO_X", "ANO_DESC", "MON_A", "NUM_B", "UBIGEO"]
    assert columns_by_name(columns, {"startswith": ["ANO_"], "skip_contains": ["DESC"]}) == ["ANO_X"]
    config = {
        "global_rules": {
            "pattern_rules": {
                "ubigeo": {"enabled": True, "exact_columns": ["UBIGEO"], "regex": "^x$"},
                "off": {"enabled": False, "contains": ["A"]},
            }
        },
        "datasets": {"d": {"required_columns": {"columns": ["MON_A"]}, "unique_keys": [{"columns": ["ANO_X", "MON_A"]}]}},
        "referential_integrity": [{"dataset": "d", "column": "MON_A", "reference_dataset": "e", "reference_column": "K"}],
    }
    built = survey_rules(config, "d", columns, AS_OF)
    assert [r.rule_id for r in built] == [
        "d.full_row_duplicates",
        "d.MON_A.required",
        "d.unique_key.ANO_X+MON_A",
        "d.UBIGEO.ubigeo",
        "d.MON_A.ref_integrity",
    ]


def test_a_pass_has_few_enough_conditions_for_the_jvm_to_compile(spark):
    names = [f"c{i}" for i in range(20)]
    df = spark.range(5).selectExpr(*[f"CAST(id AS STRING) AS {c}" for c in names])
    _, checks = compile_rules(df, [(i, rule("accepted_range", c, min_value=0, max_value=9)) for i, c in enumerate(names)], AS_OF)
    assert max(len(p) for p in _passes(checks)) <= 8


def test_set_samples_look_at_few_rows(spark):
    """Only rows that may be shown are read whole: those up to the last wanted one, and those of a rule's few keys."""
    met = spark.sparkContext.accumulator(0)

    def seen(x):
        met.add(1)
        return x

    ids = spark.range(4000, numPartitions=4).selectExpr("id", "id div 2 AS pair", "IF(id % 1000 = 7, 'x', 'y') AS code", "id % 2 AS name")
    df = ids.withColumn("extra", F.udf(seen, "long")("id"))
    rules = [
        (0, rule("unique_key", "pair", sample_columns=("id",))),
        (1, rule("referential_integrity", "code", reference_dataset="p", reference_columns=("code",), sample_columns=("id",))),
    ]
    parent = spark.createDataFrame([("y",)], "code string")
    picked = failed_set_samples(df, rules, ["id"], 3, catalog={"p": parent}).collect()
    assert sorted((r.pos, r["values"]["id"]) for r in picked) == [(0, "1"), (0, "3"), (0, "5"), (1, "1007"), (1, "2007"), (1, "7")]
    assert 0 < met.value < 100


@pytest.mark.parametrize("limit", [1, 2, 3, 50])
def test_set_samples_by_a_column_with_nulls_and_ties(spark, limit):
    """The first failing rows are those of a plain ranking, wherever a key's rows stand in the order."""
    data = [(i, None if i % 5 == 0 else (i * 37) % 11, f"k{(i * 7) % 9}" if i % 4 else f"z{i}", f"c{i % 3}", f"n{i % 6 if i % 3 else 0}") for i in range(60)]
    df = spark.createDataFrame(data, "id long, at long, key string, code string, name string").repartition(3)
    rules = [
        (0, rule("unique_key", "key", sample_columns=("id",))),
        (1, rule("code_name_consistency", "code", "name", sample_columns=("id",))),
        (2, rule("referential_integrity", "code", reference_dataset="p", reference_columns=("code",), sample_columns=("id",))),
    ]
    parent = spark.createDataFrame([("c1",)], "code string")
    ordered = sorted(data, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    earlier = set()
    repeated = [r[0] for r in ordered if r[2] in earlier or earlier.add(r[2])]
    names = {c: {r[4] for r in data if r[3] == c} for c in ("c0", "c1", "c2")}
    several = [r[0] for r in ordered if len(names[r[3]]) > 1]
    lost = [r[0] for r in ordered if r[3] != "c1"]
    want = [(pos, i + 1, str(x)) for pos, found in enumerate((repeated, several, lost)) for i, x in enumerate(found[:limit])]
    picked = failed_set_samples(df, rules, ["at", "id"], limit, catalog={"p": parent}).collect()
    assert sorted((r.pos, r["rank"], r["values"]["id"]) for r in picked) == sorted(want)
