"""From declared rules to the scored result table, in as few scans as the rules allow.

All row rules of a table are counters of the same aggregation. Aggregations wider than Spark will compile are
cut into passes; the rules are ordered by the columns they read, so the passes together read each column about once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.missing import RULE_TOKENS
from tamiz.functions.text import column, literal, quoted
from tamiz.rules.model import (
    RESULT_COLUMNS,
    STATUS_CLEAN,
    STATUS_NOT_EVALUABLE,
    STATUS_OBSERVED,
    Rule,
)
from tamiz.rules.row import EVERY_ROW, ROW_RULES, RowCheck, RowContext, bind_filters
from tamiz.rules.sets import SAMPLED_RULES, SET_RULES, UNIQUE_RULES, evaluate_sets, failed_set_rows, key_counts, leading
from tamiz.session import literal_rows, written_once

# Counters per pass. The conditions of a pass become one generated method, and the JVM interprets methods beyond 8000 bytes.
COUNTERS_PER_PASS = 16
SAMPLES_PER_RULE = 10
FULL_ROWS = "duplicate_full_rows"

_META = (
    "dimension string, rule_id string, rule_name string, column_name string, rule_type string, "
    "expected_value string, severity string, source string, observation string"
)


def _texts(df: DataFrame, rules: Sequence[Rule], catalog: Mapping[str, DataFrame]) -> tuple[list, list, list]:
    """Split numbered rules into row rules, set rules and those whose columns are absent."""
    row, sets, absent = [], [], []
    for pos, rule in enumerate(rules):
        if rule.rule_type not in ROW_RULES and rule.rule_type not in SET_RULES:
            raise ValueError(f"unknown rule type: {rule.rule_type!r} ({rule.rule_id})")
        gone = [c for c in rule.columns if c not in df.columns]
        if rule.param("reference_dataset") is not None:
            parent = catalog.get(rule.param("reference_dataset"))
            if parent is None:
                raise KeyError(f"{rule.rule_id}: no table {rule.param('reference_dataset')!r} in the catalog")
            gone += [c for c in rule.param("reference_columns") if c not in parent.columns]
        if gone:
            absent.append((pos, rule))
        elif rule.rule_type in ROW_RULES:
            row.append((pos, rule))
        else:
            sets.append((pos, rule))
    return row, sets, absent


def _passes(checks: Sequence[tuple[int, Rule, RowCheck]]) -> list[list[tuple[int, Rule, RowCheck]]]:
    ordered = sorted(checks, key=lambda c: (c[1].columns, c[0]))
    passes: list[list] = [[]]
    seen = {EVERY_ROW}
    used = 1
    for item in ordered:
        evaluable = item[2].evaluable
        cost = 1 + (evaluable not in seen)
        if used + cost > COUNTERS_PER_PASS and passes[-1]:
            passes.append([])
            seen, used = {EVERY_ROW}, 1
            cost = 1 + (evaluable not in seen)
        passes[-1].append(item)
        seen.add(evaluable)
        used += cost
    return [p for p in passes if p]


def _one_pass(df: DataFrame, checks: Sequence[tuple[int, Rule, RowCheck]]) -> DataFrame:
    """One aggregation over the table, turned into one row per rule."""
    counters = {EVERY_ROW: "n_rows"}
    for _, _, check in checks:
        counters.setdefault(check.evaluable, f"e{len(counters)}")
    outputs = []
    for pos, rule, check in checks:
        evaluated, failed = counters[check.evaluable], f"f{pos}"
        facts = f"array(format_number({failed}, 0))"
        if rule.rule_type == "null_threshold":
            share = f"CASE WHEN {evaluated} > 0 THEN {failed} / {evaluated} * 100 ELSE 0D END"
            over = f"({share}) > {float(rule.param('threshold_pct'))!r}D"
            verdict = f"CASE WHEN {over} THEN 'Superado — revisar.' ELSE 'Dentro del umbral esperado.' END"
            facts = f"array(format_string('%.4f', {share}), {verdict})"
            failed = f"CASE WHEN {over} THEN {failed} ELSE 0L END"
        outputs.append(f"named_struct('pos', {pos}, 'evaluated', {evaluated}, 'failed', {failed}, 'facts', {facts})")
    evaluated = [f"count_if({ok}) AS {name}" for ok, name in counters.items()]
    failures = [f"count_if({check.failed}) AS f{pos}" for pos, _, check in checks]
    return df.agg(*[F.expr(c) for c in (*evaluated, *failures)]).selectExpr(f"inline(array({', '.join(outputs)}))")


def failed_samples(
    df: DataFrame,
    checks: Sequence[tuple[int, Rule, RowCheck]],
    order_by: Sequence[str],
    limit: int = SAMPLES_PER_RULE,
) -> DataFrame:
    """Up to `limit` failing rows per rule, in key order: (pos, rank, values MAP).

    One scan for all rules. The limit is applied inside each map task before the shuffle (Spark's window group
    limit), so a rule that fails everywhere still moves only `limit` rows per task.
    """
    wanted = sorted({c for _, r, _ in checks for c in r.sample_columns if c in df.columns} | set(order_by))
    hits = ", ".join(f"CASE WHEN {check.failed} THEN {pos} END" for pos, _, check in checks)
    rows = df.select(F.expr(f"explode(array({hits}))").alias("pos"), *[column(c) for c in wanted]).where("pos IS NOT NULL")
    keys = ", ".join(quoted(k) for k in order_by)
    ranked = rows.withColumn("rank", F.expr(f"row_number() over (partition by pos order by {keys})"))
    return _shown(ranked.where(F.col("rank") <= limit), [(pos, rule) for pos, rule, _ in checks])


def _shown(ranked: DataFrame, rules: Sequence[tuple[int, Rule]], otherwise: Sequence[str] = ()) -> DataFrame:
    """(pos, rank, values MAP) from (pos, rank, columns); a rule without sample columns shows those of `otherwise`."""
    named = {pos: [c for c in rule.sample_columns or otherwise if c in ranked.columns] for pos, rule in rules}
    shown = ", ".join(f"{pos}, array({', '.join(map(literal, names))})" for pos, names in named.items() if names)
    held = sorted({c for names in named.values() for c in names})
    values = ", ".join(f"{literal(c)}, coalesce(CAST({quoted(c)} AS STRING), '')" for c in held)
    picked = f"map_from_entries(transform(map({shown})[pos], c -> struct(c, map({values})[c])))"
    return ranked.select("pos", "rank", F.expr(picked).alias("values"))


def failed_set_samples(
    df: DataFrame, rules: Sequence[tuple[int, Rule]], order_by: Sequence[str], limit: int = SAMPLES_PER_RULE, **options
) -> DataFrame:
    """The same for set rules (see `failed_set_rows`); full-row duplicates show the columns of `order_by`."""
    ranked = failed_set_rows(df, rules, order_by, limit, **options)
    return _shown(ranked, [(p, r) for p, r in rules if r.rule_type in SAMPLED_RULES], order_by)


def compile_rules(
    df: DataFrame, rules: Sequence[tuple[int, Rule]], as_of: dt.datetime, tokens: Sequence[str] = RULE_TOKENS
) -> tuple[DataFrame, list[tuple[int, Rule, RowCheck]]]:
    """Row rules as conditions, with the frame they are conditions on."""
    bound, filters = bind_filters(df, [r for _, r in rules])
    ctx = RowContext(bound, as_of, tuple(tokens), filters)
    return bound, [(pos, rule, ROW_RULES[rule.rule_type](ctx, rule)) for pos, rule in rules]


def evaluate(
    df: DataFrame,
    rules: Sequence[Rule],
    *,
    dataset: str,
    as_of: dt.datetime,
    tokens: Sequence[str] = RULE_TOKENS,
    catalog: Mapping[str, DataFrame] | None = None,
    sample_key: Sequence[str] | None = None,
    max_samples: int = SAMPLES_PER_RULE,
) -> DataFrame:
    """The quality detail of one table: one row per rule, in the fixed result columns.

    Failing rows are sampled only when `sample_key` names the columns that order them; the keys of the uniqueness rules are
    then counted once, in a job of its own, for their figures and their samples.
    """
    if not rules:
        return _empty(df)
    catalog = dict(catalog or {})
    row, sets, absent = _texts(df, rules, catalog)
    sampled = bool(sample_key) and max_samples > 0
    set_shown = [(p, r) for p, r in sets if r.rule_type in SAMPLED_RULES and (r.sample_columns or r.rule_type == FULL_ROWS)] if sampled else []
    unique = [(p, r) for p, r in sets if r.rule_type in UNIQUE_RULES]
    repeats_shown = any(r.rule_type in UNIQUE_RULES for _, r in set_shown)
    counts = written_once(key_counts(df, unique, leading(df, sample_key)), "keys") if repeats_shown else None
    bound, checks = compile_rules(df, row, as_of, tokens)
    parts = [_one_pass(bound, chunk) for chunk in _passes(checks)] if checks else []
    parts += evaluate_sets(df, sets, tokens, catalog, counts)
    if absent:
        missing_rows = [{"pos": pos, "evaluated": 1, "failed": 1, "facts": []} for pos, _ in absent]
        parts.append(
            literal_rows(df.sparkSession, missing_rows, "pos int, evaluated bigint, failed bigint, facts array<string>")
        )
    tallies = reduce(DataFrame.unionByName, parts)
    absent_at = {pos for pos, _ in absent}
    result = _assemble(tallies, rules, absent_at, dataset)
    shown = [c for c in checks if c[1].sample_columns] if sampled else []
    samples = [failed_samples(bound, shown, sample_key, max_samples)] if shown else []
    if set_shown:
        repeated = None if counts is None else counts.where("n > 1")
        samples.append(failed_set_samples(df, set_shown, sample_key, max_samples, tokens=tokens, catalog=catalog, counts=repeated))
    if samples:
        as_json = reduce(DataFrame.unionByName, samples).groupBy("pos").agg(
            F.sort_array(F.collect_list(F.struct("rank", F.to_json("values").alias("row")))).alias("s")
        )
        as_json = as_json.select(
            "pos", F.concat(F.lit("["), F.array_join(F.transform("s", lambda r: r["row"]), ", "), F.lit("]")).alias("js")
        )
        result = result.join(as_json, "pos", "left").withColumn(
            "sample_failed_rows", F.when(F.col("failed_rows") > 0, F.coalesce("js", F.lit("[]"))).otherwise(F.lit("[]"))
        )
    return result.select(*RESULT_COLUMNS)


def _empty(df: DataFrame) -> DataFrame:
    counts = ("evaluated_rows", "passed_rows", "failed_rows")
    kinds = {**dict.fromkeys(counts, T.LongType()), "score": T.DoubleType()}
    return df.sparkSession.createDataFrame(
        [], T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in RESULT_COLUMNS])
    )


def score(passed: Column, evaluated: Column) -> Column:
    """Percentage of passed rows, four decimals; NULL when nothing was evaluated."""
    return F.when(evaluated > 0, F.round(passed / evaluated * 100, 4))


def _assemble(counts: DataFrame, rules: Sequence[Rule], absent: set[int], dataset: str) -> DataFrame:
    texts = [
        {
            "dimension": r.dimension,
            "rule_id": r.rule_id,
            "rule_name": r.rule_name,
            "column_name": r.column_name,
            "rule_type": r.rule_type,
            "expected_value": r.expected_value,
            "severity": r.severity,
            "source": r.source,
            "observation": r.absent_observation if pos in absent else r.observation,
        }
        for pos, r in enumerate(rules)
    ]
    described = literal_rows(counts.sparkSession, [{"pos": i, **t} for i, t in enumerate(texts)], f"pos int, {_META}")
    evaluated, failed = F.col("evaluated"), F.col("failed")
    passed = F.greatest(evaluated - failed, F.lit(0)).cast("bigint")
    observation = F.col("observation")
    for i in range(2):
        observation = F.replace(observation, F.lit("{%d}" % i), F.coalesce(F.get("facts", F.lit(i)), F.lit("")))
    status = (
        F.when(evaluated == 0, STATUS_NOT_EVALUABLE).when(failed == 0, STATUS_CLEAN).otherwise(STATUS_OBSERVED)
    )
    return counts.join(described, "pos").select(
        "pos",
        F.lit(dataset).alias("dataset"),
        "dimension",
        "rule_id",
        "rule_name",
        "column_name",
        "rule_type",
        "expected_value",
        evaluated.alias("evaluated_rows"),
        passed.alias("passed_rows"),
        failed.alias("failed_rows"),
        score(passed, evaluated).alias("score"),
        "severity",
        "source",
        status.alias("status"),
        observation.alias("observation"),
        F.lit("[]").alias("sample_failed_rows"),
    )
