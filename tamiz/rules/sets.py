"""Set rules: uniqueness, cardinality, functional dependency, coverage and reference checks.

Every one first shrinks its input with a grouped count, so a key that holds a large share of the rows arrives at
the shuffle as one row per map task, and reports (pos, evaluated, failed, facts). Rules of one kind share a scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.casts import integer_sql
from tamiz.functions.missing import RULE_TOKENS, present, present_sql, text_sql
from tamiz.functions.text import column, key_sql, quoted
from tamiz.rules.model import Rule
from tamiz.session import literal_rows, written_once

Numbered = Sequence[tuple[int, Rule]]

#: Short years that an observation names; `coverage_short_years` has them all.
LISTED = 1000
UNIQUE_RULES = ("duplicate_full_rows", "unique_key")
REFERENCE_RULES = ("referential_integrity", "temporal_catalog_exists")


def _zero(total: Column) -> Column:
    return F.coalesce(total, F.lit(0)).cast("bigint")


def _outcome(df: DataFrame, pos: int, evaluated: Column, failed: Column, *facts: Column) -> DataFrame:
    texts = F.array(*facts).cast("array<string>")
    return df.select(
        F.lit(pos).alias("pos"), _zero(evaluated).alias("evaluated"), _zero(failed).alias("failed"), texts.alias("facts")
    )


def _key_hashes(df: DataFrame, names: Sequence[str]) -> tuple[str, str]:
    """Two 64-bit hashes of a key as it is; NULLs are equal to each other and to nothing else."""
    nullable = {f.name: f.nullable for f in df.schema.fields}
    parts = [x for n in names for x in ([quoted(n), f"{quoted(n)} IS NULL"] if nullable[n] else [quoted(n)])]
    return tuple(f"xxhash64({seed}{', '.join(parts)})" for seed in ("", "17, "))


def _unique_cells(df: DataFrame, rules: Numbered) -> dict[int, str]:
    """What one row contributes to each uniqueness rule: (pos, a, b), its key by 128 bits. Full rows: all columns as key."""
    hashed = [(pos, _key_hashes(df, rule.columns if rule.rule_type == "unique_key" else df.columns)) for pos, rule in rules]
    return {pos: f"named_struct('pos', {pos}, 'a', {a}, 'b', {b})" for pos, (a, b) in hashed}


def _exploded(df: DataFrame, cells: Iterable[str], *kept: Column) -> DataFrame:
    return df.select(F.expr(f"explode(array({', '.join(cells)}))").alias("c"), *kept).where("c IS NOT NULL").select("c.*", "*").drop("c")


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[column(c) for c in df.columns])


def leading(df: DataFrame, order_by: Sequence[str]) -> Column:
    """What samples are ordered by first."""
    return column(order_by[0]) if order_by else _row_hash(df)


def key_counts(df: DataFrame, rules: Numbered, lead: Column | None = None) -> DataFrame:
    """(pos, a, b, n): how often each key of each uniqueness rule occurs. One scan; 20 bytes per row and rule are shuffled.

    With `lead` also `at`, the last value of it that a row of the key has.
    """
    last = [] if lead is None else [F.max("at").alias("at")]
    rows = _exploded(df, _unique_cells(df, rules).values(), *([] if lead is None else [lead.alias("at")]))
    return rows.groupBy("pos", "a", "b").agg(F.count(F.lit(1)).alias("n"), *last)


def uniqueness(df: DataFrame, rules: Numbered, counts: DataFrame | None = None) -> DataFrame:
    """Rows beyond the first of each key, for all uniqueness rules of a table together."""
    counts = key_counts(df, rules) if counts is None else counts
    totals = counts.groupBy("pos").agg(F.sum("n").alias("rows"), F.sum(F.col("n") - 1).alias("extra"))
    declared = literal_rows(df.sparkSession, [{"pos": pos} for pos, _ in rules], "pos int")
    extra = _zero(F.col("extra"))
    return declared.join(totals, "pos", "left").select(
        "pos", _zero(F.col("rows")).alias("evaluated"), extra.alias("failed"), F.array(F.format_number(extra, 0)).alias("facts")
    )


def repeated_rows(df: DataFrame) -> DataFrame:
    """evaluated (rows) and failed (rows beyond the first of equal ones) of a whole table."""
    return uniqueness(df, [(0, Rule("duplicate_full_rows", ()))])


CELL_RULES = ("code_name_consistency", "cardinality_check", "cardinality_upper_bound", "temporal_coverage_check")


def _cell(df: DataFrame, pos: int, rule: Rule, tokens: Sequence[str]) -> str:
    """What one row contributes to one rule: (pos, a, b), or NULL where the rule does not look at the row."""
    if rule.rule_type == "temporal_coverage_check":
        a, b = (f"CAST({integer_sql(df, c)} AS STRING)" for c in rule.columns)
    else:
        a, b = [*(f"CAST({quoted(c)} AS STRING)" for c in rule.columns), "CAST(NULL AS STRING)"][:2]
    seen = present_sql(df, *rule.columns, tokens=tokens)
    return f"CASE WHEN {seen} THEN named_struct('pos', {pos}, 'a', {a}, 'b', {b}) END"


def _per_rule(rules: Numbered, pick) -> Column:
    """A per-rule constant, looked up by the rule's position."""
    return F.create_map(*[v for pos, rule in rules for v in (F.lit(pos), F.lit(pick(rule)))])[F.col("pos")]


def _cell_groups(df: DataFrame, rules: Numbered, tokens: Sequence[str], lead: Column | None = None) -> DataFrame:
    """(pos, a) with its rows, its distinct b (NULL too), its distinct non-NULL b and the least `lead` if one is given."""
    kept, least = ([], []) if lead is None else ([lead.alias("at")], [F.min("at").alias("at")])
    seen = _exploded(df, [_cell(df, pos, rule, tokens) for pos, rule in rules], *kept)
    distinct = seen.groupBy("pos", "a", "b").agg(F.count(F.lit(1)).alias("n"), *least)
    return distinct.groupBy("pos", "a").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("pairs"), F.count("b").alias("members"), *least
    )


def _is_short(rules: Numbered) -> Column:
    """The group is a year of a coverage rule with too few months, and no exception."""
    kind = _per_rule(rules, lambda r: r.rule_type)
    expected = _per_rule(rules, lambda r: int(r.param("expected_months", 12)))
    excepted = _per_rule(rules, lambda r: "," + ",".join(str(int(y)) for y in r.param("exception_years", ())) + ",")
    # A year that is no number is a group of its own, which no exception can name.
    named = F.coalesce(excepted.contains(F.concat(F.lit(","), F.col("a"), F.lit(","))), F.lit(False))
    return (kind == "temporal_coverage_check") & (F.col("members") < expected) & ~named


def coverage_short_years(df: DataFrame, rules: Sequence[Rule], tokens: Sequence[str] = RULE_TOKENS) -> DataFrame:
    """(rule_id, year, months): every year that a coverage rule finds too short, as a table of its own."""
    numbered = [(i, r) for i, r in enumerate(rules) if r.rule_type == "temporal_coverage_check"]
    if not numbered:
        raise ValueError("no coverage rule given")
    short = _cell_groups(df, numbered, tokens).where(_is_short(numbered))
    name = _per_rule(numbered, lambda r: r.rule_id)
    return short.select(name.alias("rule_id"), F.col("a").alias("year"), F.col("members").alias("months"))


def cell_rules(df: DataFrame, rules: Numbered, tokens: Sequence[str]) -> DataFrame:
    """All rules about distinct values in one pass over the table and one shuffle of distinct (rule, a, b).

    code_name_consistency: rows whose code (a) carries several names (b). cardinality: distinct values (a) over the
    limit. temporal_coverage: years (a) with fewer months (b) than expected, exception years aside.
    """
    groups = _cell_groups(df, rules, tokens)
    covering = any(r.rule_type == "temporal_coverage_check" for _, r in rules)
    if covering:  # read twice below
        groups = written_once(groups, "cells")
    kind = _per_rule(rules, lambda r: r.rule_type)
    many = F.col("pairs") > 1
    short = _is_short(rules)
    shown = F.format_string("{'ano': %s, 'n_meses': %s}", F.col("a"), F.col("members").cast("string"))
    # The first short years of each rule by text; Spark limits them in each task before they move.
    groups = groups.withColumns({"short": short, "shown": F.coalesce(shown, F.lit(""))})
    few = groups.where("short").withColumn("rank", F.expr("row_number() over (partition by pos order by shown)"))
    few = few.where(F.col("rank") <= LISTED)
    few = few.groupBy("pos").agg(F.sort_array(F.collect_list("shown")).alias("which"))
    found = groups.groupBy("pos").agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("groups"),
        F.sum(F.when(many, F.col("n"))).alias("ambiguous_rows"),
        F.count_if(many).alias("ambiguous"),
        F.count_if("short").alias("short"),
    )
    if covering:
        found = found.join(few, "pos", "left")
    else:
        found = found.withColumn("which", F.lit(None).cast("array<string>"))
    limit = _per_rule(rules, lambda r: int(r.param("limit", 0)))
    over = F.greatest(_zero(F.col("groups")) - limit, F.lit(0))
    verdict = F.when(over > 0, _per_rule(rules, lambda r: r.param("verdicts", ("", ""))[0])).otherwise(
        _per_rule(rules, lambda r: r.param("verdicts", ("", ""))[1])
    )
    more = F.when(F.col("short") > LISTED, F.format_string(" y %s más", F.format_number(F.col("short") - LISTED, 0))).otherwise("")
    listed = F.concat(F.lit("["), F.array_join("which", ", "), F.lit("]"), more)
    pairs, coverage = kind == "code_name_consistency", kind == "temporal_coverage_check"
    groups_seen = _zero(F.col("groups"))
    # Rules that met no evaluable row have no group; they are kept with zero counts.
    declared = literal_rows(df.sparkSession, [{"pos": pos} for pos, _ in rules], "pos int")
    found = declared.join(found, "pos", "left")
    return found.select(
        "pos",
        F.when(pairs, _zero(F.col("rows"))).otherwise(groups_seen).alias("evaluated"),
        F.when(pairs, _zero(F.col("ambiguous_rows"))).when(coverage, _zero(F.col("short"))).otherwise(over).cast("bigint").alias("failed"),
        F.when(pairs, F.array(_zero(F.col("ambiguous")).cast("string")))
        .when(coverage, F.array(F.when(F.size("which") > 0, listed).otherwise("ninguno")))
        .otherwise(F.array(groups_seen.cast("string"), verdict))
        .alias("facts"),
    )


def _key_texts(df: DataFrame, names: Sequence[str], as_key: bool) -> list[str]:
    return [key_sql(quoted(n)) if as_key else text_sql(df, n) for n in names]


def _unmatched(child: DataFrame, parent: DataFrame, rule: Rule, tokens: Sequence[str], lead: Column | None = None) -> DataFrame:
    """Key tuples of the child (k0, k1, ...) with their rows n, the least `lead` if one is given, and whether the parent knows them."""
    as_key = rule.rule_type == "temporal_catalog_exists"
    theirs = rule.param("reference_columns")
    keys = [f"k{i}" for i in range(len(rule.columns))]

    def texts(df: DataFrame, names: Sequence[str], *kept: Column) -> DataFrame:
        named = [F.expr(x).alias(k) for x, k in zip(_key_texts(df, names, as_key), keys, strict=True)]
        return df.where(present(df, *names, tokens=tokens)).select(*named, *kept)

    kept, least = ([], []) if lead is None else ([lead.alias("at")], [F.min("at").alias("at")])
    counted = texts(child, rule.columns, *kept).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *least)
    known = texts(parent, theirs).distinct().withColumn("known", F.lit(True))
    return counted.join(known, keys, "left")


def reference(child: DataFrame, parent: DataFrame, pos: int, rule: Rule, tokens: Sequence[str] = RULE_TOKENS) -> DataFrame:
    """Child rows whose key tuple is not among the parent's. Counting the child by key first keeps hot keys small."""
    totals = _unmatched(child, parent, rule, tokens).agg(
        F.sum("n").alias("evaluated"), F.sum(F.when(F.col("known").isNull(), F.col("n"))).alias("failed")
    )
    return _outcome(totals, pos, F.col("evaluated"), F.col("failed"))


def _hashed(texts: Sequence[str]) -> str:
    """Fields a and b of a cell: 128 bits of some non-null texts."""
    return f"'a', xxhash64({', '.join(texts)}), 'b', xxhash64(17, {', '.join(texts)})"


def contested(
    df: DataFrame, rules: Numbered, tokens: Sequence[str], catalog: Mapping[str, DataFrame], counts: DataFrame | None, lead: Column
) -> tuple[dict[int, str], list[DataFrame]]:
    """For each rule a cell per row, (pos, a, b), and tables of the cells that failing rows have, (pos, a, b, at).

    Uniqueness: keys that repeat. References: keys the parent lacks. code_name_consistency: codes with several names.
    At least one failing row of a cell has a `lead` of `at` or before. `counts` are the repeated keys of the uniqueness rules.
    """
    unique = [(p, r) for p, r in rules if r.rule_type in UNIQUE_RULES]
    pairs = [(p, r) for p, r in rules if r.rule_type == "code_name_consistency"]
    cells, found = _unique_cells(df, unique), []
    if unique:
        found.append(counts.where(F.col("pos").isin([p for p, _ in unique])).select("pos", "a", "b", "at"))
    for pos, rule in rules:
        if rule.rule_type in REFERENCE_RULES:
            texts = _key_texts(df, rule.columns, rule.rule_type == "temporal_catalog_exists")
            cells[pos] = f"CASE WHEN {present_sql(df, *rule.columns, tokens=tokens)} THEN named_struct('pos', {pos}, {_hashed(texts)}) END"
            lost = _unmatched(df, catalog[rule.param("reference_dataset")], rule, tokens, lead).where("known IS NULL")
            own = _hashed([f"k{i}" for i in range(len(rule.columns))])
            found.append(lost.selectExpr(f"inline(array(named_struct('pos', {pos}, {own}, 'at', at)))"))
    for pos, rule in pairs:
        code = f"CAST({quoted(rule.columns[0])} AS STRING)"
        cells[pos] = f"CASE WHEN {present_sql(df, *rule.columns, tokens=tokens)} THEN named_struct('pos', {pos}, {_hashed([code])}) END"
    if pairs:
        several = _cell_groups(df, pairs, tokens, lead).where("pairs > 1")
        found.append(several.selectExpr("pos", "xxhash64(a) AS a", "xxhash64(17, a) AS b", "at"))
    return cells, found


def _within_reach(cells: Mapping[int, str], failing: DataFrame, lead: Column, limit: int) -> Column:
    """Which rows may be among the first `limit` failing rows of a rule, or share a key with one of them and come before it.

    Each of a rule's contested keys has a failing row with a `lead` of the key's `at` or before, so with `limit` keys the wanted
    rows do not come after the last of the first `limit` values of `at`. Of a rule with fewer keys all their rows are looked at.
    """
    first = failing.withColumn("nth", F.expr("row_number() over (partition by pos order by at)")).where(F.col("nth") <= limit)
    keys = first.groupBy("pos").agg(F.collect_list("__a").alias("keys")).collect()  # `limit` keys of a rule at most
    few = [F.expr(cells[r["pos"]]).getField("a").isin(r["keys"]) for r in keys if len(r["keys"]) < limit]
    bounded = [r["pos"] for r in keys if len(r["keys"]) >= limit]
    if bounded:
        last = first.where(F.col("pos").isin(bounded)).agg(F.max("at")).scalar()
        few.append(lead.isNull() | (lead <= last))
    return reduce(Column.__or__, few, F.lit(False))


#: Set rules whose failures are rows; coverage and cardinality rules fail by years and values.
SAMPLED_RULES = (*UNIQUE_RULES, *REFERENCE_RULES, "code_name_consistency")


def failed_set_rows(
    df: DataFrame,
    rules: Numbered,
    order_by: Sequence[str],
    limit: int,
    tokens: Sequence[str] = RULE_TOKENS,
    catalog: Mapping[str, DataFrame] | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Up to `limit` failing rows per set rule, the first by `order_by`: (pos, rank, and the columns the rules show).

    A row fails a uniqueness rule if an earlier row has its key. One scan for all rules, of the rows within reach: a row's
    cells are met with the contested ones, and only those rows are ranked; the ranks are limited in each task before they move, by
    key for uniqueness rules, so a key with a third of the rows costs `limit` rows per task. Ties are broken by a hash of the row.
    `counts` are repeated keys by `key_counts` with `leading(df, order_by)`.
    """
    rules = [(p, r) for p, r in rules if r.rule_type in SAMPLED_RULES]
    unique = [p for p, r in rules if r.rule_type in UNIQUE_RULES]
    if unique and counts is None:
        counts = key_counts(df, [(p, r) for p, r in rules if p in unique], leading(df, order_by)).where("n > 1")
    lead = leading(df, order_by)
    cells, found = contested(df, rules, tokens, catalog or {}, counts, lead)
    failing = reduce(DataFrame.unionByName, found).select("pos", F.col("a").alias("__a"), F.col("b").alias("__b"), "at")
    failing = written_once(failing, "contested")
    wanted = sorted({c for _, r in rules for c in r.sample_columns if c in df.columns} | set(order_by))
    near = df.where(_within_reach(cells, failing, lead, limit))
    rows = _exploded(near, cells.values(), *[column(c) for c in wanted], _row_hash(df).alias("__tie"))
    met = (rows["pos"] == failing["pos"]) & (rows["a"] == failing["__a"]) & (rows["b"] == failing["__b"])
    hits = rows.join(failing, met, "left_semi").withColumn("__key", F.struct("pos", "a", "b"))
    order = ", ".join([*(quoted(c) for c in order_by), "__tie"])
    ranked = [hits]
    if unique:
        of_unique = F.col("pos").isin(unique)
        later = hits.where(of_unique).withColumn("__nth", F.expr(f"row_number() over (partition by __key order by {order})"))
        ranked = [later.where(F.col("__nth") <= limit + 1).where("__nth > 1").drop("__nth")]
        if len(unique) < len(rules):
            ranked.append(hits.where(~of_unique))
    first = reduce(DataFrame.unionByName, ranked).withColumn("rank", F.expr(f"row_number() over (partition by pos order by {order})"))
    return first.where(F.col("rank") <= limit).select("pos", "rank", *[column(c) for c in wanted])


SET_RULES = (*CELL_RULES, *UNIQUE_RULES, *REFERENCE_RULES)


def evaluate_sets(
    df: DataFrame,
    rules: Numbered,
    tokens: Sequence[str] = RULE_TOKENS,
    catalog: Mapping[str, DataFrame] | None = None,
    counts: DataFrame | None = None,
) -> list[DataFrame]:
    """Result frames of all set rules of one table. `catalog` resolves the tables that reference rules name.

    `counts`: the keys of the uniqueness rules, if the caller has counted them already.
    """
    parts: list[DataFrame] = []
    cells = [(p, r) for p, r in rules if r.rule_type in CELL_RULES]
    unique = [(p, r) for p, r in rules if r.rule_type in UNIQUE_RULES]
    if cells:
        parts.append(cell_rules(df, cells, tokens))
    if unique:
        parts.append(uniqueness(df, unique, counts))
    for pos, rule in rules:
        if rule.rule_type in REFERENCE_RULES:
            parts.append(reference(df, (catalog or {})[rule.param("reference_dataset")], pos, rule, tokens))
    return parts
