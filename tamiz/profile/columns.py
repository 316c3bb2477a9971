"""The rich column profile: everything about every column, in two scans however wide the table is.

The first scan explodes each row into its cells and sums lengths, numbers, dates and type tests by column inside each map task;
no cell is shuffled. The second counts values: distinct counts, top and sample values and exact quantiles come from it. A long
text is counted under its beginning and a hash, so that what is shuffled per distinct value is bounded; the few long
texts that are shown are looked up at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.casts import DATE_FORMATS, NUMBER_SHAPE, text_number_sql
from tamiz.functions.missing import RULE_TOKENS
from tamiz.functions.text import literal, quoted, strip_sql
from tamiz.operators.quantiles import exact_quantiles
from tamiz.operators.wide import side_by_side
from tamiz.profile.sections import percent, ranked_json, top_values
from tamiz.rules.sets import repeated_rows
from tamiz.session import literal_rows, written_once

# Type-inference thresholds, indicator words, e-mail shape, outlier fence, sample and top sizes.
NUMERIC_SHARE = 0.98
DATE_SHARE = 0.90
EMAIL_SHARE = 0.80
CATEGORICAL_SHARE = 0.10
INDICATORS = ("0", "1", "S", "N", "SI", "NO", "TRUE", "FALSE", "A", "I")
EMAIL_SHAPE = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
FENCE = 1.5
SAMPLES, TOP = 5, 10

#: Characters of a value that are counted as they are, and how a longer one is named: as many characters in all.
KEPT = 64
_SHORT = "concat(left(value, 32), md5(value))"


def _cells(df: DataFrame, names: Sequence[str], tokens: Sequence[str]) -> DataFrame:
    """(column_name, value, here, x, d0, d1, ...): a row per cell with its stripped text, whether it is present, its number, and
    a timestamp per date layout."""
    kinds = dict(df.dtypes)
    texts = ", ".join(strip_sql(quoted(c) if kinds[c] == "string" else f"CAST({quoted(c)} AS STRING)") for c in names)
    listed = ", ".join(literal(t) for t in tokens)
    dates = [
        f"CASE WHEN here AND value RLIKE {literal(shape)} THEN try_to_timestamp(value, {literal(pattern)}) END AS d{i}"
        for i, (_, pattern, shape) in enumerate(DATE_FORMATS)
    ]
    cells = df.select(F.expr(f"posexplode(array({texts})) AS (pos, value)"))
    cells = cells.selectExpr("*", f"value IS NOT NULL AND value NOT IN ({listed}) AS here")
    return cells.selectExpr("*", f"CASE WHEN here THEN {text_number_sql('value')} END AS x", *dates)


def _key_counts(df: DataFrame, names: Sequence[str], tokens: Sequence[str]) -> DataFrame:
    """(column_name, value, long, n, x) of the present values; `long` ones are named by their first characters and a hash."""
    kinds = dict(df.dtypes)
    texts = ", ".join(strip_sql(quoted(c) if kinds[c] == "string" else f"CAST({quoted(c)} AS STRING)") for c in names)
    listed = ", ".join(literal(t) for t in tokens)
    cells = df.select(F.expr(f"posexplode(array({texts})) AS (pos, value)")).where(f"value IS NOT NULL AND value NOT IN ({listed})")
    long = f"length(value) > {KEPT} AND NOT value RLIKE {literal(NUMBER_SHAPE)}"
    keyed = cells.selectExpr("pos", "value", f"{long} AS long").selectExpr("pos", f"if(long, {_SHORT}, value) AS value", "long")
    counted = keyed.groupBy("pos", "value", "long").agg(F.count(F.lit(1)).alias("n"))
    named = counted.select(F.expr(f"array({', '.join(literal(c) for c in names)})[pos]").alias("column_name"), "value", "long", "n")
    return written_once(named.selectExpr("*", f"if(long, NULL, {text_number_sql('value')}) AS x"), "value-counts")


def _whole_texts(df: DataFrame, shown: DataFrame) -> DataFrame:
    """`shown` (column_name, value, long, ...) with the whole text of its long values; one more scan, of their columns only."""
    wanted = shown.where("long").select("column_name", "value").distinct().collect()  # a few per column
    if not wanted:
        return shown
    kinds, names = dict(df.dtypes), sorted({r["column_name"] for r in wanted})
    texts = ", ".join(strip_sql(quoted(c) if kinds[c] == "string" else f"CAST({quoted(c)} AS STRING)") for c in names)
    keys = literal_rows(df.sparkSession, [r.asDict() for r in wanted], "column_name string, value string")
    cells = df.select(F.expr(f"posexplode(array({texts})) AS (pos, text)")).where(f"length(text) > {KEPT}")
    named = cells.selectExpr(f"array({', '.join(literal(c) for c in names)})[pos] AS column_name", "text", f"{_SHORT.replace('value', 'text')} AS value")
    found = named.join(F.broadcast(keys), ["column_name", "value"]).groupBy("column_name", "value").agg(F.min("text").alias("text"))
    texted = shown.join(found.withColumn("long", F.lit(True)), ["column_name", "value", "long"], "left")
    return texted.withColumn("value", F.coalesce("text", "value")).drop("text")


def _weighted(condition: str) -> str:
    return f"CAST(coalesce(sum(CASE WHEN {condition} THEN n END), 0) AS BIGINT)"


def inferred_type(
    total: Column, distinct: Column, indicator: Column, numeric: Column, whole: Column, date: Column, email: Column
) -> Column:
    """The first class whose share of present values is high enough. All arguments are counts, but two flags."""
    return (
        F.when(total == 0, "empty_or_null")
        .when(indicator, "categorical_indicator")
        .when(numeric / total >= NUMERIC_SHARE, F.when(whole, "integer").otherwise("decimal"))
        .when(date / total >= DATE_SHARE, "datetime_or_date")
        .when(email / total >= EMAIL_SHARE, "email")
        .when(distinct / total <= CATEGORICAL_SHARE, "categorical_text")
        .otherwise("text")
    )


def _best_date(total: Column) -> tuple[Column, Column, Column, Column]:
    """Highest share over the layouts (first wins a tie), its layout, first and last date."""
    hits = [F.col(f"d{i}_n") for i in range(len(DATE_FORMATS))]
    best = F.greatest(*hits)
    layout = shown_min = shown_max = F.when(F.lit(False), F.lit(""))
    for i, (name, _, _) in enumerate(DATE_FORMATS):
        wins = (best > 0) & (hits[i] == best)
        layout = layout.when(wins, name)
        shown_min = shown_min.when(wins, F.date_format(f"d{i}_lo", "yyyy-MM-dd HH:mm:ss"))
        shown_max = shown_max.when(wins, F.date_format(f"d{i}_hi", "yyyy-MM-dd HH:mm:ss"))
    share = F.when(total > 0, F.round(best / total * 100, 4)).otherwise(F.lit(0.0))
    return share, layout.otherwise(""), shown_min.otherwise(""), shown_max.otherwise("")


def value_class(share: Column) -> Column:
    return (
        F.when(share > 95, "alta_posible_identificador")
        .when(share > 50, "media_alta")
        .when(share > 5, "media")
        .otherwise("baja_categorica")
    )


def _measures(df: DataFrame, names: Sequence[str], tokens: Sequence[str], indicators: Sequence[str]) -> DataFrame:
    """Per column all that a sum, a minimum or a maximum over its cells can tell; written once, a row per column."""
    words = ", ".join(literal(w) for w in indicators)
    aggregates = {
        "row_count": "count(1)",
        "null_count": "count_if(value IS NULL)",
        # A NULL reads as empty text.
        "empty_string_count": "count_if(value IS NULL OR value = '')",
        "missing_like_count": "count_if(NOT here)",
        "non_missing_count": "count_if(here)",
        "lo_len": "min(CASE WHEN here THEN length(value) END)",
        "hi_len": "max(CASE WHEN here THEN length(value) END)",
        "sum_len": "sum(CASE WHEN here THEN length(value) END)",
        "numeric_valid_count": "count(x)",
        "numeric_min": "min(x)",
        "numeric_max": "max(x)",
        "sum_x": "sum(x)",
        "whole": "coalesce(bool_and(CASE WHEN x IS NOT NULL THEN x % 1 = 0 END), false)",
        "indicator": f"coalesce(bool_and(CASE WHEN here THEN upper(value) IN ({words}) END), false)",
        "email": f"count_if(here AND value RLIKE {literal(EMAIL_SHAPE)})",
    }
    for i in range(len(DATE_FORMATS)):
        aggregates |= {f"d{i}_n": f"count(d{i})", f"d{i}_lo": f"min(d{i})", f"d{i}_hi": f"max(d{i})"}
    found = _cells(df, names, tokens).groupBy("pos").agg(*[F.expr(f"{sql} AS {name}") for name, sql in aggregates.items()])
    named = F.expr(f"array({', '.join(literal(c) for c in names)})[pos]").alias("column_name")
    return written_once(found.select(named, *aggregates), "measures")


def _smallest(counts: DataFrame, k: int) -> DataFrame:
    """(column_name, value, long, rank) of the k smallest values of each column."""
    ranked = counts.withColumn("rank", F.expr("row_number() over (partition by column_name order by value)"))
    return ranked.where(F.col("rank") <= k).select("column_name", "value", "long", "rank")


def sample_values(
    df: DataFrame, columns: Sequence[str] | None = None, tokens: Sequence[str] = RULE_TOKENS, k: int = SAMPLES
) -> DataFrame:
    """(column_name, sample_values): the k smallest present values of each column, as a JSON array."""
    few = _smallest(_key_counts(df, list(columns or df.columns), tokens), k)
    return _as_array(_whole_texts(df, written_once(few, "samples")))


def _as_array(few: DataFrame) -> DataFrame:
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("rank", "value"))), lambda r: r["value"])
    return few.groupBy("column_name").agg(F.to_json(ordered).alias("sample_values"))


def infer_types(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    tokens: Sequence[str] = RULE_TOKENS,
    indicators: Sequence[str] = INDICATORS,
) -> DataFrame:
    """(column_name, inferred_type, row_count) from all values of the table.

    Distinct values are counted only for the columns whose type they decide: texts that are no numbers, dates or e-mails.
    """
    found = _measures(df, list(columns or df.columns), tokens, indicators)
    kind = _kind_of(found, F.col("distinct"))
    # A distinct count of 0 and one beyond all rows give the same type unless the count decides it.
    open_kinds = found.withColumn("distinct", F.lit(0)).select("column_name", kind.alias("few")).join(
        found.withColumn("distinct", F.col("row_count")).select("column_name", kind.alias("many")), "column_name"
    )
    undecided = [r["column_name"] for r in open_kinds.where("few <> many").collect()]  # names of columns
    if undecided:
        distinct = _key_counts(df, undecided, tokens).groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct"))
        found = found.join(distinct, "column_name", "left")
    else:
        found = found.withColumn("distinct", F.lit(None).cast("bigint"))
    found = found.withColumn("distinct", F.coalesce("distinct", F.lit(0)))
    return found.select("column_name", kind.alias("inferred_type"), "row_count")


def _kind_of(found: DataFrame, distinct: Column) -> Column:
    dates = F.greatest(*[F.col(f"d{i}_n") for i in range(len(DATE_FORMATS))])
    numbers, whole, indicator = F.col("numeric_valid_count"), F.col("whole"), F.col("indicator")
    return inferred_type(F.col("non_missing_count"), distinct, indicator, numbers, whole, dates, F.col("email"))


def best_date_layout(df: DataFrame, columns: Sequence[str] | None = None, tokens: Sequence[str] = RULE_TOKENS) -> DataFrame:
    """(column_name, datetime_valid_pct, datetime_detected_format, datetime_min, datetime_max)."""
    found = _measures(df, list(columns or df.columns), tokens, INDICATORS)
    share, layout, lo, hi = _best_date(F.col("non_missing_count"))
    return found.select(
        "column_name",
        share.alias("datetime_valid_pct"),
        layout.alias("datetime_detected_format"),
        lo.alias("datetime_min"),
        hi.alias("datetime_max"),
    )


def column_profile(
    df: DataFrame,
    dataset: str,
    columns: Sequence[str] | None = None,
    tokens: Sequence[str] = RULE_TOKENS,
    indicators: Sequence[str] = INDICATORS,
) -> DataFrame:
    """One row per column with all measures of the rich profile."""
    names = list(columns or df.columns)
    measures, counts = _measures(df, names, tokens, indicators), _key_counts(df, names, tokens)
    quartiles = exact_quantiles(counts, "column_name", "x", "n", (0.25, 0.75)).select(
        "column_name", F.col("quantiles")[0].alias("q1_raw"), F.col("quantiles")[1].alias("q3_raw")
    )
    # One row per column: small by construction.
    fences = F.broadcast(written_once(quartiles, "quartiles"))
    width = f"{FENCE}D * (q3_raw - q1_raw)"
    outside = f"x < q1_raw - {width} OR x > q3_raw + {width}"
    own = (
        counts.join(fences, "column_name", "left")
        .groupBy("column_name", "q1_raw", "q3_raw")
        .agg(F.count(F.lit(1)).alias("distinct"), F.expr(_weighted(outside)).alias("outside"))
        .withColumn("outlier_count_iqr", F.when(F.col("q3_raw") > F.col("q1_raw"), F.col("outside")))
    )
    top = written_once(top_values(counts, TOP, "column_name", "long"), "top-values")
    samples = written_once(_smallest(counts, SAMPLES), "samples")
    found = (
        measures.join(own, "column_name", "left")
        .withColumn("unique_count", F.coalesce("distinct", F.lit(0)))
        .join(_as_array(_whole_texts(df, samples)), "column_name", "left")
        .join(ranked_json(_whole_texts(df, top), "column_name"), "column_name", "left")
    )
    rows, here, numbers = F.col("row_count"), F.col("non_missing_count"), F.col("numeric_valid_count")
    unique_pct = percent(F.col("unique_count"), rows)
    share, layout, lo, hi = _best_date(here)
    wanted = set(names)
    kinds = ", ".join(f"{literal(f.name)}, {literal(f.dataType.simpleString())}" for f in df.schema if f.name in wanted)
    physical = F.expr(f"map({kinds})")
    return found.select(
        F.lit(dataset).alias("dataset"),
        "column_name",
        physical[F.col("column_name")].alias("parquet_type"),
        _kind_of(found, F.col("unique_count")).alias("inferred_type"),
        "row_count",
        "null_count",
        percent(F.col("null_count"), rows).alias("null_pct"),
        "empty_string_count",
        percent(F.col("empty_string_count"), rows).alias("empty_string_pct"),
        "missing_like_count",
        percent(F.col("missing_like_count"), rows).alias("missing_like_pct"),
        "non_missing_count",
        "unique_count",
        unique_pct.alias("unique_pct"),
        value_class(unique_pct).alias("cardinality_class"),
        F.coalesce("lo_len", F.lit(0)).cast("bigint").alias("min_length"),
        F.coalesce("hi_len", F.lit(0)).cast("bigint").alias("max_length"),
        F.when(here > 0, F.round(F.col("sum_len") / here, 4)).otherwise(F.lit(0.0)).alias("avg_length"),
        "numeric_valid_count",
        percent(numbers, here).alias("numeric_valid_pct"),
        "numeric_min",
        "numeric_max",
        F.round(F.col("sum_x") / F.nullif(numbers, F.lit(0)), 4).alias("numeric_mean"),
        F.round("q1_raw", 4).alias("q1"),
        F.round("q3_raw", 4).alias("q3"),
        F.round(F.col("q3_raw") - F.col("q1_raw"), 4).alias("iqr"),
        "outlier_count_iqr",
        F.round(F.col("outlier_count_iqr") / F.nullif(numbers, F.lit(0)) * 100, 4).alias("outlier_pct_iqr"),
        share.alias("datetime_valid_pct"),
        layout.alias("datetime_detected_format"),
        lo.alias("datetime_min"),
        hi.alias("datetime_max"),
        F.coalesce("sample_values", F.lit("[]")).alias("sample_values"),
        F.coalesce("top_values", F.lit("{}")).alias("top_values"),
    )


def profile_summary(profile: DataFrame, df: DataFrame, dataset: str) -> DataFrame:
    """One row per dataset over its column profile, with the table's duplicate rows."""
    repeated = repeated_rows(df).select(F.col("failed").alias("duplicate_rows"))
    missing_pct = F.col("missing_like_pct")
    over = profile.agg(
        F.max("row_count").alias("row_count"),
        F.count(F.lit(1)).alias("column_count"),
        F.count_if(F.col("missing_like_count") > 0).alias("columns_with_missing"),
        F.count_if(missing_pct == 100).alias("columns_all_missing"),
        F.count_if(missing_pct >= 50).alias("columns_high_missing_50pct"),
        F.round(F.avg(missing_pct), 4).alias("avg_missing_pct"),
        F.round(F.avg("unique_pct"), 4).alias("avg_unique_pct"),
        F.count_if(F.col("numeric_valid_pct") >= 98).alias("numeric_like_columns"),
        F.count_if(F.col("datetime_valid_pct") >= 90).alias("datetime_like_columns"),
        F.count_if(F.col("inferred_type") == "empty_or_null").alias("empty_or_null_columns"),
    )
    merged = side_by_side([over, repeated])
    return merged.select(
        F.lit(dataset).alias("dataset"),
        "row_count",
        "column_count",
        "duplicate_rows",
        percent(F.col("duplicate_rows"), F.col("row_count")).alias("duplicate_rows_pct"),
        "columns_with_missing",
        "columns_all_missing",
        "columns_high_missing_50pct",
        "avg_missing_pct",
        "avg_unique_pct",
        "numeric_like_columns",
        "datetime_like_columns",
        "empty_or_null_columns",
        F.lit("OK").alias("profile_status"),
    )
