"""Profile sections for large tables: one aggregation per section, approximate distinct counts by choice.

Column names and labels of the section tables are fixed values of the report format.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.casts import as_integer, as_number, number_sql
from tamiz.functions.missing import PROFILE_TOKENS, missing_sql
from tamiz.functions.text import column, literal, quoted
from tamiz.operators.wide import per_column, stack
from tamiz.rules.sets import repeated_rows
from tamiz.session import literal_rows, written_once

# Alert limits and the relative error of approximate counts.
MISSING_ALERT = 0.05
CARDINALITY_ALERT = 500
ZERO_ALERT = 0.30
APPROX_ERROR = 0.05
NO_DATA, REVIEW, OK = "SIN_DATOS", "REVISAR", "OK"


def percent(part: Column, whole: Column, digits: int = 4) -> Column:
    """part / whole * 100, 0 for an empty table."""
    return F.when(whole > 0, F.round(part / whole * 100, digits)).otherwise(F.lit(0.0))


def flag(bad: Column) -> Column:
    return F.when(bad, REVIEW).otherwise(OK)


def _tag(dataset: str) -> Column:
    return F.lit(dataset).alias("dataset")


def missing_counts(df: DataFrame, tokens: Sequence[str] = PROFILE_TOKENS) -> DataFrame:
    """(columna, n_rows, nulos_reales, faltantes_like) of every column; each column is read by one pass only."""
    return per_column(
        df,
        df.columns,
        lambda c: {"nulos_reales": f"count_if({quoted(c)} IS NULL)", "faltantes_like": f"count_if({missing_sql(df, c, tokens)})"},
        label="columna",
    )


def null_profile(df: DataFrame, dataset: str) -> DataFrame:
    """NULLs and missing-like values of every column, with an alert above the limit."""
    found = missing_counts(df)
    rows, gone = F.col("n_rows"), F.col("faltantes_like")
    return found.select(
        _tag(dataset),
        "columna",
        rows.alias("total_filas"),
        "nulos_reales",
        percent(F.col("nulos_reales"), rows).alias("pct_nulos"),
        "faltantes_like",
        percent(gone, rows).alias("pct_faltantes"),
        F.when(rows > 0, F.round((1 - gone / rows) * 100, 4)).otherwise(F.lit(0.0)).alias("completitud_pct"),
        F.when(rows == 0, NO_DATA).when(gone / rows > MISSING_ALERT, REVIEW).otherwise(OK).alias("alerta"),
    )


def duplicate_profile(
    df: DataFrame, dataset: str, business_key: Sequence[str]
) -> DataFrame:
    """Exact duplicates (rows beyond the first) and rows in groups that share the business key.

    Exact duplicates are counted by 128 bits of each row; whole rows are not moved.
    """

    def groups(keys: Sequence[str]) -> DataFrame:
        return df.groupBy(*[column(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))

    def line(kind: str, totals: DataFrame, text: Column) -> DataFrame:
        found = F.coalesce("found", F.lit(0)).cast("bigint")
        rows = F.coalesce("rows", F.lit(0)).cast("bigint")
        return totals.select(
            _tag(dataset),
            F.lit(kind).alias("tipo_duplicado"),
            found.alias("conteo"),
            percent(found, rows).alias("pct"),
            text.alias("descripcion"),
            flag(found > 0).alias("alerta"),
        )

    counted = repeated_rows(df)
    exact = counted.select(F.col("evaluated").alias("rows"), F.col("failed").alias("found"))
    keys = [k for k in business_key if k in df.columns]
    if len(keys) < len(business_key) or not keys:
        shared = df.agg(F.count(F.lit(1)).alias("rows"), F.lit(0).alias("found"), F.lit(0).alias("shared"))
    else:
        many = F.col("n") > 1
        shared = groups(keys).agg(
            F.sum("n").alias("rows"),
            F.sum(F.when(many, F.col("n"))).alias("found"),
            F.count_if(many).alias("shared"),
        )
    described = F.concat(
        F.lit(f"Clave: {' + '.join(keys)} | grupos afectados: "), F.col("shared").cast("string")
    )
    return line("Filas exactas duplicadas", exact, F.lit("Filas con todos los campos idénticos")).unionByName(
        line("Duplicados por clave de negocio", shared, described)
    )


def value_counts(df: DataFrame, columns: Sequence[str], label: str = "columna") -> DataFrame:
    """(label, value, n) for all columns in one pass: values as text, NULL as a value of its own.

    Rows are exploded by position and counted inside each map task, so what is shuffled grows with the distinct values,
    not with the rows; names are attached to the counts.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    cells = ", ".join(quoted(c) if isinstance(kinds[c], T.StringType) else f"CAST({quoted(c)} AS STRING)" for c in columns)
    names = ", ".join(literal(c) for c in columns)
    counted = (
        df.select(F.expr(f"posexplode(array({cells})) AS (pos, value)"))
        .groupBy("pos", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.select(F.expr(f"array({names})[pos]").alias(label), "value", "n")


def top_values(counts: DataFrame, k: int = 10, label: str = "columna", *kept: str) -> DataFrame:
    """The k most frequent values per column, ties by value: (label, rank, value, n, kept...)."""
    ranked = counts.withColumn("rank", F.expr(f"row_number() over (partition by `{label}` order by n desc, value)"))
    return ranked.where(F.col("rank") <= k).select(label, "rank", "value", "n", *kept)


def ranked_json(top: DataFrame, label: str = "columna") -> DataFrame:
    """Per column: ranked values as a JSON object in rank order, and their total count."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", "value", "n")))
    pairs = F.map_from_entries(F.transform(ordered, lambda t: F.struct(t["value"].alias("key"), t["n"].alias("value"))))
    return top.groupBy(label).agg(F.to_json(pairs).alias("top_values"), F.sum("n").alias("top_n"))


def top_values_json(counts: DataFrame, k: int = 10, label: str = "columna") -> DataFrame:
    """Per column: the top values (NULL is none) as a JSON object in rank order, and their total count."""
    return ranked_json(top_values(counts.where("value is not null"), k, label), label)


def _approx(name: str) -> dict[str, str]:
    return {"cardinalidad_aprox": f"approx_count_distinct({quoted(name)}, {APPROX_ERROR})"}


def cardinality_class(unique: Column, rows: Column) -> Column:
    share = unique / rows * 100
    return (
        F.when(rows == 0, "sin_datos")
        .when(unique <= 2, "binaria")
        .when(share > 90, "identificador")
        .when(share > 50, "alta")
        .when(share > 5, "media")
        .otherwise("baja_categorica")
    )


def categorical_profile(df: DataFrame, dataset: str, columns: Sequence[str], exact: bool = False) -> DataFrame:
    """Cardinality, top ten values and what they cover. One job for all columns."""
    names = [c for c in columns if c in df.columns]
    counts = value_counts(df, names)
    top = top_values_json(counts)
    if exact:
        sizes = counts.groupBy("columna").agg(
            F.count("value").alias("cardinalidad_aprox"), F.sum("n").alias("n_rows")
        )
    else:
        sizes = per_column(
            df, names, _approx, "columna"
        )
    size, rows = F.col("cardinalidad_aprox"), F.col("n_rows")
    return sizes.join(top, "columna", "left").select(
        _tag(dataset),
        "columna",
        "cardinalidad_aprox",
        cardinality_class(size, rows).alias("clase_cardinalidad"),
        F.coalesce("top_values", F.lit("{}")).alias("top10_valores"),
        percent(F.coalesce("top_n", F.lit(0)), rows, 2).alias("cobertura_top10_pct"),
        flag(size > CARDINALITY_ALERT).alias("alerta"),
        F.when(size > CARDINALITY_ALERT, "Alta cardinalidad inesperada para columna categórica")
        .otherwise("")
        .alias("nota"),
    )


def cardinality_profile(df: DataFrame, dataset: str, exact: bool = False) -> DataFrame:
    """Distinct values of every column with their class."""
    if exact:
        found = value_counts(df, df.columns).groupBy("columna").agg(
            F.count("value").alias("cardinalidad_aprox"), F.sum("n").alias("n_rows")
        )
    else:
        found = per_column(
            df, df.columns, _approx, "columna"
        )
    size, rows = F.col("cardinalidad_aprox"), F.col("n_rows")
    return found.select(
        _tag(dataset),
        "columna",
        "cardinalidad_aprox",
        percent(size, rows).alias("pct_unicidad"),
        cardinality_class(size, rows).alias("clase"),
    )


#: Ranges that a summary's text names; `temporal_gaps` has them all.
LISTED = 1000


def _range_texts(ranges: DataFrame) -> DataFrame:
    """(variable, gaps, strays): the ranges as text, and how many more there are; one or two values are listed, more are first..last."""
    first, last = F.col("first").cast("string"), F.col("last").cast("string")
    text = F.when(F.col("n") == 1, first).otherwise(F.concat(first, F.when(F.col("n") == 2, ", ").otherwise(".."), last))
    totals = ranges.groupBy("variable", "kind").agg(F.count(F.lit(1)).alias("total"))
    # Spark limits the rank in each task before the rows move.
    few = ranges.withColumn("rank", F.expr("row_number() over (partition by variable, kind order by first)")).where(F.col("rank") <= LISTED)
    few = few.groupBy("variable", "kind").agg(F.sort_array(F.collect_list(F.struct("rank", text.alias("text")))).alias("few"))
    more = F.when(F.col("total") > LISTED, F.format_string(" y %s más", F.format_number(F.col("total") - LISTED, 0))).otherwise("")
    shown = F.concat(F.lit("["), F.array_join(F.transform("few", lambda r: r["text"]), ", "), F.lit("]"), more)
    both = totals.join(few, ["variable", "kind"]).withColumn("shown", shown)
    return both.groupBy("variable").agg(*[F.max(F.when(F.col("kind") == k, F.col("shown"))).alias(k + "s") for k in ("gap", "stray")])


def _time_values(df: DataFrame, domains: Mapping[str, tuple[int, int, bool]]) -> DataFrame:
    """(variable, v, n, low, high, closed): the distinct whole numbers of the time columns, in a written table."""
    names = [c for c in domains if c in df.columns]
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), as_integer(df, c).alias("v")) for c in names])
    seen = df.select(F.explode(cells).alias("x")).select("x.*").groupBy("variable", "v").agg(F.count(F.lit(1)).alias("n"))
    parts = [(name, F.create_map(*[F.lit(x) for c in names for x in (c, domains[c][i])])) for i, name in enumerate(("low", "high", "closed"))]
    kinds = {"low": "bigint", "high": "bigint", "closed": "boolean"}
    return written_once(seen.select("*", *[m[F.col("variable")].cast(kinds[k]).alias(k) for k, m in parts]), "time-values")


def _ranges(seen: DataFrame) -> DataFrame:
    """(variable, kind, first, last, n) of gaps and strays, from `_time_values`.

    Gaps lie between neighbours within range partitions; the value before a partition's first one comes from one edge row
    per partition, so no task holds more than a partition. A closed domain also has gaps at its ends.
    """
    inside = seen.where("v IS NOT NULL AND (NOT closed OR v BETWEEN low AND high)").select("variable", "v")
    ranged = inside.repartitionByRange("variable", "v").withColumn("part", F.spark_partition_id())
    ranged = written_once(ranged, "time-ranges")
    edges = ranged.groupBy("part").agg(F.max(F.struct("variable", "v")).alias("edge"))
    edges = edges.withColumn("edge", F.expr("lag(edge) over (order by part)"))  # a row per partition
    before = F.expr("lag(struct(variable, v)) over (partition by part order by variable, v)")
    near = ranged.withColumn("before", before).join(edges, "part").withColumn("before", F.coalesce("before", "edge"))
    near = near.where("before.variable = variable AND v > before.v + 1")
    between = near.selectExpr("variable", "before.v + 1 AS first", "v - 1 AS last")
    ends = seen.where("closed").groupBy("variable", "low", "high").agg(
        *[F.expr(f"{f}(CASE WHEN v BETWEEN low AND high THEN v END) AS {name}") for f, name in (("min", "least"), ("max", "greatest"))]
    )
    ends = ends.selectExpr(
        "variable",
        "inline(CASE WHEN least IS NULL THEN array(named_struct('first', low, 'last', high))"
        " ELSE array(named_struct('first', low, 'last', least - 1), named_struct('first', greatest + 1, 'last', high)) END)",
    ).where("first <= last")
    strays = seen.where("v < low OR v > high").selectExpr("variable", "'stray' AS kind", "v AS first", "v AS last")
    gaps = between.unionByName(ends).withColumn("kind", F.lit("gap"))
    return gaps.unionByName(strays).select("variable", "kind", "first", "last", (F.col("last") - F.col("first") + 1).alias("n"))


def temporal_gaps(df: DataFrame, domains: Mapping[str, tuple[int, int, bool]]) -> DataFrame:
    """(variable, kind, first, last, n): the gaps and the stray values of the time columns as rows, for `temporal_summary`."""
    return _ranges(_time_values(df, domains))


def temporal_summary(df: DataFrame, dataset: str, domains: Mapping[str, tuple[int, int, bool]]) -> DataFrame:
    """Range, gaps and out-of-domain values of whole-number time columns.

    `domains`: column -> (lowest, highest expected value, closed). A closed domain (months) must be full; an open one
    (years) must have no gap between its own minimum and maximum. Gaps are written as ranges, however wide a garbled
    column's range is; the text names the first LISTED of them and counts the rest, `temporal_gaps` gives all as rows.
    """
    seen = _time_values(df, domains)
    stats = seen.groupBy("variable").agg(
        F.min("v").alias("lo"),
        F.max("v").alias("hi"),
        F.count("v").alias("distintos"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("nulos"),
    )
    found = stats.join(_range_texts(_ranges(seen)), "variable", "left")
    wrong = F.col("gaps").isNotNull() | F.col("strays").isNotNull() | (F.col("nulos") > 0)
    return found.select(
        _tag(dataset),
        "variable",
        F.coalesce("lo", F.lit(0)).cast("bigint").alias("valor_minimo"),
        F.coalesce("hi", F.lit(0)).cast("bigint").alias("valor_maximo"),
        F.col("distintos").alias("valores_distintos"),
        "nulos",
        F.coalesce("gaps", F.lit("ninguno")).alias("gaps_en_rango"),
        F.coalesce("strays", F.lit("ninguno")).alias("valores_fuera_rango_esperado"),
        flag(wrong).alias("alerta"),
    )


def yearly_evolution(
    df: DataFrame, dataset: str, year: str, month: str | None = None, amount: str | None = None
) -> DataFrame:
    """Rows, amount totals and months with data per year. Grouped by (year, month) first, then by year."""
    keys = [as_integer(df, year).alias("ano")]
    if month:
        keys.append(column(month).cast("string").alias("mes"))
    value = as_number(df, amount) if amount else F.lit(None).cast("double")
    cells = df.select(*keys, value.alias("v")).groupBy(*["ano", "mes"][: len(keys)]).agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"), F.count("v").alias("valued")
    )
    columns = [F.sum("n").alias("registros")]
    if amount:
        total = F.coalesce(F.sum("total"), F.lit(0.0))
        mean = F.coalesce(F.sum("total") / F.nullif(F.sum("valued"), F.lit(0)), F.lit(0.0))
        columns += [F.round(total, 2).alias("sum_monto"), F.round(mean, 2).alias("avg_monto")]
    if month:
        columns.append(F.count("mes").alias("meses_con_datos"))
    yearly = cells.groupBy("ano").agg(*columns)
    names = [c for c in yearly.columns if c != "ano"]
    # A year that is NULL or no number is reported as 0.
    return yearly.select(_tag(dataset), F.coalesce("ano", F.lit(0)).cast("bigint").alias("ano"), *names).orderBy("ano")


def consistency_profile(df: DataFrame, dataset: str, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Code -> name pairs: distinct codes and names, and codes with several names. Exact, one shuffle for all pairs."""
    known = [(c, n) for c, n in pairs if c in df.columns and n in df.columns]
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("pair"), column(c).cast("string").alias("code"), column(n).cast("string").alias("name")
            )
            for i, (c, n) in enumerate(known)
        ]
    )
    long = df.select(F.explode(cells).alias("x")).select("x.*").distinct()
    codes = long.groupBy("pair", "code").agg(
        F.min("name").alias("lo"), F.max("name").alias("hi")
    )
    by_code = codes.groupBy("pair").agg(
        F.count("code").alias("cardinalidad_codigo"),
        F.count_if(F.col("code").isNotNull() & (F.col("lo") != F.col("hi"))).alias("codigos_con_multiples_nombres"),
    )
    names = long.select("pair", "name").distinct().groupBy("pair").agg(F.count("name").alias("cardinalidad_nombre"))
    described = literal_rows(
        df.sparkSession,
        [{"pair": i, "columna_codigo": c, "columna_nombre": n} for i, (c, n) in enumerate(known)],
        "pair int, columna_codigo string, columna_nombre string",
    )
    many = F.coalesce("codigos_con_multiples_nombres", F.lit(0)).cast("bigint")
    return described.join(by_code, "pair", "left").join(names, "pair", "left").select(
        _tag(dataset),
        "columna_codigo",
        "columna_nombre",
        F.coalesce("cardinalidad_codigo", F.lit(0)).cast("bigint").alias("cardinalidad_codigo"),
        F.coalesce("cardinalidad_nombre", F.lit(0)).cast("bigint").alias("cardinalidad_nombre"),
        many.alias("codigos_con_multiples_nombres"),
        F.when(many > 0, "INCONSISTENTE").otherwise(OK).alias("consistencia"),
        F.when(many > 0, F.concat(many.cast("string"), F.lit(" código(s) tienen más de un nombre asociado")))
        .otherwise("Relación 1→1 correcta")
        .alias("nota"),
    )


def sign_profile(df: DataFrame, dataset: str, amounts: Sequence[str]) -> DataFrame:
    """Negative, zero, positive and NULL amounts with their range, total and mean. One pass."""
    names = [c for c in amounts if c in df.columns]

    def metrics(name: str) -> dict[str, str]:
        v = number_sql(df, name)
        return {
            "negativos": f"count_if({v} < 0)",
            "ceros": f"count_if({v} = 0)",
            "positivos": f"count_if({v} > 0)",
            "nulos": f"count_if({v} IS NULL)",
            "lo": f"min({v})",
            "hi": f"max({v})",
            "total": f"sum({v})",
            "mean": f"avg({v})",
        }

    found = per_column(df, names, metrics, "columna", cost=9)
    rows = F.col("n_rows")
    negative, zero = F.col("negativos"), F.col("ceros")
    return found.select(
        _tag(dataset),
        "columna",
        rows.alias("total_filas"),
        "negativos",
        percent(negative, rows).alias("pct_negativos"),
        "ceros",
        percent(zero, rows).alias("pct_ceros"),
        "positivos",
        percent(F.col("positivos"), rows).alias("pct_positivos"),
        "nulos",
        F.round("lo", 2).alias("valor_minimo"),
        F.round("hi", 2).alias("valor_maximo"),
        F.round("total", 2).alias("suma_total"),
        F.round("mean", 4).alias("promedio"),
        flag(negative > 0).alias("alerta_negativos"),
        F.when(rows == 0, NO_DATA).when(zero / rows > ZERO_ALERT, REVIEW).otherwise(OK).alias("alerta_ceros"),
        F.when(
            negative > 0,
            F.concat(F.format_number(negative, 0), F.lit(" valores negativos detectados — ingresos negativos son inusuales")),
        )
        .otherwise("Sin valores negativos")
        .alias("nota"),
    )


_ORDERED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.StringType, T.TimestampType)


def generic_profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """NULLs, distinct values, minimum and maximum of every column of any type. One pass.

    `exact` counts the distinct values of each column by itself: counted together, every row would be copied once per column,
    and a task would hold the values of all columns, each as wide as all of them.
    """
    kinds = {f.name: f.dataType for f in df.schema}

    def metrics(name: str) -> dict[str, str]:
        v = quoted(name)
        ordered = isinstance(kinds[name], _ORDERED)
        distinct = {} if exact else {"Cardinalidad_Aprox": f"approx_count_distinct({v}, {APPROX_ERROR})"}
        return {
            "Nulos": f"count_if({v} IS NULL)",
            **distinct,
            "Min": f"CAST(min({v}) AS STRING)" if ordered else "max(CAST(NULL AS STRING))",
            "Max": f"CAST(max({v}) AS STRING)" if ordered else "max(CAST(NULL AS STRING))",
        }

    found = per_column(df, df.columns, metrics, "Columna")
    if exact:
        each = [df.agg(F.count_distinct(column(c)).alias("Cardinalidad_Aprox")).withColumn("Columna", F.lit(c)) for c in df.columns]
        found = found.join(stack(each), "Columna")  # a row per column
    kind = F.create_map(*[F.lit(x) for n, k in kinds.items() for x in (n, k.simpleString())])
    return found.select(
        "Columna",
        kind[F.col("Columna")].alias("Tipo_Spark"),
        "Nulos",
        percent(F.col("Nulos"), F.col("n_rows")).alias("Porcentaje_Nulos"),
        "Cardinalidad_Aprox",
        F.coalesce("Min", F.lit("")).alias("Min"),
        F.coalesce("Max", F.lit("")).alias("Max"),
        F.col("n_rows").alias("Total_Filas"),
    )


def generic_summary(profile: DataFrame) -> DataFrame:
    """One row over a generic profile. An empty table is an error, as a profile of nothing says nothing."""
    with_nulls = F.col("Nulos") > 0
    n = F.count(F.lit(1))
    empty = F.coalesce(F.max("Total_Filas"), F.lit(0)) == 0
    total = F.when(empty, F.raise_error(F.lit("the table has no rows")).cast("bigint")).otherwise(F.max("Total_Filas"))
    return profile.agg(
        total.alias("total_filas"),
        n.alias("total_columnas"),
        F.count_if(with_nulls).alias("columnas_con_nulos"),
        F.count_if(~with_nulls).alias("columnas_sin_nulos"),
        F.round(F.count_if(~with_nulls) / n * 100, 2).alias("completitud_columnas_pct"),
        F.floor(F.avg("Cardinalidad_Aprox")).alias("cardinalidad_promedio"),
    )


def profile_metadata(df: DataFrame, dataset: str, paths: Sequence[str]) -> DataFrame:
    """One row: what was profiled."""
    return df.agg(F.count(F.lit(1)).alias("total_filas")).select(
        _tag(dataset),
        "total_filas",
        F.lit(len(df.columns)).alias("total_columnas"),
        F.lit(len(paths)).alias("archivos_combinados"),
        F.lit(" | ".join(paths)).alias("rutas"),
        F.lit(OK).alias("estado"),
    )


def alert_totals(nulls: DataFrame, duplicates: DataFrame, signs: DataFrame, consistency: DataFrame) -> DataFrame:
    """One row over the sections: what asks for review, and the overall verdict."""
    exact = F.col("tipo_duplicado") == "Filas exactas duplicadas"
    lines = stack(
        [
            duplicates.agg(F.coalesce(F.sum(F.when(exact, F.col("conteo"))), F.lit(0)).alias("duplicados_exactos")),
            nulls.agg(F.count_if(F.col("pct_faltantes") > MISSING_ALERT * 100).alias("columnas_con_faltantes")),
            signs.agg(F.count_if(F.col("negativos") > 0).alias("montos_con_negativos")),
            consistency.agg(F.count_if(F.col("consistencia") == "INCONSISTENTE").alias("pares_inconsistentes")),
        ]
    )
    names = ("duplicados_exactos", "columnas_con_faltantes", "montos_con_negativos", "pares_inconsistentes")
    merged = lines.agg(*[F.coalesce(F.max(n), F.lit(0)).cast("bigint").alias(n) for n in names])
    total = F.col(names[0])
    for n in names[1:]:
        total = total + F.col(n)
    return merged.withColumn("estado", flag(total > 0))
