"""Silver -> Gold: annual totals with partial years, one canonical name per code, and a star schema with checked keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.casts import as_integer, as_number, integer_sql
from tamiz.functions.text import column, name_text, quoted
from tamiz.operators.numbering import numbered
from tamiz.operators.wide import stack
from tamiz.session import written_once
from tamiz.sinks.tables import overwrite_flat, overwrite_partitions

#: The key and the label of the member that stands for facts without a known one.
UNKNOWN_KEY, UNKNOWN_LABEL = 0, "DESCONOCIDO"
MONTHS = 12


# --- years -----------------------------------------------------------------------------------------------------


def year_coverage(df: DataFrame, year: str, month: str, expected_months: int = MONTHS) -> DataFrame:
    """(ano, meses_con_datos, ano_parcial): the months 1 to `expected_months` that each year has rows in."""
    cells = df.select(as_integer(df, year).alias("ano"), as_integer(df, month).alias("mes")).distinct()
    months = F.count_if(F.col("mes").between(1, expected_months))
    years = cells.where("ano IS NOT NULL").groupBy("ano").agg(months.alias("meses_con_datos"))
    return years.withColumn("ano_parcial", F.col("meses_con_datos") < expected_months)


def mark_partial_years(df: DataFrame, year: str, month: str, expected_months: int = MONTHS) -> DataFrame:
    """`df` with meses_con_datos and ano_parcial of each row's year; NULL where the row has no year."""
    coverage = year_coverage(df, year, month, expected_months).withColumnRenamed("ano", "__ano")
    return df.withColumn("__ano", as_integer(df, year)).join(coverage, "__ano", "left").drop("__ano")


def annual_totals(
    df: DataFrame, entity: Sequence[str], year: str, month: str, amounts: Sequence[str], expected_months: int = MONTHS
) -> DataFrame:
    """Totals of amounts by year and entity, by year, and over all, with the months that each line has data in.

    Columns: nivel (entidad, ano, total), ano, the entity, registros, a total per amount, meses_con_datos and ano_parcial (of the
    year, on its own line and on those of its entities; NULL on the last line). An opening budget that stands in one month
    only is thus an annual figure. Rows are summed by (year, month, entity) before they are rolled up.
    """
    keys = [as_integer(df, year).alias("ano"), as_integer(df, month).alias("mes"), *[column(c) for c in entity]]
    names = [f"total_{a}" for a in amounts]
    base = df.select(*keys, *[as_number(df, a).alias(n) for a, n in zip(amounts, names, strict=True)])
    grouped = ["ano", "mes", *[quoted(c) for c in entity]]
    cells = base.groupBy(*grouped).agg(F.count(F.lit(1)).alias("registros"), *[F.sum(quoted(n)).alias(n) for n in names])
    fitting = F.when(F.col("mes").between(1, expected_months), F.col("mes"))
    sums = [F.sum("registros").alias("registros"), *[F.round(F.coalesce(F.sum(quoted(n)), F.lit(0.0)), 2).alias(n) for n in names]]
    # The year is the first key of the rollup; entities are one key together.
    own = F.struct(*[column(c) for c in entity]).alias("__entity")
    rolled = cells.select("*", own).rollup("ano", "__entity").agg(
        *sums, F.count_distinct(fitting).alias("meses"), F.grouping_id().alias("__level")
    )
    coverage = year_coverage(df, year, month, expected_months).drop("meses_con_datos")
    level = F.when(F.col("__level") == 0, "entidad").when(F.col("__level") == 1, "ano").otherwise("total")
    return rolled.join(coverage, "ano", "left").select(
        level.alias("nivel"),
        "ano",
        *[F.col("__entity")[c].alias(c) for c in entity],
        "registros",
        *[column(n) for n in names],
        F.col("meses").alias("meses_con_datos"),
        F.when(level != "total", F.coalesce("ano_parcial", F.lit(True))).alias("ano_parcial"),
    )


# --- names -----------------------------------------------------------------------------------------------------


def canonical_names(df: DataFrame, codes: Sequence[str], name: str, year: str, into: str = "nombre_canonico") -> DataFrame:
    """One row per code: the name of its latest year, normalised; of several, the most frequent, then the first by text.

    Names are counted by (code, name, year) in each task, and only the best of a code leaves it.
    """
    named = df.select(*[column(c) for c in codes], name_text(column(name).cast("string")).alias(into), as_integer(df, year).alias("ultimo_ano"))
    keys = ", ".join(quoted(c) for c in codes)
    counted = named.where(F.col(into).isNotNull() & (F.col(into) != "")).groupBy(*named.columns).agg(F.count(F.lit(1)).alias("n"))
    best = f"row_number() over (partition by {keys} order by ultimo_ano desc nulls last, n desc, {quoted(into)})"
    first = counted.withColumn("__best", F.expr(best)).where(F.col("__best") == 1)
    return first.select(*[column(c) for c in codes], into, "ultimo_ano")


def with_canonical_names(df: DataFrame, codes: Sequence[str], name: str, year: str, into: str = "nombre_canonico") -> DataFrame:
    """`df` with the canonical name of each row's code; a code without any name keeps NULL."""
    names = canonical_names(df, codes, name, year, into).drop("ultimo_ano")
    theirs = names.select(*[column(c).alias(f"__{i}") for i, c in enumerate(codes)], into)
    met = [df[quoted(c)].eqNullSafe(theirs[f"__{i}"]) for i, c in enumerate(codes)]
    on = met[0]
    for m in met[1:]:
        on = on & m
    return df.join(theirs, on, "left").drop(*[f"__{i}" for i in range(len(codes))])


# --- star schema -----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Dimension:
    """A dimension of the facts.

    `keys` are its natural key; a fact with a NULL in it belongs to the unknown member. `attributes` are columns that follow the
    key: a member takes the values of its first row by `latest` (descending, then by value). `surrogate` is a SQL
    expression of the key that tells its members apart and is a whole number, or None for numbers from 1 in key order.
    """

    name: str
    keys: tuple[str, ...]
    attributes: tuple[str, ...] = ()
    latest: tuple[str, ...] = ()
    surrogate: str | None = None

    @property
    def key(self) -> str:
        return f"sk_{self.name}"


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    dimensions: Mapping[str, DataFrame] = field(default_factory=dict)


def _complete(names: Sequence[str]) -> Column:
    return F.expr(" AND ".join(f"{quoted(n)} IS NOT NULL" for n in names))


def _members(facts: DataFrame, dim: Dimension) -> DataFrame:
    """One row per natural key with its attributes and its surrogate key, in a written table."""
    held = list(dict.fromkeys([*dim.keys, *dim.attributes, *dim.latest]))
    seen = facts.where(_complete(dim.keys)).select(*[column(c) for c in held]).distinct()
    if len(held) > len(dim.keys):
        order = [f"{quoted(c)} desc nulls last" for c in dim.latest] + [quoted(c) for c in dim.attributes]
        best = f"row_number() over (partition by {', '.join(map(quoted, dim.keys))} order by {', '.join(order)})"
        seen = seen.withColumn("__best", F.expr(best)).where(F.col("__best") == 1).select(*dim.keys, *dim.attributes)
    if dim.surrogate is None:
        keyed = numbered(seen, dim.keys, dim.key)
    else:
        keyed = seen.withColumn(dim.key, F.expr(dim.surrogate).cast("bigint"))
    return written_once(keyed.select(dim.key, *[c for c in seen.columns]), f"dimension-{dim.name}")


def _with_unknown(members: DataFrame, dim: Dimension) -> DataFrame:
    """The members and the unknown one: NULL key and attributes, or the label where they are text."""
    kinds = dict(members.dtypes)
    blank = [F.lit(UNKNOWN_LABEL if kinds[c] == "string" and c not in dim.keys else None).cast(kinds[c]).alias(c) for c in members.columns[1:]]
    one = members.sparkSession.range(1).select(F.lit(UNKNOWN_KEY).cast("bigint").alias(dim.key), *blank)
    return members.unionByName(one)


def star_schema(facts: DataFrame, dimensions: Sequence[Dimension], measures: Sequence[str]) -> Star:
    """Dimensions with unknown members, and the facts with a foreign key for each and the measures.

    Every fact keeps its row. Surrogate keys are checked: each is one member's only, none is the unknown member's, and each
    fact's key is among its dimension's; anything else raises.
    """
    tables, fact = {}, facts
    for dim in dimensions:
        members = _members(facts, dim)
        checks = members.agg(
            F.count(F.lit(1)).alias("members"), F.count_distinct(dim.key).alias("keys"), F.count_if(F.col(dim.key) == UNKNOWN_KEY).alias("taken")
        ).first()
        if checks["members"] != checks["keys"] or checks["taken"]:
            raise ValueError(f"{dim.name}: {checks['members']} members, {checks['keys']} keys, {checks['taken']} of them the unknown member's")
        theirs = members.select(dim.key, *[column(k).alias(f"__{dim.name}_{i}") for i, k in enumerate(dim.keys)])
        renamed = [f"__{dim.name}_{i}" for i in range(len(dim.keys))]
        met = " AND ".join(f"{quoted(k)} = {quoted(r)}" for k, r in zip(dim.keys, renamed, strict=True))
        fact = fact.join(theirs, F.expr(met), "left").drop(*renamed)
        fact = fact.withColumn(dim.key, F.coalesce(F.col(dim.key), F.lit(UNKNOWN_KEY).cast("bigint")))
        tables[dim.name] = _with_unknown(members, dim)
    return Star(fact.select(*[d.key for d in dimensions], *[column(m) for m in measures]), tables)


def star_check(star: Star) -> DataFrame:
    """(dimension, members, facts, unknown, orphans): a line per dimension; orphans are facts whose key is no member's."""
    lines = []
    for name, members in star.dimensions.items():
        key = f"sk_{name}"
        used = star.fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        known = members.select(key, F.lit(True).alias("known"))
        met = known.join(used, key, "full_outer")
        n = F.coalesce("n", F.lit(0))
        lines.append(
            met.agg(
                F.count("known").alias("members"),
                F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("facts"),
                F.coalesce(F.sum(F.when(F.col(key) == UNKNOWN_KEY, n)), F.lit(0)).cast("bigint").alias("unknown"),
                F.coalesce(F.sum(F.when(F.col("known").isNull(), n)), F.lit(0)).cast("bigint").alias("orphans"),
            ).select(F.lit(name).alias("dimension"), "*")
        )
    return stack(lines)


def month_dimension(df: DataFrame, year: str, month: str, name: str = "tiempo") -> Dimension:
    """The time dimension of whole-number year and month columns, with the month key (202604) as surrogate."""
    return Dimension(name, (year, month), surrogate=f"{integer_sql(df, year)} * 100 + {integer_sql(df, month)}")


def write_star(star: Star, root: str, source: str, partition_by: Sequence[str] = ()) -> Mapping[str, str]:
    """Writes the tables below {root}/{source}, the facts regrouped by their partition columns; gives the paths."""
    paths = {f"dim_{name}": overwrite_flat(table, root, source, f"dim_{name}") for name, table in star.dimensions.items()}
    if not partition_by:
        return paths | {"fact": overwrite_flat(star.fact, root, source, "fact")}
    return paths | {"fact": overwrite_partitions(star.fact, f"{root}/{source}/fact", partition_by, regroup=True)}
