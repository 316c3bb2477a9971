"""Many metrics over many columns, in as few scans as Spark will compile."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import literal
from tamiz.session import written_once

# Aggregation buffers per pass; operators with more than 100 fields lose whole-stage code generation.
BUFFERS_PER_PASS = 90


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name of report frames; columns one of them lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def per_column(
    df: DataFrame,
    columns: Sequence[str],
    metrics: Callable[[str], Mapping[str, str]],
    label: str = "column_name",
    cost: int | None = None,
) -> DataFrame:
    """One row per column: (label, n_rows, metrics...), from one aggregation per group of columns.

    `metrics` gives SQL aggregates by name. Each pass reads only its own columns, so the passes together read the table
    once. `cost` is the number of aggregation buffers a column needs when that differs from its number of metrics.
    """
    if not columns:
        raise ValueError("no columns to measure")
    measured = [(name, metrics(name)) for name in columns]
    width = max(1, BUFFERS_PER_PASS // max(1, cost or len(measured[0][1])))

    def one_pass(part: Sequence[tuple[str, Mapping[str, str]]]) -> DataFrame:
        aggregates, rows = ["count(1) AS n_rows"], []
        for i, (name, named) in enumerate(part):
            aggregates += [f"{sql} AS m{i}_{alias}" for alias, sql in named.items()]
            fields = "".join(f", {literal(alias)}, m{i}_{alias}" for alias in named)
            rows.append(f"named_struct({literal(label)}, {literal(name)}, 'n_rows', n_rows{fields})")
        return df.agg(*[F.expr(a) for a in aggregates]).selectExpr(f"inline(array({', '.join(rows)}))")

    return stack([one_pass(measured[i : i + width]) for i in range(0, len(measured), width)])


def flag_counts(
    df: DataFrame,
    columns: Sequence[str],
    flags: Callable[[str], Mapping[str, str]],
    rows: Mapping[str, str],
    label: str = "column_name",
) -> DataFrame:
    """One row per column: (label, n_rows, counts of `rows`, counts of `flags`), from one scan however wide the table is.

    `flags` gives SQL conditions by name for each column, the same names for all, and `rows` conditions on the whole row. A
    row becomes one (position, bits) cell for each column with a flag set and one for itself; cells are counted inside each
    map task, so a task hands on a few numbers per column. The counts are written once.
    """
    names = list(flags(columns[0]))

    def bits(conditions: Sequence[str]) -> str:
        return " + ".join(f"if({c}, {1 << i}, 0)" for i, c in enumerate(conditions))

    cells = [bits([flags(c)[n] for n in names]) for c in columns] + [bits(["true", *rows.values()])]
    seen = df.select(F.expr(f"posexplode(array({', '.join(cells)})) AS (pos, bits)")).where("bits <> 0")
    counts = written_once(seen.groupBy("pos", "bits").agg(F.count(F.lit(1)).alias("n")), "flags")

    def total(bit: int, name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(1 << bit) > 0, F.col("n"))), F.lit(0)).cast("bigint").alias(name)

    whole = counts.where(F.col("pos") == len(columns)).agg(*[total(i, n) for i, n in enumerate(("n_rows", *rows))])
    # One row is copied to each column of the table.
    each = whole.select(F.posexplode(F.array(*[F.lit(c) for c in columns])).alias("pos", label), "*")
    own = counts.where(F.col("pos") < len(columns)).groupBy("pos").agg(*[total(i, n) for i, n in enumerate(names)])
    return each.join(own, "pos", "left").fillna(0, names).drop("pos")


def side_by_side(frames: Sequence[DataFrame]) -> DataFrame:
    """One-row tables with different columns as one row."""
    return stack(frames).agg(*[F.max(c).alias(c) for f in frames for c in f.columns])
