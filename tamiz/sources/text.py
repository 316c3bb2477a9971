"""Landed CSV: all-text scans, encoding and delimiter detection, quarantine of malformed lines, dictionaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.text import column, header_name, header_text, strip
from tamiz.sources.parquet import list_files

# Delimiters in the order they are tried, header aliases of dictionary files.
DELIMITERS = (";", ",", "\t")
NAME_HEADERS = ("VARIABLE", "COLUMNA", "CAMPO")
TYPE_HEADERS = ("TIPO_DATO", "TIPO", "TYPE")
DESCRIPTION_HEADERS = ("DESCRIPCION", "DESCRIPCIÓN", "DESCRIPTION")
UTF8, LATIN = "UTF-8", "ISO-8859-1"
_OVERFLOW, _PATH, _UTF8 = "__overflow", "__path", "__utf8"
#: Files whose headers are read side by side.
AT_ONCE = 16


@dataclass(frozen=True)
class Landing:
    """Rows that fit the header, and the lines that held more fields than it."""

    rows: DataFrame
    quarantine: DataFrame


def _headers(spark: SparkSession, paths: Sequence[str], options: Mapping[str, str]) -> dict[str, list[str]]:
    """path -> column names of every file with a line. Only first lines are read, of AT_ONCE files side by side."""
    files = sorted({r["path"] for p in paths for r in list_files(spark, p, "*").select("path").collect()})
    with ThreadPoolExecutor(AT_ONCE) as pool:
        found = pool.map(lambda f: spark.read.options(**options, header="true").csv(f).columns, files)
    return {f: names for f, names in zip(files, found, strict=True) if names}


def _named(raw: str, encoding: str | None) -> str:
    """A column name whose bytes were read as Latin-1, in the encoding that its bytes have."""
    if encoding is None:
        try:
            raw = raw.encode(LATIN).decode(UTF8)
        except UnicodeDecodeError:
            pass
    return raw.replace("\ufeff", "")


def _decoded(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Fields whose bytes were read as Latin-1: as UTF-8 where all of the row's are, else as they are."""
    as_utf8 = {n: F.encode(column(n), LATIN).cast("string") for n in names}
    valid = F.lit(True)
    for text in as_utf8.values():
        valid = valid & F.coalesce(F.is_valid_utf8(text), F.lit(True))
    marked = df.withColumn(_UTF8, valid)
    return marked.withColumns({n: F.when(F.col(_UTF8), as_utf8[n]).otherwise(column(n)) for n in names}).drop(_UTF8)


def read_csv(
    spark: SparkSession, *paths: str, sep: str = ",", encoding: str | None = None, multi_line: bool = False
) -> Landing:
    """All columns as text, an empty field stays ''. Short lines are padded, long ones go to the quarantine.

    Files are matched by column name: those with the same header are one scan, the scans are united by name. Without an
    encoding the bytes are told apart in the scan itself: a row that is UTF-8 is read so, any other as Latin-1. Quoted line
    breaks need `multi_line`, which costs the splitting of large files.
    """
    options = {"sep": sep, "encoding": encoding or LATIN, "mode": "PERMISSIVE", "multiLine": str(multi_line).lower()}
    options["escape"] = '"'  # a quote inside a quoted field is doubled
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, raw in _headers(spark, paths, options).items():
        groups.setdefault(tuple(_named(n, encoding) for n in raw), []).append(path)
    rows, bad = None, None
    for names, files in groups.items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _OVERFLOW]])
        scanned = spark.read.options(**options, header="true").schema(schema).csv(files).withColumn(_PATH, F.col("_metadata.file_path"))
        scanned = scanned if encoding else _decoded(scanned, [*names, _OVERFLOW])
        over = F.col(_OVERFLOW).isNotNull()
        good = scanned.where(~over).select(*[F.coalesce(column(n), F.lit("")).alias(n) for n in names])
        line = F.to_json(F.struct(*[column(n) for n in names], F.col(_OVERFLOW))).alias("line")
        long = scanned.where(over).select(line, F.col(_PATH).alias("path"))
        rows = good if rows is None else rows.unionByName(good, allowMissingColumns=True)
        bad = long if bad is None else bad.unionByName(long)
    if rows is None:
        raise FileNotFoundError(f"no CSV file in {paths}")
    return Landing(rows, bad)


def sniff_delimiter(spark: SparkSession, path: str, encodings: Sequence[str] = (UTF8, LATIN)) -> tuple[str, str] | None:
    """(encoding, delimiter) of the first combination that splits the header; None if there is none."""
    for enc in encodings:
        for sep in DELIMITERS:
            header = spark.read.options(header="true", sep=sep, encoding=enc).csv(path).columns
            if len(header) > 1 and "\ufffd" not in "".join(header):
                return enc, sep
    return None


def read_csv_sniffed(spark: SparkSession, path: str) -> Landing:
    found = sniff_delimiter(spark, path)
    if found is None:
        raise ValueError(f"no delimiter of {DELIMITERS} splits the header of {path}")
    return read_csv(spark, path, sep=found[1], encoding=None if found[0] in (UTF8, LATIN) else found[0])


def _trimmed(df: DataFrame) -> DataFrame:
    return df.select(*[F.coalesce(strip(column(c)), F.lit("")).alias(c) for c in df.columns])


def read_catalogue(spark: SparkSession, path: str, dataset: str, name_column: str, required: Sequence[str] = (), sep: str = ";") -> DataFrame:
    """A dictionary file with known headers: required columns checked, nameless and repeated entries dropped."""
    table = _trimmed(read_csv(spark, path, sep=sep).rows)
    gone = [c for c in (name_column, *required) if c not in table.columns]
    if gone:
        raise ValueError(f"{path}: missing dictionary columns {gone}")
    named = table.withColumns({"dataset": F.lit(dataset), "official_column": header_text(column(name_column))})
    return named.where(F.col("official_column") != "").dropDuplicates(["dataset", "official_column"])


def read_dictionary(spark: SparkSession, path: str, dataset: str, sep: str = ",") -> DataFrame:
    """A dictionary file whose headers vary: name, type and description columns are found by their aliases."""
    table = _trimmed(read_csv(spark, path, sep=sep).rows)
    by_header = {header_name(c): c for c in table.columns}

    def pick(aliases: Sequence[str]) -> str | None:
        return next((by_header[a] for a in aliases if a in by_header), None)

    name, kind, text = pick(NAME_HEADERS), pick(TYPE_HEADERS), pick(DESCRIPTION_HEADERS)
    if name is None:
        raise ValueError(f"{path}: no dictionary header among {table.columns}")
    return (
        table.select(
            F.lit(dataset).alias("dataset"),
            header_text(column(name)).alias("official_column"),
            (column(kind) if kind else F.lit("")).alias("official_type"),
            (column(text) if text else F.lit("")).alias("official_description"),
            F.lit("dictionary_csv").alias("dictionary_source"),
        )
        .where(F.col("official_column") != "")
        .dropDuplicates(["dataset", "official_column"])
    )
