"""Parquet landings: plain and schema-merging scans, file choice, inventory."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tamiz.functions.text import column
from tamiz.session import literal_rows

# Fixed value: the path part that marks daily files.
DAILY_TOKEN = "_diario"
#: Footers that the driver reads side by side.
AT_ONCE = 16


def all_text(df: DataFrame) -> DataFrame:
    """Columns without a type (all values NULL at the source) read as text."""
    return df.select(*[column(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.NullType) else column(f.name) for f in df.schema])


def read_parquet(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    """One table over all paths; `merge_schema` unifies files by column name."""
    return all_text(spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(*paths))


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, modificationTime, length) of all files below a root; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return files.load(root).select("path", "modificationTime", "length")


def without_token(path: Column, token: str = DAILY_TOKEN) -> Column:
    """The token occurs nowhere in the path, in any case. Daily files repeat the monthly ones."""
    return ~F.lower(path).contains(token.lower())


def eligible_files(spark: SparkSession, root: str, token: str = DAILY_TOKEN, required: bool = True) -> DataFrame:
    found = list_files(spark, root).where(without_token(F.col("path"), token))
    if required and found.isEmpty():
        raise FileNotFoundError(f"no Parquet file below {root} without {token!r} in its path")
    return found


def read_history(spark: SparkSession, root: str, token: str = DAILY_TOKEN) -> DataFrame:
    """All eligible files below a root as one table, columns unified by name.

    The files are named one by one, as the driver lists them for any scan; so excluded files cannot add columns.
    """
    files = sorted(r[0] for r in eligible_files(spark, root, token).select("path").collect())
    return read_parquet(spark, *files, merge_schema=True)


def relative_path(path: Column, root: str) -> Column:
    marker = "/" + root.rstrip("/").split("/")[-1] + "/"
    return F.substring_index(path, marker, -1)


def one_file_per_dataset(spark: SparkSession, root: str, token: str = DAILY_TOKEN) -> DataFrame:
    """(dataset, path): the first folder below the root names the dataset; a file in that folder itself beats dated
    copies deeper down, then the last path of the folder's own files, else the first path."""
    files = eligible_files(spark, root, token, required=False)
    relative = relative_path(F.col("path"), root)
    parts = F.split(relative, "/")
    staged = files.select("path", parts[0].alias("dataset"), F.size(parts).alias("depth")).where("depth > 1")
    own = F.col("depth") == 2
    picked = staged.groupBy("dataset").agg(
        F.coalesce(F.max(F.when(own, F.col("path"))), F.min("path")).alias("path")
    )
    return picked


def latest_file(spark: SparkSession, root: str, pattern: str = "*.parquet") -> str:
    """The newest file below a root, the last path among equally new ones."""
    newest = list_files(spark, root, pattern).agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]
    if newest is None:
        raise FileNotFoundError(f"no {pattern} below {root}")
    return newest


class Catalog(Mapping[str, DataFrame]):
    """Datasets by name, each opened once: {root}/{dataset} by default."""

    def __init__(self, spark: SparkSession, root: str, datasets: Sequence[str], layout: str = "{root}/{dataset}"):
        self._spark, self._root, self._names, self._layout = spark, root.rstrip("/"), list(datasets), layout
        self._open: dict[str, DataFrame] = {}

    def path(self, dataset: str) -> str:
        return self._layout.format(root=self._root, dataset=dataset)

    def __getitem__(self, dataset: str) -> DataFrame:
        if dataset not in self._names:
            raise KeyError(dataset)
        if dataset not in self._open:
            try:
                self._open[dataset] = read_parquet(self._spark, self.path(dataset))
            except AnalysisException as exc:
                raise FileNotFoundError(f"no Parquet for {dataset!r}: {self.path(dataset)}") from exc
        return self._open[dataset]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def _columns_of(spark: SparkSession, path: str) -> int | None:
    """Columns by a file's footer; None if it has none that can be read."""
    try:
        return len(spark.read.parquet(path).columns)
    except (AnalysisException, PySparkException, Py4JJavaError):
        return None


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes, rows, columns, readable) per Parquet file.

    A file is readable if its footer is, so an empty table is; one that is not is listed instead of ending the job. The driver
    reads AT_ONCE footers side by side; rows come from one scan that reads no column.
    """
    listed = list_files(spark, root)
    files = sorted(r[0] for r in listed.select("path").collect())
    with ThreadPoolExecutor(AT_ONCE) as pool:
        counted = list(pool.map(lambda f: _columns_of(spark, f), files))
    columns = [{"path": f, "columns": n} for f, n in zip(files, counted, strict=True) if n is not None]
    footers = literal_rows(spark, columns, "path string, columns int")
    found = listed.join(footers, "path", "left")
    if columns:
        table = spark.read.schema("`-` int").parquet(*[c["path"] for c in columns])
        counted = table.groupBy(F.col("_metadata.file_path").alias("uri")).agg(F.count(F.lit(1)).alias("rows"))
        # A scanned file's path is a URI. It is decoded once per file: as it is never NULL, the join below has no NULLs to
        # look for, a test that would go down to the rows.
        plain = F.coalesce(F.url_decode(F.replace("uri", F.lit("+"), F.lit("%2B"))), F.lit(""))
        found = found.join(counted.select(plain.alias("path"), "rows"), "path", "left")
    else:
        found = found.withColumn("rows", F.lit(None).cast("bigint"))
    return found.select(
        "path",
        F.col("length").alias("bytes"),
        F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce("columns", F.lit(0)).alias("columns"),
        F.col("columns").isNotNull().alias("readable"),
    )


def inventory_totals(inventory: DataFrame) -> DataFrame:
    return inventory.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(~F.col("readable")).alias("unreadable"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("bytes"),
    )


def head(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
