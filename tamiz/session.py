"""What the library needs from the caller's session: a place that every executor can reach."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_fallback: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared work folder, as named in the session. Only a local[*] session may fall back to /tmp."""
    folder = spark.conf.get(_CHECKPOINT_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError(f"{_CHECKPOINT_KEY} is unset: name a folder all executors can reach")
    if not _local_fallback:
        _local_fallback.append(tempfile.mkdtemp(prefix="tamiz-"))
    return _local_fallback[0]


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written_once(df: DataFrame, label: str) -> DataFrame:
    """An intermediate table that several parts of a job read: written to the shared folder, then read back.

    Unlike a cache it survives lost executors, and unlike a plan used twice it is computed once.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def literal_rows(spark: SparkSession, rows: Sequence[Mapping[str, Any]], ddl: str) -> DataFrame:
    """A small driver-side list as a DataFrame: one literal in the plan, no job and no Python worker."""
    payload = F.from_json(F.lit(json.dumps(list(rows), ensure_ascii=False)), f"array<struct<{ddl}>>")
    return spark.range(0, 1, 1, 1).select(F.inline(payload))
