"""A training corpus in five stages, each an operator of ``tamiz.llm`` over all that the stage before it kept.

``run(spark, sf_dir)`` applies STAGES to the documents table; every stage is written as Parquet to the shared folder and read again.
Workers are used again from stage to stage, so each stage asks for small batches, and tasks give back what they took.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm import decontaminate, lines, neardup, packing, quality
from tamiz.llm.common import small_batches
from tamiz.session import written_once


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are neither toxic nor of low quality, each judged by its own text and site."""
    small_batches(spark)
    return quality.keep(docs, quality.labels_of(spark, sf_dir))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are kept elsewhere; those left without any text go. n_chars follows the text."""
    small_batches(spark)
    cleared = lines.deduplicate_lines(docs, min_words=1)
    cleared = cleared.where((F.col("lines_removed") == 0) | F.col("text").rlike(r"\S"))
    changed = F.when(F.col("lines_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cleared.withColumn("n_chars", changed).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: those linked by pairs that share 80 % of their five-word shingles."""
    small_batches(spark)
    return neardup.representatives(docs, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    small_batches(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed training sequences."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: The classifier, SimHash and the tokenizer are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written_once(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
