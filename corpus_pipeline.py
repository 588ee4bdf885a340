"""The corpus pipeline: quality filter, exact and near dedup, masking, packing.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows of ``docs``
and, but for the last, returns the columns of ``docs``.  Between stages the
rows are written as Parquet under the shared checkpoint folder and reread.

Cases: a null or empty text is scored as empty, and its group of copies keeps
one row; rows with a null key pass like others and lose to a named one;
repeated rows are copies of each other; texts of any length are read whole;
an empty table passes all stages and gives no pieces; further columns, also
null ones, are carried to the last stage untouched.
"""

from __future__ import annotations

import gc
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.llm import chunk_dedup, hilbert_pack, nbsvm, pii, pivot_simhash
from tickhouse.llm.common import read_table, ship, stored
from tickhouse.llm.queries import quality_model

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _settled(spark: SparkSession) -> None:
    """Drops what earlier stages left on the driver: plans and their broken-off references."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents the quality classifier rejects."""
    model = quality_model(spark, docs, sf_dir)
    return docs.where(nbsvm.accepted(F.coalesce("text", F.lit("")), model))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of equal texts."""
    _settled(spark)
    return chunk_dedup.distinct_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component."""
    _settled(spark)
    return pivot_simhash.representatives(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts; ``n_chars`` follows the new text."""
    _settled(spark)
    masked = docs.withColumn("text", pii.redacted(F.col("text")))
    return masked.withColumn("n_chars", F.char_length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences, neighbours along the curve together."""
    _settled(spark)
    return hilbert_pack.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("personal_data", private),
    ("packing", packing),
]

#: The classifier, the masking and the packing cannot be written in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed pieces."""
    ship(spark)
    docs = read_table(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
