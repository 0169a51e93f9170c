"""Documents to training data, in five stages.

Each stage works on all that its predecessor kept, and all but the last return
the columns of ``documents``. Between stages the documents are written as
Parquet and read again, which also cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.bpe import round_trip
from lexmill.llm.common import stored
from lexmill.llm.line_dedup import line_dedup
from lexmill.llm.mixing import mix
from lexmill.llm.quality import quality_rules
from lexmill.llm.simhash import drop_near_duplicates

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules(docs, labels).where("kept").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that another one keeps. A copy of which nothing is left stays, with an empty text."""
    return line_dedup(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    return drop_near_duplicates(docs).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of training."""
    return mix(docs).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row of the mixture."""
    return round_trip(docs.select("doc_id", "text")).drop("text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("mixing", mixture),
    ("bpe", tokens),
]

#: DuckDB has neither the hashes of the quality rules and fingerprints nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
