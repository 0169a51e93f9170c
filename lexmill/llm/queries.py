"""The operators as queries over their whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexmill.llm.bpe import round_trip
from lexmill.llm.fill_middle import FILL_MIDDLE_SQL, fill_middle_report
from lexmill.llm.html_layout import extracted
from lexmill.llm.line_dedup import LINE_DEDUP_SQL, line_dedup_report
from lexmill.llm.merkle import MERKLE_SQL, manifest_report
from lexmill.llm.mixing import MIX_SQL, mix_report
from lexmill.llm.order_minhash import fingerprints
from lexmill.llm.piece import piece_report
from lexmill.llm.quality import quality_report
from lexmill.llm.simhash import near_duplicates
from lexmill.llm.token_counts import token_counts
from lexmill.llm.toxicity import toxicity
from lexmill.llm.warc import archived_pages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages").select("page_id", "html"))


def op2_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))


def op3_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op5_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op6_simhash_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_toxicity_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity(docs, table(spark, sf_dir, "labels")).drop("text")


def op8_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup_report(table(spark, sf_dir, "documents"))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op11_piece_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_report(table(spark, sf_dir, "documents"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle_report(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_layout": op1_html_layout,
    "op2_warc_archive": op2_warc_archive,
    "op3_quality_llr": op3_quality_llr,
    "op4_token_counts": op4_token_counts,
    "op5_bpe_transducer": op5_bpe_transducer,
    "op6_simhash_variants": op6_simhash_variants,
    "op7_toxicity_channel": op7_toxicity_channel,
    "op8_curriculum_mix": op8_curriculum_mix,
    "op9_line_dedup": op9_line_dedup,
    "op10_order_minhash": op10_order_minhash,
    "op11_piece_chunks": op11_piece_chunks,
    "op12_fill_middle": op12_fill_middle,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES: dict[str, str] = {
    "op8_curriculum_mix": MIX_SQL,
    "op9_line_dedup": LINE_DEDUP_SQL,
    "op12_fill_middle": FILL_MIDDLE_SQL,
    "op13_merkle_manifest": MERKLE_SQL,
}
