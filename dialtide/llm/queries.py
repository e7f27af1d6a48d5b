"""One query per operator, over its whole table with production parameters, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from . import sql
from .bpe_tree import bpe_round_trip
from .compression_classifier import compression_classifier
from .edit_fingerprints import document_fingerprints
from .exact_dedup import exact_dedup
from .importance import importance_resample
from .line_dedup import line_dedup
from .minhash import near_duplicates
from .packing import pack
from .quality_rules import quality_rules
from .source_audit import source_audit
from .suffix_dedup import suffix_dedup
from .token_files import token_files
from .url_filter import url_filter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
        "n_passages",
        "n_passage_words",
        (F.col("n_passages") > 0).alias("has_repeated_passage"),
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(_table(spark, sf_dir, "pages"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op9_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_classifier(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit(_table(spark, sf_dir, "documents"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = importance_resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return scored.select("doc_id", "n_features", "weight", "score", "rank")


def op13_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(_table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_line_dedup,
        op3_packing,
        op4_quality_rules,
        op5_token_files,
        op6_suffix_dedup,
        op7_url_filter,
        op8_minhash,
        op9_compression_classifier,
        op10_bpe_tree,
        op11_source_audit,
        op12_importance,
        op13_edit_fingerprints,
    )
}

LLM_ORACLES: dict[str, str] = {
    "op1_exact_dedup": sql.EXACT_DEDUP,
    "op2_line_dedup": sql.LINE_DEDUP,
    "op4_quality_rules": sql.QUALITY_RULES,
    "op7_url_filter": sql.URL_FILTER,
    "op11_source_audit": sql.SOURCE_AUDIT,
    "op12_importance": sql.IMPORTANCE,
}
