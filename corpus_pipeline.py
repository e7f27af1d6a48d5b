"""The corpus pipeline: documents in, packed training sequences out.

Each stage works on all that the one before it kept and, but for the last,
returns the columns of ``documents``. Columns beyond those pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dialtide.llm.line_dedup import line_filter
from dialtide.llm.minhash import near_filter
from dialtide.llm.packing import pack
from dialtide.llm.quality_rules import quality_filter
from dialtide.llm.suffix_dedup import passage_filter
from dialtide.session import configure, materialize


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject, see :func:`~dialtide.llm.quality_rules.quality_filter`.

    Null and empty texts have no words and go; repeated rows are judged alike;
    texts of any length are judged whole. Rows stay as they are, with columns of
    any names. An empty table stays empty.
    """
    return quality_filter(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes shared lines out of every document, see :func:`~dialtide.llm.line_dedup.line_filter`.

    A null text becomes an empty one; a document that loses all lines stays, with
    an empty text. Every row counts as a document, repeated ones too. Only text
    and n_chars change, columns of any names stay. An empty table stays empty.
    """
    return line_filter(docs)


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies, see :func:`~dialtide.llm.minhash.near_filter`.

    The smallest doc_id stays, rows without one only if there is no other; of
    rows repeated whole one stays. Texts without words are one class. Rows stay
    as they are, with columns of any names. An empty table stays empty.
    """
    return near_filter(docs)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes passages of over 50 words that repeat out of every document, see :func:`~dialtide.llm.suffix_dedup.passage_filter`.

    All their occurrences go, so of two equal rows nothing of that length stays.
    A null text becomes an empty one. Only text and n_chars change, columns of
    any names stay. An empty table stays empty.
    """
    return passage_filter(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of token ids, see :func:`~dialtide.llm.packing.pack`.

    A null or empty text is its end token; longer texts are cut; repeated rows
    are packed like others. Only doc_id and text are read. An empty table gives
    no pieces.
    """
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("line_dedup", line_dedup_stage),
    ("minhash", minhash_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("packing", packing_stage),
]

#: SQL can neither sign, pack nor encode; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read again by the next; returns the pieces of the last.

    Nulls, empty texts, ties, repeated rows, clashing names and empty tables are
    handled as the stages say.
    """
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
