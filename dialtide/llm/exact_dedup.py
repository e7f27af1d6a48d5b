"""Exact de-duplication by deterministic block naming.

Each normalised text is cut into blocks of a fixed number of characters. The
distinct blocks are sorted and numbered, which names them; then adjacent names
are paired, the distinct pairs sorted and numbered, and so on until each
document has one name. Equal name and level mean equal text, without exception.

Blocks travel once, to be made distinct. Documents refer to them by a 128-bit
key that is checked to be different for every distinct block; another seed is
taken if it is not.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import SPACE_CLASS, document_columns

BLOCK_CHARS = 4096


def block_key(block: Column, seed: int) -> Column:
    return F.struct(
        F.xxhash64(F.lit(2 * seed), block).alias("h1"), F.xxhash64(F.lit(2 * seed + 1), block).alias("h2")
    )


def normalised(text: Column) -> Column:
    """Every run of white space as one space."""
    return F.regexp_replace(text, f"[{SPACE_CLASS}]+", " ")


def _blocks(text: Column, size: int) -> Column:
    """The blocks of a text; an empty text is one empty block."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)\A\z|.{{1,{size}}}"), F.lit(0))


def _numbered(distinct: DataFrame, *keep: Column) -> DataFrame:
    """Sorted distinct values with integer names: numbers in order inside each partition."""
    return distinct.sortWithinPartitions(*distinct.columns).select(
        *keep, F.monotonically_increasing_id().alias("name")
    )


def _named_blocks(docs: DataFrame, size: int, key: Callable[[Column, int], Column]) -> tuple[DataFrame, DataFrame]:
    texts = docs.withColumn("text", normalised(F.col("text")))
    distinct = texts.select(F.explode(_blocks(F.col("text"), size)).alias("block")).distinct()
    for seed in range(64):
        names = materialize(_numbered(distinct, key(F.col("block"), seed).alias("key")), "block-names")
        if names.groupBy("key").count().filter("count > 1").isEmpty():
            break
    else:
        raise ValueError("no seed gives every block a key of its own")
    rows = texts.select(
        "doc_id",
        F.sha2("text", 256).alias("sha"),
        F.transform(_blocks(F.col("text"), size), lambda b: key(b, seed)).alias("keys"),
    )
    return materialize(rows.withColumn("row", F.monotonically_increasing_id()), "block-rows"), names


def identities(
    docs: DataFrame, block_chars: int = BLOCK_CHARS, key: Callable[[Column, int], Column] = block_key
) -> DataFrame:
    """One row per document: row, doc_id, sha (of the normalised text) and its identity (level, name)."""
    rows, names = _named_blocks(document_columns(docs), block_chars, key)
    cells = rows.select(
        "row", F.size("keys").cast("long").alias("n"), F.posexplode("keys").alias("pos", "key")
    ).join(names, "key")
    cells = materialize(cells.select("row", "n", F.col("pos").cast("long").alias("pos"), "name"), "cells")
    level, done = 0, cells.filter("n = 1").select("row", F.lit(0).alias("level"), "name")
    while not (cells := cells.filter("n > 1")).isEmpty():
        level += 1
        pairs = cells.groupBy("row", F.expr("pos div 2").alias("pos")).agg(
            F.expr("(max(n) + 1) div 2").alias("n"),
            F.max(F.when(F.expr("pos % 2 = 0"), F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.expr("pos % 2 = 1"), F.col("name"))), F.lit(-1)).alias("right"),
        )
        names = materialize(
            _numbered(pairs.select("left", "right").distinct(), F.col("left"), F.col("right")), "pair-names"
        )
        cells = materialize(pairs.join(names, ["left", "right"]).select("row", "n", "pos", "name"), "cells")
        done = done.union(cells.filter("n = 1").select("row", F.lit(level).alias("level"), "name"))
    return rows.select("row", "doc_id", "sha").join(done, "row")


def exact_dedup(
    docs: DataFrame, block_chars: int = BLOCK_CHARS, key: Callable[[Column, int], Column] = block_key
) -> DataFrame:
    """Each document with the copy of it that stays.

    Texts are equal when they are after every run of white space became one
    space; a null text counts as empty. The row with the smallest doc_id stays;
    rows without an id come after all others, and of rows with the same id one
    stays. An empty table gives an empty result. Other columns are not read.

    Returns doc_id, keep_id, group_size, kept, text_sha256.
    """
    named = materialize(identities(docs, block_chars, key), "identities")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    groups = named.groupBy("level", "name").agg(F.count("*").alias("group_size"), F.min(order).alias("first"))
    joined = named.join(materialize(groups, "groups"), ["level", "name"])
    return joined.select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
