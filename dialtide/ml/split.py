"""Repeatable stratified splits that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import hashed_ranks


def _with_rank(df: DataFrame, ranks: DataFrame, label: str, key: str, columns: list) -> DataFrame:
    """Adds ``columns`` of the ranks to every row, rows with a null label or key included."""
    known = ranks.select(F.col(label).alias("_label"), F.col(key).alias("_key"), *columns)
    same = F.col(label).eqNullSafe(F.col("_label")) & F.col(key).eqNullSafe(F.col("_key"))
    return df.join(known, same).drop("_label", "_key")


def stratified_split(
    df: DataFrame, label: str = "churn", key: str = "customer_id", test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: in each class the first ``test_share`` of keys in hash order.

    All rows of a key land on the same side, so a customer never leaks. Rows
    without a label are a class of their own, rows without a key one key.
    """
    ranks = hashed_ranks(df, label, key, seed)
    is_test = (F.col("rank") + 1 <= F.col("group_rows") * test_share).alias("is_test")
    return _with_rank(df, ranks, label, key, [is_test])


def stratified_folds(
    df: DataFrame, folds: int = 5, label: str = "churn", key: str = "customer_id", seed: int = 42
) -> DataFrame:
    """Add ``fold`` (0 … folds − 1), dealt out in hash order within each class."""
    ranks = hashed_ranks(df, label, key, seed)
    return _with_rank(df, ranks, label, key, [(F.col("rank") % folds).cast("int").alias("fold")])
