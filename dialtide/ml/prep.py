"""Scaling, one-hot encoding and class weights."""

from __future__ import annotations

import math

from pyspark.ml import Estimator, Transformer
from pyspark.ml.feature import (
    ElementwiseProduct,
    Imputer,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MISSING = "__null__"
NOT_FEATURES = ("customer_id", "event_timestamp", "churn", "is_test", "fold", "class_weight")


def numeric_and_categorical(df: DataFrame, exclude: tuple[str, ...] = NOT_FEATURES) -> tuple[list[str], list[str]]:
    """Feature columns by type family, so int and float columns count like bigint and double."""
    fields = [f for f in df.schema.fields if f.name not in exclude]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    return numeric, text


def scale_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace each column by (x − mean) / population deviation; zero without spread."""
    stats = df.agg(
        F.struct(
            *[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("dev")).alias(c) for c in columns]
        ).alias("s")
    ).scalar()

    def scaled(c: str):
        z = (F.col(c) - stats[c]["mean"]) / F.nullif(stats[c]["dev"], F.lit(0.0))
        return F.when(F.col(c).isNotNull(), F.coalesce(z, F.lit(0.0)))

    return df.withColumns({c: scaled(c) for c in columns})


def one_hot(df: DataFrame, column: str, levels: list[str]) -> DataFrame:
    """Replace ``column`` by one 0/1 column per level; an unknown value is all zeros."""
    flags = {f"{column}_{level}": F.coalesce((F.col(column) == level).cast("int"), F.lit(0)) for level in levels}
    return df.withColumns(flags).drop(column)


def class_weights(df: DataFrame, label: str = "churn") -> DataFrame:
    """Per class: rows, balanced weight n / (2·n_class), and n0 / n1 for the positive one."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(
        F.struct(
            F.sum("n").alias("rows"),
            F.sum(F.when(F.col(label) == 0, F.col("n"))).alias("negatives"),
            F.sum(F.when(F.col(label) == 1, F.col("n"))).alias("positives"),
        ).alias("t")
    ).scalar()
    ratio = totals["negatives"] / F.nullif(totals["positives"], F.lit(0))
    return counts.select(
        label,
        "n",
        (totals["rows"] / (2 * F.col("n"))).alias("balanced_weight"),
        F.when(F.col(label) == 1, ratio).otherwise(1.0).alias("positive_weight"),
    )


def with_class_weight(df: DataFrame, negatives: float, positives: float, label: str = "churn") -> DataFrame:
    """Add ``class_weight``: one number for churned rows, one for the others."""
    return df.withColumn("class_weight", F.when(F.col(label) == 1, float(positives)).otherwise(float(negatives)))


def preparation_stages(numeric: list[str], categorical: list[str], rows: int) -> list[Estimator | Transformer]:
    """Pipeline stages from raw feature columns to the ``features`` vector.

    Missing numbers take the training mean and missing text its own level.
    ``StandardScaler`` divides by the sample deviation; the product restores the
    population one for ``rows`` training rows.
    """
    casts = [f"CAST(`{c}` AS DOUBLE) AS `{c}__n`" for c in numeric]
    casts += [f"coalesce(`{c}`, '{MISSING}') AS `{c}__c`" for c in categorical]
    stages: list[Estimator | Transformer] = [SQLTransformer(statement=f"SELECT *, {', '.join(casts)} FROM __THIS__")]
    parts = []
    if numeric:
        filled = [f"{c}__f" for c in numeric]
        to_population = math.sqrt(rows / (rows - 1)) if rows > 1 else 1.0
        stages += [
            Imputer(inputCols=[f"{c}__n" for c in numeric], outputCols=filled, strategy="mean"),
            VectorAssembler(inputCols=filled, outputCol="numeric__v"),
            StandardScaler(inputCol="numeric__v", outputCol="scaled__v", withMean=True, withStd=True),
            ElementwiseProduct(
                inputCol="scaled__v", outputCol="numeric", scalingVec=Vectors.dense([to_population] * len(numeric))
            ),
        ]
        parts.append("numeric")
    if categorical:
        indexed, hot = [f"{c}__i" for c in categorical], [f"{c}__h" for c in categorical]
        stages += [
            # the extra slot for unknown values is the dropped one: unknown → all zeros
            StringIndexer(
                inputCols=[f"{c}__c" for c in categorical],
                outputCols=indexed,
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            ),
            OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
        ]
        parts += hot
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features")]


def feature_names(fitted_stages: list[Transformer], numeric: list[str], categorical: list[str]) -> list[str]:
    """Names of the ``features`` slots: numeric columns, then ``column_level``."""
    levels = next((s.labelsArray for s in fitted_stages if hasattr(s, "labelsArray")), [])
    hot = [f"{c}_{level}" for c, found in zip(categorical, levels) for level in found]
    return [*numeric, *hot]
