"""Classification metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import running_sums, value_buckets
from ..session import materialize


def confusion(scored: DataFrame, label: str = "churn", prediction: str = "churn_prediction") -> DataFrame:
    """Rows per (label, prediction)."""
    return scored.groupBy(label, F.col(prediction).cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def binary_metrics(
    scored: DataFrame, label: str = "churn", prediction: str = "churn_prediction", by: list[str] | None = None
) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class; 0 where undefined."""
    actual, predicted = F.col(label) == 1, F.col(prediction).cast("int") == 1
    tp = F.count_if(actual & predicted)
    fp = F.count_if(~actual & predicted)
    fn = F.count_if(actual & ~predicted)
    rows = F.count(F.lit(1))

    def ratio(part, whole):
        return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))

    return scored.groupBy(*(by or [])).agg(
        ratio(F.count_if(actual == predicted), rows).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def roc_auc(scored: DataFrame, label: str = "churn", score: str = "churn_probability") -> DataFrame:
    """Exact area under the ROC curve; null when a class is missing.

    Rows are first reduced to distinct scores; each positive then outranks the
    negatives below its score and half of those at it.
    """
    freq = (
        scored.filter(F.col(score).isNotNull())
        .groupBy(F.col(score).alias("_score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )
    ranked = running_sums(value_buckets(freq, [], "_score"), [], "_bucket", ["_score"], ["pos", "neg"])
    outranked = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    pairs = F.max("pos_total").cast("double") * F.max("neg_total")
    return ranked.agg(F.try_divide(outranked, pairs).alias("roc_auc"))


def evaluate(scored: DataFrame, label: str = "churn") -> dict[str, float]:
    """All five metrics of a scored frame as a dict; rows are scored once and the scores stored."""
    scored = materialize(scored.select(label, "churn_prediction", "churn_probability"), "scores")
    row = binary_metrics(scored, label).first().asDict()
    return row | {"roc_auc": roc_auc(scored, label).first()["roc_auc"]}
