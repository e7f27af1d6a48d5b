"""Distribution drift of numeric columns between two batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

EMPTY_BIN = 1e-10


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _long(df: DataFrame, columns: list[str], is_current: int) -> DataFrame:
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return (
        values.unpivot([], columns, "column", "value")
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .withColumn("current", F.lit(is_current))
    )


def drift_report(
    current: DataFrame, reference: DataFrame, threshold: float = 0.1, bins: int = 50, min_values: int = 100
) -> DataFrame:
    """KL divergence of each shared numeric column, current against reference.

    Both sides are counted in ``bins`` equal bins over the current range (the
    top edge belongs to the last bin); empty bins count 1e-10 and both densities
    are normalised. Reference values outside the range are not binned but counted
    in ``n_outside``. A column without more than ``min_values`` values on both
    sides has reason ``too_few_values`` and no number, and is no drift. A
    reference wholly outside the current range is drift with reason
    ``no_overlap`` and no number.
    """
    shared = [c for c in _numeric(current) if c in _numeric(reference)]
    both = _long(current, shared, 1).unionByName(_long(reference, shared, 0))
    is_current, value = F.col("current") == 1, F.col("value")

    lo, hi = F.min(F.when(is_current, value)), F.max(F.when(is_current, value))
    present = (
        both.groupBy("column")
        .agg(
            F.count_if(is_current).alias("n_current"),
            F.count_if(~is_current).alias("n_reference"),
            F.when(lo == hi, lo - 0.5).otherwise(lo).alias("lo"),
            F.when(lo == hi, hi + 0.5).otherwise(hi).alias("hi"),
        )
        .withColumn("width", (F.col("hi") - F.col("lo")) / bins)
    )
    # one row per column, stored: each side is read once for the ranges and once for the bins
    present = materialize(present, "drift-ranges")
    enough = (F.col("n_current") > min_values) & (F.col("n_reference") > min_values)
    stats = present.filter(enough)

    # one row per column of the schema: small whatever the data
    guess = F.least(F.floor((value - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    binned = (
        both.join(F.broadcast(stats), "column")
        .filter(value.between(F.col("lo"), F.col("hi")))
        .withColumn("guess", guess.cast("int"))
        # the division can land one bin off at an edge; the edges themselves decide
        .withColumn(
            "bin",
            F.when(value < F.col("lo") + F.col("guess") * F.col("width"), F.col("guess") - 1)
            .when(
                (value >= F.col("lo") + (F.col("guess") + 1) * F.col("width")) & (F.col("guess") < bins - 1),
                F.col("guess") + 1,
            )
            .otherwise(F.col("guess")),
        )
    )
    counts = binned.groupBy("column", "bin").agg(
        F.sum("current").alias("c"), F.sum(1 - F.col("current")).alias("r")
    )
    grid = stats.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    filled = grid.join(counts, ["column", "bin"], "left").fillna(0, ["c", "r"])
    totals = filled.groupBy("column", "n_current", "n_reference").agg(
        F.sum("c").alias("tc"),
        F.sum("r").alias("tr"),
        F.collect_list(F.struct("c", "r", "width")).alias("cells"),
    )

    def density(count: str, total: str):
        share = lambda cell: cell[count] / (F.nullif(F.col(total), F.lit(0)) * cell["width"])
        return F.transform("cells", lambda cell: F.when(cell[count] == 0, EMPTY_BIN).otherwise(share(cell)))

    def total_of(array: str):
        return F.aggregate(array, F.lit(0.0), lambda acc, x: acc + x)

    parts = totals.withColumns({"p": density("c", "tc"), "q": density("r", "tr")}).withColumns(
        {"sp": total_of("p"), "sq": total_of("q")}
    )
    terms = F.zip_with(
        "p", "q", lambda p, q: p / F.col("sp") * F.log(p / F.col("sp") / (q / F.col("sq")))
    )
    kl = F.when(F.col("tr") > 0, F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x))
    overlap = F.col("tr") > 0
    compared = parts.withColumn("kl_divergence", kl).select(
        "column",
        "n_current",
        "n_reference",
        (F.col("n_reference") - F.col("tr")).alias("n_outside"),
        "kl_divergence",
        F.when(overlap, F.col("kl_divergence") > threshold).otherwise(True).alias("drift_detected"),
        F.when(~overlap, "no_overlap").when(F.col("kl_divergence") > threshold, "kl_above_threshold").otherwise("ok")
        .alias("reason"),
    )
    # every shared column has a row, also one without any value
    names = both.sparkSession.createDataFrame([(c,) for c in shared], "column string")
    few = (
        names.join(present, "column", "left")
        .fillna(0, ["n_current", "n_reference"])
        .filter(~enough)
        .select(
            "column",
            "n_current",
            "n_reference",
            F.lit(None).cast("bigint").alias("n_outside"),
            F.lit(None).cast("double").alias("kl_divergence"),
            F.lit(False).alias("drift_detected"),
            F.lit("too_few_values").alias("reason"),
        )
    )
    return compared.unionByName(few)


def drift_detected(report: DataFrame) -> DataFrame:
    """One row: whether any column drifted, and how many."""
    return report.agg(
        F.coalesce(F.bool_or("drift_detected"), F.lit(False)).alias("drift_detected"),
        F.count_if("drift_detected").alias("columns_drifted"),
        F.count(F.lit(1)).alias("columns_checked"),
    )


def drift_alert(report: DataFrame) -> DataFrame:
    """One line of text per drifted column."""
    drifted = report.filter("drift_detected")
    number = F.when(F.col("kl_divergence").isNull(), F.col("reason")).otherwise(
        F.format_string("divergence %.4f", "kl_divergence")
    )
    return drifted.select(
        "column",
        F.concat(F.lit("values of "), "column", F.lit(" have moved: "), number).alias(
            "alert"
        ),
    )
