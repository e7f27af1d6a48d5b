"""Churn analytics over one row per customer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import churn_segment, segment_rank, tenure_band
from .ordered import exact_quantiles, null_safe_join

BOX_METRICS = ["monthly_charge", "account_weeks", "cust_serv_calls", "day_mins", "data_usage"]
HISTOGRAM_METRICS = ["monthly_charge", "day_mins", "cust_serv_calls", "account_weeks", "data_usage", "overage_fee"]


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _long(df: DataFrame, ids: list[str], columns: list[str], name: str = "feature") -> DataFrame:
    wide = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(ids, columns, name, "value")


def churn_kpis(df: DataFrame, entity: str = "customer_id") -> DataFrame:
    """Headline figures as one row."""
    features = [c for c in df.columns if c != entity]
    with_plan = F.count_if(F.col("data_plan") == 1)
    rows = F.count(F.lit(1))
    return df.agg(
        F.avg("churn").alias("churn_rate"),
        rows.alias("customers"),
        with_plan.alias("data_plan_customers"),
        (with_plan / F.nullif(rows, F.lit(0)) * 100).alias("data_plan_pct"),
        F.avg("monthly_charge").alias("avg_monthly_charge"),
        F.avg("contract_renewal").alias("renewal_rate"),
        F.avg("account_weeks").alias("avg_account_weeks"),
        F.lit(len(features)).alias("features"),
    )


def missing_report(df: DataFrame) -> DataFrame:
    """Null count of each column that has nulls."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "missing").filter("missing > 0")


def group_means(df: DataFrame, by: str = "churn") -> DataFrame:
    """Mean of every numeric column per value of ``by``."""
    return df.groupBy(by).agg(*[F.avg(c).alias(c) for c in _numeric(df) if c != by])


def percent_difference(df: DataFrame, by: str = "churn") -> DataFrame:
    """Mean of churned against stayed customers, in percent; needs a positive stayed mean."""
    columns = [c for c in _numeric(df) if c != by]
    aggs = []
    for c in columns:
        stayed = F.avg(F.when(F.col(by) == 0, F.col(c)))
        churned = F.avg(F.when(F.col(by) == 1, F.col(c)))
        aggs.append(F.when(stayed > 0, (churned - stayed) / F.nullif(stayed, F.lit(0.0)) * 100).alias(c))
    return (
        df.agg(*aggs)
        .unpivot([], columns, "feature", "percent_difference")
        .filter(F.col("percent_difference").isNotNull())
        .orderBy(F.desc("percent_difference"), "feature")
    )


def service_calls_by_churn(df: DataFrame) -> DataFrame:
    """Mean service calls of churned and stayed customers."""
    return df.groupBy("churn").agg(F.avg("cust_serv_calls").alias("avg_cust_serv_calls"))


def churn_by_data_plan(df: DataFrame) -> DataFrame:
    """Churn rate with and without a data plan."""
    return df.groupBy("data_plan").agg(F.avg("churn").alias("churn_rate"), F.count(F.lit(1)).alias("customers"))


def churn_by_tenure(df: DataFrame) -> DataFrame:
    """Churn rate up to and beyond 52 weeks."""
    return df.groupBy(tenure_band(F.col("account_weeks")).alias("tenure_band")).agg(
        F.avg("churn").alias("churn_rate"), F.count(F.lit(1)).alias("customers")
    )


def with_segment(df: DataFrame) -> DataFrame:
    """Add the rule-based risk segment."""
    segment = churn_segment(*[F.col(c) for c in ("cust_serv_calls", "day_mins", "data_plan", "account_weeks")])
    return df.withColumn("segment", segment)


def data_plan_filter(df: DataFrame, has_plan: bool) -> DataFrame:
    """Customers with, or without, a data plan."""
    return df.filter(F.col("data_plan") == int(has_plan))


def segment_summary(df: DataFrame) -> DataFrame:
    """Customers and share of each segment, low risk first."""
    counts = with_segment(df).groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))
    share = F.col("customers") / F.sum("customers").over(Window.partitionBy(F.lit(0))) * 100
    return counts.withColumn("percentage", share).orderBy(segment_rank(F.col("segment")))


def churn_trend(labels: DataFrame, end: str, days: int = 90) -> DataFrame:
    """Customers, churned so far and churn rate on each day of the last ``days``.

    Churn before the first day counts on it, so the running sum is over at most
    ``days + 1`` rows.
    """
    last = F.lit(end).cast("date")
    first = F.date_sub(last, days)
    churned = labels.filter((F.col("churn") == 1) & (F.col("churn_date") <= last))
    per_day = churned.groupBy(F.greatest("churn_date", first).alias("date")).agg(F.count(F.lit(1)).alias("n"))
    total = labels.agg(F.count(F.lit(1)).alias("n")).scalar()
    spine = labels.sparkSession.range(days + 1).select(F.date_add(first, F.col("id").cast("int")).alias("date"))
    running = Window.partitionBy(F.lit(0)).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return (
        spine.join(per_day, "date", "left")
        .withColumn("churned_customers", F.coalesce(F.sum("n").over(running), F.lit(0)))
        .select("date", total.alias("total_customers"), "churned_customers")
        .withColumn("churn_rate", F.col("churned_customers") / F.nullif(F.col("total_customers"), F.lit(0)))
    )


def churn_delta(trend: DataFrame) -> DataFrame:
    """Newest churn rate and its change from the day before."""
    by_date = Window.partitionBy(F.lit(0)).orderBy("date")
    delta = F.col("churn_rate") - F.lag("churn_rate").over(by_date)
    return trend.withColumn("delta", delta).orderBy(F.desc("date")).limit(1).select("date", "churn_rate", "delta")


def box_summary(df: DataFrame, by: str = "churn", metrics: list[str] | None = None) -> DataFrame:
    """Box-plot figures per metric and group: extremes, quartiles, 1.5-IQR whiskers.

    Quartiles are exact and interpolated; whiskers end at the outermost value
    within 1.5 interquartile ranges of the box.
    """
    metrics = metrics or BOX_METRICS
    values = _long(df, [by], metrics, "metric").filter(F.col("value").isNotNull())
    group = [by, "metric"]
    quartiles = exact_quantiles(values, group, "value", [0.0, 0.25, 0.5, 0.75, 1.0])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    # one row per group and metric; how many groups there are is the caller's choice
    inside = null_safe_join(values, quartiles, group).filter(
        F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    )
    return inside.groupBy(*group, "n", "q0", "q1", "q2", "q3", "q4").agg(
        F.min("value").alias("lower_whisker"), F.max("value").alias("upper_whisker")
    ).withColumnsRenamed({"q0": "min", "q2": "median", "q4": "max"})


def histogram_by_churn(
    df: DataFrame, by: str = "churn", metrics: list[str] | None = None, bins: int = 20
) -> DataFrame:
    """Counts in ``bins`` equal bins over each metric's range, per group; empty bins left out."""
    values = _long(df, [by], metrics or HISTOGRAM_METRICS).filter(F.col("value").isNotNull())
    edges = values.groupBy("feature").agg(
        F.min("value").alias("lo"), ((F.max("value") - F.min("value")) / bins).alias("width")
    )
    # one row per metric; a metric with one value has a single bin
    index = F.when(
        F.col("width") > 0,
        F.least(F.floor((F.col("value") - F.col("lo")) / F.nullif(F.col("width"), F.lit(0.0))), F.lit(bins - 1)),
    ).otherwise(0)
    return (
        values.join(F.broadcast(edges), "feature")
        .groupBy("feature", by, index.cast("int").alias("bin"), "lo", "width")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "feature",
            by,
            "bin",
            (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
            (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
            "n",
        )
    )


def pearson(a: str, b: str) -> Column:
    """Pearson correlation over rows where both are present; null without variance.

    (The built-in ``corr`` raises a division error on a constant column in ANSI mode.)
    """
    x = F.when(F.col(b).isNotNull(), F.col(a))
    y = F.when(F.col(a).isNotNull(), F.col(b))
    spread = F.sqrt(F.var_pop(x)) * F.sqrt(F.var_pop(y))
    return F.covar_pop(a, b) / F.nullif(spread, F.lit(0.0))


_MOMENTS = ["n", "mx", "my", "xx", "yy", "xy"]
_PAIR = "i int, j int, n double, mx double, my double, xx double, yy double, xy double"


def _block_moments(x: np.ndarray, there: np.ndarray) -> np.ndarray:
    """[moment, i, j] of all column pairs of a block, each over the rows where both are present.

    Values are shifted by the column's first one, so that large means do no harm.
    """
    first = x[there.argmax(axis=0), np.arange(x.shape[1])]
    x, m = np.where(there, x - np.where(there.any(axis=0), first, 0.0), 0.0), there.astype(float)
    first = np.where(there.any(axis=0), first, 0.0)
    n, sx, sy = m.T @ m, x.T @ m, m.T @ x
    sxx, syy, sxy = (x * x).T @ m, m.T @ (x * x), x.T @ x
    with np.errstate(invalid="ignore", divide="ignore"):
        xx, yy, xy = sxx - sx * sx / n, syy - sy * sy / n, sxy - sx * sy / n
        # what is left of equal values is rounding
        xx, yy = (np.where(v <= 1e-14 * s, 0.0, v) for v, s in ((xx, sxx), (yy, syy)))
        return np.where(n > 0, np.stack([n, first[:, None] + sx / n, first[None, :] + sy / n, xx, yy, xy]), 0.0)


def _merged_moments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The moments of two sets of rows together."""
    n = a[0] + b[0]
    with np.errstate(invalid="ignore", divide="ignore"):
        share, dx, dy = np.where(n > 0, b[0] / n, 0.0), b[1] - a[1], b[2] - a[2]
    both = np.stack([n, a[1] + dx * share, a[2] + dy * share, *(a[k] + b[k] + a[0] * share * d for k, d in ((3, dx * dx), (4, dy * dy), (5, dx * dy)))])
    return np.where(a[0] == 0, b, np.where(b[0] == 0, a, both))


def _moments(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(_MOMENTS), width, width))
        for batch in batches:
            values = batch.column("x").flatten()
            x = values.to_numpy(zero_copy_only=False).reshape(-1, width)
            there = values.is_valid().to_numpy(zero_copy_only=False).reshape(-1, width)
            if len(x):
                total = _merged_moments(total, _block_moments(x, there))
        i, j = np.nonzero(np.triu(total[0]))
        columns = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *[pa.array(t[i, j]) for t in total]]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", *_MOMENTS])

    return run


def _all_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tasks' moments of each pair, put together."""
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        moments = np.stack([batch.column(c).to_numpy() for c in _MOMENTS])
        for k, pair in enumerate(zip(batch.column("i").to_pylist(), batch.column("j").to_pylist())):
            total[pair] = _merged_moments(total[pair], moments[:, k]) if pair in total else moments[:, k]
    if total:
        i, j = (pa.array([p[k] for p in total], pa.int32()) for k in (0, 1))
        moments = np.stack(list(total.values()), axis=1)
        yield pa.RecordBatch.from_arrays([i, j, *[pa.array(m) for m in moments]], names=["i", "j", *_MOMENTS])


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every ordered pair of numeric columns, in long form.

    A task multiplies blocks of rows with masks of what is present and keeps one
    set of moments for each pair, whatever its rows; only these are shuffled. A
    pair uses the rows where both are present; without variance it is null, and
    without such rows it is left out.
    """
    columns = columns or _numeric(df)
    values = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))
    half = values.mapInArrow(_moments(len(columns)), _PAIR).repartition("i", "j").mapInArrow(_all_moments, _PAIR)
    half = half.select("i", "j", (F.col("xy") / F.nullif(F.sqrt("xx") * F.sqrt("yy"), F.lit(0.0))).alias("correlation"))
    both = F.array_distinct(F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
    names = F.array(*map(F.lit, columns))
    return half.select(F.explode(both).alias("p"), "correlation").select(
        F.element_at(names, F.col("p.i") + 1).alias("feature_a"),
        F.element_at(names, F.col("p.j") + 1).alias("feature_b"),
        "correlation",
    )


def churn_correlation(df: DataFrame, target: str = "churn") -> DataFrame:
    """Correlation of every column with the target, largest first."""
    columns = [c for c in _numeric(df) if c != target]
    return (
        df.agg(*[pearson(c, target).alias(c) for c in columns])
        .unpivot([], columns, "feature", "importance")
        .orderBy(F.desc_nulls_last("importance"), "feature")
    )


def sample_rows(df: DataFrame, key: str = "customer_id", n: int = 10) -> DataFrame:
    """The first ``n`` rows by key."""
    return df.orderBy(key).limit(n)


def benchmark_summary(rows: DataFrame) -> DataFrame:
    """Mean time, memory and rate per row count."""
    return rows.groupBy("row_count").agg(
        F.avg("execution_time_seconds").alias("avg_seconds"),
        F.avg("memory_usage_mb").alias("avg_memory_mb"),
        F.avg("records_per_second").alias("avg_records_per_second"),
    )
