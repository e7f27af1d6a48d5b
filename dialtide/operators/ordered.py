"""Ranks, running sums and quantiles without one big sort in one task.

A window ordered over a whole table, or over a label with two values, would run
in one or two tasks. Here the ordered rows first fall into buckets whose order
agrees with the row order; running sums are taken inside each bucket, in
parallel, and shifted by the totals of the buckets before it — a table with at
most one row per group and bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stable_order

#: Least number of buckets; more where the session shuffles into more partitions.
CUTS = 64


def _cuts(df: DataFrame) -> int:
    """Buckets that keep every core of the cluster busy: twice its shuffle partitions."""
    setting = df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")
    return max(CUTS, 2 * int(setting)) if setting.isdigit() else CUTS


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null being equal to null; the keys of ``left`` stay."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(other, same, how).drop(*[f"_r_{k}" for k in keys])


def running_sums(df: DataFrame, group: list[str], bucket: str, order: list[str], sums: list[str]) -> DataFrame:
    """Add ``<c>_before`` (sum over earlier rows of the group) and ``<c>_total``.

    An empty ``group`` takes the whole frame as one. ``bucket`` must rise with ``order``; rows must be unique on group and order,
    which callers reach by aggregating first.
    """
    per_bucket = df.groupBy(*group, bucket).agg(*[F.sum(c).alias(c) for c in sums])
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = per_bucket.select(
        *group,
        bucket,
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_offset") for c in sums],
        *[F.sum(c).over(whole).alias(f"{c}_total") for c in sums],
    )
    inside = (
        Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    here = df.withColumns({f"{c}_inside": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums})
    joined = null_safe_join(here, offsets, [*group, bucket])
    return joined.select(
        *df.columns,
        *[(F.col(f"{c}_offset") + F.col(f"{c}_inside")).alias(f"{c}_before") for c in sums],
        *[F.col(f"{c}_total") for c in sums],
    )


def _cut_points(df: DataFrame, group: list[str], value: str, cuts: int) -> DataFrame:
    shares = [i / cuts for i in range(1, cuts)]
    return df.groupBy(*group).agg(F.percentile_approx(value, shares, 10000).alias("_cuts"))


def value_buckets(freq: DataFrame, group: list[str], value: str, cuts: int | None = None) -> DataFrame:
    """Add ``_bucket``: about equally many distinct values each, rising with ``value``.

    The cut points come from a fixed-size sketch, one row per group; groups are
    labels and metric names, not ids. The cuts need not be exact: any cut points
    give exact sums, only the balance changes.
    """
    points = _cut_points(freq, group, value, cuts or _cuts(freq))
    tagged = null_safe_join(freq, points, group) if group else freq.withColumn("_cuts", points.scalar())
    return tagged.withColumn("_bucket", _below("_cuts", F.col(value), cuts or _cuts(freq))).drop("_cuts")


def _below(cuts: str, value: Column, most: int) -> Column:
    """How many of the sorted ``cuts``, ``most`` at the most, are below the value, by halving."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(most.bit_length()))])
    is_below = lambda place: F.coalesce(F.get(F.col(cuts), place) < value, F.lit(False))
    return F.aggregate(steps, F.lit(0), lambda found, step: F.when(is_below(found + step - 1), found + step).otherwise(found))


def exact_quantiles(df: DataFrame, group: list[str], value: str, probs: list[float]) -> DataFrame:
    """Linearly interpolated exact quantiles: group, ``n``, and ``q0``, ``q1``, … per prob.

    Equal values are counted first; then each value knows the ranks it covers,
    and one aggregate picks the values at the two ranks around each quantile.
    """
    freq = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"))
    ranked = running_sums(value_buckets(freq, group, value), group, "_bucket", [value], ["n"])
    first, after, last = F.col("n_before"), F.col("n_before") + F.col("n"), F.col("n_total") - 1

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= first) & (rank < after), F.col(value)))

    aggs = [F.max("n_total").alias("n")]
    for i, p in enumerate(probs):
        aggs += [at(F.floor(last * p)).alias(f"_lo{i}"), at(F.ceil(last * p)).alias(f"_hi{i}")]
    picked = ranked.groupBy(*group).agg(*aggs)

    def between(i: int, p: float) -> Column:
        position = (F.col("n") - 1) * F.lit(p)
        return F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (position - F.floor(position))

    return picked.select(*group, "n", *[between(i, p).alias(f"q{i}") for i, p in enumerate(probs)])


def hashed_ranks(df: DataFrame, group: str, key: str, seed: int = 42, digits: int = 3) -> DataFrame:
    """Per (group, key): ``rank`` of the key in a fixed random order, and ``group_rows``.

    ``rank`` counts the rows of earlier keys in the group, so a key that repeats
    stays together and a key with a third of all rows is one row here. Buckets
    are the leading hex digits of the hash (16 ** ``digits`` of them).
    """
    units = (
        df.groupBy(group, key)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_order", stable_order(F.col(key), seed))
        .withColumn("_bucket", F.coalesce(F.substring("_order", 1, digits), F.lit("")))
    )
    ranked = running_sums(units, [group], "_bucket", ["_order", key], ["n"])
    return ranked.select(group, key, F.col("n_before").alias("rank"), F.col("n_total").alias("group_rows"))
