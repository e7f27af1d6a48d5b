"""Per-row explanations of churn scores, as Spark jobs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hash_normal, normals_of, stable_order
from ..operators.ranking import top_abs
from .score import positive_probability
from .tree_shapley import ForestScorer, explain_forest_sampled, leaves_of, spread_answers, spread_rows


def explain_linear(df: DataFrame, key: str, coefficients: dict[str, float]) -> DataFrame:
    """Exact Shapley values of a linear model: coefficient × (x − mean of x)."""
    columns = list(coefficients)
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns]).alias("m")).scalar()
    parts = df.select(key, *[((F.col(c) - means[c]) * F.lit(float(w))).alias(c) for c, w in coefficients.items()])
    return parts.unpivot([key], columns, "feature", "contribution")


def explain_linear_model(prepared: DataFrame, key: str, model, names: list[str]) -> DataFrame:
    """:func:`explain_linear` for a fitted logistic model on prepared ``features``.

    Contributions are to the log-odds.
    """
    d = len(names)
    rows = prepared.select(key, vector_to_array("features").alias("x"))
    means = rows.agg(F.array(*[F.avg(F.col("x")[j]) for j in range(d)]).alias("m")).scalar()
    weights = F.array(*[F.lit(float(w)) for w in model.coefficients.toArray()])
    return rows.select(key, F.posexplode("x").alias("j", "v")).select(
        key,
        F.element_at(F.array(*map(F.lit, names)), F.col("j") + 1).alias("feature"),
        ((F.col("v") - F.element_at(means, F.col("j") + 1)) * F.element_at(weights, F.col("j") + 1)).alias(
            "contribution"
        ),
    )


COPIES_PER_TASK = 20_000
#: Copies that a task makes and scores by itself, and the rows whose copies it holds at a time.
SCORED_PER_TASK, ROWS_AT_A_TIME = 1_000_000, 32


def _spread_rows(rows: DataFrame, copies: int) -> DataFrame:
    """Tasks of about :data:`COPIES_PER_TASK` copies, before each row is multiplied."""
    return spread_rows(rows, copies, COPIES_PER_TASK)


def _orderings(background: DataFrame, key: str, d: int, n: int, seed: int) -> DataFrame:
    """``n`` rows: a background row and a random feature order (``place`` of each feature)."""
    chosen = background.select(key, "features").orderBy(stable_order(F.col(key), seed)).limit(n)
    numbered = chosen.select(
        (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(stable_order(F.col(key), seed)))).alias("k"),
        vector_to_array("features").alias("base"),
    )
    slots = F.sequence(F.lit(0), F.lit(d - 1))
    drawn = F.array_sort(
        F.transform(slots, lambda j: F.struct(F.xxhash64(F.col("k"), j, F.lit(seed)).alias("h"), j.alias("j")))
    )
    ordered = F.transform(drawn, lambda x: x["j"])
    return numbered.withColumn("order", ordered).withColumn(
        "place", F.transform(slots, lambda j: F.array_position(F.col("order"), j))
    )


def explain_shapley(
    prepared: DataFrame,
    background: DataFrame,
    classifier: Transformer,
    names: list[str],
    key: str = "customer_id",
    orderings: int = 16,
    seed: int = 42,
) -> DataFrame:
    """Shapley values of the churn probability for any classifier: key, feature, contribution.

    Each row is moved from a background row to itself one feature at a time, in
    ``orderings`` random orders; a feature's value is the mean change it made.
    The changes telescope, so per row they add up exactly to its score minus
    the mean score of the background rows. ``prepared`` and ``background`` carry
    a ``features`` vector. Work is rows × orderings × (features + 1) scores, all
    made from the row in place: only one sum per row and feature is shuffled. Of
    a forest no scores are made: the same changes are read off its leaves. A
    key that comes more than once gets the mean over its rows.
    """
    d = len(names)
    plan = _orderings(background, key, d, orderings, seed)
    if isinstance(classifier, RandomForestClassificationModel) and classifier.numClasses == 2:
        try:
            leaves = leaves_of(classifier, prepared.sparkSession)
        except ValueError:  # a split by more than two categories
            return _shapley_by_scores(prepared, plan, classifier, names, key, orderings)
        chosen = plan.select("base", "place").collect()  # a row for each ordering
        if chosen:
            base, place = (np.array([r[c] for r in chosen]) for c in ("base", "place"))
            # few rows of a file are much work: spread by the values that the leaves add to
            spread = spread_answers(prepared.select(key, "features"), leaves)
            return explain_forest_sampled(spread, leaves, base, place, names, key)
    return _shapley_by_scores(prepared, plan, classifier, names, key, orderings)


def _shapley_by_scores(prepared: DataFrame, plan: DataFrame, classifier: Transformer, names: list[str], key: str, orderings: int) -> DataFrame:
    """:func:`explain_shapley` of any classifier, by scoring every step of every ordering."""
    d = len(names)
    moved = (
        _spread_rows(prepared.select(key, vector_to_array("features").alias("x")), orderings * (d + 1))
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(orderings))))
        .join(F.broadcast(plan), "k")  # `orderings` rows by construction
        .withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(d))))
        .withColumn(
            "features",
            array_to_vector(
                F.transform(
                    "x",
                    lambda v, j: F.when(F.element_at("place", j + 1) <= F.col("step"), v).otherwise(
                        F.element_at("base", j + 1)
                    ),
                )
            ),
        )
    )
    scored = classifier.transform(moved).select(key, "order", "step", positive_probability().alias("p"))
    # a prefix's score counts for the feature just added and against the one added next
    added = F.struct(F.get("order", F.col("step") - 1).alias("j"), F.col("p").alias("change"))
    follow = F.struct(F.get("order", F.col("step")).alias("j"), (-F.col("p")).alias("change"))
    changes = scored.select(key, F.inline(F.array(added, follow))).filter(F.col("j").isNotNull())
    return (
        changes.groupBy(key, "j")
        # every ordering of every row of the key adds a feature once and is followed by it once
        .agg((F.sum("change") / (F.count(F.lit(1)) / 2)).alias("contribution"))
        .select(key, F.element_at(F.array(*map(F.lit, names)), F.col("j") + 1).alias("feature"), "contribution")
    )


def explain_local_linear(
    prepared: DataFrame,
    training: DataFrame,
    classifier: Transformer,
    names: list[str],
    key: str = "customer_id",
    samples: int = 200,
    ridge: float = 1.0,
    seed: int = 42,
) -> DataFrame:
    """Weights of a linear model fitted around each row: key, feature, contribution.

    ``samples`` copies of the row are shifted by training-deviation noise and
    scored; nearer copies weigh more. The copies of a row come from it in place
    and stay together, so none is shuffled; many small ridge problems are
    solved at a time. Of a forest the copies, with the same noise, are made and
    scored in the task that solves them. A key that comes more than once gets a
    fit for each of its rows.
    """
    d = len(names)
    width = 0.75 * math.sqrt(d)
    key_type = prepared.schema[key].dataType.simpleString()
    out_type = f"{key} {key_type}, feature string, contribution double"
    training = training.select(vector_to_array("features").alias("x"))
    spread_of = F.array(*[F.stddev_pop(F.col("x")[j]) for j in range(d)])

    def solve(z: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Weights for rows × samples × features shifts and rows × samples scores."""
        near = np.exp(-(z**2).sum(axis=2) / width**2)
        w = near / near.sum(axis=1, keepdims=True)
        zc = z - np.einsum("rs,rsd->rd", w, z)[:, None, :]
        pc = p - np.einsum("rs,rs->r", w, p)[:, None]
        weighted = (near[:, :, None] * zc).transpose(0, 2, 1)
        left = weighted @ zc + ridge * np.eye(d)
        right = (weighted @ pc[:, :, None])[:, :, 0]
        return np.linalg.solve(left, right[:, :, None])[:, :, 0]

    if isinstance(classifier, RandomForestClassificationModel) and classifier.numClasses == 2:
        try:
            scorer = ForestScorer(classifier, prepared.sparkSession)
        except ValueError:  # a split by more than two categories
            pass
        else:
            deviation = np.array(training.agg(spread_of.alias("s")).first()["s"] or [0.0] * d, float)

            def scored_here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                feature, sample = np.arange(d)[:, None, None], np.arange(samples)[None, None, :]
                for batch in batches:
                    for at in range(0, batch.num_rows, ROWS_AT_A_TIME):
                        part = batch.slice(at, ROWS_AT_A_TIME)
                        x = np.asarray(part.column("x").flatten()).reshape(part.num_rows, d).T[:, :, None]
                        own = part.column("hash").to_numpy()[None, :, None]
                        z = np.where(sample > 0, normals_of(own, sample, feature, np.array(seed)), 0.0)
                        p = scorer((x + z * deviation[:, None, None]).reshape(d, -1)).reshape(-1, samples)
                        weights = solve(np.ascontiguousarray(z.transpose(1, 2, 0)), p)
                        keys = part.column("key").take(pa.array(np.repeat(np.arange(part.num_rows), d)))
                        columns = [keys, pa.array(names * part.num_rows, pa.string()), pa.array(weights.reshape(-1))]
                        yield pa.RecordBatch.from_arrays(columns, names=[key, "feature", "contribution"])

            rows = prepared.select(F.col(key).alias("key"), F.xxhash64(key).alias("hash"), vector_to_array("features").alias("x"))
            return spread_rows(rows, samples, SCORED_PER_TASK).mapInArrow(scored_here, out_type)

    noise = F.transform(
        F.sequence(F.lit(0), F.lit(d - 1)),
        lambda j: F.when(
            F.col("sample") > 0, hash_normal(F.col(key), F.col("sample"), j, F.lit(seed))
        ).otherwise(0.0),
    )
    shifted = (
        _spread_rows(prepared.select(key, vector_to_array("features").alias("x")), samples)
        .withColumn("spread", training.agg(spread_of.alias("s")).scalar())
        .withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))))
        .withColumn("z", noise)
        .withColumn(
            "features",
            array_to_vector(F.transform("x", lambda v, j: v + F.element_at("z", j + 1) * F.element_at("spread", j + 1))),
        )
    )
    scored = classifier.transform(shifted).select(key, "z", positive_probability().alias("p"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            whole = len(rows) - len(rows) % samples
            if whole:
                now = rows.iloc[:whole]
                z = np.stack(now["z"].to_numpy()).reshape(-1, samples, d)
                keys, weights = now[key].to_numpy()[::samples], solve(z, now["p"].to_numpy().reshape(-1, samples))
                yield pd.DataFrame({key: np.repeat(keys, d), "feature": names * len(keys), "contribution": weights.reshape(-1)})
            rest = rows.iloc[whole:]

    return scored.mapInPandas(run, out_type)


def explain_top(contributions: DataFrame, key: str = "customer_id", n: int = 10) -> DataFrame:
    """Per row, its ``n`` largest contributions as an ordered map."""
    top = top_abs(contributions, [key], n)
    entries = F.array_sort(F.collect_list(F.struct("rank", "feature", "contribution")))
    as_map = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["feature"], e["contribution"])))
    return top.groupBy(key).agg(as_map.alias("feature_importance"))
