"""Metrics, splits, training, scoring, explanation and monitoring."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import gauge_band, risk_level
from ..ml import explain, metrics, prep, split, train
from ..ml.score import FixedLogistic, logistic_score, score
from ..ml.score import batch_score as score_batch
from ..ml.score import score_one as score_single
from ..ml.tree_shapley import explain_trees
from ..operators import monitoring, ranking
from ..operators.snapshot import latest_snapshot
from ..plans.training import TRIALS as JOB_TRIALS
from ..schemas import CHURN_METRICS, MODEL_FEATURES
from ..session import materialize, scratch_dir
from ..sources import models
from ..sources.tables import merge_snapshot, read_importance, read_snapshot, write_importance
from .analytics import CHURN_CORRELATION, churn_table
from .base import query, register, sql
from .features import daily_frame
from .store import LOOKUP_AT, LOOKUP_REFS, TRAINING_SQL, TRAINING_USES, names, training
from .store import requests as lookup_requests

USES = ("churn_table",)

# ---------------------------------------------------------------- fixed scores

WEIGHTS = {"cust_serv_calls": 0.35, "day_mins": 0.004, "account_weeks": -0.012, "data_plan": -0.5}
INTERCEPT = 1.2


def logistic_sql(table: str, weights: dict[str, float], intercept: float, keep: str) -> str:
    margin = " + ".join(f"({w}) * {c}" for c, w in weights.items())
    return f"""
SELECT {keep}, p AS churn_probability, p >= 0.5 AS churn_prediction
FROM (SELECT *, floor(1 / (1 + exp(-CAST({intercept} + {margin} AS DOUBLE))) * 10000) / 10000 AS p FROM {table})"""


SCORED = logistic_sql("churn_table", WEIGHTS, INTERCEPT, "customer_id, churn")


def coarse(scored):
    """Scores cut to four digits, so that some are equal."""
    p = F.floor(F.col("churn_probability") * 10000).cast("double") / 10000
    return scored.withColumn("churn_probability", p).withColumn("churn_prediction", p >= 0.5)


def scored_frame(spark, sf_dir):
    scored = coarse(logistic_score(churn_table(spark, sf_dir), WEIGHTS, INTERCEPT))
    return scored.select("customer_id", "churn", "churn_probability", "churn_prediction")


register("logistic_score", scored_frame, sql(SCORED, USES, ("churn_probability",)))


@query(
    "threshold_prediction",
    f"SELECT customer_id, churn_probability >= 0.5 AS churn_prediction FROM ({SCORED})",
    USES,
)
def threshold(spark, sf_dir):
    return scored_frame(spark, sf_dir).select("customer_id", "churn_prediction")


BANDS = """CASE WHEN churn_probability < 0.3 THEN 'Low Risk' WHEN churn_probability < 0.7 THEN 'Medium Risk'
     ELSE 'High Risk' END"""


@query("risk_level", f"SELECT customer_id, {BANDS} AS risk FROM ({SCORED})", USES)
def risk(spark, sf_dir):
    return scored_frame(spark, sf_dir).select("customer_id", risk_level(F.col("churn_probability")).alias("risk"))


@query("gauge_band", f"SELECT customer_id, {BANDS} AS band FROM ({SCORED})", USES)
def gauge(spark, sf_dir):
    percent = F.col("churn_probability") * 100
    return scored_frame(spark, sf_dir).select("customer_id", gauge_band(percent).alias("band"))


def metrics_sql(source: str, by: str = "", label: str = "churn = 1") -> str:
    hit = f"{label} AND churn_prediction"
    either = f"count(*) FILTER (WHERE {label}) + count(*) FILTER (WHERE churn_prediction)"
    return f"""
SELECT {by}{',' if by else ''} count(*) FILTER (WHERE ({label}) = churn_prediction) / count(*) AS accuracy,
       coalesce(count(*) FILTER (WHERE {hit}) / nullif(count(*) FILTER (WHERE churn_prediction), 0), 0) AS precision,
       coalesce(count(*) FILTER (WHERE {hit}) / nullif(count(*) FILTER (WHERE {label}), 0), 0) AS recall,
       coalesce(2 * count(*) FILTER (WHERE {hit}) / nullif({either}, 0), 0) AS f1
FROM {source} {'GROUP BY ' + by if by else ''}"""


FOUR = ("accuracy", "precision", "recall", "f1")


@query("binary_metrics", metrics_sql(f"({SCORED})"), USES, FOUR)
def binary_metrics(spark, sf_dir):
    return metrics.binary_metrics(scored_frame(spark, sf_dir))


@query(
    "confusion",
    f"SELECT churn, CAST(churn_prediction AS INTEGER) AS prediction, count(*) AS n FROM ({SCORED}) GROUP BY 1, 2",
    USES,
)
def confusion(spark, sf_dir):
    return metrics.confusion(scored_frame(spark, sf_dir))


ROC_SQL = f"""
SELECT sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) AS roc_auc
FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY churn_probability ROWS BETWEEN UNBOUNDED PRECEDING
                                               AND 1 PRECEDING), 0) AS below
      FROM (SELECT churn_probability, count(*) FILTER (WHERE churn = 1) AS pos,
                   count(*) FILTER (WHERE churn = 0) AS neg FROM ({SCORED}) GROUP BY 1))"""


@query(
    "roc_auc",
    ROC_SQL,
    USES,
    ("roc_auc",),
)
def roc_auc(spark, sf_dir):
    return metrics.roc_auc(scored_frame(spark, sf_dir))


THRESHOLDS = [0.3, 0.4, 0.5, 0.6]


@query(
    "rank_models",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        metrics_sql(f"(SELECT * REPLACE (churn_probability >= {t} AS churn_prediction) FROM ({SCORED}))").replace(
            "SELECT ", f"SELECT {i} AS position, ", 1
        )
        for i, t in enumerate(THRESHOLDS)
    )
    + ") ORDER BY f1 DESC, position LIMIT 1",
    USES,
    FOUR,
)
def rank_models(spark, sf_dir):
    # the same scores cut at different thresholds stand for candidate models
    cuts = F.explode(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(t).alias("cut"))
                               for i, t in enumerate(THRESHOLDS)]))
    each = scored_frame(spark, sf_dir).select("churn", "churn_probability", cuts.alias("c"))
    flagged = each.select(
        F.col("c.position").alias("position"), "churn", (F.col("churn_probability") >= F.col("c.cut")).alias("churn_prediction")
    )
    return ranking.rank_models(metrics.binary_metrics(flagged, by=["position"]))


@query("top_importance", f"SELECT * FROM ({CHURN_CORRELATION}) ORDER BY importance DESC, feature LIMIT 5", USES, ("importance",))
def top_importance(spark, sf_dir):
    from .analytics import churn_correlation

    return ranking.top_importance(churn_correlation(spark, sf_dir), 5)


# ---------------------------------------------------------------- explanation of a linear score

LINEAR = {c: w for c, w in zip(CHURN_METRICS, (-0.012, -0.9, -0.5, 0.2, 0.35, 0.004, -0.1, 0.01, 0.07, 0.15))}
LINEAR_SQL = " UNION ALL ".join(
    f"SELECT customer_id, '{c}' AS feature, CAST({w} AS DOUBLE) * ({c} - avg({c}) OVER ()) AS contribution FROM churn_table"
    for c, w in LINEAR.items()
)


def linear_frame(spark, sf_dir):
    return explain.explain_linear(churn_table(spark, sf_dir), "customer_id", LINEAR)


register("explain_linear", linear_frame, sql(LINEAR_SQL, USES, ("contribution",)))

TOP3 = f"""
SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY abs(contribution) DESC, feature) AS INTEGER) AS rank
FROM ({LINEAR_SQL}) QUALIFY rank <= 3"""


@query("top_abs", TOP3, USES, ("contribution",))
def top_abs(spark, sf_dir):
    return ranking.top_abs(linear_frame(spark, sf_dir), ["customer_id"], 3)


@query(
    "explain_top",
    f"""
SELECT customer_id, string_agg(feature, ',' ORDER BY rank) AS features, max(abs(contribution)) AS strongest
FROM ({TOP3}) GROUP BY customer_id""",
    USES,
    ("strongest",),
)
def explain_top(spark, sf_dir):
    top = explain.explain_top(linear_frame(spark, sf_dir), n=3)
    importance = F.col("feature_importance")
    return top.select(
        "customer_id",
        F.array_join(F.map_keys(importance), ",").alias("features"),
        F.abs(F.map_values(importance)[0]).alias("strongest"),
    )


@query(
    "positive_negative_factors",
    f"""
SELECT customer_id, feature, contribution, CASE WHEN contribution > 0 THEN 'increases' ELSE 'decreases' END AS direction,
       CAST(row_number() OVER (PARTITION BY customer_id, contribution > 0 ORDER BY abs(contribution) DESC, feature)
            AS INTEGER) AS rank
FROM ({LINEAR_SQL}) WHERE contribution <> 0 QUALIFY rank <= 3""",
    USES,
    ("contribution",),
)
def factors(spark, sf_dir):
    return ranking.positive_negative_factors(linear_frame(spark, sf_dir), ["customer_id"])


# ---------------------------------------------------------------- preparation

SPLIT_ORDER = "md5(concat(customer_id, ':42'))"


@query(
    "stratified_split",
    f"""
SELECT customer_id, churn, row_number() OVER (PARTITION BY churn ORDER BY {SPLIT_ORDER})
       <= 0.2 * count(*) OVER (PARTITION BY churn) AS is_test FROM churn_table""",
    USES,
)
def stratified_split(spark, sf_dir):
    return split.stratified_split(churn_table(spark, sf_dir)).select("customer_id", "churn", "is_test")


@query(
    "stratified_folds",
    f"""
SELECT customer_id, churn,
       CAST((row_number() OVER (PARTITION BY churn ORDER BY {SPLIT_ORDER}) - 1) % 5 AS INTEGER) AS fold
FROM churn_table""",
    USES,
)
def stratified_folds(spark, sf_dir):
    return split.stratified_folds(churn_table(spark, sf_dir)).select("customer_id", "churn", "fold")


@query(
    "class_weights",
    """
SELECT churn, count(*) AS n, sum(count(*)) OVER () / (2 * count(*)) AS balanced_weight,
       CASE WHEN churn = 1 THEN (SELECT count(*) FILTER (WHERE churn = 0) / count(*) FILTER (WHERE churn = 1)
                                 FROM churn_table) ELSE 1 END AS positive_weight
FROM churn_table GROUP BY churn""",
    USES,
    ("balanced_weight", "positive_weight"),
)
def class_weights(spark, sf_dir):
    return prep.class_weights(churn_table(spark, sf_dir))


@query(
    "scale_numeric",
    "SELECT customer_id, "
    + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in CHURN_METRICS)
    + " FROM churn_table",
    USES,
    tuple(CHURN_METRICS),
)
def scale_numeric(spark, sf_dir):
    table = churn_table(spark, sf_dir).select("customer_id", *CHURN_METRICS)
    return prep.scale_numeric(table, CHURN_METRICS)


CONTRACTS = ["Month-to-month", "One year"]


@query(
    "one_hot",
    "SELECT customer_id, "
    + ", ".join(f"CASE WHEN contract_type = '{c}' THEN 1 ELSE 0 END AS \"contract_type_{c}\"" for c in CONTRACTS)
    + " FROM customer_profile",
    ("customer_profile",),
)
def one_hot(spark, sf_dir):
    # 'Two year' is left out of the known levels: its rows show the all-zero encoding
    return prep.one_hot(fx.customer_profile(spark, sf_dir).select("customer_id", "contract_type"), "contract_type", CONTRACTS)


# ---------------------------------------------------------------- trained models

RUN = datetime(2024, 1, 31, 12, 0, 0)
_stored: dict[tuple, object] = {}


def _once(spark, sf_dir, what: str, make):
    """Keep a training result for the session, so that queries on it do not train again.

    The key holds size and time of the input files: other data means another result.
    """
    files = spark.read.format("binaryFile").load([f"{sf_dir}/{t}.parquet" for t in ("orders", "customer", "events", "lineitem")])
    state = files.agg(F.sum("length"), F.max("modificationTime")).first()
    key = (spark.sparkContext.applicationId, sf_dir, tuple(state), what)
    if key not in _stored:
        _stored[key] = make()
    return _stored[key]


def forget() -> None:
    """Drop the kept training results, so that the next query trains again."""
    _stored.clear()


def model_table(spark, sf_dir):
    """Training rows: the service's features of every labelled customer as of a day, with the label."""

    return _once(spark, sf_dir, "table", lambda: materialize(training(spark, sf_dir), "model-table"))


def trained(spark, sf_dir, kind: str):
    def make():
        model = train.fit(model_table(spark, sf_dir), kind)
        model.metrics = metrics.evaluate(score(model_table(spark, sf_dir), model.pipeline))
        return model

    return _once(spark, sf_dir, kind, make)


def stored_runs(spark, sf_dir) -> str:
    """A model folder with the forest as its latest run and the logistic model before it."""

    def make():
        base = scratch_dir(spark, "models")
        models.save_model(spark, trained(spark, sf_dir, "logistic"), base, datetime(2024, 1, 30, 12, 0, 0))
        models.save_model(spark, trained(spark, sf_dir, "forest"), base, RUN)
        return base

    return _once(spark, sf_dir, "runs", make)


def _predictions(kind: str):
    def run(spark, sf_dir):
        return score(model_table(spark, sf_dir), trained(spark, sf_dir, kind).pipeline).select(
            "customer_id", "churn", "churn_probability", "churn_prediction"
        )

    return run


register("train_logistic", _predictions("logistic"))
register("train_forest", _predictions("forest"))
register("train_boosted", _predictions("boosted"))


NUMERIC = [c for c in names(MODEL_FEATURES) if c not in ("contract_type", "payment_method", "gender")]
CATEGORICAL = ["contract_type", "payment_method", "gender"]
FAMILIES = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS filled, '{f}' AS family FROM ({TRAINING_SQL})"
    for f, columns in (("numeric", NUMERIC), ("categorical", CATEGORICAL))
    for c in columns
)


@query("numeric_and_categorical", FAMILIES, TRAINING_USES)
def numeric_and_categorical(spark, sf_dir):
    table = model_table(spark, sf_dir)
    numeric, text = prep.numeric_and_categorical(table)
    filled = table.agg(*[F.count(c).alias(c) for c in [*numeric, *text]]).unpivot([], [*numeric, *text], "column", "filled")
    return filled.withColumn("family", F.when(F.col("column").isin(text), "categorical").otherwise("numeric"))


def _scaled_sql(c: str) -> str:
    """A column standardised after missing values took the mean; left out without any value."""
    filled = f"SELECT customer_id, coalesce({c}, m) AS x, m, n FROM (SELECT *, avg({c}) OVER () AS m, count({c}) OVER () AS n FROM frame)"
    return f"""
SELECT customer_id, '{c}' AS feature, CAST(coalesce((x - m) / nullif(stddev_pop(x) OVER (), 0), 0) AS DOUBLE) AS value
FROM ({filled}) WHERE n > 0"""


def _hot_sql(c: str) -> str:
    return f"""
SELECT f.customer_id, concat('{c}_', l.level), CASE WHEN coalesce(f.{c}, '{prep.MISSING}') = l.level THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
FROM frame f CROSS JOIN (SELECT DISTINCT coalesce({c}, '{prep.MISSING}') AS level FROM frame) l"""


ASSEMBLED = f"""
SELECT * FROM (WITH frame AS MATERIALIZED ({TRAINING_SQL})
{' UNION ALL '.join([*map(_scaled_sql, NUMERIC), *map(_hot_sql, CATEGORICAL)])})"""


@query("assemble", ASSEMBLED, TRAINING_USES, ("value",))
def assemble(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    table = model_table(spark, sf_dir)
    ready = train.prepare(table)
    slots = prep.feature_names(ready.preparation.stages, ready.profile.numeric, ready.profile.categorical)
    values = ready.preparation.transform(table).select("customer_id", F.posexplode(vector_to_array("features")).alias("j", "value"))
    return values.select("customer_id", F.element_at(F.array(*map(F.lit, slots)), F.col("j") + 1).alias("feature"), "value")


@query("feature_importance")
def feature_importance(spark, sf_dir):
    return train.feature_importance(trained(spark, sf_dir, "forest"), spark)


@query(
    "importance_names",
    f"SELECT CAST(row_number() OVER (ORDER BY feature) - 1 AS INTEGER) AS position, feature, importance FROM ({CHURN_CORRELATION})",
    USES,
    ("importance",),
)
def importance_names(spark, sf_dir):
    from .analytics import churn_correlation

    # correlations with churn stand for a model's importances: two arrays, in the order of the names
    pairs = F.array_sort(F.collect_list(F.struct("feature", "importance")))
    arrays = churn_correlation(spark, sf_dir).agg(pairs.alias("p"))
    return ranking.importance_names(arrays.select(F.col("p.feature").alias("names")), arrays.select(F.col("p.importance").alias("importances")))


@query("write_importance", CHURN_CORRELATION, USES, ("importance",))
def importance_file(spark, sf_dir):
    from .analytics import churn_correlation

    path = scratch_dir(spark, "importance")
    write_importance(churn_correlation(spark, sf_dir), path)
    return read_importance(spark, path)


#: The job's own trials: both kinds, drawn out of the whole tuning space.
TRIALS = train.sample_trials(JOB_TRIALS)
FOLDS = 5


@query("tune")
def tune(spark, sf_dir):
    table = model_table(spark, sf_dir)
    scores = train.cross_validate(table, TRIALS, folds=FOLDS)
    rows = [(i, t["kind"], t["trees"], t["max_depth"], s) for i, (t, s) in enumerate(zip(TRIALS, scores))]
    best = TRIALS[max(range(len(TRIALS)), key=lambda i: scores[i])]
    refit = train.fit(table, best["kind"], **{k: v for k, v in best.items() if k != "kind"})
    found = metrics.evaluate(score(table, refit.pipeline))["roc_auc"]
    rows.append((-1, f"refit {best['kind']}", best["trees"], best["max_depth"], found))
    return spark.createDataFrame(rows, "trial int, kind string, trees int, max_depth int, roc_auc double")


@query("select_best")
def select_best(spark, sf_dir):
    _, candidates, _ = train.train_candidates(model_table(spark, sf_dir), trials=TRIALS, folds=FOLDS)
    return ranking.rank_models(train.model_candidates(candidates, spark))


@query("save_model")
def save_model(spark, sf_dir):
    pipeline, version = models.load_model(spark, stored_runs(spark, sf_dir))
    return score(model_table(spark, sf_dir), pipeline).select(
        "customer_id", "churn_probability", "churn_prediction", F.lit(version).alias("model_version")
    )


@query("model_info")
def model_info(spark, sf_dir):
    info = models.model_info(spark, stored_runs(spark, sf_dir), feature_importance(spark, sf_dir))
    kept = ["model_version", "model_type", "training_date"]
    figures = info.select(*kept, F.explode("metrics").alias("metric", "value"))
    importance = info.select(*kept, F.explode("feature_importance").alias("metric", "value"))
    return figures.union(importance.withColumn("metric", F.concat(F.lit("importance of "), "metric")))


@query(
    "write_metrics",
    f"SELECT TIMESTAMP '2024-01-31 12:00:00' AS timestamp, m.*, r.roc_auc FROM ({metrics_sql(f'({SCORED})')}) m, ({ROC_SQL}) r",
    USES,
    (*FOUR, "roc_auc"),
)
def write_metrics(spark, sf_dir):
    base = scratch_dir(spark, "metrics")
    models.write_metrics(spark, metrics.evaluate(scored_frame(spark, sf_dir)), base, RUN)
    history = models.read_metrics_history(spark, base)
    return history.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def _requests_and_views(spark, sf_dir):
    requests = fx.table(spark, sf_dir, "customer").select(
        fx.customer_key("c_custkey").alias("customer_id"), F.col("c_custkey").alias("position")
    )
    columns = [c for c in model_table(spark, sf_dir).columns if c not in ("customer_id", "churn", "event_timestamp")]
    stored = model_table(spark, sf_dir).drop("churn", "event_timestamp").withColumn(
        "event_timestamp", F.lit(RUN).cast("timestamp_ntz")
    )
    return requests, {"customer_profile": latest_snapshot(stored)}, [f"customer_profile:{c}" for c in columns]


SCORE_WEIGHTS = {"daily_total_minutes": 0.01, "customer_service_calls": 0.6, "monthly_charges": -0.02}
SCORE_MEANS = {"monthly_charges": 40.0}
SCORE_REFS = [r for r in LOOKUP_REFS if r.partition(":")[2] in SCORE_WEIGHTS]
FIXED = FixedLogistic(SCORE_WEIGHTS, -0.4, SCORE_MEANS)


def _scored_lookup_sql(where: str = "") -> str:
    margin = " + ".join(f"{w} * coalesce({c}, {SCORE_MEANS.get(c, 0)})" for c, w in SCORE_WEIGHTS.items())
    key = "concat('CUST', lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(6, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0'))"
    return f"""
SELECT customer_id, position, has_features, churn_probability, churn_probability >= 0.5 AS churn_prediction, 'fixed' AS model_version
FROM (SELECT r.customer_id, position, s.customer_id IS NOT NULL OR p.customer_id IS NOT NULL AS has_features,
             1 / (1 + exp(-CAST(-0.4 + {margin} AS DOUBLE))) AS churn_probability
      FROM (SELECT {key} AS customer_id, c_custkey AS position FROM customer) r
      LEFT JOIN (SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY event_timestamp DESC) = 1) s
        ON s.customer_id = r.customer_id AND s.event_timestamp >= TIMESTAMP '2024-04-20' - INTERVAL 90 DAY
      LEFT JOIN customer_profile p
        ON p.customer_id = r.customer_id AND p.event_timestamp >= TIMESTAMP '2024-04-20' - INTERVAL 365 DAY){where}"""


def _stored_views(spark, sf_dir):
    """Snapshots written once and read back, as a service would hold them."""
    base, paths = scratch_dir(spark, "snapshots"), {}
    for view, rows in (("cdr_statistics", daily_frame(spark, sf_dir)), ("customer_profile", fx.customer_profile(spark, sf_dir))):
        paths[view] = f"{base}/{view}"
        merge_snapshot(latest_snapshot(rows), paths[view])
    return {view: read_snapshot(spark, path) for view, path in paths.items()}


@query("batch_score", _scored_lookup_sql(), ("daily", "customer_profile"), ("churn_probability",))
def batch_score(spark, sf_dir):
    views = _stored_views(spark, sf_dir)
    return score_batch(lookup_requests(spark, sf_dir), views, SCORE_REFS, FIXED, "fixed", LOOKUP_AT).drop("prediction_time")


@query(
    "score_one",
    f"SELECT * EXCLUDE (position) FROM ({_scored_lookup_sql(chr(32) + 'WHERE customer_id = ' + chr(39) + 'CUST000019' + chr(39))})",
    ("daily", "customer_profile"),
    ("churn_probability",),
)
def score_one(spark, sf_dir):
    views = _stored_views(spark, sf_dir)
    return score_single("CUST000019", views, SCORE_REFS, FIXED, "fixed", LOOKUP_AT).drop("prediction_time")


@query("batch_score_stored_model")
def batch_score_stored_model(spark, sf_dir):
    pipeline, version = models.load_model(spark, stored_runs(spark, sf_dir))
    return score_batch(*_requests_and_views(spark, sf_dir), pipeline, version).drop("prediction_time")


@query("score_one_stored_model")
def score_one_stored_model(spark, sf_dir):
    pipeline, version = models.load_model(spark, stored_runs(spark, sf_dir))
    _, views, refs = _requests_and_views(spark, sf_dir)
    return score_single("CUST000019", views, refs, pipeline, version).drop("prediction_time")


@query("explain_linear_model")
def explain_linear_model(spark, sf_dir):
    model = trained(spark, sf_dir, "logistic")
    prepared = model.preparation.transform(model_table(spark, sf_dir))
    return explain.explain_linear_model(prepared, "customer_id", model.classifier, model.names)


def _exact_shapley(kind: str):
    def run(spark, sf_dir):
        model = trained(spark, sf_dir, kind)
        prepared = model.preparation.transform(model_table(spark, sf_dir))
        return explain_trees(prepared, prepared, model.classifier, model.names)

    return run


register("explain_shapley", _exact_shapley("forest"))
register("explain_shapley_boosted", _exact_shapley("boosted"))


@query("explain_shapley_sampled")
def explain_shapley_sampled(spark, sf_dir):
    model = trained(spark, sf_dir, "forest")
    prepared = model.preparation.transform(model_table(spark, sf_dir))
    return explain.explain_shapley(prepared, prepared, model.classifier, model.names)


@query("explain_local_linear")
def explain_local_linear(spark, sf_dir):
    model = trained(spark, sf_dir, "forest")
    prepared = model.preparation.transform(model_table(spark, sf_dir))
    return explain.explain_local_linear(prepared, prepared, model.classifier, model.names)


# ---------------------------------------------------------------- monitoring

DAY_WEIGHTS = {"customer_service_calls": 0.8, "daily_total_calls": -0.3, "daily_charges": 0.02}
DAY_SCORED = logistic_sql("daily", DAY_WEIGHTS, -0.2, "customer_id, event_date, event_timestamp, dropped_calls_pct")


def day_scores(spark, sf_dir):
    return coarse(logistic_score(daily_frame(spark, sf_dir), DAY_WEIGHTS, -0.2))


@query(
    "prediction_histogram",
    f"""
SELECT CAST(event_timestamp AS DATE) AS date, CAST(least(floor(churn_probability * 10), 9) AS INTEGER) AS bin,
       count(*) AS n FROM ({DAY_SCORED}) GROUP BY 1, 2""",
    ("daily",),
)
def prediction_histogram(spark, sf_dir):
    return monitoring.prediction_histogram(day_scores(spark, sf_dir))


# the label of a customer-day: a call was dropped
DROPPED = "coalesce(dropped_calls_pct, 0) > 0"


def metrics_by(spark, sf_dir, period: str):
    label = F.when(F.coalesce(F.col("dropped_calls_pct"), F.lit(0.0)) > 0, 1).otherwise(0)
    time = F.date_trunc(period, F.col("event_date")).cast("timestamp_ntz")
    labelled = day_scores(spark, sf_dir).withColumn("churn", label).withColumn("timestamp", time)
    return metrics.binary_metrics(labelled, by=["timestamp"])


WEEKLY = metrics_sql(
    f"(SELECT *, CAST(date_trunc('week', event_date) AS TIMESTAMP) AS timestamp FROM ({DAY_SCORED}))", "timestamp", DROPPED
)
DAILY = metrics_sql(f"(SELECT *, CAST(event_date AS TIMESTAMP) AS timestamp FROM ({DAY_SCORED}))", "timestamp", DROPPED)


@query(
    "read_metrics_history",
    f"SELECT *, CAST(0 AS DOUBLE) AS roc_auc FROM ({WEEKLY})",
    ("daily",),
    FOUR,
)
def read_metrics_history(spark, sf_dir):
    base = scratch_dir(spark, "history")
    for run in metrics_by(spark, sf_dir, "week").collect():  # one row per week
        models.write_metrics(spark, run.asDict(), base, run["timestamp"])
    history = models.read_metrics_history(spark, base)
    return history.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query(
    "metric_drop_alert",
    f"""
SELECT *, coalesce(previous - value > 0.05, false) AS alert
FROM (SELECT *, lag(value) OVER (PARTITION BY metric ORDER BY timestamp) AS previous
      FROM (SELECT timestamp, unnest(['accuracy', 'precision', 'recall', 'f1']) AS metric,
                   unnest([accuracy, precision, recall, f1]) AS value FROM ({DAILY})))""",
    ("daily",),
    ("value", "previous"),
)
def metric_drop_alert(spark, sf_dir):
    return monitoring.metric_drop_alert(metrics_by(spark, sf_dir, "day"), list(FOUR))
