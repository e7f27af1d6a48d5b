"""Data quality and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import clean, drift, quality
from .base import query, register, sql

EXISTING = (
    "call_id", "customer_id", "call_time", "call_duration_seconds", "call_type", "destination_number",
    "network_type", "call_result", "call_charge",
)
TYPED = ("call_id", "customer_id", "call_time", "call_duration_seconds", "call_charge")


SPARK_TYPES = "CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'FLOAT' THEN 'float' WHEN 'TIMESTAMP' THEN 'timestamp' ELSE lower(column_type) END"
TYPES = {"call_id": "string", "customer_id": "string", "call_time": "timestamp", "call_duration_seconds": "int", "call_charge": "float"}


def _suite_sql(source: str = "cdr_dirty", missing: tuple[str, ...] = (), by: str = "") -> str:
    """The suite on ``source``; columns and types are asked of the table itself.

    ``missing`` are columns that the source lacks. ``by`` is an expression that tells batches apart.
    """
    batch = f"{by} AS batch, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    described = f"(DESCRIBE SELECT * FROM {source})"
    rows = []

    def whole(kind, column, ok):
        holds = f"(SELECT count(*) = 1 FROM {described} WHERE column_name = '{column}'{ok})"
        start = f"SELECT DISTINCT {batch}" if by else "SELECT "
        rows.append(
            f"{start}'{kind}' AS \"check\", '{column}' AS \"column\", CAST(CAST({holds} AS INTEGER) AS DOUBLE) AS observed, "
            f"1.0 AS threshold, {holds} AS success" + (f" FROM {source}" if by else "")
        )

    for column in EXISTING:
        whole(quality.EXISTS, column, "")
    for column, wanted in TYPES.items():
        whole(quality.OF_TYPE, column, f" AND {SPARK_TYPES} = '{wanted}'")

    def share(kind, column, ok, total, threshold):
        if column in missing:
            return f"SELECT {batch}'{kind}', '{column}', NULL, {threshold}, false FROM {source}{group or ' LIMIT 1'}"
        value = f"count(*) FILTER (WHERE {ok}) / nullif(CAST({total} AS DOUBLE), 0)"
        return f"SELECT {batch}'{kind}', '{column}', {value}, {threshold}, coalesce({value} >= {threshold}, true) FROM {source}{group}"

    for column, threshold in [
        ("call_id", 1.0), ("customer_id", 1.0), ("call_time", 1.0), ("call_duration_seconds", 0.95),
        ("call_type", 0.95), ("call_result", 0.95), ("call_charge", 0.95),
    ]:
        rows.append(share(quality.NOT_NULL, column, f"{column} IS NOT NULL", "count(*)", threshold))
    conditions = {
        "call_duration_seconds": (quality.BETWEEN, "call_duration_seconds BETWEEN 0 AND 7200"),
        "call_charge": (quality.BETWEEN, "call_charge BETWEEN 0 AND 100"),
        "call_type": (quality.IN_SET, "call_type IN ('VOICE', 'SMS', 'DATA')"),
        "network_type": (quality.IN_SET, "network_type IN ('2G', '3G', '4G', '5G', 'WIFI', 'ROAMING')"),
        "call_result": (quality.IN_SET, "call_result IN ('COMPLETED', 'BUSY', 'NO_ANSWER', 'FAILED', 'DROPPED')"),
    }
    for column, (kind, ok) in conditions.items():
        rows.append(share(kind, column, ok, f"count({column})", 0.99))
    rows.append(f"SELECT {batch}'{quality.ROW_COUNT}', NULL, CAST(count(*) AS DOUBLE), 1.0, count(*) >= 1 FROM {source}{group}")
    if by:
        return " UNION ALL ".join(f"({r})" for r in rows)
    union = " UNION ALL ".join(f"({r})" for r in rows)
    return f"SELECT CAST(row_number() OVER () AS INTEGER) AS check_no, * FROM ({union})"


SUITE = _suite_sql()
USES = ("cdr_dirty",)
DOUBLES = ("observed", "threshold")


def suite_results(spark, sf_dir):
    return quality.run_suite(fx.cdr_dirty(spark, sf_dir))


register("run_suite", suite_results, sql(f"SELECT * REPLACE (CAST(observed AS DOUBLE) AS observed, CAST(threshold AS DOUBLE) AS threshold) FROM ({SUITE})", USES, DOUBLES))


def _register_kind(name: str, kind: str, mostly: bool | None = None) -> None:
    condition = f"\"check\" = '{kind}'"
    if mostly is not None:
        condition += " AND threshold < 1" if mostly else " AND threshold = 1"
    register(
        name,
        lambda spark, sf_dir: suite_results(spark, sf_dir).filter(condition.replace('"', "`")),
        sql(
            f"SELECT * REPLACE (CAST(observed AS DOUBLE) AS observed, CAST(threshold AS DOUBLE) AS threshold) "
            f"FROM ({SUITE}) WHERE {condition}",
            USES,
            DOUBLES,
        ),
    )


def broken_results(spark, sf_dir):
    """Records that lack a column and hold another in a wrong type."""
    broken = fx.cdr_dirty(spark, sf_dir).drop("network_type")
    return quality.run_suite(broken.withColumn("call_duration_seconds", F.col("call_duration_seconds").cast("bigint")))


BROKEN = _suite_sql("broken", ("network_type",))
BROKEN_USES = ("cdr_broken",)


def _register_broken(name: str, kind: str) -> None:
    register(
        name,
        lambda spark, sf_dir: broken_results(spark, sf_dir).filter(F.col("check") == kind),
        sql(
            f"SELECT * REPLACE (CAST(threshold AS DOUBLE) AS threshold) FROM ({BROKEN.replace('FROM broken', 'FROM cdr_broken')}) "
            f"WHERE \"check\" = '{kind}'",
            BROKEN_USES,
            DOUBLES,
        ),
    )


_register_broken("expect_columns", quality.EXISTS)
_register_broken("expect_types", quality.OF_TYPE)
_register_kind("expect_not_null", quality.NOT_NULL, False)
_register_kind("expect_mostly_not_null", quality.NOT_NULL, True)
_register_kind("expect_between", quality.BETWEEN)
_register_kind("expect_in_set", quality.IN_SET)
_register_kind("expect_row_count", quality.ROW_COUNT)


@query(
    "quality_gate",
    f"SELECT count(*) AS checks, count(*) FILTER (WHERE NOT success) AS failed, bool_and(success) AS passed FROM ({SUITE})",
    USES,
)
def quality_gate(spark, sf_dir):
    return quality.quality_gate(suite_results(spark, sf_dir))


FAILED = f"""
SELECT check_no, "check", "column", CAST(observed AS DOUBLE) AS observed, CAST(threshold AS DOUBLE) AS threshold,
       success, format('observed {{:.4f}}, required {{:.4f}}', CAST(observed AS DOUBLE), CAST(threshold AS DOUBLE)) AS details
FROM ({SUITE}) WHERE NOT success"""


@query("failed_checks", FAILED, USES, DOUBLES)
def failed_checks(spark, sf_dir):
    return quality.failed_checks(suite_results(spark, sf_dir))


@query(
    "first_failures",
    f"""
SELECT *, CAST(row_number() OVER (ORDER BY check_no) AS INTEGER) AS failure_no, greatest(count(*) OVER () - 2, 0) AS more
FROM ({FAILED}) QUALIFY row_number() OVER (ORDER BY check_no) <= 2""",
    USES,
    DOUBLES,
)
def first_failures(spark, sf_dir):
    return quality.first_failures(suite_results(spark, sf_dir), 2)


@query(
    "alert_text",
    f"""
SELECT concat('Records failed their checks. Night batch', chr(10),
              string_agg(concat(n, '. ', "check", ' on ', "column"), chr(10) ORDER BY n) FILTER (WHERE n <= 2),
              CASE WHEN count(*) > 2 THEN concat(chr(10), 'plus ', count(*) - 2, ' not listed') ELSE '' END)
         AS alert
FROM (SELECT *, row_number() OVER (ORDER BY check_no) AS n FROM ({FAILED}))""",
    USES,
)
def alert_text(spark, sf_dir):
    return quality.alert_text(suite_results(spark, sf_dir), "Night batch", 2)


def _drift_sql(current: str, reference: str, columns: tuple[str, ...]) -> str:
    """Histogram both sides by comparing each value with the bin edges."""
    sides = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v, {flag} AS cur FROM {side}"
        for c in columns
        for side, flag in ((current, 1), (reference, 0))
    )
    return f"""
SELECT "column", n_current, n_reference, CAST(n_reference - tr AS BIGINT) AS n_outside, CASE WHEN tr > 0 THEN kl END AS kl_divergence,
       CASE WHEN tr > 0 THEN kl > 0.1 ELSE true END AS drift_detected,
       CASE WHEN tr = 0 THEN 'no_overlap' WHEN kl > 0.1 THEN 'kl_above_threshold' ELSE 'ok' END AS reason
FROM (
  SELECT "column", any_value(n_current) AS n_current, any_value(n_reference) AS n_reference, any_value(tr) AS tr,
         sum(p / sp * ln((p / sp) / (q / sq))) AS kl
  FROM (
    SELECT *, sum(p) OVER (PARTITION BY "column") AS sp, sum(q) OVER (PARTITION BY "column") AS sq
    FROM (
      SELECT *, CASE WHEN c = 0 THEN 1e-10 ELSE c / (tc * width) END AS p,
                CASE WHEN r = 0 THEN 1e-10 ELSE r / (tr * width) END AS q
      FROM (
        SELECT *, sum(c) OVER (PARTITION BY "column") AS tc, sum(r) OVER (PARTITION BY "column") AS tr
        FROM (
          SELECT s."column", i, any_value(n_current) AS n_current, any_value(n_reference) AS n_reference,
                 any_value(width) AS width,
                 count(*) FILTER (WHERE cur = 1) AS c, count(*) FILTER (WHERE cur = 0) AS r
          FROM (SELECT *, (hi - lo) / 50 AS width FROM (
                  SELECT "column", count(*) FILTER (WHERE cur = 1) AS n_current,
                         count(*) FILTER (WHERE cur = 0) AS n_reference,
                         CASE WHEN min(v) FILTER (WHERE cur = 1) = max(v) FILTER (WHERE cur = 1)
                              THEN min(v) FILTER (WHERE cur = 1) - 0.5 ELSE min(v) FILTER (WHERE cur = 1) END AS lo,
                         CASE WHEN min(v) FILTER (WHERE cur = 1) = max(v) FILTER (WHERE cur = 1)
                              THEN max(v) FILTER (WHERE cur = 1) + 0.5 ELSE max(v) FILTER (WHERE cur = 1) END AS hi
                  FROM long GROUP BY 1) WHERE n_current > 100 AND n_reference > 100) s
          CROSS JOIN (SELECT unnest(range(50)) AS i)
          LEFT JOIN long l ON l."column" = s."column" AND l.v >= lo + i * width
               AND (l.v < lo + (i + 1) * width OR (i = 49 AND l.v <= hi))
          GROUP BY s."column", i))))
  GROUP BY "column")""".replace("FROM long GROUP", f"FROM ({sides}) GROUP").replace("LEFT JOIN long l", f"LEFT JOIN ({sides}) l")


LATE = "(SELECT * FROM dated WHERE call_date >= DATE '2024-01-16')"
EARLY = "(SELECT * FROM dated WHERE call_date < DATE '2024-01-16')"
DRIFT_COLUMNS = ("call_duration_seconds", "call_charge", "hour")
DRIFT = _drift_sql(LATE, EARLY, DRIFT_COLUMNS)
SHIFTED = _drift_sql(
    "(SELECT * REPLACE (call_charge + 1000000 AS call_charge, call_duration_seconds * 2 AS call_duration_seconds) FROM dated)",
    "dated",
    DRIFT_COLUMNS,
)


def _dated(spark, sf_dir):
    return clean.add_date_parts(clean.clean_cdr(fx.cdr(spark, sf_dir)))


def drift_frame(spark, sf_dir):
    records = _dated(spark, sf_dir)
    late, early = records.filter("call_date >= DATE '2024-01-16'"), records.filter("call_date < DATE '2024-01-16'")
    return drift.drift_report(late.select(*DRIFT_COLUMNS), early.select(*DRIFT_COLUMNS))


def shifted_frame(spark, sf_dir):
    records = _dated(spark, sf_dir).select(*DRIFT_COLUMNS)
    moved = records.withColumns(
        {
            "call_charge": F.col("call_charge") + 1000000,
            "call_duration_seconds": F.col("call_duration_seconds") * 2,
        }
    )
    return drift.drift_report(moved, records)


register("drift_report", drift_frame, sql(DRIFT, ("dated",), ("kl_divergence",)))
register("drift_report_shifted", shifted_frame, sql(SHIFTED, ("dated",), ("kl_divergence",)))


@query(
    "drift_detected",
    f"""
SELECT bool_or(drift_detected) AS drift_detected, count(*) FILTER (WHERE drift_detected) AS columns_drifted,
       count(*) AS columns_checked FROM ({SHIFTED})""",
    ("dated",),
)
def drift_any(spark, sf_dir):
    return drift.drift_detected(shifted_frame(spark, sf_dir))


@query(
    "drift_alert",
    f"""
SELECT "column", concat('values of ', "column", ' have moved: ',
       CASE WHEN kl_divergence IS NULL THEN reason ELSE format('divergence {{:.4f}}', kl_divergence) END) AS alert
FROM ({SHIFTED}) WHERE drift_detected""",
    ("dated",),
)
def drift_alert(spark, sf_dir):
    return drift.drift_alert(shifted_frame(spark, sf_dir))
