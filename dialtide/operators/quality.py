"""Data-quality checks on call records, all evaluated by one aggregate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import CALL_RESULTS, CALL_TYPES, NETWORK_TYPES

EXISTS = "expect_column_to_exist"
OF_TYPE = "expect_column_values_to_be_of_type"
NOT_NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
ROW_COUNT = "expect_table_row_count_to_be_between"


@dataclass(frozen=True)
class Check:
    """One expectation; ``mostly`` is the share of rows that must meet it."""

    kind: str
    column: str | None = None
    mostly: float = 1.0
    low: float | None = None
    high: float | None = None
    values: tuple[str, ...] = ()
    type_name: str | None = None


# The expectations every batch of call records must meet.
CDR_SUITE = [
    *[
        Check(EXISTS, c)
        for c in (
            "call_id",
            "customer_id",
            "call_time",
            "call_duration_seconds",
            "call_type",
            "destination_number",
            "network_type",
            "call_result",
            "call_charge",
        )
    ],
    Check(OF_TYPE, "call_id", type_name="string"),
    Check(OF_TYPE, "customer_id", type_name="string"),
    Check(OF_TYPE, "call_time", type_name="timestamp"),
    Check(OF_TYPE, "call_duration_seconds", type_name="int"),
    Check(OF_TYPE, "call_charge", type_name="float"),
    Check(NOT_NULL, "call_id"),
    Check(NOT_NULL, "customer_id"),
    Check(NOT_NULL, "call_time"),
    Check(NOT_NULL, "call_duration_seconds", 0.95),
    Check(NOT_NULL, "call_type", 0.95),
    Check(NOT_NULL, "call_result", 0.95),
    Check(NOT_NULL, "call_charge", 0.95),
    Check(BETWEEN, "call_duration_seconds", 0.99, 0, 7200),
    Check(BETWEEN, "call_charge", 0.99, 0, 100),
    Check(IN_SET, "call_type", 0.99, values=tuple(CALL_TYPES)),
    Check(IN_SET, "network_type", 0.99, values=tuple(NETWORK_TYPES)),
    Check(IN_SET, "call_result", 0.99, values=tuple(CALL_RESULTS)),
    Check(ROW_COUNT, None, low=1),
]


def _evaluate(check: Check, df: DataFrame) -> tuple[Column, Column]:
    """(observed, success) of one check as aggregate expressions."""
    rows = F.count(F.lit(1))
    if check.kind == ROW_COUNT:
        ok = F.lit(True)
        for bound, holds in ((check.low, rows >= check.low), (check.high, rows <= check.high)):
            ok = ok if bound is None else ok & holds
        return rows.cast("double"), ok
    present = check.column in df.columns
    if check.kind == EXISTS:
        return F.lit(float(present)), F.lit(present)
    if not present:
        return F.lit(None).cast("double"), F.lit(False)
    if check.kind == OF_TYPE:
        same = df.schema[check.column].dataType.simpleString() == check.type_name
        return F.lit(float(same)), F.lit(same)
    column = F.col(check.column)
    if check.kind == NOT_NULL:
        share = F.count(column) / F.nullif(rows, F.lit(0))
    else:
        ok = column.between(check.low, check.high) if check.kind == BETWEEN else column.isin(*check.values)
        share = F.count_if(ok) / F.nullif(F.count(column), F.lit(0))
    return share, F.coalesce(share >= check.mostly, F.lit(True))


def run_suite(df: DataFrame, suite: list[Check] | None = None, by: list[str] | None = None) -> DataFrame:
    """One row per check (and batch): check_no, check, column, observed, threshold, success.

    ``by`` names the columns that tell batches apart. All row-level checks share
    one aggregate, whatever their number. Shares leave nulls out, except for the
    not-null checks; a check without any row to look at passes.
    """
    suite = CDR_SUITE if suite is None else suite
    results = []
    for number, check in enumerate(suite, 1):
        observed, success = _evaluate(check, df)
        results.append(
            F.struct(
                F.lit(number).alias("check_no"),
                F.lit(check.kind).alias("check"),
                F.lit(check.column).cast("string").alias("column"),
                observed.cast("double").alias("observed"),
                F.lit(check.mostly).alias("threshold"),
                success.alias("success"),
            )
        )
    by = by or []
    return df.groupBy(*by).agg(F.array(*results).alias("results")).select(*by, F.inline("results"))


def failed_checks(results: DataFrame) -> DataFrame:
    """The checks that did not hold, with their details as text."""
    details = F.format_string("observed %.4f, required %.4f", "observed", "threshold")
    return results.filter(~F.col("success")).withColumn("details", details)


def first_failures(results: DataFrame, n: int = 5, by: list[str] | None = None) -> DataFrame:
    """Up to ``n`` failures per batch, numbered, and how ``more`` there are.

    The windows see one batch's failed checks: never more rows than the suite has.
    """
    batch = Window.partitionBy(*(by or [F.lit(0)]))
    return (
        failed_checks(results)
        .withColumn("failure_no", F.row_number().over(batch.orderBy("check_no")))
        .withColumn("more", F.greatest(F.count(F.lit(1)).over(batch) - n, F.lit(0)))
        .filter(F.col("failure_no") <= n)
    )


def alert_text(results: DataFrame, message: str, n: int = 5, by: list[str] | None = None) -> DataFrame:
    """The alert of each failed batch as one text; batches that passed have none."""
    shown = first_failures(results, n, by).withColumn(
        "line",
        F.format_string("%d. %s on %s", "failure_no", "check", F.coalesce("column", F.lit("the table"))),
    )
    lines = F.array_sort(F.collect_list(F.struct("failure_no", "line")))
    body = F.array_join(F.transform(lines, lambda x: x["line"]), "\n")
    tail = F.when(F.max("more") > 0, F.format_string("\nplus %d not listed", F.max("more"))).otherwise("")
    text = F.concat(F.lit(f"Records failed their checks. {message}\n"), body, tail)
    grouped = shown.groupBy(*(by or [])).agg(text.alias("alert"), F.count(F.lit(1)).alias("shown"))
    return grouped.filter("shown > 0").drop("shown")


def quality_gate(results: DataFrame) -> DataFrame:
    """One row: number of checks, number failed, and whether all passed.

    Without any check, as for an empty input told apart by batch, nothing passed.
    """
    return results.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("success")).alias("failed"),
        F.coalesce(F.every("success"), F.lit(False)).alias("passed"),
    )


class QualityError(RuntimeError):
    """Raised by :func:`require_gate` when a check failed."""


def require_gate(results: DataFrame) -> None:
    """Stop the job unless every check of every batch passed."""
    gate = quality_gate(results).first()
    if not gate["passed"]:
        raise QualityError(f"{gate['failed']} of {gate['checks']} data-quality checks failed")
