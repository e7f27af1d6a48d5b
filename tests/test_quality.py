import numpy as np
import pytest
from helpers import calls, plan_text

from dialtide.operators import drift
from dialtide.operators.quality import (
    CDR_SUITE,
    Check,
    QualityError,
    alert_text,
    failed_checks,
    first_failures,
    quality_gate,
    require_gate,
    run_suite,
)


def test_suite_has_every_expectation():
    kinds = [c.kind for c in CDR_SUITE]
    assert len(kinds) == 27
    assert [kinds.count(k) for k in dict.fromkeys(kinds)] == [9, 5, 7, 2, 3, 1]


def test_clean_batch_passes(spark):
    results = run_suite(calls(spark, {}, {}))
    assert quality_gate(results).first().asDict() == {"checks": 27, "failed": 0, "passed": True}
    require_gate(results)


def test_one_scan_and_one_aggregate(spark):
    plan = plan_text(run_suite(calls(spark, {})))
    assert plan.count("Scan") == 1 and plan.count("Exchange") == 1


def test_mostly_is_inclusive_and_ignores_nulls(spark):
    rows = [{"network_type": "4G"}] * 99 + [{"network_type": "SAT"}] + [{"network_type": None}] * 50
    check = [c for c in CDR_SUITE if c.column == "network_type" and c.values]
    assert run_suite(calls(spark, *rows), check).first()["success"] is True
    assert run_suite(calls(spark, *rows, {"network_type": "SAT"}), check).first()["success"] is False


def test_bounds_are_inclusive(spark):
    check = [Check("expect_column_values_to_be_between", "call_duration_seconds", 1.0, 0, 7200)]
    assert run_suite(calls(spark, {"call_duration_seconds": 0}, {"call_duration_seconds": 7200}), check).first()["success"]
    assert not run_suite(calls(spark, {"call_duration_seconds": 7201}), check).first()["success"]


def test_missing_column_fails_its_checks_only(spark):
    failed = failed_checks(run_suite(calls(spark, {}).drop("call_charge")))
    assert {r["column"] for r in failed.collect()} == {"call_charge"} and failed.count() == 4


def test_empty_batch_fails_the_row_count_only(spark):
    failed = failed_checks(run_suite(calls(spark, {}).filter("false"))).collect()
    assert [r["check"] for r in failed] == ["expect_table_row_count_to_be_between"]


def test_every_batch_must_pass(spark):
    df = calls(spark, {"cell_tower_id": "a"}, {"cell_tower_id": "b", "call_type": "FAX"})
    results = run_suite(df, by=["cell_tower_id"])
    assert results.count() == 54
    assert {r["cell_tower_id"] for r in failed_checks(results).collect()} == {"b"}
    with pytest.raises(QualityError):
        require_gate(results)


def test_alert_shows_five_and_counts_the_rest(spark):
    bad = calls(spark, {}).select("call_id")
    results = run_suite(bad)
    n = failed_checks(results).count()
    shown = first_failures(results).collect()
    assert len(shown) == 5 and {r["more"] for r in shown} == {n - 5}
    text = alert_text(results, "daily run").first()["alert"]
    assert len(text.splitlines()) == 7 and text.endswith(f"plus {n - 5} not listed")
    assert alert_text(run_suite(calls(spark, {})), "daily run").count() == 0


# ------------------------------------------------------------------ drift


def expected_kl(current, reference):
    p, edges = np.histogram(current, bins=50, density=True)
    q, _ = np.histogram(reference, bins=edges, density=True)
    p, q = np.where(p == 0, 1e-10, p), np.where(q == 0, 1e-10, q)
    p, q = p / p.sum(), q / q.sum()
    return float(np.sum(p * np.log(p / q)))


def report(spark, current, reference):
    def frame(values):
        return spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")

    return drift.drift_report(frame(current), frame(reference)).collect()


RNG = np.random.default_rng(0)


@pytest.mark.parametrize(
    "current,reference",
    [
        (RNG.normal(size=500), RNG.normal(size=700)),
        (RNG.normal(size=500), RNG.normal(1, 2, size=700)),
        (RNG.integers(0, 50, 500).astype(float), RNG.integers(0, 50, 400).astype(float)),
        (np.arange(101) / 100.0, np.arange(202) / 201.0),
        (np.full(150, 3.0), np.concatenate([np.full(150, 3.0), np.full(20, 9.0)])),
    ],
)
def test_drift_equals_numpy(spark, current, reference):
    (got,) = report(spark, current, reference)
    assert got["kl_divergence"] == pytest.approx(expected_kl(current, reference), abs=1e-9)
    assert got["drift_detected"] is (got["kl_divergence"] > 0.1)


def test_no_overlap_is_drift(spark):
    (got,) = report(spark, RNG.normal(size=200), RNG.normal(size=200) + 1e6)
    assert (got["kl_divergence"], got["drift_detected"], got["reason"]) == (None, True, "no_overlap")


def test_nulls_and_nans_do_not_count(spark):
    values = list(RNG.normal(size=101))
    (got,) = report(spark, [*values, None, float("nan")], values)
    assert (got["n_current"], got["n_reference"]) == (101, 101) and got["kl_divergence"] == pytest.approx(0, abs=1e-9)


def test_columns_with_few_values_are_reported(spark):
    for current in (RNG.normal(size=100), [None] * 200):
        (got,) = report(spark, current, RNG.normal(size=500))
        assert (got["reason"], got["drift_detected"], got["kl_divergence"]) == ("too_few_values", False, None)


def test_reference_values_outside_are_counted(spark):
    (got,) = report(spark, np.arange(200.0), np.concatenate([np.arange(150.0), np.full(7, 1e9)]))
    assert got["n_outside"] == 7


def test_a_gate_without_checks_does_not_pass(spark):
    empty = calls(spark, {}).limit(0)
    assert quality_gate(run_suite(empty, by=["call_id"])).first()["passed"] is False
    assert quality_gate(run_suite(empty)).first()["passed"] is False


def test_no_upper_bound_on_rows(spark):
    from dialtide.operators.quality import CDR_SUITE

    assert [c.high for c in CDR_SUITE if c.low == 1] == [None]


def test_only_shared_numeric_columns(spark):
    left = spark.range(200).selectExpr("id AS a", "id AS b", "string(id) AS s")
    right = spark.range(200).selectExpr("id AS a", "id AS c", "string(id) AS s")
    got = drift.drift_report(left, right)
    assert [r["column"] for r in got.collect()] == ["a"]
    assert drift.drift_detected(got).first()["drift_detected"] is False
    assert drift.drift_alert(got).count() == 0
