"""Scoring bands and rule-based churn segments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEGMENTS = ["Low Risk", "Medium Risk", "High Risk"]


def threshold_prediction(probability: Column, threshold: float = 0.5) -> Column:
    """True from the threshold upward."""
    return probability >= threshold


def risk_level(probability: Column) -> Column:
    """Low below 0.3, Medium below 0.7, else High; null → null."""
    return (
        F.when(probability < 0.3, "Low Risk")
        .when(probability < 0.7, "Medium Risk")
        .when(probability.isNotNull(), "High Risk")
    )


def gauge_band(percent: Column) -> Column:
    """:func:`risk_level` on a 0–100 scale."""
    return risk_level(percent / 100)


def churn_segment(cust_serv_calls: Column, day_mins: Column, data_plan: Column, account_weeks: Column) -> Column:
    """Rule-based segment of a customer; anything undecided is Medium.

    The low and high rules exclude each other (they need ≤ 1 and ≥ 4 service
    calls, or a data plan and none), so their order does not matter.
    """
    high = (cust_serv_calls >= 4) | ((day_mins > 250) & (data_plan == 0))
    low = (account_weeks > 100) & (cust_serv_calls <= 1) & (data_plan == 1)
    return F.when(low, "Low Risk").when(high, "High Risk").otherwise("Medium Risk")


def segment_rank(segment: Column) -> Column:
    """Low 0, Medium 1, High 2."""
    return F.array_position(F.array(*map(F.lit, SEGMENTS)), segment) - 1


def tenure_band(account_weeks: Column) -> Column:
    """``new`` up to 52 weeks, ``old`` after."""
    return F.when(account_weeks <= 52, "new").when(account_weeks > 52, "old")
