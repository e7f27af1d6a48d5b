"""Column functions: no DataFrame, no session, no Python on the executors."""

from .calls import (
    call_date_parts,
    created_timestamp,
    is_international,
    is_promo,
    month_index,
    peak_flag,
    weekend_flag,
)
from .churn import churn_segment, gauge_band, risk_level, segment_rank, tenure_band, threshold_prediction
from .hashing import hash_bucket, hash_normal, hash_uniform, normals_of, stable_order

__all__ = [
    "call_date_parts",
    "churn_segment",
    "created_timestamp",
    "gauge_band",
    "hash_bucket",
    "hash_normal",
    "hash_uniform",
    "is_international",
    "is_promo",
    "month_index",
    "normals_of",
    "peak_flag",
    "risk_level",
    "segment_rank",
    "stable_order",
    "tenure_band",
    "threshold_prediction",
    "weekend_flag",
]
