"""Structured Streaming versions of ingest and features."""

from .day_state import add_batch, late_records, read_day_features, stream_day_state, stream_progress
from .streams import (
    push_latest,
    read_pushed,
    run_available,
    stream_clean,
    stream_daily_features,
    stream_dedupe,
    stream_ingest,
)

__all__ = [
    "add_batch",
    "late_records",
    "push_latest",
    "read_day_features",
    "read_pushed",
    "run_available",
    "stream_clean",
    "stream_daily_features",
    "stream_day_state",
    "stream_dedupe",
    "stream_ingest",
    "stream_progress",
]
