"""Named queries over the test tables, each with its SQL counterpart where SQL can say it."""

from . import analytics, base, features, ingest, ml, quality, store, streams

MODULES = (ingest, features, store, quality, analytics, ml, streams)

QUERIES = base.QUERIES
ORACLES = base.ORACLES

__all__ = ["MODULES", "ORACLES", "QUERIES"]
