"""End-to-end jobs: ingest a day, build features, train, score."""
