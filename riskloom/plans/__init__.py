"""End-to-end jobs: ingest, transform, train, score, publish."""
