"""Message ingest and its audits."""
