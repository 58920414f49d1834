"""Incremental ingestion of landed files."""

from quarterdeck.streaming.ingest import ingest_available, upsert_available

__all__ = ["ingest_available", "upsert_available"]
