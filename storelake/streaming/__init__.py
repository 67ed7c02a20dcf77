"""Continuous ingestion of changed rows."""
