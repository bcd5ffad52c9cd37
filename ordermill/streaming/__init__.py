"""Structured Streaming ingestion and enrichment of order events."""
