"""Structured Streaming versions of ingestion, monitoring, drift, features and scoring."""
