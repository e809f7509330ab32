"""Ingest-time cleaning as a Structured Streaming job."""
