"""Structured Streaming landing that feeds the batch ingest operators."""
