"""Micro-batch ingest."""
