"""Structured Streaming: decode, ingest, publish, reports."""
