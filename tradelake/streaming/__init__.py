"""Structured Streaming forms of ingest, dedup, candles and whale alerts."""
