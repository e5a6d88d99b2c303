"""Structured Streaming: ingestion, alert flow, windowed metrics."""
