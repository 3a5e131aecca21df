"""Incremental profiling of data as it lands (Structured Streaming)."""
