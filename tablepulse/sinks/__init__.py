"""Outputs: stored tables, newline-delimited JSON, schema-evolving table writes."""
