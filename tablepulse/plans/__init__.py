"""Whole runs composed from the operators (profile modes, alert run, partition tables)."""
