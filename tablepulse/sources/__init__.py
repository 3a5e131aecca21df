"""Inputs: table scans, partition statistics, snapshot history, readers, rule settings, saved cuts."""
