"""Profiling operators: DataFrame in, DataFrame out, built-in expressions only."""
