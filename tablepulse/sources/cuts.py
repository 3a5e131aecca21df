"""Newest saved quantile cuts per (table, column, partition)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_cuts(saved: DataFrame) -> DataFrame:
    """One row per (table_name, column_name, partition_value): the cuts with the newest ``created_at``."""
    return saved.groupBy("table_name", "column_name", "partition_value").agg(
        F.max_by("cuts", "created_at").alias("cuts"), F.max("created_at").alias("created_at")
    )
