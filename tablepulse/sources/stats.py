"""Partition statistics and snapshot history as DataFrames.

A catalog may already keep these (a ``$partitions`` / ``$history`` metadata
table); :func:`stats_from_metadata` normalises such a table. For plain
tables they are derived with one aggregation: partial counts are combined
map-side, so the shuffle carries one row per (task, partition value) no
matter how skewed the partitions are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepulse.functions.exprs import as_instant
from tablepulse.functions.partitioning import Partitioning, as_partitioning


def partition_stats(df: DataFrame, table_name: str, partitioning: Partitioning | str) -> DataFrame:
    """``table_name, partition_value, record_count`` counted from the rows."""
    p = as_partitioning(partitioning)
    counted = df.groupBy(p.key().alias("_key")).agg(F.count(F.lit(1)).alias("record_count"))
    return counted.select(F.lit(table_name).alias("table_name"), p.text_of(F.col("_key")).alias("partition_value"), "record_count")


def stats_from_metadata(meta: DataFrame, table_name: str, key: str, count_col: str = "record_count") -> DataFrame:
    """Normalise a partitions metadata table: sum counts per key value, null counts as 0."""
    return meta.groupBy(F.col(key).cast("string").alias("partition_value")).agg(
        F.coalesce(F.sum(F.col(count_col).cast("long")), F.lit(0)).cast("long").alias("record_count")
    ).select(F.lit(table_name).alias("table_name"), "partition_value", "record_count")


def history_from_column(df: DataFrame, table_name: str, ts_col: str | Column) -> DataFrame:
    """Newest change of a table taken from a timestamp column of its rows (zone-less times read as UTC)."""
    c = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    newest = df.agg(F.max(c).alias("m"))
    return newest.select(F.lit(table_name).alias("table_name"), as_instant(F.col("m"), newest.schema["m"].dataType).alias("made_current_at"))


def history_from_files(df: DataFrame, table_name: str) -> DataFrame:
    """Newest data-file modification time of a file-based table (hidden ``_metadata`` column)."""
    return history_from_column(df.select("_metadata.file_modification_time"), table_name, "file_modification_time")


def latest_snapshot(history: DataFrame) -> DataFrame:
    """``table_name, made_current_at`` of the newest snapshot per table."""
    return history.groupBy("table_name").agg(F.max(F.col("made_current_at").cast("timestamp")).alias("made_current_at"))
