"""Row-count change between partitions (day over day, week over week)."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablepulse.functions.exprs import change_ratio, newest_first, parse_iso_date, partition_key_details, partition_order, str_map
from tablepulse.operators.results import metric_date_of, metric_rows


def row_count_changes(
    stats: DataFrame,
    partition_key: str | Mapping[str, str] | None = None,
    last: int | None = None,
    direction: str = "previous",
    as_of: date | datetime | str | None = None,
    steps: tuple[int, int] = (1, 7),
) -> DataFrame:
    """``row_count_dod_delta`` (1 partition back) and ``row_count_wow_delta`` (7 back).

    Partitions are ordered by value within each table, numbers as numbers (statistics
    are one row per partition, so each window holds one table's partition list). Only the
    newest ``last`` partitions report (all by default), after the lag is taken.
    ``direction="next"`` compares with the following partition instead.
    Rows without a partition value are no partition: they are left out of the
    comparison and reported as ``null_partition_row_count``.
    """
    if direction not in ("previous", "next"):
        raise ValueError("direction must be 'previous' or 'next'")
    value = F.col("partition_value")
    w = Window.partitionBy("table_name").orderBy(*(partition_order(value) if direction == "previous" else newest_first(value)))
    newest = Window.partitionBy("table_name").orderBy(*newest_first(value))
    rc = F.col("record_count").cast("double")
    s1, s7 = steps
    x = stats.where(F.col("partition_value").isNotNull()).select(
        "table_name",
        "partition_value",
        rc.alias("rc"),
        F.lag(rc, s1).over(w).alias("prev1"),
        F.lag(rc, s7).over(w).alias("prev7"),
        F.row_number().over(newest).alias("age_rank"),
    )
    if last is not None:
        x = x.where(F.col("age_rank") <= last)
    pairs = F.array(
        F.struct(F.lit("row_count_dod_delta").alias("n"), change_ratio(F.col("rc"), F.col("prev1")).alias("v")),
        F.struct(F.lit("row_count_wow_delta").alias("n"), change_ratio(F.col("rc"), F.col("prev7")).alias("v")),
    )
    long = x.select("table_name", "partition_value", F.inline(pairs)).where(F.col("v").isNotNull())
    lost = stats.where(F.col("partition_value").isNull() & (rc > 0))
    long = long.unionByName(lost.select("table_name", "partition_value", F.lit("null_partition_row_count").alias("n"), rc.alias("v")))
    if isinstance(partition_key, Mapping):
        details = partition_key_details(partition_key)
    else:
        details = str_map(partitionKey=partition_key) if partition_key else None
    return metric_rows(
        long,
        F.col("table_name"),
        F.col("partition_value"),
        metric_date_of(F.col("partition_value"), as_of),
        F.col("n"),
        F.col("v"),
        details,
    )


def row_count_change_by_date(
    stats: DataFrame,
    days: int = 7,
    partition_key: str | None = None,
    name: str | None = None,
) -> DataFrame:
    """Change against the partition exactly ``days`` calendar days earlier (gaps give no row).

    Day partitions only: the earlier partition is found by an equi-join on
    ``date_sub(day, days)``, so missing days never shift the comparison.
    """
    cur = stats.select("table_name", "partition_value", F.col("record_count").cast("double").alias("rc")).withColumn(
        "prev_value", F.date_format(F.date_sub(parse_iso_date(F.col("partition_value")), days), "yyyy-MM-dd")
    )
    prev = stats.select(
        "table_name", F.col("partition_value").alias("prev_value"), F.col("record_count").cast("double").alias("prev")
    )
    j = cur.join(prev, ["table_name", "prev_value"], "inner")
    metric = name or ("row_count_wow_delta" if days == 7 else "row_count_dod_delta" if days == 1 else f"row_count_{days}d_delta")
    details = str_map(partitionKey=partition_key) if partition_key else None
    return metric_rows(
        j,
        F.col("table_name"),
        F.col("partition_value"),
        parse_iso_date(F.col("partition_value")),
        F.lit(metric),
        change_ratio(F.col("rc"), F.col("prev")),
        details,
    )
