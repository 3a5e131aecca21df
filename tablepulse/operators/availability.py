"""Partition availability and table freshness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepulse import schemas as S
from tablepulse.functions.exprs import lit_date, lit_ts, partition_key_details, str_map
from tablepulse.functions.joins import bounded_broadcast
from tablepulse.operators.results import metric_rows, rule_rows
from tablepulse.sources.stats import latest_snapshot


def expected_partitions(spark: SparkSession, expected: Mapping[str, Sequence[str]]) -> DataFrame:
    """``table_name, partition_value`` rows from a driver-side mapping table -> expected values."""
    rows = [(t, p) for t, ps in expected.items() for p in ps]
    return spark.createDataFrame(rows, "table_name string, partition_value string")


def partition_counts(stats: DataFrame, expected: DataFrame, expected_rows: int | None = None) -> DataFrame:
    """Record count of every expected partition; missing partitions count 0.

    The expected list is the small, known side: the statistics stream past it
    (a semi-join with the list broadcast), and what is left of them, a row per
    expected partition at most, is looked up by the list.
    """
    keys = ["table_name", "partition_value"]
    exp = expected.select(*keys).distinct()
    found = bounded_broadcast(stats.join(bounded_broadcast(exp, expected_rows), keys, "left_semi"), expected_rows)
    return exp.join(found, keys, "left").select(
        "table_name", "partition_value", F.coalesce(F.col("record_count"), F.lit(0)).cast("long").alias("record_count")
    )


def availability_metrics(
    counts: DataFrame, partition_key: str | Mapping[str, str] | None = None, as_of: date | datetime | str | None = None
) -> DataFrame:
    """Two metrics per expected partition: ``partition_row_count`` and ``partition_exists``."""
    pairs = F.array(
        F.struct(F.lit("partition_row_count").alias("n"), F.col("record_count").cast("double").alias("v")),
        F.struct(F.lit("partition_exists").alias("n"), F.when(F.col("record_count") > 0, 1.0).otherwise(0.0).alias("v")),
    )
    long = counts.select("table_name", "partition_value", F.inline(pairs))
    if isinstance(partition_key, Mapping):
        details = partition_key_details(partition_key)
    else:
        details = str_map(partitionKey=partition_key) if partition_key else None
    return metric_rows(
        long, F.col("table_name"), F.col("partition_value"), lit_date(as_of), F.col("n"), F.col("v"), details
    )


def availability_rules(counts: DataFrame, ts: datetime | str | None = None) -> DataFrame:
    """A failed ``availability`` rule for each expected partition with no rows."""
    failed = counts.where(F.col("record_count") <= 0)
    return rule_rows(
        failed,
        F.col("table_name"),
        F.col("partition_value"),
        F.lit("availability"),
        F.lit(False),
        F.lit(1.0),
        F.col("record_count"),
        F.lit(S.RESULT_FAIL_SEVERITY),
        F.lit("record_count<=0"),
        F.lit("record_count>0"),
        ts=ts,
    )


def hours_between(start: Column, end: Column) -> Column:
    """Whole elapsed hours from ``start`` to ``end``, truncated toward zero.

    Counted on the instants (epoch microseconds), so daylight-saving changes
    of the session time zone never add or remove an hour.
    """
    return ((F.unix_micros(end) - F.unix_micros(start)) / 3_600_000_000).cast("long")


def snapshot_age(latest: DataFrame, as_of: datetime | str | None) -> DataFrame:
    """``table_name, made_current_at, age_hours`` (whole hours, truncated)."""
    return latest.select(
        "table_name",
        "made_current_at",
        hours_between(F.col("made_current_at").cast("timestamp"), lit_ts(as_of)).alias("age_hours"),
    )


def freshness_metrics(history: DataFrame, as_of: datetime | str | None) -> DataFrame:
    """``snapshot_age_hours`` of the newest snapshot per table with history."""
    aged = snapshot_age(latest_snapshot(history), as_of)
    return metric_rows(
        aged, F.col("table_name"), F.lit(None), lit_date(as_of), F.lit("snapshot_age_hours"), F.col("age_hours")
    )


def freshness_rules(
    tables: DataFrame,
    history: DataFrame,
    as_of: datetime | str | None,
    sla_hours: int = S.SLA_HOURS,
    ts: datetime | str | None = None,
    tables_rows: int | None = None,
) -> DataFrame:
    """Failed ``freshness`` rules: no history at all, or the newest snapshot's age above the SLA (strict)."""
    t = tables.select("table_name").distinct()
    known = history.join(bounded_broadcast(t, tables_rows), "table_name", "left_semi")
    aged = bounded_broadcast(snapshot_age(latest_snapshot(known), as_of), tables_rows)
    j = t.join(aged, "table_name", "left")
    no_hist = F.col("made_current_at").isNull()
    failed = j.where(no_hist | (F.col("age_hours") > F.lit(sla_hours)))
    return rule_rows(
        failed,
        F.col("table_name"),
        F.lit(None),
        F.lit("freshness"),
        F.lit(False),
        F.lit(1.0),
        F.when(no_hist, 0).otherwise(1),
        F.lit(S.RESULT_FAIL_SEVERITY),
        F.when(no_hist, F.lit("no_history")).otherwise(F.concat(F.lit("ageHours="), F.col("age_hours").cast("string"))),
        F.when(no_hist, F.lit("recent_snapshot")).otherwise(F.lit(f"<= {sla_hours}")),
        ts=ts,
    )


def table_list(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(t,) for t in tables], "table_name string")
