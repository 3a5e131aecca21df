"""Builders for the stored result shapes (METRIC and RULE rows)."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepulse import schemas as S
from tablepulse.functions.exprs import empty_str_map, lit_date, lit_ts, parse_iso_date


def metric_date_of(partition: Column, as_of: date | datetime | str | None) -> Column:
    """The partition read as a yyyy-MM-dd date, else the run date."""
    return F.coalesce(parse_iso_date(partition), lit_date(as_of))


def metric_rows(
    df: DataFrame,
    table: Column,
    partition: Column,
    metric_date: Column,
    name: Column,
    value: Column,
    details: Column | None = None,
) -> DataFrame:
    return df.select(
        table.cast("string").alias("table_name"),
        partition.cast("string").alias("partition_value"),
        metric_date.cast("date").alias("metric_date"),
        name.cast("string").alias("metric_name"),
        value.cast("double").alias("metric_value"),
        (details if details is not None else empty_str_map()).cast("map<string,string>").alias("details"),
    )


def rule_rows(
    df: DataFrame,
    table: Column,
    partition: Column,
    rule_id: Column,
    passed: Column,
    fail_rate: Column,
    sampled_rows: Column,
    severity: Column,
    observed: Column,
    expected: Column,
    examples: Column | None = None,
    ts: datetime | str | None = None,
) -> DataFrame:
    return df.select(
        table.cast("string").alias("table_name"),
        partition.cast("string").alias("partition_value"),
        rule_id.cast("string").alias("rule_id"),
        passed.cast("boolean").alias("passed"),
        fail_rate.cast("double").alias("fail_rate"),
        sampled_rows.cast("long").alias("sampled_rows"),
        severity.cast("string").alias("severity"),
        observed.cast("string").alias("observed"),
        expected.cast("string").alias("expected"),
        (examples if examples is not None else F.array().cast("array<string>")).cast("array<string>").alias("examples"),
        lit_ts(ts).alias("ts"),
    )


def pass_severity(passed: Column) -> Column:
    return F.when(passed, F.lit(S.RESULT_PASS_SEVERITY)).otherwise(F.lit(S.RESULT_FAIL_SEVERITY))
