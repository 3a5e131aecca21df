"""Null rates by partition and by segment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablepulse import schemas as S
from tablepulse.functions.exprs import partition_key_details, str_map
from tablepulse.functions.partitioning import Partitioning, as_partitioning
from tablepulse.operators.results import metric_date_of, metric_rows, pass_severity, rule_rows


def null_counts_by_partition(
    df: DataFrame, table_name: str, partitioning: Partitioning | str | None, columns: Sequence[str]
) -> DataFrame:
    """Long form ``table_name, partition_value, column_name, record_count, null_count``.

    One aggregation pass for all columns (partial aggregation map-side), then
    an unpivot of the per-partition result.
    """
    p = as_partitioning(partitioning)
    key = p.key() if p is not None else F.lit(None).cast("string")
    aggs = [F.count(F.lit(1)).alias("record_count")] + [
        F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)
    ]
    per = df.groupBy(key.alias("_key")).agg(*aggs)
    per = per.withColumn("partition_value", p.text_of(F.col("_key")) if p is not None else F.col("_key"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count")) for i, c in enumerate(columns)])
    return per.select(F.lit(table_name).alias("table_name"), "partition_value", "record_count", F.inline(pairs))


def null_ratio_by_partition(
    df: DataFrame,
    table_name: str,
    partitioning: Partitioning | str | None,
    columns: Sequence[str],
    as_of: date | datetime | str | None = None,
) -> DataFrame:
    """Metric ``null_ratio`` = null_count / record_count per (partition, column)."""
    p = as_partitioning(partitioning)
    long = null_counts_by_partition(df, table_name, p, columns)
    return null_ratio_metrics(long, p.column if p is not None else None, as_of)


def null_ratio_metrics(
    long: DataFrame, partition_key: str | Mapping[str, str] | None = None, as_of: date | datetime | str | None = None
) -> DataFrame:
    """``null_ratio`` metrics from the long counts ``table_name, partition_value, record_count, column_name, null_count``."""
    details = str_map(
        column=F.col("column_name"),
        null_count=F.col("null_count").cast("string"),
        record_count=F.col("record_count").cast("string"),
        **({"partitionKey": partition_key} if isinstance(partition_key, str) else {}),
    )
    if isinstance(partition_key, Mapping):
        details = F.map_concat(details, partition_key_details(partition_key))
    return metric_rows(
        long,
        F.col("table_name"),
        F.col("partition_value"),
        metric_date_of(F.col("partition_value"), as_of),
        F.lit("null_ratio"),
        F.col("null_count") / F.col("record_count"),
        details,
    )


def _fmt_threshold(threshold: float) -> str:
    return repr(float(threshold))


def segment_null_rates(df: DataFrame, column: str, dims: Sequence[str]) -> DataFrame:
    """``dim, segment, rows, null_rows, null_rate`` for each present dim, in one grouping-sets pass.

    ``grouping()`` tells a real null segment from a rolled-up one. Dims not
    in the frame are skipped.
    """
    present = [d for d in dims if d in df.columns]
    if not present:
        return df.sparkSession.createDataFrame(
            [], "dim string, segment string, is_null_segment boolean, rows long, null_rows long, null_rate double"
        )
    g = df.groupingSets([[d] for d in present], *present).agg(
        *[F.grouping(d).alias(f"g_{i}") for i, d in enumerate(present)],
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(column).isNull()).alias("null_rows"),
    )
    dim = F.lit(None).cast("string")
    seg = F.lit(None).cast("string")
    for i, d in reversed(list(enumerate(present))):
        active = F.col(f"g_{i}") == 0
        dim = F.when(active, F.lit(d)).otherwise(dim)
        seg = F.when(active, F.col(d).cast("string")).otherwise(seg)
    return g.select(
        dim.alias("dim"),
        seg.alias("segment"),
        seg.isNull().alias("is_null_segment"),
        "rows",
        "null_rows",
        (F.col("null_rows") / F.col("rows")).alias("null_rate"),
    )


def segment_nulls(
    df: DataFrame,
    column: str,
    dims: Sequence[str] = tuple(S.SEGMENT_DIMS),
    threshold: float = S.NULL_RATE_THRESHOLD,
    table_name: str = "",
    ts: datetime | str | None = None,
) -> DataFrame:
    """Rule ``null_rate_<column>_by_<dim>`` per segment; passes when rate <= threshold."""
    rates = segment_null_rates(df, column, dims)
    ok = F.col("null_rate") <= F.lit(threshold)
    seg_text = F.coalesce(F.col("segment"), F.lit(S.NULL_SEGMENT))
    return rule_rows(
        rates,
        F.lit(table_name),
        F.lit(None),
        F.concat(F.lit(f"null_rate_{column}_by_"), F.col("dim")),
        ok,
        F.when(ok, 0.0).otherwise(F.col("null_rate")),
        F.col("rows"),
        pass_severity(ok),
        F.format_string("rate=%.4f", F.col("null_rate")),
        F.lit(f"<= {_fmt_threshold(threshold)}"),
        F.when(ok, F.array().cast("array<string>")).otherwise(F.array(seg_text)),
        ts=ts,
    )
