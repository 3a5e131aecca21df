"""Average of each column per partition and its change against the previous partition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablepulse.functions.exprs import change_ratio, nan_to_null, newest_first, partition_key_details, partition_order, str_map
from tablepulse.functions.partitioning import Partitioning, as_partitioning
from tablepulse.operators.results import metric_date_of, metric_rows


def partition_averages(
    df: DataFrame, table_name: str, partitioning: Partitioning | str, columns: Sequence[str]
) -> DataFrame:
    """Long form ``table_name, partition_value, column_name, average, rows`` (one aggregation pass; NaN counts as null)."""
    p = as_partitioning(partitioning)
    aggs = [F.count(F.lit(1)).alias("rows")] + [F.avg(nan_to_null(F.col(c))).alias(f"a{i}") for i, c in enumerate(columns)]
    per = df.groupBy(p.key().alias("_key")).agg(*aggs).withColumn("partition_value", p.text_of(F.col("_key")))
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"a{i}").alias("average")) for i, c in enumerate(columns)])
    return per.select(F.lit(table_name).alias("table_name"), "partition_value", "rows", F.inline(pairs))


def average_change(
    df: DataFrame,
    table_name: str,
    partitioning: Partitioning | str,
    columns: Sequence[str],
    as_of: date | datetime | str | None = None,
    last: int | None = None,
) -> DataFrame:
    """Metric ``average_change`` = (avg - previous avg) / previous avg per (partition, column).

    The previous average is that of the last preceding partition in which the
    column has a value; an average of 0 there gives 0.0 and the first partition
    gives no row. A partition without any value gives ``average_missing`` = 1.
    """
    p = as_partitioning(partitioning)
    return average_change_metrics(partition_averages(df, table_name, p, columns), p.column, as_of, last)


def average_change_metrics(
    avgs: DataFrame, partition_key: str | Mapping[str, str] | None = None, as_of: date | datetime | str | None = None, last: int | None = None
) -> DataFrame:
    """``average_change`` metrics from ``table_name, partition_value, column_name, average`` rows.

    The window holds one column's partition list (one row per partition).
    """
    value = F.col("partition_value")
    per_column = Window.partitionBy("table_name", "column_name")
    before = per_column.orderBy(*partition_order(value)).rowsBetween(Window.unboundedPreceding, -1)
    # rows without a partition value are no partition to compare with
    x = avgs.where(value.isNotNull()).withColumn("prev", F.last("average", ignorenulls=True).over(before))
    if last is not None:
        x = x.withColumn("_r", F.row_number().over(per_column.orderBy(*newest_first(value)))).where(F.col("_r") <= last)
    missing = F.col("average").isNull()
    x = x.where(missing | F.col("prev").isNotNull())
    details = str_map(
        column=F.col("column_name"),
        average=F.col("average").cast("string"),
        previous_average=F.col("prev").cast("string"),
        **({"partitionKey": partition_key} if isinstance(partition_key, str) else {}),
    )
    if isinstance(partition_key, Mapping):
        details = F.map_concat(details, partition_key_details(partition_key))
    return metric_rows(
        x,
        F.col("table_name"),
        F.col("partition_value"),
        metric_date_of(F.col("partition_value"), as_of),
        F.when(missing, F.lit("average_missing")).otherwise(F.lit("average_change")),
        F.when(missing, F.lit(1.0)).otherwise(change_ratio(F.col("average"), F.col("prev"))),
        details,
    )
