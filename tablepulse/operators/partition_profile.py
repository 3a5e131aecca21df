"""One aggregation per table that feeds several checks.

Row counts, null counts and averages per partition, and the newest value of
a time column, all come from the same ``groupBy(partition)``: the table is
scanned once (only the needed columns are read) and the shuffle carries one
partial row per (task, partition value). Availability, row-count change,
null ratio, average change and freshness are then derived from this small
frame, which Spark computes once per plan (exchange reuse).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablepulse.functions.exprs import as_instant, nan_to_null
from tablepulse.functions.partitioning import Partitioning, as_partitioning


def partition_profile(
    df: DataFrame,
    table_name: str,
    partitioning: Partitioning | str,
    null_columns: Sequence[str] = (),
    average_columns: Sequence[str] = (),
    time_column: str | None = None,
) -> DataFrame:
    """Wide frame: ``table_name, partition_value, record_count, n<i>`` (nulls), ``a<i>`` (averages), ``max_ts``."""
    p = as_partitioning(partitioning)
    aggs = [F.count(F.lit(1)).alias("record_count")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(null_columns)]
    aggs += [F.avg(nan_to_null(F.col(c))).alias(f"a{i}") for i, c in enumerate(average_columns)]
    if time_column:
        aggs.append(F.max(F.col(time_column)).alias("max_ts"))
    per = df.groupBy(p.key().alias("_key")).agg(*aggs)
    return per.select(p.text_of(F.col("_key")).alias("partition_value"), *per.columns[1:], F.lit(table_name).alias("table_name"))


def stats_of(pp: DataFrame) -> DataFrame:
    return pp.select("table_name", "partition_value", "record_count")


def normalized_profile(
    pp: DataFrame, null_columns: Sequence[str] = (), average_columns: Sequence[str] = (), has_time: bool = False
) -> DataFrame:
    """One shape for every table, so several tables' aggregates can be unioned (and checkpointed) together.

    ``table_name, partition_value, record_count, nulls map<column, count>,
    averages map<column, avg>, max_ts`` (an instant; zone-less times as UTC).
    """
    nulls = (
        F.map_from_arrays(F.array(*[F.lit(c) for c in null_columns]), F.array(*[F.col(f"n{i}") for i in range(len(null_columns))]))
        if null_columns
        else F.create_map()
    )
    avgs = (
        F.map_from_arrays(
            F.array(*[F.lit(c) for c in average_columns]), F.array(*[F.col(f"a{i}") for i in range(len(average_columns))])
        )
        if average_columns
        else F.create_map()
    )
    ts = as_instant(F.col("max_ts"), pp.schema["max_ts"].dataType) if has_time else F.lit(None).cast("timestamp")
    return pp.select(
        "table_name",
        "partition_value",
        "record_count",
        nulls.cast("map<string,bigint>").alias("nulls"),
        avgs.cast("map<string,double>").alias("averages"),
        ts.alias("max_ts"),
    )


def null_counts_of_normalized(pn: DataFrame) -> DataFrame:
    return pn.select("table_name", "partition_value", "record_count", F.explode("nulls").alias("column_name", "null_count"))


def averages_of_normalized(pn: DataFrame) -> DataFrame:
    return pn.select(
        "table_name", "partition_value", F.col("record_count").alias("rows"), F.explode("averages").alias("column_name", "average")
    )


def history_of_normalized(pn: DataFrame) -> DataFrame:
    return pn.groupBy("table_name").agg(F.max("max_ts").alias("made_current_at"))
