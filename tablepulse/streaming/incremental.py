"""Partition statistics kept current while files arrive.

The same per-partition aggregate as a batch run (row count, null counts,
averages as sum/count, newest time value) runs as a streaming aggregation:
the state store holds one row per partition value, so state grows with the
number of partitions, not with rows. Each micro-batch emits the partitions
it changed (``update`` mode) and ``foreachBatch`` replaces exactly those
partitions in a table partitioned by ``table_name, partition_value`` (dynamic
partition overwrite stored on the table), so several tables can share it. The stream's checkpoint makes restarts
exactly-once; the batch checks then read the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablepulse.functions.partitioning import Partitioning, as_partitioning
from tablepulse.sinks.writer import write_table


def running_partition_stats(
    stream: DataFrame,
    table_name: str,
    partitioning: Partitioning | str,
    null_columns: Sequence[str] = (),
    sum_columns: Sequence[str] = (),
    time_column: str | None = None,
) -> DataFrame:
    """Streaming aggregate per partition value: ``record_count``, ``null_<c>``, ``sum_<c>``/``count_<c>``, ``max_ts``.

    Averages are kept as sum and count so that updates stay exact.
    """
    p = as_partitioning(partitioning)
    aggs = [F.count(F.lit(1)).alias("record_count")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in null_columns]
    for c in sum_columns:
        aggs += [F.sum(F.col(c).cast("double")).alias(f"sum_{c}"), F.count(F.col(c)).alias(f"count_{c}")]
    if time_column:
        aggs.append(F.max(F.col(time_column)).alias("max_ts"))
    return stream.groupBy(p.value().alias("partition_value")).agg(*aggs).withColumn("table_name", F.lit(table_name))


def start_stats_stream(
    stats: DataFrame,
    target_table: str,
    target_path: str,
    checkpoint_location: str,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Upsert each micro-batch's changed partitions into ``target_table`` (created on the first batch)."""

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        if spark.catalog.tableExists(target_table):
            write_table(spark, target_table, batch, mode="overwrite")
        else:
            write_table(spark, target_table, batch, partition_by=["table_name", "partition_value"], path=target_path)

    w = stats.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint_location)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def stream_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """A file source stream with a fixed schema (no inference on the stream)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)
