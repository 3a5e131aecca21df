"""Running partition statistics from a file stream equal the batch aggregate."""

from pyspark.sql import functions as F

from conftest import SF001, rows
from tablepulse import Partitioning
from tablepulse.operators.partition_profile import partition_profile
from tablepulse.session import work_path
from tablepulse.streaming.incremental import running_partition_stats, start_stats_stream, stream_files


def test_stream_upserts_match_batch(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    landing = work_path(spark, "test-landing")
    ev.repartition(4).write.parquet(landing)
    p = Partitioning("ts", "day")
    stream = stream_files(spark, landing, ev.schema, max_files_per_trigger=1)
    stats = running_partition_stats(stream, "events", p, ["value"], ["value"], "ts")
    fqn = "stream_stats_test_" + landing.rsplit("/", 1)[-1]
    q = start_stats_stream(stats, fqn, work_path(spark, "test-stream-table"), work_path(spark, "test-stream-ckpt"))
    q.awaitTermination(300)
    got = rows(spark.table(fqn), "partition_value", "record_count", "null_value")
    batch = partition_profile(ev, "events", p, ["value"])
    want = rows(batch.select("partition_value", "record_count", F.col("n0").alias("null_value")))
    assert got == want and len(got) == 30


def test_tables_share_a_statistics_table(spark):
    import uuid

    from tablepulse.sinks.writer import write_table

    fqn = f"stream_shared_{uuid.uuid4().hex[:8]}"
    keys = ["table_name", "partition_value"]
    for name, n in (("a", 1), ("b", 2), ("a", 3)):
        batch = spark.createDataFrame([(n, name, "2024-01-01")], "record_count int, table_name string, partition_value string")
        if spark.catalog.tableExists(fqn):
            write_table(spark, fqn, batch, mode="overwrite")
        else:
            write_table(spark, fqn, batch, partition_by=keys)
    assert rows(spark.table(fqn), "table_name", "record_count") == [("a", 3), ("b", 2)]
    spark.sql(f"DROP TABLE {fqn}")
