"""Consecutive row numbers over a global order without a single-task window.

``row_number()`` over an unpartitioned window moves every row into one task.
Here the frame is range-partitioned by the sort, each partition numbers its
rows locally (``monotonically_increasing_id`` is consecutive within a
partition) and a per-partition offset — one row per partition — is added.
The sorted frame is checkpointed first (reliable checkpoint in the
session's ``spark.checkpoint.dir``) so that both uses see the same layout
and a lost executor cannot re-sort it differently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablepulse.session import checkpointed


def with_sequence(df: DataFrame, order: Sequence[Column], name: str = "seq") -> DataFrame:
    """Add ``name`` = 0-based position of each row in ``order`` (a total order)."""
    ordered = (
        checkpointed(df.orderBy(*order))
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    sizes = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    # one row per partition: a tiny window is fine here
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    return (
        ordered.join(F.broadcast(offsets), "_pid")
        .withColumn(name, (F.col("_offset") + F.col("_mid") - F.col("_first")).cast("long"))
        .drop("_pid", "_mid", "_first", "_offset")
    )
