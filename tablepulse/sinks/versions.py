"""Tables that keep the state of the last finished run.

A run writes all its tables under a number of its own and enters the number in
the table of runs last. Readers take the newest number that is entered, so a run that
dies leaves the state before it in force, and nobody reads its half-written rows.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablepulse.sinks.writer import write_table


class Versions:
    """The tables ``<prefix>_<kind>`` and ``<prefix>_runs`` in ``folder``."""

    def __init__(self, spark: SparkSession, prefix: str, folder: str, schemas: Mapping[str, StructType | str]):
        self.spark, self.prefix, self.folder, self.schemas = spark, prefix, folder.rstrip("/"), dict(schemas)

    def name(self, kind: str) -> str:
        return f"{self.prefix}_{kind}"

    def last_run(self) -> int:
        """The number of the last finished run; 0 before the first."""
        if not self.spark.catalog.tableExists(self.name("runs")):
            return 0
        return self.spark.table(self.name("runs")).agg(F.max("run_id")).first()[0] or 0

    def next_run(self) -> int:
        """A number above all others, also above those of runs that died: microseconds since 1970."""
        return max(self.last_run() + 1, time.time_ns() // 1000)

    def read(self, kind: str) -> DataFrame:
        run = self.last_run()
        if not run:
            return self.spark.createDataFrame([], self.schemas[kind])
        return self.spark.table(self.name(kind)).where(F.col("run_id") == run).drop("run_id")

    def write(self, run_id: int, frames: Mapping[str, DataFrame]) -> None:
        for kind, frame in frames.items():
            frame = frame.withColumn("run_id", F.lit(run_id).cast("long"))
            write_table(self.spark, self.name(kind), frame, "append", ["run_id"], f"{self.folder}/{kind}")
        done = self.spark.createDataFrame([(run_id,)], "run_id long").coalesce(1)
        write_table(self.spark, self.name("runs"), done, "append", path=f"{self.folder}/runs")

    def tables(self) -> list[str]:
        return [self.name(k) for k in (*self.schemas, "runs")]
