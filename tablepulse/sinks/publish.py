"""K8 with checks: write, audit, publish.

New partitions are written beside the table, checked there, and put in place by
pointing the catalog's partition at the new folder: a reader sees the old partition or the
new one, never half of it, and a failing check leaves the table as it was.

A journal has the plan of every publication (each partition with its old and new
folder) before the first partition is switched, and an entry when all are. A run that
dies between two partitions is carried through by :meth:`Publisher.repair`, which
every publication calls first; :meth:`Publisher.revert` points the partitions back.
Old folders are kept, as they are the way back.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepulse.sinks.nested import type_text
from tablepulse.sinks.writer import align_to_schema, write_table

JOURNAL = "run_id long, step string, partition_value string, old_location string, new_location string"
PLANNED, DONE = "planned", "done"

Check = Callable[[DataFrame], DataFrame]


class PublishRefused(Exception):
    """A check of the staged rows failed; ``failed`` has its RULE rows' ids and observations."""

    def __init__(self, failed: list[tuple[str, str | None]]):
        super().__init__(f"{len(failed)} failed checks: {failed}")
        self.failed = failed


class Publisher:
    """Publishes partitions of ``fqn``, a Parquet table with one partition column (text) in ``folder``."""

    def __init__(self, spark: SparkSession, fqn: str, partition_column: str, folder: str):
        self.spark, self.fqn, self.column, self.folder = spark, fqn, partition_column, folder.rstrip("/")
        self.journal = f"{fqn}_journal"

    def ensure_table(self, df: DataFrame) -> None:
        if not self.spark.catalog.tableExists(self.fqn):
            columns = ", ".join(f"`{f.name}` {type_text(f.dataType)}" for f in df.schema.fields if f.name != self.column)
            self.spark.sql(f"CREATE TABLE {self.fqn} ({columns}, `{self.column}` STRING) USING parquet PARTITIONED BY (`{self.column}`) LOCATION '{self.folder}/table'")

    def stage(self, df: DataFrame) -> tuple[int, str]:
        """Write rows beside the table; gives the run's number and folder."""
        run_id = max(self._last_run() + 1, time.time_ns() // 1000)
        path = f"{self.folder}/staged/{run_id}"
        target = self.spark.table(self.fqn).schema
        align_to_schema(df, target).select(*target.names).write.partitionBy(self.column).parquet(path)
        return run_id, path

    def publish(self, df: DataFrame, checks: Sequence[Check] = ()) -> int:
        """Replace the partitions that ``df`` has by its rows, if all checks (staged rows to RULE rows) pass; gives the run's number."""
        self.ensure_table(df)
        self.repair()
        run_id, path = self.stage(df)
        staged = self.spark.read.schema(self.spark.table(self.fqn).schema).option("basePath", path).parquet(path)
        failed = []
        for check in checks:
            failed += [(r["rule_id"], r["observed"]) for r in check(staged).where(~F.col("passed")).select("rule_id", "observed").limit(100).collect()]
        if failed:
            raise PublishRefused(failed)
        # a name per partition: the catalog takes them one by one
        values = sorted(r[0] for r in staged.select(self.column).distinct().collect())
        there = self._partitions()
        plan = [(run_id, PLANNED, v, self._location(v) if v in there else None, f"{path}/{self.column}={_folder_name(v)}") for v in values]
        write_table(self.spark, self.journal, self.spark.createDataFrame(plan, JOURNAL), path=f"{self.folder}/journal")
        self._switch(run_id, [(p[2], p[4]) for p in plan])
        return run_id

    def _switch(self, run_id: int, places: list[tuple[str, str | None]]) -> None:
        there = self._partitions()
        for value, location in places:
            self._point(value, location, value in there)
        self.spark.catalog.refreshTable(self.fqn)
        done = self.spark.createDataFrame([(run_id, DONE, None, None, None)], JOURNAL)
        write_table(self.spark, self.journal, done, path=f"{self.folder}/journal")

    def _point(self, value: str, location: str | None, exists: bool) -> None:
        """One catalog step: the partition lies in ``location`` from now on (nowhere: it is gone)."""
        part = f"PARTITION (`{self.column}` = '{_quoted(value)}')"
        if location is None:
            self.spark.sql(f"ALTER TABLE {self.fqn} DROP IF EXISTS {part}")
        elif exists:
            self.spark.sql(f"ALTER TABLE {self.fqn} {part} SET LOCATION '{_quoted(location)}'")
        else:
            self.spark.sql(f"ALTER TABLE {self.fqn} ADD IF NOT EXISTS {part} LOCATION '{_quoted(location)}'")

    def repair(self) -> list[int]:
        """Carry publications through that died between two partitions; gives their numbers."""
        if not self.spark.catalog.tableExists(self.journal):
            return []
        rows = self.spark.table(self.journal)
        done = rows.where(F.col("step") == DONE).select("run_id")
        left = rows.where(F.col("step") == PLANNED).join(done, "run_id", "left_anti").orderBy("run_id", "partition_value").collect()
        runs = sorted({r["run_id"] for r in left})
        for run in runs:
            self._switch(run, [(r["partition_value"], r["new_location"]) for r in left if r["run_id"] == run])
        return runs

    def revert(self, run_id: int) -> int:
        """Point the partitions of a publication back to where they were before it; gives the number of this step."""
        self.repair()
        rows = self.spark.table(self.journal).where((F.col("run_id") == run_id) & (F.col("step") == PLANNED)).collect()
        back = max(self._last_run() + 1, time.time_ns() // 1000)
        plan = [(back, PLANNED, r["partition_value"], r["new_location"], r["old_location"]) for r in rows]
        write_table(self.spark, self.journal, self.spark.createDataFrame(plan, JOURNAL), path=f"{self.folder}/journal")
        self._switch(back, [(p[2], p[4]) for p in plan])
        return back

    def _last_run(self) -> int:
        if not self.spark.catalog.tableExists(self.journal):
            return 0
        return self.spark.table(self.journal).agg(F.max("run_id")).first()[0] or 0

    def _partitions(self) -> set[str]:
        """Partition values in the catalog."""
        rows = self.spark.sql(f"SHOW PARTITIONS {self.fqn}").select(F.url_decode(F.replace(F.col("partition"), F.lit("+"), F.lit("%2B"))).alias("p")).collect()
        return {r["p"].split("=", 1)[1] for r in rows}

    def _location(self, value: str) -> str:
        rows = self.spark.sql(f"DESCRIBE EXTENDED {self.fqn} PARTITION (`{self.column}` = '{_quoted(value)}')")
        return rows.where("col_name = 'Location'").select("data_type").first()[0]

    def tables(self) -> list[str]:
        return [self.fqn, self.journal]


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _folder_name(value: str) -> str:
    """The folder that Spark's writer gives a partition value: these characters are percent-encoded in it (fixed values)."""
    special = set("\"#%'*/:=?\\{[]^\x7f") | {chr(i) for i in range(1, 32)}
    return "".join(f"%{ord(c):02X}" if c in special else c for c in value)
