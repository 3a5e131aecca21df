"""Table writes that evolve the schema.

* :func:`align_to_schema` adds each target column missing from the data as
  a typed null.
* :func:`add_missing_columns` adds data-only columns to the table
  (``ALTER TABLE … ADD COLUMNS``).
* :func:`write_table` creates the table or aligns, evolves, orders and
  inserts; ``overwrite`` replaces only the partitions present in the data.
  Dynamic partition overwrite is a property of the table
  (``partitionOverwriteMode=dynamic`` in its storage options), never a
  session setting: tables made here carry it, older tables get it set
  before their first overwrite.
* :func:`write_with_telemetry` gives success/failure, rows and time as a
  one-row DataFrame (rows counted by ``observe`` during the write) and appends
  it to a telemetry table, also when the write fails.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DYNAMIC = ("partitionOverwriteMode", "dynamic")


def align_to_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Target columns in target order (missing ones as typed nulls), then data-only columns."""
    have = set(df.columns)
    cols = [F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields]
    extra = [F.col(c) for c in df.columns if c not in set(target.fieldNames())]
    return df.select(*cols, *extra)


def missing_columns(df: DataFrame, target: T.StructType) -> list[T.StructField]:
    names = set(target.fieldNames())
    return [f for f in df.schema.fields if f.name not in names]


def add_missing_columns(spark: SparkSession, fqn: str, df: DataFrame) -> list[str]:
    """Add data-only columns to table ``fqn``; returns their names."""
    add = missing_columns(df, spark.table(fqn).schema)
    if add:
        spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in add)
        spark.sql(f"ALTER TABLE {fqn} ADD COLUMNS ({spec})")
        spark.catalog.refreshTable(fqn)
    return [f.name for f in add]


def reconcile_schema(spark: SparkSession, fqn: str, df: DataFrame) -> DataFrame:
    """Both directions: evolve the table with data-only columns, pad the data with table-only ones."""
    add_missing_columns(spark, fqn, df)
    target = spark.table(fqn).schema
    return align_to_schema(df, target).select(*target.fieldNames())


def write_table(
    spark: SparkSession,
    fqn: str,
    df: DataFrame,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    path: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Create ``fqn`` from ``df`` when missing; else reconcile and insert (``append`` or ``overwrite``)."""
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be 'append' or 'overwrite'")
    if not spark.catalog.tableExists(fqn):
        w = df.write.format(fmt).mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by).option(DYNAMIC[0], DYNAMIC[1])
        if path:
            w = w.option("path", path)
        w.saveAsTable(fqn)
        return
    out = reconcile_schema(spark, fqn, df)
    if mode == "overwrite":
        ensure_dynamic_overwrite(spark, fqn)
    out.write.insertInto(fqn, overwrite=(mode == "overwrite"))


def ensure_dynamic_overwrite(spark: SparkSession, fqn: str) -> None:
    """Store ``partitionOverwriteMode=dynamic`` on a partitioned table that lacks it."""
    if not spark.catalog.listColumns(fqn) or not any(c.isPartition for c in spark.catalog.listColumns(fqn)):
        return
    props = spark.sql(f"DESCRIBE TABLE EXTENDED {fqn}").where("col_name = 'Storage Properties'").select("data_type").first()
    if props is None or f"{DYNAMIC[0]}={DYNAMIC[1]}" not in props[0]:
        spark.sql(f"ALTER TABLE {fqn} SET SERDEPROPERTIES ('{DYNAMIC[0]}'='{DYNAMIC[1]}')")


def write_with_telemetry(
    spark: SparkSession, fqn: str, df: DataFrame, mode: str = "append", partition_by: Sequence[str] = (),
    path: str | None = None, telemetry: str | None = None, raise_error: bool = True,
) -> DataFrame:
    """Run :func:`write_table` and return ``table, status, error, rows, millis`` as one row.

    The row is appended to table ``telemetry`` when one is named. A failure is
    recorded there first and then raised; with ``raise_error=False`` its row is
    returned instead.
    """
    obs = Observation(f"write_{abs(hash(fqn)) % 10**8}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    t0 = time.perf_counter()
    status, failure, rows = "success", None, None
    try:
        write_table(spark, fqn, observed, mode, partition_by, path)
        rows = int(obs.get.get("rows", 0))
    except Exception as e:  # recorded, then raised below
        status, failure = "failure", e
    ms = int((time.perf_counter() - t0) * 1000)
    result = spark.createDataFrame(
        [(fqn, status, type(failure).__name__ if failure else None, rows, ms)],
        "table string, status string, error string, rows long, millis long",
    )
    if telemetry is not None:
        write_table(spark, telemetry, result)
    if failure is not None and raise_error:
        raise failure
    return result
