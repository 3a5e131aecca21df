"""Result tables and NDJSON files.

Writes are distributed (``DataFrameWriter``), never pulled through the
driver. Tables are partitioned by a date column, not by a raw timestamp.
Errors are raised, not swallowed.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepulse import schemas as S
from tablepulse.functions.exprs import empty_str_map

JSON_OPTS = {"ignoreNullFields": "false"}


def to_storage(df: DataFrame, kind: str) -> DataFrame:
    """Project a result frame onto its stored columns (adds the date partition column)."""
    if kind == "metrics":
        return df.select(*[F.col(c) for c in S.METRIC.fieldNames()])
    if kind == "rules":
        return df.select(*[F.col(c) for c in S.RULE.fieldNames()], F.to_date("ts").alias("ts_date"))
    if kind == "drift":
        return df.select(*[F.col(c) for c in S.DRIFT.fieldNames()], F.to_date("ts").alias("ts_date"))
    if kind == "cuts":
        return df.select(*[F.col(c) for c in S.CUTS.fieldNames()], F.to_date("created_at").alias("created_date"))
    raise ValueError(f"unknown result kind {kind!r}")


def json_struct(kind: str) -> Column:
    """The JSON field layout of each result kind."""
    if kind == "metrics":
        return F.struct(
            F.col("table_name").alias("table"), F.col("partition_value").alias("partition"),
            F.date_format("metric_date", "yyyy-MM-dd").alias("metricDate"), F.col("metric_name").alias("name"),
            F.col("metric_value").alias("value"), F.coalesce("details", empty_str_map()).alias("details"),
        )
    if kind == "rules":
        return F.struct(
            F.col("rule_id").alias("id"), F.col("table_name").alias("table"), F.col("partition_value").alias("partition"),
            "passed", F.col("fail_rate").alias("failRate"), F.col("sampled_rows").alias("sampledRows"), "severity",
            F.coalesce("examples", F.array().cast("array<string>")).alias("examples"), "observed", "expected",
        )
    if kind == "drift":
        return F.struct(
            F.col("table_name").alias("table"), F.col("partition_value").alias("partition"),
            F.col("metric_name").alias("name"), "score", "severity", "reference",
        )
    if kind == "audit":
        return F.struct(*[F.col(c) for c in S.AUDIT.fieldNames()])
    raise ValueError(f"unknown result kind {kind!r}")


def encode_json(df: DataFrame, kind: str) -> DataFrame:
    """One column ``value``: the row as one-line JSON (nulls kept as null)."""
    return df.select(F.to_json(json_struct(kind), JSON_OPTS).alias("value"))


def write_ndjson(df: DataFrame, kind: str, base: str, run_date: date | datetime | str, name: str | None = None) -> str:
    """Append NDJSON under ``base/yyyyMMdd/<name>/`` (part files written by the executors)."""
    d = str(run_date)[:10].replace("-", "")
    path = f"{base.rstrip('/')}/{d}/{name or kind}"
    encode_json(df, kind).write.mode("append").text(path)
    return path


def read_ndjson(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def ensure_tables(
    spark: SparkSession, names: dict[str, str], location: str | None = None, fmt: str = "parquet"
) -> dict[str, str]:
    """CREATE TABLE IF NOT EXISTS for each ``kind -> table name`` (kinds: metrics, rules, drift, cuts)."""
    for kind, fqn in names.items():
        loc = f" LOCATION '{location.rstrip('/')}/{kind}'" if location else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {fqn} ({S.DDL[kind]}) USING {fmt} "
            f"OPTIONS ('partitionOverwriteMode'='dynamic') PARTITIONED BY ({S.DDL_PARTITION[kind]}){loc}"
        )
    return names


def append_results(df: DataFrame, kind: str, fqn: str) -> None:
    """Append a result frame to its stored table (columns matched by name)."""
    spark = df.sparkSession
    cols = spark.table(fqn).columns
    to_storage(df, kind).select(*cols).write.mode("append").insertInto(fqn)


def save_cuts(cuts: DataFrame, fqn: str) -> None:
    """Append newly computed cuts (CUTS rows) to the saved-cuts table."""
    append_results(cuts, "cuts", fqn)
