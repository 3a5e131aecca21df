"""The profile of the bundled test tables used by the registered queries and the bench.

Tables: ``events`` (daily partitions of ``ts``), ``orders`` (monthly of
``o_orderdate``), ``lineitem`` (monthly of ``l_shipdate``) and
``documents`` left-joined with ``labels`` (partitions by ``lang``, where
unlabelled documents give real nulls). The run time is fixed so results
repeat.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepulse.functions.partitioning import Partitioning
from tablepulse.operators.dispatch import Channel
from tablepulse.plans.profile import TableSpec
from tablepulse.sources.rules import rules_from_config

AS_OF = "2024-01-31T12:00:00Z"


def days(first: str, last: str) -> list[str]:
    d, end = date.fromisoformat(first), date.fromisoformat(last)
    out = []
    while d <= end:
        out.append(d.isoformat())
        d += timedelta(days=1)
    return out


def months(first: str, last: str) -> list[str]:
    y, m = (int(x) for x in first.split("-"))
    ly, lm = (int(x) for x in last.split("-"))
    out = []
    while (y, m) <= (ly, lm):
        out.append(f"{y:04d}-{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


EVENT_DAYS = days("2024-01-01", "2024-02-01")
ORDER_MONTHS = months("1995-01", "2001-09")

# rule settings of the demo run: every value differs from the built-in one, so a merge error shows
RULES_CONFIG = {
    "default": {
        "availability": {"enabled": True, "severity": "Warn"},
        "freshness": {"enabled": True, "stale_hours": 36, "severity": "Critical"},
        "drift": {"enabled": True, "threshold": 0.25, "severity": "Critical"},
        "null_ratio": {"enabled": True, "threshold": 0.15, "severity": "Critical"},
        "row_count_dod": {"enabled": True, "threshold": 0.35, "severity": "Critical"},
        "average_change": {"enabled": True, "threshold": 0.12, "severity": "Info"},
    },
    "overrides": {
        "lineitem": {"average_change": {"threshold": 0.05}},
        "orders": {"row_count_dod": {"enabled": False}, "freshness": {"severity": "Warn"}},
        "events": {"drift": {"threshold": 0.08, "severity": "Warn"}},
    },
}
RULES_ROWS = sum(len(blocks) for blocks in [RULES_CONFIG["default"], *RULES_CONFIG["overrides"].values()])


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents_with_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return docs.join(labels, "doc_id", "left")


def tables(spark: SparkSession, sf_dir: str) -> list[TableSpec]:
    return [
        TableSpec(
            name="events",
            df=read(spark, sf_dir, "events"),
            partitioning=Partitioning("ts", "day"),
            expected=EVENT_DAYS,
            key_cols=["event_id"],
            drift_columns=["value"],
            null_columns=["value", "event_type", "props"],
            average_columns=["value"],
            time_column="ts",
        ),
        TableSpec(
            name="orders",
            df=read(spark, sf_dir, "orders"),
            partitioning=Partitioning("o_orderdate", "month"),
            expected=ORDER_MONTHS,
            key_cols=["o_orderkey"],
            null_columns=["o_orderstatus", "o_totalprice"],
            average_columns=["o_totalprice"],
            time_column="o_orderdate",
        ),
        TableSpec(
            name="lineitem",
            df=read(spark, sf_dir, "lineitem"),
            partitioning=Partitioning("l_shipdate", "month"),
            key_cols=["l_orderkey", "l_linenumber"],
            average_columns=["l_quantity", "l_extendedprice", "l_discount"],
            time_column="l_shipdate",
        ),
        TableSpec(
            name="documents",
            df=documents_with_labels(spark, sf_dir),
            partitioning=Partitioning("lang"),
            null_columns=["quality", "toxic"],
            segment_column="quality",
            segment_dims=["lang", "source", "geo_value"],
            row_counts=False,
        ),
    ]


def rules(spark: SparkSession) -> DataFrame:
    return rules_from_config(spark, RULES_CONFIG)


CHANNEL_BASIC = Channel(level="basic", channel="table-health", mentions={"CRITICAL": "@duty"})
CHANNEL_ADVANCED = Channel(level="advanced", channel="table-health", mentions={"CRITICAL": "@duty"})
CHANNEL_DETAILED = Channel(level="detailed", channel="table-health", mentions={"CRITICAL": "@duty"})


def with_null_segment(df: DataFrame) -> DataFrame:
    """``lang`` with German blanked out, so the segment itself can be null."""
    return df.withColumn("lang", F.expr("nullif(lang, 'de')"))
