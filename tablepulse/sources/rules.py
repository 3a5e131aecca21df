"""Alert rule settings.

Settings are a DataFrame of ``RULES`` rows: ``table_name`` null is the default
for a behaviour, a non-null ``table_name`` overrides it. Each field is merged
on its own: table override, then default row, then the built-in default.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepulse import schemas as S
from tablepulse.functions.exprs import severity_rank
from tablepulse.functions.joins import bounded_broadcast

FIELDS = ("enabled", "threshold", "stale_hours", "severity")


def _norm_severity(v: Any) -> str | None:
    if v is None:
        return None
    s = str(v).upper()
    if s not in S.SEVERITIES:
        raise ValueError(f"Unknown severity: {v}")
    return s


def _block_row(table: str | None, behavior: str, block: Mapping[str, Any]) -> tuple:
    if behavior not in S.BEHAVIORS:
        raise ValueError(f"Unknown behavior: {behavior}")
    stale = block.get("stale_hours", block.get("staleHours"))
    thr = block.get("threshold")
    en = block.get("enabled")
    return (
        table,
        behavior,
        None if en is None else (en if isinstance(en, bool) else str(en).lower() == "true"),
        None if thr is None else float(thr),
        None if stale is None else int(stale),
        _norm_severity(block.get("severity")),
    )


def rules_from_config(spark: SparkSession, rules: Mapping[str, Any]) -> DataFrame:
    """Rule rows from a settings mapping ``{"default": {...}, "overrides": {table: {...}}}``.

    An override block exists only when it is non-empty.
    """
    rows = [_block_row(None, b, blk or {}) for b, blk in (rules.get("default") or {}).items()]
    for table, blocks in (rules.get("overrides") or {}).items():
        rows += [_block_row(table, b, blk) for b, blk in (blocks or {}).items() if blk]
    return spark.createDataFrame(rows, S.RULES)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rule rows stored as newline-delimited JSON with the ``RULES`` fields."""
    return spark.read.schema(S.RULES).json(path).withColumn("severity", F.upper("severity"))


def _builtin(field: str, behavior: Column) -> Column:
    idx = {"enabled": 0, "severity": 1, "threshold": 2, "stale_hours": 3}[field]
    pairs: list[Column] = []
    for b, vals in S.DEFAULT_RULES.items():
        if vals[idx] is not None:
            pairs += [F.lit(b), F.lit(vals[idx])]
    return F.element_at(F.create_map(*pairs), behavior)


def collapse(rules: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; duplicates merge strictly (disabled wins, lowest limits, highest severity)."""
    return rules.groupBy(*keys).agg(
        F.bool_and("enabled").alias("enabled"),
        F.min("threshold").alias("threshold"),
        F.min("stale_hours").alias("stale_hours"),
        F.min_by("severity", severity_rank(F.col("severity"))).alias("severity"),
    )


def resolve_rules(events: DataFrame, rules: DataFrame | None, max_rule_rows: int | None = None) -> DataFrame:
    """Add ``enabled, severity, threshold, stale_hours`` for each event's (table, behaviour).

    The settings side is tiny; it is broadcast when its row count is known
    (``max_rule_rows``), else the planner decides from its size statistics.
    """
    out = events
    if rules is not None:
        r = rules.select("table_name", "behavior", *[F.col(c) for c in FIELDS])
        over = collapse(r.where(F.col("table_name").isNotNull()), ["table_name", "behavior"])
        dflt = collapse(r.where(F.col("table_name").isNull()), ["behavior"])
        over = over.select("table_name", "behavior", *[F.col(c).alias("o_" + c) for c in FIELDS])
        dflt = dflt.select("behavior", *[F.col(c).alias("d_" + c) for c in FIELDS])
        out = out.join(bounded_broadcast(over, max_rule_rows), ["table_name", "behavior"], "left").join(
            bounded_broadcast(dflt, max_rule_rows), ["behavior"], "left"
        )
    else:
        out = out.select("*", *[F.lit(None).alias("o_" + c) for c in FIELDS], *[F.lit(None).alias("d_" + c) for c in FIELDS])
    return merged_settings(out, events.columns)


def merged_settings(out: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and the settings: each field of the override (``o_…``), else of the default (``d_…``), else built in."""
    b = F.col("behavior")
    return out.select(
        *columns,
        F.coalesce("o_enabled", "d_enabled", _builtin("enabled", b), F.lit(True)).alias("enabled"),
        F.upper(F.coalesce("o_severity", "d_severity", _builtin("severity", b), F.lit("WARN"))).alias("severity"),
        F.coalesce("o_threshold", "d_threshold", _builtin("threshold", b)).cast("double").alias("threshold"),
        F.coalesce("o_stale_hours", "d_stale_hours", _builtin("stale_hours", b)).cast("int").alias("stale_hours"),
    )
