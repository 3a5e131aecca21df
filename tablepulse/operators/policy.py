"""Check results to events, events to alert decisions.

Rule settings are joined once (a tiny broadcast side); each behaviour's
branch is a ``when`` chain, so every event is decided in one projection.
NaN never passes a comparison here (Spark orders NaN above every number,
so each comparison is guarded with ``isnan``).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepulse import schemas as S
from tablepulse.functions.exprs import empty_str_map, java_double_text, lit_ts
from tablepulse.sources.rules import resolve_rules

# metric name of a stored result -> (behaviour, event metric key)
METRIC_TO_EVENT = {
    "partition_exists": "availability",
    "snapshot_age_hours": "freshness",
    "null_ratio": "null_ratio",
    "row_count_dod_delta": "row_count_dod",
    "average_change": "average_change",
}


def _event(behavior: Column, table: Column, partition: Column, ts: Column, key: Column, value: Column, extra: Column) -> list[Column]:
    return [
        behavior.alias("behavior"),
        table.alias("table_name"),
        partition.cast("string").alias("partition_value"),
        ts.alias("ts"),
        # the optimizer may compute this before rows without a key are filtered out
        F.create_map(F.coalesce(key, F.lit("")), value.cast("double")).alias("metrics"),
        extra.cast("map<string,string>").alias("extra"),
    ]


def events_from_results(
    metrics: DataFrame | None = None, drift: DataFrame | None = None, run_ts: datetime | str | None = None, rules: DataFrame | None = None
) -> DataFrame:
    """EVENT rows from METRIC rows (availability, freshness, null ratio, row count, average) and DRIFT rows.

    ``rules`` adds what fails without a metric: a table without any snapshot is a
    freshness event of infinite age.
    """
    parts: list[DataFrame] = []
    ts = lit_ts(run_ts)
    if metrics is not None:
        behavior = F.element_at(F.create_map(*[F.lit(x) for kv in METRIC_TO_EVENT.items() for x in kv]), F.col("metric_name"))
        key = F.element_at(F.create_map(*[F.lit(x) for kv in S.EVENT_METRIC.items() for x in kv]), behavior)
        m = metrics.where(F.col("metric_name").isin(list(METRIC_TO_EVENT)))
        extra = F.map_concat(
            F.coalesce(F.col("details"), empty_str_map()), F.create_map(F.lit("metric"), F.col("metric_name"))
        )
        parts.append(
            m.select(*_event(behavior, F.col("table_name"), F.col("partition_value"), ts, key, F.col("metric_value"), extra))
        )
    if drift is not None:
        extra = F.map_concat(
            F.coalesce(F.col("details"), empty_str_map()),
            F.create_map(F.lit("metric"), F.col("metric_name"), F.lit("reference"), F.col("reference")),
        )
        parts.append(
            drift.select(
                *_event(F.lit("drift"), F.col("table_name"), F.col("partition_value"), ts, F.lit("drift_score"), F.col("score"), extra)
            )
        )
    if rules is not None:
        silent = rules.where((F.col("rule_id") == "freshness") & ~F.col("passed") & (F.col("observed") == "no_history"))
        extra = F.create_map(F.lit("rule"), F.col("rule_id"), F.lit("observed"), F.col("observed"))
        parts.append(
            silent.select(
                *_event(F.lit("freshness"), F.col("table_name"), F.col("partition_value"), ts, F.lit("age_hours"), F.lit(float("inf")), extra)
            )
        )
    if not parts:
        raise ValueError("give metrics, drift results or rules")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def utc_day(ts: Column, session_tz: str) -> Column:
    """yyyy-MM-dd of the instant in UTC, whatever the session time zone."""
    return F.date_format(F.to_utc_timestamp(ts, session_tz), "yyyy-MM-dd")


def alert_key(behavior: Column, table: Column, partition: Column, ts: Column, session_tz: str) -> Column:
    """``behavior|table|partition or -|yyyy-MM-dd`` (UTC run date)."""
    return F.concat_ws("|", behavior, table, F.coalesce(partition, F.lit("-")), utc_day(ts, session_tz))


def evaluate(events: DataFrame, rules: DataFrame | None = None, max_rule_rows: int | None = None) -> DataFrame:
    """DECISION rows: status sent / skipped / muted with reason, severity, actual and threshold."""
    tz = events.sparkSession.conf.get("spark.sql.session.timeZone")
    r = resolve_rules(events, rules, max_rule_rows)
    b = F.col("behavior")
    key = F.element_at(F.create_map(*[F.lit(x) for kv in S.EVENT_METRIC.items() for x in kv]), b)
    raw = F.col("metrics")[key]
    nan = F.lit(float("nan"))
    val = F.coalesce(raw, nan)
    avail = F.coalesce(raw, F.lit(1.0))
    avail_ok = (avail >= 1.0) & ~F.isnan(avail)
    absval = F.abs(val)
    stale = F.coalesce(F.col("stale_hours"), F.lit(24)).cast("double")
    thr = F.col("threshold")

    is_av, is_fr = b == "availability", b == "freshness"
    is_abs = b.isin("row_count_dod", "average_change")
    actual = F.when(is_av, F.when(avail_ok, 1.0).otherwise(0.0)).when(is_abs, absval).otherwise(val)
    limit = F.when(is_fr, stale).otherwise(thr)
    send = F.when(is_av, ~avail_ok).otherwise(~F.isnan(actual) & (actual > limit))
    threshold = F.when(is_av, F.lit(None).cast("double")).otherwise(limit)

    def pick(idx: int) -> Column:
        return F.element_at(F.create_map(*[x for k, v in S.POLICY_TEXT.items() if v[idx] for x in (F.lit(k), F.lit(v[idx]))]), b)

    never = F.lit(float("inf"))
    sent_msg = F.when(is_fr & (val == never), F.lit("No snapshot known")).when(is_fr, F.concat(F.lit("Stale by "), java_double_text(val - stale), F.lit("h"))).otherwise(pick(2))
    enabled = F.col("enabled")
    first_metric = F.coalesce(F.element_at(F.map_values("metrics"), 1), nan)
    out = r.select(
        "behavior",
        "table_name",
        "partition_value",
        F.when(~enabled, first_metric).otherwise(actual).alias("actual"),
        F.when(~enabled, F.when(is_av | is_fr, F.lit(None).cast("double")).otherwise(thr)).otherwise(threshold).alias("threshold"),
        F.when(~enabled, F.col("severity"))
        .when(send, F.when(is_av, F.lit("CRITICAL")).otherwise(F.col("severity")))
        .otherwise(F.lit("INFO"))
        .alias("severity"),
        F.when(~enabled, F.lit(S.MUTED_MESSAGE)).when(send, sent_msg).otherwise(pick(3)).alias("message"),
        "ts",
        F.coalesce(F.col("extra"), empty_str_map()).alias("extra"),
        F.when(~enabled, F.lit(S.STATUS_MUTED)).when(send, F.lit(S.STATUS_SENT)).otherwise(F.lit(S.STATUS_SKIPPED)).alias("status"),
        F.when(~enabled, F.lit(S.MUTED_REASON)).when(send, pick(0)).otherwise(pick(1)).alias("reason"),
    )
    return out.withColumn("alert_key", alert_key(F.col("behavior"), F.col("table_name"), F.col("partition_value"), F.col("ts"), tz))
