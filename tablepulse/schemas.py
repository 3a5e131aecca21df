"""Result schemas and fixed values.

The schemas are the stored forms of the profiling results. The fixed values
below must stay equal to the reference behaviour for alerts to match.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (names, defaults and reason codes of the alert policy) ---
BEHAVIORS = ["availability", "freshness", "drift", "null_ratio", "row_count_dod", "average_change"]
SEVERITIES = ["INFO", "WARN", "CRITICAL"]
LEVELS = ["basic", "advanced", "detailed"]
STATUS_SENT, STATUS_SKIPPED, STATUS_MUTED = "sent", "skipped", "muted"

# behaviour -> metric key read from the event's metric map
EVENT_METRIC = {
    "availability": "available",
    "freshness": "age_hours",
    "drift": "drift_score",
    "null_ratio": "null_ratio",
    "row_count_dod": "delta_pct",
    "average_change": "change_ratio",
}

# built-in rule defaults: behaviour -> (enabled, severity, threshold, stale_hours)
DEFAULT_RULES = {
    "availability": (True, "CRITICAL", None, None),
    "freshness": (True, "WARN", None, 24),
    "drift": (True, "WARN", 0.30, None),
    "null_ratio": (True, "WARN", 0.20, None),
    "row_count_dod": (True, "WARN", 0.20, None),
    "average_change": (True, "WARN", 0.20, None),
}

# behaviour -> (sent reason, skipped reason, sent message, skipped message)
POLICY_TEXT = {
    "availability": ("availability_failed", "availability_ok", "Availability failure", "Available"),
    "freshness": ("freshness_stale", "freshness_within_sla", None, "Fresh"),
    "drift": ("drift_high", "drift_low", "Drift above threshold", "Drift normal"),
    "null_ratio": ("null_high", "null_low", "Null ratio high", "Null ratio ok"),
    "row_count_dod": ("dod_large", "dod_small", "Row count DoD large change", "Row count DoD normal"),
    "average_change": ("avg_high", "avg_low", "Average change high", "Average change normal"),
}
MUTED_REASON, MUTED_MESSAGE = "rule_disabled", "Muted by rule"

# check defaults
SAMPLE_FRACTION, SAMPLE_SEED = 0.01, 42
SLA_HOURS = 6
SEGMENT_DIMS = ["geo_value", "time_value"]
NULL_RATE_THRESHOLD = 0.2
DOD_DELTA_PCT = 0.10
DRIFT_BINS, PSI_THRESHOLD = 10, 0.2
QUANTILE_ACCURACY = 1_000_000  # relative error 1e-6
PSI_EPSILON = 1e-9
ROW_COUNT_LAST_PARTITIONS = 8
BATCH_SIZE, MAX_MESSAGES_PER_RUN = 10, 20
BATCH_ITEM_LINES = 10
PRODUCT, ENVIRONMENT = "tablepulse", "dev"
NULL_SEGMENT = "<null>"
# check-result severities (a separate scale from the alert severities)
RESULT_PASS_SEVERITY, RESULT_FAIL_SEVERITY = "medium", "high"

# --- stored forms ---
STR, DBL, LONG, BOOL = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()
STR_MAP = T.MapType(T.StringType(), T.StringType())
DBL_MAP = T.MapType(T.StringType(), T.DoubleType())


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


METRIC = _schema(
    ("table_name", STR), ("partition_value", STR), ("metric_date", T.DateType()),
    ("metric_name", STR), ("metric_value", DBL), ("details", STR_MAP),
)
RULE = _schema(
    ("table_name", STR), ("partition_value", STR), ("rule_id", STR), ("passed", BOOL),
    ("fail_rate", DBL), ("sampled_rows", LONG), ("severity", STR), ("observed", STR),
    ("expected", STR), ("examples", T.ArrayType(T.StringType())), ("ts", T.TimestampType()),
)
DRIFT = _schema(
    ("table_name", STR), ("partition_value", STR), ("metric_name", STR), ("score", DBL),
    ("severity", STR), ("reference", STR), ("details", STR_MAP), ("ts", T.TimestampType()),
)
CUTS = _schema(
    ("table_name", STR), ("column_name", STR), ("partition_value", STR),
    ("cuts", T.ArrayType(T.DoubleType())), ("created_at", T.TimestampType()),
)
PARTITION_STATS = _schema(("table_name", STR), ("partition_value", STR), ("record_count", LONG))
HISTORY = _schema(("table_name", STR), ("made_current_at", T.TimestampType()))
EVENT = _schema(
    ("behavior", STR), ("table_name", STR), ("partition_value", STR), ("ts", T.TimestampType()),
    ("metrics", DBL_MAP), ("extra", STR_MAP),
)
RULES = _schema(
    ("table_name", STR), ("behavior", STR), ("enabled", BOOL), ("threshold", DBL),
    ("stale_hours", T.IntegerType()), ("severity", STR),
)
DECISION = _schema(
    ("behavior", STR), ("table_name", STR), ("partition_value", STR), ("actual", DBL),
    ("threshold", DBL), ("severity", STR), ("message", STR), ("ts", T.TimestampType()),
    ("extra", STR_MAP), ("status", STR), ("reason", STR), ("alert_key", STR),
)
AUDIT = _schema(
    ("key", STR), ("level", STR), ("severity", STR), ("table", STR), ("behavior", STR),
    ("status", STR), ("reason", STR), ("timestamp", STR),
)

DDL = {
    "metrics": "table_name STRING, partition_value STRING, metric_date DATE, metric_name STRING, "
               "metric_value DOUBLE, details MAP<STRING,STRING>",
    "rules": "table_name STRING, partition_value STRING, rule_id STRING, passed BOOLEAN, fail_rate DOUBLE, "
             "sampled_rows BIGINT, severity STRING, observed STRING, expected STRING, examples ARRAY<STRING>, "
             "ts TIMESTAMP, ts_date DATE",
    "drift": "table_name STRING, partition_value STRING, metric_name STRING, score DOUBLE, severity STRING, "
             "reference STRING, details MAP<STRING,STRING>, ts TIMESTAMP, ts_date DATE",
    "cuts": "table_name STRING, column_name STRING, partition_value STRING, cuts ARRAY<DOUBLE>, "
            "created_at TIMESTAMP, created_date DATE",
}
# partition column of each stored table (a date, never a raw timestamp)
DDL_PARTITION = {"metrics": "metric_date", "rules": "ts_date", "drift": "ts_date", "cuts": "created_date"}
