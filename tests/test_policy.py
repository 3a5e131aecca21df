"""Events to decisions (a case for every branch), and the dispatch path."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablepulse import schemas as S
from tablepulse.operators import dispatch as D
from tablepulse.operators.policy import evaluate, events_from_results
from tablepulse.sources.rules import resolve_rules, rules_from_config

TS = "2031-03-04T09:30:00Z"
T = "shop.carts"
P = "day=2031-03-04"

# drift overridden, null ratio muted for one table
CONFIG = {
    "default": {"drift": {"threshold": 0.30}},
    "overrides": {T: {"drift": {"threshold": 0.10, "severity": "critical"}, "null_ratio": {"enabled": False}}},
}


def events(spark, items):
    """items: (behavior, table, partition, metrics dict)."""
    rows_ = [(b, t, p, TS.replace("T", " ").rstrip("Z"), m, {}) for b, t, p, m in items]
    return spark.createDataFrame(
        rows_, "behavior string, table_name string, partition_value string, ts string, metrics map<string,double>, extra map<string,string>"
    ).withColumn("ts", F.col("ts").cast("timestamp")).select(*S.EVENT.fieldNames())


def decide(spark, items, config=CONFIG):
    return {
        (r["behavior"], r["table_name"]): r
        for r in evaluate(events(spark, items), rules_from_config(spark, config), 8).collect()
    }


def test_policy_cases(spark):
    d = decide(
        spark,
        [
            ("availability", "db.a", P, {"available": 0.0}),
            ("freshness", "db.f", P, {"age_hours": 48.0}),
            ("drift", "db.d", P, {"drift_score": 0.1}),
            ("drift", T, P, {"drift_score": 0.12}),
            ("null_ratio", T, P, {"null_ratio": 0.9}),
        ],
    )
    a = d[("availability", "db.a")]
    assert (a["status"], a["severity"], a["reason"], a["actual"], a["message"]) == ("sent", "CRITICAL", "availability_failed", 0.0, "Availability failure")
    f = d[("freshness", "db.f")]
    assert (f["status"], f["severity"], f["message"], f["threshold"]) == ("sent", "WARN", "Stale by 24.0h", 24.0)
    assert (d[("drift", "db.d")]["status"], d[("drift", "db.d")]["severity"]) == ("skipped", "INFO")
    o = d[("drift", T)]
    assert (o["status"], o["severity"], o["threshold"]) == ("sent", "CRITICAL", 0.1)
    m = d[("null_ratio", T)]
    assert (m["status"], m["reason"], m["message"], m["severity"], m["actual"]) == ("muted", "rule_disabled", "Muted by rule", "WARN", 0.9)


def test_every_branch_missing_and_nan_metrics(spark):
    nan = float("nan")
    d = decide(
        spark,
        [
            ("availability", "ok", None, {"available": 1.0}),
            ("availability", "missing", None, {}),
            ("availability", "nan", None, {"available": nan}),
            ("freshness", "fresh", None, {"age_hours": 3.0}),
            ("freshness", "nan", None, {"age_hours": nan}),
            ("freshness", "missing", None, {}),
            ("row_count_dod", "big", P, {"delta_pct": -0.5}),
            ("row_count_dod", "small", P, {"delta_pct": 0.1}),
            ("average_change", "big", P, {"change_ratio": 0.25}),
            ("average_change", "small", P, {"change_ratio": -0.2}),
            ("null_ratio", "high", P, {"null_ratio": 0.21}),
            ("null_ratio", "nan", P, {"null_ratio": nan}),
            ("drift", "high", P, {"drift_score": 0.31}),
        ],
    )
    want = {
        ("availability", "ok"): ("skipped", "availability_ok", "INFO"),
        ("availability", "missing"): ("skipped", "availability_ok", "INFO"),
        ("availability", "nan"): ("sent", "availability_failed", "CRITICAL"),
        ("freshness", "fresh"): ("skipped", "freshness_within_sla", "INFO"),
        ("freshness", "nan"): ("skipped", "freshness_within_sla", "INFO"),
        ("freshness", "missing"): ("skipped", "freshness_within_sla", "INFO"),
        ("row_count_dod", "big"): ("sent", "dod_large", "WARN"),
        ("row_count_dod", "small"): ("skipped", "dod_small", "INFO"),
        ("average_change", "big"): ("sent", "avg_high", "WARN"),
        ("average_change", "small"): ("skipped", "avg_low", "INFO"),
        ("null_ratio", "high"): ("sent", "null_high", "WARN"),
        ("null_ratio", "nan"): ("skipped", "null_low", "INFO"),
        ("drift", "high"): ("sent", "drift_high", "WARN"),
    }
    assert {k: (v["status"], v["reason"], v["severity"]) for k, v in d.items()} == want
    assert d[("row_count_dod", "big")]["actual"] == 0.5  # absolute change
    assert d[("availability", "ok")]["alert_key"] == "availability|ok|-|2031-03-04"


def test_rules_merge_field_by_field(spark):
    cfg = {
        "default": {"drift": {"threshold": 0.5, "severity": "info"}},
        "overrides": {"t": {"drift": {"severity": "Critical"}, "freshness": {}}},
    }
    ev = events(spark, [("drift", "t", None, {}), ("drift", "u", None, {}), ("freshness", "t", None, {})])
    r = {(x["behavior"], x["table_name"]): x for x in resolve_rules(ev, rules_from_config(spark, cfg)).collect()}
    assert (r[("drift", "t")]["threshold"], r[("drift", "t")]["severity"]) == (0.5, "CRITICAL")
    assert (r[("drift", "u")]["threshold"], r[("drift", "u")]["severity"]) == (0.5, "INFO")
    assert (r[("freshness", "t")]["stale_hours"], r[("freshness", "t")]["enabled"]) == (24, True)
    with pytest.raises(ValueError):
        rules_from_config(spark, {"default": {"drift": {"severity": "loud"}}})


def test_events_from_results(spark):
    m = spark.createDataFrame(
        [("t", "p", "partition_exists", 0.0), ("t", None, "snapshot_age_hours", 30.0), ("t", "p", "partition_row_count", 0.0)],
        "table_name string, partition_value string, metric_name string, metric_value double",
    ).withColumn("metric_date", F.current_date()).withColumn("details", F.create_map().cast("map<string,string>"))
    ev = events_from_results(m, None, TS)
    assert rows(ev, "behavior", "table_name") == [("availability", "t"), ("freshness", "t")]


def level_decisions(spark, items):
    return evaluate(events(spark, items), rules_from_config(spark, CONFIG), 8)


THREE = [
    ("availability", "db.t", P, {"available": 0.0}),
    ("drift", "db.t", P, {"drift_score": 0.4}),
    ("null_ratio", "db.t", P, {"null_ratio": 0.25}),
]


def test_level_filters(spark):
    dec = level_decisions(spark, THREE + [("drift", "db.u", P, {"drift_score": 0.0}), ("null_ratio", T, P, {"null_ratio": 0.9})])
    assert rows(D.sendable(dec, "basic"), "behavior") == [("availability",)]
    assert rows(D.sendable(dec, "advanced"), "behavior") == [("availability",), ("drift",), ("null_ratio",)]
    detailed = rows(D.sendable(dec, "detailed"), "behavior", "table_name")
    assert ("drift", "db.u") in detailed and ("null_ratio", T) not in detailed  # muted never goes out
    assert D.level_filter(dec, "detailed").count() == 5
    with pytest.raises(ValueError):
        D.Channel(level="verbose")


def test_rate_limit_and_batches(spark):
    five = [("availability", f"db.t{i}", P, {"available": 0.0}) for i in range(1, 6)]
    dec = level_decisions(spark, five)
    ch = D.Channel(level="basic", batch_size=1, max_messages=2)
    assert D.messages(dec, ch).count() == 2
    assert D.dry_run(dec, ch).count() == 5


def test_twenty_five_failures_batch_10_10_5(spark):
    many = [("availability", f"db.t{i:02d}", P, {"available": 0.0}) for i in range(25)]
    msgs = D.messages(level_decisions(spark, many), D.Channel(level="basic")).orderBy("batch_no").collect()
    assert [m["alerts"] for m in msgs] == [10, 10, 5]
    assert msgs[0]["text"] == msgs[1]["text"] == "[tablepulse|dev] 10 alerts (CRITICAL=10)"
    assert msgs[0]["items"].split("\n")[0] == "• db.t00/day=2031-03-04:availability CRITICAL Availability failure"
    assert len(msgs[2]["items"].split("\n")) == 5


def test_dedup_by_key(spark):
    dup = [("drift", "db.t", P, {"drift_score": 0.5}), ("drift", "db.t", P, {"drift_score": 0.35})]
    dec = level_decisions(spark, dup)
    a = D.dedup_alerts(D.sendable(dec, "advanced")).collect()
    assert len(a) == 1 and a[0]["actual"] == 0.5
    assert D.messages(dec, D.Channel(level="advanced")).first()["alerts"] == 1


def test_rendered_single_alert_text_and_blocks(spark):
    dec = level_decisions(spark, [("drift", "db.t", "p", {"drift_score": 0.42})])
    ch = D.Channel(level="advanced", mentions={"WARN": "@team"})
    m = D.messages(dec, ch).first()
    assert m["text"] == "[tablepulse|dev] db.t/p drift WARN: Drift above threshold actual=0.4200 (thr=0.300). @team"
    blocks = json.loads(m["blocks"])
    assert blocks[1]["fields"][1]["text"] == "*Behavior*: drift"
    assert blocks[1]["fields"][5]["text"] == "*Run At*: 2031-03-04T09:30:00Z"
    basic = json.loads(D.messages(dec, D.Channel(level="detailed")).first()["blocks"])
    assert len(basic) == 2  # no extra fields: no third section


def test_audit_rows_before_filtering(spark):
    dec = level_decisions(spark, THREE)
    a = D.audit_rows(dec, "basic").collect()
    assert len(a) == 3
    assert {r["timestamp"] for r in a} == {"2031-03-04T09:30:00Z"}
    assert {r["level"] for r in a} == {"basic"}


def results(spark, metrics=(), drifts=()):
    m = spark.createDataFrame([(t, p, n, v, d) for t, p, n, v, d in metrics], "table_name string, partition_value string, metric_name string, metric_value double, details map<string,string>").withColumn("metric_date", F.current_date())
    d = spark.createDataFrame(list(drifts), "table_name string, partition_value string, metric_name string, score double, reference string, details map<string,string>")
    return events_from_results(m, d, TS)


def test_dedup_keeps_the_worst_column_and_names_all(spark):
    ev = results(spark, [("t", "p", "null_ratio", 0.25, {"column": "b"}), ("t", "p", "null_ratio", 0.95, {"column": "a"}), ("t", "q", "null_ratio", 0.5, {"column": "a"})])
    got = {r["partition_value"]: r for r in D.dedup_alerts(D.sendable(evaluate(ev, None), "advanced")).collect()}
    assert got["p"]["actual"] == 0.95 and got["p"]["extra"]["column"] == "a" and got["p"]["extra"]["merged"] == "a, b"
    assert "merged" not in got["q"]["extra"]


def test_dedup_keeps_the_worst_reference(spark):
    ev = results(spark, drifts=[("t", "p", "v_psi_dod", 0.4, "yesterday", {"column": "v"}), ("t", "p", "v_psi_wow", 0.9, "week", {"column": "v"})])
    a = D.dedup_alerts(D.sendable(evaluate(ev, None), "advanced")).collect()
    assert [(x["actual"], x["extra"]["merged"]) for x in a] == [(0.9, "v/week, v/yesterday")]


def test_large_batches_count_what_they_do_not_list(spark):
    many = [("availability", f"db.t{i:02d}", P, {"available": 0.0}) for i in range(25)]
    m = D.messages(level_decisions(spark, many), D.Channel(level="basic", batch_size=25)).collect()
    lines = m[0]["items"].split("\n")
    assert len(m) == 1 and len(lines) == 11 and lines[-1] == "… and 15 more"


def test_cap_says_what_it_holds_back(spark):
    from tablepulse.plans.alerts import run_alerts
    from tablepulse.plans.profile import Profile

    rows_ = [("t", f"p{i}", "partition_exists", 0.0, {}) for i in range(7)]
    m = spark.createDataFrame(rows_, "table_name string, partition_value string, metric_name string, metric_value double, details map<string,string>").withColumn("metric_date", F.current_date())
    none = spark.createDataFrame([], S.DRIFT)
    run = run_alerts(Profile(m, spark.createDataFrame([], S.RULE), none, spark.createDataFrame([], S.CUTS)), D.Channel(level="basic", batch_size=2, max_messages=2), run_ts=TS)
    got = run.messages.orderBy("batch_no").collect()
    assert (run.suppressed_messages, run.suppressed_alerts, len(got)) == (2, 3, 2)
    assert "not sent" not in got[0]["text"] and got[1]["text"].endswith("(+3 alerts in 2 more messages not sent)")
