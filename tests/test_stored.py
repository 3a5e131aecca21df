"""What is kept between runs: sketches, partition rows, change-driven runs, alert state; settings over time."""

import os
import random
import shutil
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tablepulse.functions.partitioning import Partitioning
from tablepulse.operators import alert_state as AS
from tablepulse.operators import sketches as SK
from tablepulse.operators.averages import average_change_metrics
from tablepulse.operators.drift import drift
from tablepulse.operators.policy import evaluate, events_from_results
from tablepulse.operators.rowcounts import row_count_changes
from tablepulse.plans.changed import FileTable, RunState, run_changed
from tablepulse.plans.profile import TableSpec, partition_status, run_profile, stored_rows
from tablepulse.sources.rules import resolve_rules
from tablepulse.sources.rules_asof import resolve_rules_asof

DAY = Partitioning("ts", "day")
AS_OF = "2024-03-20T00:00:00Z"


def events(spark, days=12, per_day=40, seed=1):
    r = random.Random(seed)
    out = []
    for d in range(days):
        for k in range(per_day + d):
            value = None if r.random() < 0.1 else float("nan") if r.random() < 0.05 else r.gauss(d % 3, 1)
            out.append((d * 1000 + k, datetime(2024, 3, 1, r.randrange(24)) + timedelta(days=d), r.randrange(25), r.choice(["a", "b", None]), value))
    return spark.createDataFrame(out, "id long, ts timestamp_ntz, user long, kind string, value double")


# ---------------------------------------------------------------- sketches
def test_merged_key_sketches_are_the_sketch_of_all(spark):
    # enough keys a day that every sketch has left the form that lists them
    df = spark.range(9000).selectExpr("id", "timestamp_ntz '2024-03-01' + make_dt_interval(id % 6) AS ts", "id % 5000 AS user", "if(id % 3 = 0, null, 'k') AS kind")
    parts = SK.partition_sketches(df, "t", DAY, {"id": ["id"], "pair": ["user", "kind"]}, ts=AS_OF)
    whole = SK.partition_sketches(df.withColumn("ts", F.lit("2024-03-01").cast("timestamp_ntz")), "t", DAY, {"id": ["id"], "pair": ["user", "kind"]}, ts=AS_OF)
    # a merged sketch estimates from its registers alone, so the whole is merged, too: with itself
    one, many = rows(SK.distinct_keys(whole.unionByName(whole)), "name", "distinct_keys"), rows(SK.distinct_keys(parts), "name", "distinct_keys")
    assert one == many
    assert rows(SK.distinct_keys(parts), "record_count") == rows(SK.distinct_keys(whole), "record_count") == [(df.count(),)] * 2
    exact = {"id": df.select("id").distinct().count(), "pair": df.select("user", "kind").distinct().count()}
    assert all(abs(n - exact[name]) <= 4 * SK.key_error() * exact[name] for name, n in many)


def test_nulls_are_values_of_a_key(spark):
    df = spark.createDataFrame([("p", "a", None, "b"), ("p", "a", "b", None), ("p", None, "a", "b"), ("p", "a", None, "b")], "p string, x string, y string, z string")
    s = SK.partition_sketches(df, "t", "p", {"k": ["x", "y", "z"]}, ts=AS_OF)
    assert rows(SK.distinct_keys(s), "distinct_keys") == [(3,)]


def test_newest_sketch_of_a_partition_counts(spark):
    df = spark.createDataFrame([("p", 1), ("p", 2), ("q", 3)], "p string, k int")
    again = spark.createDataFrame([("p", 1)], "p string, k int")
    saved = SK.partition_sketches(df, "t", "p", {"k": ["k"]}, ts="2024-01-01").unionByName(SK.partition_sketches(again, "t", "p", {"k": ["k"]}, ts="2024-01-02"))
    found = SK.distinct_keys(SK.latest_sketches(saved), ["partition_value"])
    assert rows(found, "partition_value", "record_count", "distinct_keys") == [("p", 1, 1), ("q", 1, 1)]


def test_stored_duplicates(spark):
    df = spark.range(3000).selectExpr("concat('d', id % 3) AS p", "id AS one", "id % 1500 AS two")
    s = SK.partition_sketches(df, "t", "p", {"one": ["one"], "two": ["two"]}, ts=AS_OF)
    assert rows(SK.pk_duplicates_stored(s), "rule_id", "passed", "sampled_rows") == [("pk_duplicates_one", True, 3000), ("pk_duplicates_two", False, 3000)]
    assert all(r["passed"] for r in SK.pk_duplicates_stored(s, ["partition_value"]).where("rule_id = 'pk_duplicates_one'").collect())
    none = SK.partition_sketches(df.limit(0), "t", "p", {"one": ["one"]}, values=["two"], ts=AS_OF)
    assert none.count() == 0 and SK.pk_duplicates_stored(none).count() == 0


def test_columns_without_values_have_no_cuts(spark):
    df = spark.createDataFrame([("2024-01-01", None, "x"), ("2024-01-02", 1.0, "2"), ("2024-01-02", float("nan"), "y")], "p string, v double, w string")
    s = SK.partition_sketches(df, "t", "p", values=["v", "w"], ts=AS_OF)
    assert rows(s, "partition_value", "name", "record_count", "null_count") == [
        ("2024-01-01", "v", 1, 1), ("2024-01-01", "w", 1, 1), ("2024-01-02", "v", 2, 1), ("2024-01-02", "w", 2, 1),
    ]
    assert [(r[0], r[1], r[2][:2]) for r in rows(SK.stored_cuts(s), "column_name", "partition_value", "cuts")] == [("v", "2024-01-02", [1.0, 1.0]), ("w", "2024-01-02", [2.0, 2.0])]
    empty = SK.drift_from_sketches(df.where("p = '2024-01-01'"), "t", "p", ["v"], ["2024-01-01"], s, ts=AS_OF)
    assert empty.count() == 0


def test_drift_from_sketches_reads_the_current_day_only(spark, tmp_path):
    df = events(spark, 10, 200).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    df.write.partitionBy("day").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    part = Partitioning("day")
    s = SK.partition_sketches(table.withColumn("day", F.col("day").cast("string")), "t", part, values=["value"], ts=AS_OF)
    s.write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    today = "2024-03-10"
    want = drift(df, "t", DAY, ["value"], today=today, ts=AS_OF)
    for folder in Path(tmp_path / "t").glob("day=*"):
        if folder.name != f"day={today}":
            shutil.rmtree(folder)
    left = spark.read.parquet(str(tmp_path / "t")).withColumn("day", F.col("day").cast("string"))
    yesterday = [SK.ReferenceRange("dod", 1)]
    got = SK.drift_from_sketches(left, "t", part, ["value"], [today], stored, yesterday, ts=AS_OF)
    # few rows: the sketches hold them all, so that only the shares' grid can differ
    (a,), (b,) = rows(got, "score"), rows(want.where("metric_name = 'value_psi_dod'"), "score")
    assert abs(a[0] - b[0]) < 0.02


# ---------------------------------------------------------------- changes over partitions
def test_row_counts_of_numbered_partitions(spark):
    stats = spark.createDataFrame([("t", str(p), n) for p, n in ((8, 10), (9, 20), (10, 30), (11, 60))], "table_name string, partition_value string, record_count long")
    found = row_count_changes(stats, as_of=AS_OF).where("metric_name = 'row_count_dod_delta'")
    assert rows(found, "partition_value", "metric_value") == [("10", 0.5), ("11", 1.0), ("9", 1.0)]
    assert rows(row_count_changes(stats, last=2, as_of=AS_OF).where("metric_name = 'row_count_dod_delta'"), "partition_value") == [("10",), ("11",)]


def test_average_is_compared_with_the_last_known_one(spark):
    avgs = spark.createDataFrame(
        [("t", p, "v", a) for p, a in (("9", 10.0), ("10", None), ("11", 20.0), ("12", None))], "table_name string, partition_value string, column_name string, average double"
    )
    assert rows(average_change_metrics(avgs, as_of=AS_OF), "partition_value", "metric_name", "metric_value") == [
        ("10", "average_missing", 1.0), ("11", "average_change", 1.0), ("12", "average_missing", 1.0),
    ]


def test_a_run_over_one_partition_knows_the_stored_ones(spark):
    df = events(spark)
    full = run_profile(spark, [TableSpec("t", df, DAY, null_columns=["value"], average_columns=["value"], time_column="ts")], as_of=AS_OF).findings()
    stats = df.groupBy(DAY.value().alias("partition_value")).agg(F.count(F.lit(1)).alias("record_count")).withColumn("table_name", F.lit("t"))
    average = F.avg(F.when(~F.isnan("value"), F.col("value")))
    info = df.groupBy(DAY.value().alias("partition_value")).agg(average.alias("average")).select(F.lit("t").alias("table_name"), "partition_value", F.lit("value").alias("column_name"), "average")
    day = "2024-03-09"
    spec = TableSpec("t", df, DAY, null_columns=["value"], average_columns=["value"], partitions=[day], stored=stored_rows(stats, info))
    got = run_profile(spark, [spec], as_of=AS_OF).findings()
    assert rows(got, "name", "value") == rows(full.where(F.col("partition_value") == day), "name", "value")
    alone = run_profile(spark, [TableSpec("t", df, DAY, average_columns=["value"], partitions=[day])], as_of=AS_OF).metrics
    assert sorted((r["metric_name"], r["details"]["check"]) for r in alone.collect()) == [("no_history", "average_change"), ("no_history", "row_count_dod_delta")]


def test_tables_without_snapshots_are_alerts(spark):
    df = events(spark, 2)
    none = spark.createDataFrame([], "table_name string, made_current_at timestamp")
    p = run_profile(spark, [TableSpec("t", df, history=none), TableSpec("u", df, time_column="ts")], mode="availability", as_of="2024-03-02T12:00:00Z")
    d = evaluate(events_from_results(p.metrics, p.drift, AS_OF, p.rules))
    assert rows(d, "table_name", "status", "severity", "message") == [("t", "sent", "WARN", "No snapshot known"), ("u", "skipped", "INFO", "Fresh")]


def test_partition_status_is_one_branch(spark):
    df = events(spark)
    def exchanges(n):
        specs = [TableSpec(f"t{i}", df, DAY if i % 2 else Partitioning("kind"), time_column="ts") for i in range(n)]
        return partition_status(spark, specs, AS_OF)._jdf.queryExecution().toString().count("Exchange hash")

    assert exchanges(2) == exchanges(6)
    days = ["2024-03-05", "2024-03-06"]
    got = partition_status(spark, [TableSpec("t", df, DAY, partitions=days, time_column="ts")], AS_OF)
    assert [r[0] for r in rows(got, "partition_value")] == days
    assert got.where("row_count_dod_delta IS NOT NULL").count() == 1


# ---------------------------------------------------------------- change-driven runs
def _write(df, folder):
    df.coalesce(1).write.mode("overwrite").parquet(str(folder))


def _spec(spark, root):
    return TableSpec(
        "t", spark.read.parquet(f"{root}/*"), DAY, expected=["2024-03-01", "2024-03-15"], key_cols=["id"], drift_columns=["value"], null_columns=["value", "kind"],
        average_columns=["value"], time_column="ts", segment_column="kind", segment_dims=["user"],
    )


def test_changed_runs_find_what_full_runs_find(spark, tmp_path):
    root, df = tmp_path / "data", events(spark, 14)
    day = F.dayofmonth("ts")
    lost = spark.createDataFrame([(9_000_001, None, 1, "a", 1.0)], df.schema)
    for i in range(7):
        _write(df.where((day > 2 * i) & (day <= 2 * i + 2)), root / f"f{i}")
    state = RunState(spark, "changed_test", str(tmp_path / "state"))

    def compare():
        spec = _spec(spark, root)
        run = run_changed(spark, [FileTable(spec, f"{root}/*")], state, AS_OF)
        got = run.profile.findings().collect()
        want = run_profile(spark, [_spec(spark, root)], as_of=AS_OF).findings().collect()
        def flat(found):
            return Counter(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in found)

        assert flat(got) == flat(want)
        return run

    try:
        assert len(compare().affected["t"]) == 14
        assert compare().affected["t"] == []
        # appended: a later day and rows of an old one
        _write(events(spark, 16, 30, seed=5).where((day == 16) | (day == 4)), root / "more")
        assert compare().affected["t"] == ["2024-03-04", "2024-03-16"]
        # replaced
        _write(df.where((day == 9) & (F.col("id") % 2 == 0)), root / "f4")
        assert compare().affected["t"] == ["2024-03-09", "2024-03-10"]
        # deleted, and rows without a day
        shutil.rmtree(root / "f1")
        _write(lost, root / "lost")
        run = compare()
        assert run.affected["t"] == ["2024-03-03", "2024-03-04", None]
        assert {r["status"] for r in run.files.collect()} == {"same", "new", "removed"}
        os.utime(next((root / "f2").glob("part-*")), (1, 1))
        assert compare().affected["t"] == ["2024-03-05", "2024-03-06"]
    finally:
        for t in state.tables():
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_a_changed_run_that_died_is_not_read(spark, tmp_path):
    root = tmp_path / "data"
    _write(events(spark, 3), root / "a")
    state = RunState(spark, "died_test", str(tmp_path / "state"))
    try:
        first = run_changed(spark, [FileTable(_spec(spark, root), f"{root}/*")], state, AS_OF)
        half = state.read("manifest").limit(0)
        state.write(state.next_run(), {"manifest": half, "rows": state.read("rows").limit(0)})
        spark.sql(f"DROP TABLE {state.name('runs')}")  # as if the number had not been entered
        spark.createDataFrame([(first.run_id,)], "run_id long").write.saveAsTable(state.name("runs"))
        again = run_changed(spark, [FileTable(_spec(spark, root), f"{root}/*")], state, AS_OF)
        assert again.affected["t"] == [] and again.profile.findings().count() == first.profile.findings().count()
    finally:
        for t in state.tables():
            spark.sql(f"DROP TABLE IF EXISTS {t}")


# ---------------------------------------------------------------- alerts over runs
def _decisions(spark, day, **status):
    out = [("drift", t, f"p{day}", 0.5 + i, 0.3, "CRITICAL" if t == "c" else "WARN", "m", {"column": "v"}, s, "r") for i, (t, s) in enumerate(status.items())]
    cols = "behavior string, table_name string, partition_value string, actual double, threshold double, severity string, message string, extra map<string,string>, status string, reason string"
    return spark.createDataFrame(out, cols)


def test_alert_state_over_runs(spark):
    state = spark.createDataFrame([], AS.STATE)
    def run(day, cap=None, **status):
        nonlocal state
        state, out = AS.merge_alert_state(state, _decisions(spark, day, **status), f"2024-01-0{day}T00:00:00Z", cap)
        return sorted((r["table_name"], r["waiting"]) for r in out.collect())

    assert run(1, a="sent", b="sent", c="skipped") == [("a", "opened"), ("b", "opened")]
    assert run(2, a="sent", c="sent") == [("c", "opened")]  # a repeats, b is not evaluated
    assert run(3, a="skipped", b="muted", c="sent") == [("a", "resolved")]
    assert {r["table_name"]: (r["status"], r["runs"]) for r in state.collect()} == {"a": ("resolved", 2), "b": ("open", 1), "c": ("open", 2)}
    assert run(4, a="sent", b="skipped", c="skipped") == [("a", "opened"), ("b", "resolved"), ("c", "resolved")]
    assert all(r["waiting"] is None for r in state.collect())


def test_the_cap_is_fair_over_runs(spark):
    state = spark.createDataFrame([], AS.STATE)
    def run(day, **status):
        nonlocal state
        state, out = AS.merge_alert_state(state, _decisions(spark, day, **status), f"2024-01-0{day}T00:00:00Z", 2)
        return [(r["table_name"], r["waiting"]) for r in out.orderBy("waiting_since", "table_name").collect()]

    assert sorted(run(1, a="sent", b="sent", c="sent", d="sent", e="sent")) == [("a", "opened"), ("c", "opened")]  # CRITICAL first, then by name
    # older ones before newer ones; e ends before it was ever told
    assert run(2, x="sent", c="sent", d="sent", e="skipped") == [("b", "opened"), ("d", "opened")]
    assert run(3, a="skipped", b="skipped", c="skipped") == [("x", "opened"), ("c", "resolved")]
    # b comes back before its end was told: nobody needs to hear of it
    assert run(4, b="sent") == [("a", "resolved")]
    assert run(5) == []
    assert {r["table_name"]: r["status"] for r in state.collect()} == {"a": "resolved", "b": "open", "c": "resolved", "d": "open", "e": "resolved", "x": "open"}


# ---------------------------------------------------------------- settings over time
def test_settings_hold_from_their_time(spark):
    r = random.Random(2)
    at = lambda h: (datetime(2024, 1, 1) + timedelta(hours=h)).isoformat(sep=" ")
    settings = [(r.choice([None, "a", "b"]), "drift", r.choice([None, True, False]), r.choice([None, 0.1, 0.7]), r.choice([None, "WARN", "CRITICAL"]), at(r.randrange(100))) for _ in range(25)]
    times = [(k, r.choice(["a", "b", "c"]), at(r.randrange(-10, 130))) for k in range(300)] + [(301, "a", None)]
    ev = spark.createDataFrame(times, "id int, table_name string, at string").select("id", "table_name", F.lit("drift").alias("behavior"), F.col("at").cast("timestamp").alias("ts"))
    cfg = spark.createDataFrame([(t, b, e, x, None, s, v) for t, b, e, x, s, v in settings], "table_name string, behavior string, enabled boolean, threshold double, stale_hours int, severity string, at string")
    cfg = cfg.withColumn("valid_from", F.col("at").cast("timestamp")).drop("at")
    got = {x["id"]: (x["enabled"], x["threshold"], x["severity"]) for x in resolve_rules_asof(ev, cfg).collect()}
    for k, table, ts in times:
        # the settings in force, resolved as if they were the only ones
        force = {}
        for s in settings:
            key = s[0]
            if ts is not None and s[5] <= ts and key in (None, table) and (key not in force or s[5] >= force[key][0][5]):
                force[key] = [s] if key not in force or s[5] > force[key][0][5] else [*force[key], s]
        o, d = (_strict(force.get(key, [])) for key in (table, None))
        want = tuple(a if a is not None else b if b is not None else c for a, b, c in zip(o, d, (True, 0.30, "WARN"), strict=True))
        assert got[k] == want, (k, table, ts)


def _strict(settings):
    known = lambda i: [s[i] for s in settings if s[i] is not None]
    return (all(known(2)) if known(2) else None, min(known(3), default=None), "CRITICAL" if "CRITICAL" in known(4) else known(4)[0] if known(4) else None)


def test_settings_without_any_are_built_in(spark):
    ev = spark.createDataFrame([("t", "drift", datetime(2024, 1, 1))], "table_name string, behavior string, ts timestamp")
    none = spark.createDataFrame([], "table_name string, behavior string, enabled boolean, threshold double, stale_hours int, severity string, valid_from timestamp")
    assert rows(resolve_rules_asof(ev, none)) == rows(resolve_rules(ev, None))
    with pytest.raises(Exception, match="valid_from"):
        resolve_rules_asof(ev, none.drop("valid_from"))
