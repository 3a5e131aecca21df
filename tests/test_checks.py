"""Partition availability, freshness, row-count change, duplicates, null rates, averages."""

import math

from pyspark.sql import functions as F

from conftest import rows
from tablepulse import Partitioning
from tablepulse.operators import availability as A
from tablepulse.operators.averages import average_change
from tablepulse.operators.nulls import null_ratio_by_partition, segment_nulls
from tablepulse.operators.rowcounts import row_count_change_by_date, row_count_changes
from tablepulse.operators.uniqueness import duplicate_keys, pk_duplicates
from tablepulse.sources.stats import latest_snapshot, partition_stats

AS_OF = "2025-09-10T12:00:00Z"
NINE_DAYS = [(f"2025-09-0{i}", 10 * i) for i in range(1, 10)]


def stats(spark, data, table="db.t"):
    return spark.createDataFrame([(table, p, c) for p, c in data], "table_name string, partition_value string, record_count long")


def metric(df, name):
    return {r["partition_value"]: r["metric_value"] for r in df.where(F.col("metric_name") == name).collect()}


def test_day_over_day_compares_with_previous_day(spark):
    m = row_count_changes(stats(spark, NINE_DAYS), as_of=AS_OF)
    dod = metric(m, "row_count_dod_delta")
    assert set(dod) == {f"2025-09-0{i}" for i in range(2, 10)}  # newest 8 partitions report
    assert dod["2025-09-02"] == 1.0
    assert math.isclose(dod["2025-09-09"], (90 - 80) / 80)
    wow = metric(m, "row_count_wow_delta")
    assert wow == {"2025-09-08": 7.0, "2025-09-09": 3.5}


def test_direction_next_reproduces_descending_lag(spark):
    m = row_count_changes(stats(spark, NINE_DAYS), direction="next", as_of=AS_OF)
    dod = metric(m, "row_count_dod_delta")
    assert math.isclose(dod["2025-09-08"], (80 - 90) / 90)
    assert "2025-09-09" not in dod


def test_zero_previous_gives_zero_and_metric_date_from_partition(spark):
    data = [("2025-09-01", 0), ("2025-09-02", 50), ("2025-09-04", 40)]
    m = row_count_changes(stats(spark, data), as_of=AS_OF)
    assert metric(m, "row_count_dod_delta") == {"2025-09-02": 0.0, "2025-09-04": -0.2}
    assert metric(m, "row_count_wow_delta") == {}  # fewer than 8 partitions: no week-over-week
    dates = {r["partition_value"]: str(r["metric_date"]) for r in m.collect()}
    assert dates["2025-09-02"] == "2025-09-02"


def test_week_over_week_by_date_skips_gaps(spark):
    data = [("2025-09-01", 10), ("2025-09-08", 30), ("2025-09-10", 5)]
    m = row_count_change_by_date(stats(spark, data), 7)
    assert metric(m, "row_count_wow_delta") == {"2025-09-08": 2.0}


def test_availability_missing_and_zero_partitions(spark):
    st = stats(spark, [("2025-09-08", 5), ("2025-09-09", 0)])
    exp = A.expected_partitions(spark, {"db.t": ["2025-09-08", "2025-09-09", "2025-09-10"]})
    counts = A.partition_counts(st, exp, 3)
    m = A.availability_metrics(counts, "ds", AS_OF)
    assert metric(m, "partition_exists") == {"2025-09-08": 1.0, "2025-09-09": 0.0, "2025-09-10": 0.0}
    assert metric(m, "partition_row_count")["2025-09-08"] == 5.0
    r = A.availability_rules(counts, AS_OF)
    assert rows(r, "partition_value", "passed", "fail_rate", "severity", "observed", "expected") == [
        ("2025-09-09", False, 1.0, "high", "record_count<=0", "record_count>0"),
        ("2025-09-10", False, 1.0, "high", "record_count<=0", "record_count>0"),
    ]


def test_freshness_sla_is_strict_and_no_history_fails(spark):
    hist = spark.createDataFrame(
        [("a", "2025-09-10 06:00:00"), ("b", "2025-09-10 05:59:00"), ("b", "2025-09-09 00:00:00")],
        "table_name string, made_current_at string",
    ).withColumn("made_current_at", F.col("made_current_at").cast("timestamp"))
    latest = latest_snapshot(hist)
    m = A.freshness_metrics(latest, AS_OF)
    assert {r["table_name"]: r["metric_value"] for r in m.collect()} == {"a": 6.0, "b": 6.0}
    r = A.freshness_rules(A.table_list(spark, ["a", "b", "c"]), latest, AS_OF, sla_hours=5)
    got = {x["table_name"]: (x["observed"], x["expected"], x["sampled_rows"]) for x in r.collect()}
    assert got == {"a": ("ageHours=6", "<= 5", 1), "b": ("ageHours=6", "<= 5", 1), "c": ("no_history", "recent_snapshot", 0)}
    assert A.freshness_rules(A.table_list(spark, ["a"]), latest, AS_OF, sla_hours=6).count() == 0


def test_composite_keys_with_nulls_stay_distinct(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a||b", None, None)], "k1 string, k2 string, k3 string")
    r = pk_duplicates(df, ["k1", "k2", "k3"], "t").first()
    assert r["passed"] and r["fail_rate"] == 0.0 and r["severity"] == "medium"
    assert r["observed"] == "dupRate=0.00000 acd=3 total=3"


def test_duplicates_rate_and_examples(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (2, 1), (2, 1), (3, 1)], "a int, b int")
    r = pk_duplicates(df, ["a", "b"], "t").first()
    assert not r["passed"] and r["severity"] == "high"
    assert math.isclose(r["fail_rate"], 0.5)
    assert r["examples"] == ["1||1", "2||1"]
    assert r["observed"] == "dupRate=0.50000 acd=3 total=6"
    keys = duplicate_keys(df, ["a", "b"])
    assert rows(keys, "a", "occurrences") == [(1, 3), (2, 2)]


def test_duplicates_no_keys_and_empty_input(spark):
    df = spark.createDataFrame([], "a int")
    assert pk_duplicates(df, [], "t").first()["observed"] == "no_pk_cols"
    r = pk_duplicates(df, ["a"], "t").first()
    assert r["passed"] and r["sampled_rows"] == 0 and r["observed"] is None


def test_approx_duplicates_uses_tolerance(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    r = pk_duplicates(df, ["k"], "t", method="approx", rsd=0.01, tolerance=0.05).first()
    assert r["passed"]


def test_layout_independence(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    a = pk_duplicates(li.repartition(1), ["l_orderkey", "l_linenumber"], "li").first()
    b = pk_duplicates(li.repartition(7), ["l_orderkey", "l_linenumber"], "li").first()
    assert (a["observed"], a["examples"]) == (b["observed"], b["examples"])


def test_null_ratio_by_partition(spark):
    df = spark.createDataFrame([("d1", None, 1.0), ("d1", "x", None), ("d2", "y", 2.0)], "p string, s string, v double")
    m = null_ratio_by_partition(df, "t", "p", ["s", "v"], AS_OF)
    got = {(r["partition_value"], r["details"]["column"]): r["metric_value"] for r in m.collect()}
    assert got == {("d1", "s"): 0.5, ("d1", "v"): 0.5, ("d2", "s"): 0.0, ("d2", "v"): 0.0}


def test_segment_nulls_grouping_sets_and_null_segment(spark):
    df = spark.createDataFrame(
        [("a", "x", None), ("a", "y", 1), (None, "x", None), (None, "x", None)], "d1 string, d2 string, c int"
    )
    r = segment_nulls(df, "c", ["d1", "d2", "absent"], 0.5, "t")
    got = {(x["rule_id"], tuple(x["examples"]), x["passed"], x["observed"], x["sampled_rows"]) for x in r.collect()}
    assert got == {
        ("null_rate_c_by_d1", (), True, "rate=0.5000", 2),
        ("null_rate_c_by_d1", ("<null>",), False, "rate=1.0000", 2),
        ("null_rate_c_by_d2", ("x",), False, "rate=1.0000", 3),
        ("null_rate_c_by_d2", (), True, "rate=0.0000", 1),
    }
    assert {x["expected"] for x in r.collect()} == {"<= 0.5"}


def test_average_change(spark):
    df = spark.createDataFrame(
        [("2025-09-01", 2.0), ("2025-09-01", 4.0), ("2025-09-02", 6.0), ("2025-09-03", 0.0)], "p string, v double"
    )
    m = average_change(df, "t", "p", ["v"], AS_OF)
    assert metric(m, "average_change") == {"2025-09-02": 1.0, "2025-09-03": -1.0}


def test_partition_stats_pushes_day_range_to_scan(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    p = Partitioning("ts", "day")
    plan = ev.where(p.where_in(ev, ["2024-01-05"]))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-05T00:00)" in plan
    st = partition_stats(ev, "events", p)
    assert st.count() == 30


def test_null_partitions_are_nobody_s_yesterday(spark):
    from tablepulse.operators.averages import average_change_metrics
    from tablepulse.operators.rowcounts import row_count_changes

    st = spark.createDataFrame([("t", None, 1000), ("t", "2025-09-01", 10), ("t", "2025-09-02", 20)], "table_name string, partition_value string, record_count long")
    got = {(r["metric_name"], r["partition_value"]): r["metric_value"] for r in row_count_changes(st).collect()}
    assert got == {("row_count_dod_delta", "2025-09-02"): 1.0, ("null_partition_row_count", None): 1000.0}
    avg = spark.createDataFrame([("t", None, "c", 9.0), ("t", "2025-09-01", "c", 1.0)], "table_name string, partition_value string, column_name string, average double")
    assert average_change_metrics(avg).count() == 0


def test_nan_is_null_in_averages(spark):
    from tablepulse.operators.averages import partition_averages
    from tablepulse.operators.partition_profile import partition_profile

    df = spark.createDataFrame([("p", 1.0), ("p", float("nan")), ("p", 3.0), ("p", None)], "p string, x double")
    assert partition_averages(df, "t", "p", ["x"]).first()["average"] == 2.0
    assert partition_profile(df, "t", "p", [], ["x"]).first()["a0"] == 2.0


def test_freshness_takes_the_newest_snapshot(spark):
    from tablepulse.operators import availability as A
    from tablepulse.plans.profile import TableSpec, partition_status, run_profile

    rows_ = [("t", "2024-01-22 00:00:00"), ("t", "2024-01-31 11:00:00"), ("t", "2024-01-26 00:00:00"), ("u", "2024-01-01 00:00:00")]
    h = spark.createDataFrame(rows_, "table_name string, made_current_at string").withColumn("made_current_at", F.col("made_current_at").cast("timestamp"))
    as_of = "2024-01-31T12:00:00Z"
    assert rows(A.freshness_metrics(h, as_of), "table_name", "metric_value") == [("t", 1.0), ("u", 732.0)]
    assert rows(A.freshness_rules(A.table_list(spark, ["t", "u", "v"]), h, as_of), "table_name", "observed") == [("u", "ageHours=732"), ("v", "no_history")]
    df = spark.createDataFrame([("2024-01-30", 1), ("2024-01-31", 2)], "p string, x int")
    spec = TableSpec("t", df, Partitioning("p"), history=h.where("table_name = 't'"))
    run = run_profile(spark, [spec], mode="availability", as_of=as_of)
    assert run.rules.where("rule_id = 'freshness'").count() == 0
    assert run.metrics.where("metric_name = 'snapshot_age_hours'").count() == 1
    assert partition_status(spark, [spec], as_of).count() == 2


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_plans_do_not_grow_with_the_tables(spark):
    from tablepulse.plans.profile import TableSpec, run_profile

    df = spark.createDataFrame([("2024-01-30", 1.0), ("2024-01-31", 2.0)], "p string, x double")

    def sizes(n):
        specs = [TableSpec(f"t{i}", df, Partitioning("p"), expected=["2024-01-31"], null_columns=["x"], average_columns=["x"]) for i in range(n)]
        run = run_profile(spark, specs, mode="all", as_of="2024-01-31T12:00:00Z")
        text = _plan(run.metrics) + _plan(run.rules)
        return [text.count(w) for w in ("Window", "Join", "Aggregate")]

    assert sizes(2) == sizes(9)


def test_expected_partitions_are_the_broadcast_side(spark):
    from tablepulse.operators import availability as A

    st = spark.createDataFrame([("t", "a", 5)], "table_name string, partition_value string, record_count long")
    counts = A.partition_counts(st, A.expected_partitions(spark, {"t": ["a", "b"]}), 2)
    assert rows(counts, "partition_value", "record_count") == [("a", 5), ("b", 0)]
    assert "LeftSemi" in counts._jdf.queryExecution().executedPlan().toString() or "LeftSemi" in _plan(counts)


def test_no_nested_loop_join_in_duplicates(spark):
    from tablepulse.operators.uniqueness import pk_duplicates

    df = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (2, 3), (2, 4)], "k int, v int")
    r = pk_duplicates(df, ["k"], "t")
    assert "NestedLoop" not in r._jdf.queryExecution().executedPlan().toString()
    got = r.first()
    assert got["examples"] == ["2", "1"] and not got["passed"]
    none = pk_duplicates(df.where("k > 5"), ["k"], "t").first()
    assert none["passed"] and none["sampled_rows"] == 0


def test_examples_of_duplicates_leave_no_key_count_in_the_stage_of_a_union(spark):
    """The tasks of a union are dealt to its branches by their size, so a table of few MB may get one for all its keys."""
    df = spark.createDataFrame([(k % 7 + k % 3,) for k in range(100)], "k int")
    r = pk_duplicates(df, ["k"], "a", examples=2).unionByName(pk_duplicates(df.where("k > 2"), ["k"], "b", examples=2))
    above, found = [], 0
    for line in r._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        above = [x for x in above if x[0] < depth]
        if "TakeOrderedAndProject" in line:
            found += 1
            assert any("Exchange" in x for _, x in above)
        above.append((depth, line))
    assert found == 2
    got = {x["table_name"]: (x["sampled_rows"], x["examples"]) for x in r.collect()}
    n = {k: sum(1 for i in range(100) if i % 7 + i % 3 == k) for k in range(9)}
    top = lambda keys: [str(k) for k in sorted(keys, key=lambda k: (-n[k], str(k)))[:2]]
    assert got == {"a": (100, top(range(9))), "b": (sum(n[k] for k in range(3, 9)), top(range(3, 9)))}


def test_thousands_of_partitions_plan_as_few_ranges(spark):
    from datetime import date, timedelta

    df = spark.createDataFrame([("2024-01-03 10:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    p = Partitioning("t", "day")
    days = [(date(2015, 1, 1) + timedelta(days=i)).isoformat() for i in range(3650)]
    assert df.where(p.where_in(df, days)).count() == 1
    assert df.where(p.where_in(df, days[::2])).count() in (0, 1)
    week = df.where(p.where_in(df, ["2024-01-03", "2024-01-01", "2024-01-02"]))
    assert _plan(week).count(">=") == 1


def test_partitions_limit_what_a_run_reports(spark):
    from tablepulse.plans.profile import TableSpec, run_profile

    df = spark.createDataFrame([(f"2024-01-{d:02d}", d, float(d)) for d in range(1, 11) for _ in range(d)], "p string, k int, x double")
    meta = df.groupBy("p").count().withColumnRenamed("count", "record_count")
    spec = TableSpec("t", df, Partitioning("p"), expected=[f"2024-01-{d:02d}" for d in range(1, 11)], key_cols=["k"], null_columns=["x"], partitions=["2024-01-05"], metadata=meta)
    run = run_profile(spark, [spec], as_of="2024-01-31T12:00:00Z")
    m = {(r["metric_name"], r["partition_value"]): r["metric_value"] for r in run.metrics.collect()}
    assert {p for _, p in m} == {"2024-01-05"}
    assert m["row_count_dod_delta", "2024-01-05"] == 0.25 and m["partition_row_count", "2024-01-05"] == 5.0
    assert run.rules.where("rule_id = 'pk_duplicates'").first()["sampled_rows"] == 5
