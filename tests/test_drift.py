"""Cuts, buckets, PSI and the drift run."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablepulse import Partitioning
from tablepulse.operators.drift import (
    bucket_of,
    compute_cuts,
    day_values,
    drift,
    drift_parts,
    drift_with_cuts,
    long_values,
    psi,
    reference_missing,
)
from tablepulse.plans.profile import TableSpec, run_profile

P = Partitioning("p")


def test_buckets_edges_nulls_nan_and_text(spark):
    vals = [None, "NaN", "0.5", "1.0", "2.5", "9", "abc"]
    df = spark.createDataFrame([("2025-09-01", v) for v in vals], "p string, x string")
    lv = long_values(df, "t", P, ["x"]).withColumn("cuts", F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0)))
    for max_cuts in (None, 3, 5):
        got = [r[0] for r in lv.select(bucket_of(F.col("value"), F.col("cuts"), "own", max_cuts)).collect()]
        assert sorted(got) == sorted([4, 4, 0, 0, 2, 3, 4])
    top = [r[0] for r in lv.select(bucket_of(F.col("value"), F.col("cuts"), "top", 3)).collect()]
    assert sorted(top) == sorted([3, 3, 0, 0, 2, 3, 3])


def test_cuts_ignore_nan_and_null(spark):
    df = spark.createDataFrame(
        [("2025-09-01", float(v)) for v in range(1, 11)] + [("2025-09-01", float("nan")), ("2025-09-01", None)],
        "p string, v double",
    )
    c = compute_cuts(long_values(df, "t", P, ["v"]), bins=10).first()
    assert c["cuts"] == [float(v) for v in range(1, 10)]


def test_day_values_keys_match_string_keys(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    p = Partitioning("ts", "day")
    a = compute_cuts(long_values(ev, "e", p, ["value"]))
    b = compute_cuts(day_values(ev, "e", p, ["value"]))
    assert rows(a) == rows(b)


def _days(spark, data):
    return spark.createDataFrame([(d, float(v)) for d, vs in data.items() for v in vs], "p string, v double")


def test_identical_days_have_zero_psi(spark):
    same = list(range(100))
    df = _days(spark, {"2025-09-01": same, "2025-09-07": same, "2025-09-08": same})
    d = drift(df, "t", P, ["v"], today="2025-09-08")
    got = {r["metric_name"]: r["score"] for r in d.collect()}
    assert set(got) == {"v_psi_dod", "v_psi_wow"}
    assert all(abs(s) < 1e-12 for s in got.values())
    assert {r["severity"] for r in d.collect()} == {"medium"}


def test_shifted_day_scores_high_and_names(spark):
    df = _days(spark, {"2025-09-07": range(100), "2025-09-08": range(50, 150)})
    d = drift(df, "t", P, ["v"], today="2025-09-08").collect()
    assert len(d) == 1  # no week-old reference
    r = d[0]
    assert (r["metric_name"], r["reference"], r["severity"], r["partition_value"]) == ("v_psi_dod", "yesterday", "high", "2025-09-08")
    assert r["details"]["reference_partition"] == "2025-09-07"
    assert r["score"] > 0.2


def test_empty_reference_gives_no_row_and_missing_metric(spark):
    df = _days(spark, {"2025-09-08": range(10)})
    assert drift(df, "t", P, ["v"], today="2025-09-08").count() == 0
    used = drift_parts(df, "t", P, ["v"], today="2025-09-08")[2]
    m = reference_missing(used, "t", ["v"], "2025-09-08", as_of="2025-09-10T00:00:00Z")
    assert rows(m, "metric_name", "metric_value") == [("reference_missing", 1.0), ("reference_missing", 1.0)]


def test_unparsable_today_gives_nothing(spark):
    df = _days(spark, {"2025-09-08": range(10)})
    assert drift(df, "t", P, ["v"], today="latest").count() == 0


def test_all_days_mode_equals_single_day_mode(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    p = Partitioning("ts", "day")
    one = {r["metric_name"]: r["score"] for r in drift(ev, "e", p, ["value"], today="2024-01-15").collect()}
    every = drift(ev, "e", p, ["value"]).where(F.col("partition_value") == "2024-01-15")
    for r in every.collect():
        assert math.isclose(one[r["metric_name"]], r["score"], rel_tol=1e-12)


def test_saved_cuts_are_reused_and_new_ones_returned(spark):
    df = _days(spark, {"2025-09-07": range(100), "2025-09-08": range(100)})
    saved = spark.createDataFrame(
        [("t", "v", "2025-09-07", [10.0, 20.0], "2025-09-01 00:00:00"), ("t", "v", "2025-09-07", [50.0], "2025-09-02 00:00:00")],
        "table_name string, column_name string, partition_value string, cuts array<double>, created_at string",
    ).withColumn("created_at", F.col("created_at").cast("timestamp"))
    d, new = drift_with_cuts(df, "t", P, ["v"], today="2025-09-08", saved_cuts=saved)
    assert new.count() == 0  # the reference day had saved cuts
    assert abs(d.first()["score"]) < 1e-12
    d2, new2 = drift_with_cuts(df, "t", P, ["v"], today="2025-09-08")
    assert rows(new2, "partition_value") == [("2025-09-07",)]


def test_psi_identities(spark):
    a = spark.createDataFrame([("k", 0, 0.2), ("k", 1, 0.5), ("k", 2, 0.3)], "key string, bucket int, share double")
    b = spark.createDataFrame([("k", 0, 0.4), ("k", 1, 0.4), ("k", 3, 0.2)], "key string, bucket int, share double")
    ab = psi(a, b, ["key"]).first()["score"]
    ba = psi(b, a, ["key"]).first()["score"]
    aa = psi(a, a, ["key"]).first()["score"]
    assert ab > 0 and math.isclose(ab, ba) and aa == 0.0
    expected = sum((p - q) * math.log(p / q) for p, q in [(0.2, 0.4), (0.5, 0.4), (0.3, 1e-9), (1e-9, 0.2)])
    assert math.isclose(ab, expected)


def test_two_tables_in_one_run(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    p = Partitioning("ts", "day")
    specs = [
        TableSpec("e1", ev, p, drift_columns=["value"], today="2024-01-10"),
        TableSpec("e2", ev.where(F.col("event_type") != "click"), p, drift_columns=["value"], today="2024-01-10"),
    ]
    prof = run_profile(spark, specs, mode="drift", as_of="2024-01-31T00:00:00Z")
    assert rows(prof.drift, "table_name", "metric_name") == [
        ("e1", "value_psi_dod"), ("e1", "value_psi_wow"), ("e2", "value_psi_dod"), ("e2", "value_psi_wow")
    ]
    assert prof.new_cuts.count() == 4


@pytest.mark.parametrize("parts", [1, 7])
def test_drift_layout_independent(spark, parts):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    p = Partitioning("ts", "day")
    base = {r["metric_name"]: r["score"] for r in drift(ev, "e", p, ["value"], today="2024-01-12").collect()}
    other = {r["metric_name"]: r["score"] for r in drift(ev.repartition(parts), "e", p, ["value"], today="2024-01-12").collect()}
    assert base.keys() == other.keys()
    for k in base:
        assert math.isclose(base[k], other[k], rel_tol=1e-9)


def test_unrolled_and_lambda_buckets_agree_with_python(spark):
    import random

    rng = random.Random(7)
    data = []
    for _ in range(500):
        cuts = sorted(rng.choice([0.0, 0.5, 1.0, 2.0, 3.0, 5.0]) for _ in range(rng.randint(0, 6)))
        v = rng.choice([None, -1.0, 0.0, 0.5, 1.0, 2.5, 3.0, 9.0])
        data.append((v, cuts))
    df = spark.createDataFrame(data, "v double, cuts array<double>")
    got = df.select(
        "v", "cuts",
        bucket_of(F.col("v"), F.col("cuts"), "own", None).alias("lam"),
        bucket_of(F.col("v"), F.col("cuts"), "own", 6).alias("unrolled"),
    ).collect()
    for r in got:
        want = len(r["cuts"]) + 1 if r["v"] is None else sum(1 for c in r["cuts"] if r["v"] > c)
        assert r["lam"] == r["unrolled"] == want


def test_cuts_of_a_large_day_are_exact(spark):
    df = spark.range(60_000).select(F.lit("2025-09-07").alias("p"), (F.col("id") * 7919 % 60_000).cast("double").alias("v"))
    cuts = compute_cuts(long_values(df, "t", P, ["v"])).first()["cuts"]
    assert cuts == [6000.0 * i - 1 for i in range(1, 10)]


def test_malformed_partitions_are_left_out(spark):
    good = _days(spark, {"2025-09-07": range(100), "2025-09-08": range(50, 150)})
    bad = good.unionByName(_days(spark, {"__HIVE_DEFAULT_PARTITION__": range(10), "2025-13-45": range(10)}))
    want = rows(drift(good, "t", P, ["v"]), "metric_name", "score")
    assert rows(drift(bad, "t", P, ["v"]), "metric_name", "score") == want
    saved = spark.createDataFrame([("t", "v", "not a day", [1.0])], "table_name string, column_name string, partition_value string, cuts array<double>").withColumn("created_at", F.current_timestamp())
    assert rows(drift(bad, "t", P, ["v"], saved_cuts=saved), "metric_name", "score") == want


def test_month_grain_is_refused(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    with pytest.raises(ValueError, match="month"):
        drift(ev, "e", Partitioning("ts", "month"), ["value"])


def test_large_cut_tables_take_the_shuffle_join(spark, monkeypatch):
    from tablepulse.functions import joins

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    p = Partitioning("ts", "day")
    want = rows(drift(ev, "e", p, ["value"]), "partition_value", "metric_name", "score")
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 0)
    assert rows(drift(ev, "e", p, ["value"]), "partition_value", "metric_name", "score") == want


def test_all_days_runs_name_missing_references(spark):
    df = _days(spark, {"2025-09-01": range(10), "2025-09-02": [float("nan")], "2025-09-03": range(10), "2025-09-09": range(10)})
    spec = TableSpec("t", df, P, drift_columns=["v"])
    got = run_profile(spark, [spec], mode="drift", as_of="2025-09-10T00:00:00Z").metrics
    pairs = sorted((r["partition_value"], r["details"]["reference_partition"]) for r in got.collect())
    assert pairs == [("2025-09-03", "2025-09-02"), ("2025-09-09", "2025-09-02"), ("2025-09-09", "2025-09-08")]
