"""Readers, stored forms, NDJSON, schema-evolving writes."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from tablepulse import schemas as S
from tablepulse.session import work_path
from tablepulse.sinks import storage as K
from tablepulse.sinks import writer as W
from tablepulse.sources import readers as R
from tablepulse.sources.cuts import latest_cuts
from tablepulse.operators.sampling import sample_by_key


def test_reader_dispatch_and_check(spark):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    df = R.read_source(spark, {"reader": "CATALOG"}, "SELECT count(*) AS n FROM o", {"o": orders})
    assert df.first()["n"] == orders.count()
    chk = R.source_check(R.read_source(spark, {"reader": "sql"}, "SELECT 1 AS ok", {})).first()
    assert (chk["ok"], chk["rows"]) == (True, 1)
    with pytest.raises(ValueError):
        R.read_source(spark, {"reader": "ftp"}, "SELECT 1")
    assert R.safe_config({"jdbc.url": "u", "jdbc.password": "p", "token": "t"}) == {"jdbc.url": "u"}


def test_sample_by_key_is_layout_free(spark):
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    a = rows(sample_by_key(o, ["o_orderkey"], 0.1), "o_orderkey")
    b = rows(sample_by_key(o.repartition(5), ["o_orderkey"], 0.1), "o_orderkey")
    assert a == b and 0 < len(a) < o.count()


def _metrics(spark):
    return spark.createDataFrame(
        [("t", "p1", "2025-09-08", "partition_exists", 1.0, {"partitionKey": "ds"}), ("t", None, "2025-09-08", "x", 2.5, {})],
        "table_name string, partition_value string, metric_date string, metric_name string, metric_value double, details map<string,string>",
    ).withColumn("metric_date", F.col("metric_date").cast("date")).select(*S.METRIC.fieldNames())


def test_json_encoding_keeps_nulls(spark):
    lines = [json.loads(r["value"]) for r in K.encode_json(_metrics(spark), "metrics").collect()]
    assert {"table": "t", "partition": None, "metricDate": "2025-09-08", "name": "x", "value": 2.5, "details": {}} in lines


def test_tables_append_and_ndjson(spark):
    tag = uuid.uuid4().hex[:8]
    names = K.ensure_tables(spark, {"metrics": f"m_{tag}", "cuts": f"c_{tag}"}, location=work_path(spark, "t"))
    K.append_results(_metrics(spark), "metrics", names["metrics"])
    K.append_results(_metrics(spark), "metrics", names["metrics"])
    assert spark.table(names["metrics"]).count() == 4
    cuts = spark.createDataFrame(
        [("t", "v", "d", [1.0], "2025-09-01 00:00:00"), ("t", "v", "d", [2.0], "2025-09-02 00:00:00")],
        "table_name string, column_name string, partition_value string, cuts array<double>, created_at string",
    ).withColumn("created_at", F.col("created_at").cast("timestamp"))
    K.save_cuts(cuts, names["cuts"])
    assert latest_cuts(spark.table(names["cuts"])).first()["cuts"] == [2.0]
    path = K.write_ndjson(_metrics(spark), "metrics", work_path(spark, "nd"), "2025-09-08")
    assert path.endswith("/20250908/metrics")
    assert K.read_ndjson(spark, path).count() == 2


def test_write_evolves_schema_and_overwrites_only_given_partitions(spark):
    fqn, path = f"w_{uuid.uuid4().hex[:8]}", work_path(spark, "w")
    base = spark.createDataFrame([("a", 1), ("b", 2)], "p string, x int")
    W.write_table(spark, fqn, base, partition_by=["p"], path=path)
    W.write_table(spark, fqn, spark.createDataFrame([("a", 5, "new")], "p string, x int, y string"), mode="overwrite")
    got = rows(spark.table(fqn), "p", "x", "y")
    assert got == [("a", 5, "new"), ("b", 2, None)]
    W.write_table(spark, fqn, spark.createDataFrame([("c", "only-y")], "p string, y string"))
    assert rows(spark.table(fqn), "p", "x", "y")[-1] == ("c", None, "only-y")
    aligned = W.align_to_schema(spark.createDataFrame([(1,)], "x int"), spark.table(fqn).schema)
    assert aligned.columns == spark.table(fqn).columns


def test_write_telemetry_counts_rows(spark):
    fqn, path = f"tel_{uuid.uuid4().hex[:8]}", work_path(spark, "tel")
    t = W.write_with_telemetry(spark, fqn, spark.range(7), path=path).first()
    assert (t["status"], t["rows"]) == ("success", 7)


def test_global_sequence_is_consecutive_across_partitions(spark):
    from tablepulse.functions.sequence import with_sequence

    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(7)
    out = with_sequence(df, [F.col("k")], "seq").collect()
    assert sorted((r["seq"], r["k"]) for r in out) == [(i, i) for i in range(1000)]


def test_sample_by_key_keeps_null_keys_and_small_fractions(spark):
    df = spark.createDataFrame([(None,), (1,), (2,)], "k int")
    assert sample_by_key(df, ["k"], 1.0).count() == 3
    many = spark.range(1_000_000).withColumnRenamed("id", "k")
    assert 15 <= sample_by_key(many, ["k"], 0.00004).count() <= 75


def test_failed_writes_leave_their_telemetry(spark):
    import uuid

    import pytest
    from tablepulse.sinks.writer import write_table, write_with_telemetry

    fqn, log = (f"tp_test_{uuid.uuid4().hex[:8]}" for _ in range(2))
    write_table(spark, fqn, spark.createDataFrame([(1,)], "a int"))
    with pytest.raises(Exception, match="a"):
        write_with_telemetry(spark, fqn, spark.createDataFrame([([1],)], "a array<int>"), telemetry=log)
    assert rows(spark.table(log), "status", "rows") == [("failure", None)]
    kept = write_with_telemetry(spark, fqn, spark.createDataFrame([([1],)], "a array<int>"), raise_error=False).first()
    assert kept["status"] == "failure" and kept["error"]
    for t in (fqn, log):
        spark.sql(f"DROP TABLE {t}")


def test_rules_are_read_from_json_lines(spark):
    from tablepulse.session import work_path
    from tablepulse.sources.rules import read_rules

    path = work_path(spark, "rules")
    spark.createDataFrame([('{"behavior": "drift", "threshold": 0.4, "severity": "warn"}',)], "value string").write.text(path)
    assert rows(read_rules(spark, path), "behavior", "threshold", "severity", "table_name") == [("drift", 0.4, "WARN", None)]
