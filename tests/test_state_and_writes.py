"""Streams with state, failing segments, checked publishing and nested schemas."""

import itertools
import random
import time
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepulse.functions.partitioning import Partitioning
from tablepulse.operators.drift import day_values
from tablepulse.operators.lattice import smallest_failing_segments
from tablepulse.operators.uniqueness import pk_duplicates
from tablepulse.sinks.nested import SchemaConflict, align_nested, merge_schemas, merge_types, write_nested
from tablepulse.sinks.publish import Publisher, PublishRefused
from tablepulse.streaming import drift as SD
from tablepulse.streaming import freshness as FR


def replay(spark, parts, folder, make):
    """The output of a stream that brings the parts one after the other."""
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{folder}/in/{i}")
        time.sleep(0.05)
    stream = spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")
    FR.use_timers(spark)
    try:
        make(stream).writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    return spark.read.parquet(f"{folder}/out")


def test_freshness_of_rows_out_of_order(spark, tmp_path):
    r = random.Random(3)
    start, out = datetime(2024, 5, 1), []
    for feed in ("a", "b", "c", None):
        at = start
        while at < start + timedelta(hours=30):
            out.append((feed, at + timedelta(seconds=r.randrange(60))))
            at += timedelta(minutes=r.choice([1, 5, 20, 90, 200]))
    out.append(("late starter", start + timedelta(hours=29)))
    # rows come up to 15 minutes out of order
    out.sort(key=lambda x: x[1] + timedelta(minutes=r.randrange(15)))
    df = spark.createDataFrame(out, "feed string, ts timestamp")
    step = len(out) // 5 + 1
    parts = [spark.createDataFrame(out[i : i + step], df.schema) for i in range(0, len(out), step)]
    got = replay(spark, parts, str(tmp_path), lambda s: FR.freshness_stream(s, F.col("feed"), "ts", 60, "20 minutes"))
    want = FR.freshness_transitions(df, F.col("feed"), "ts", 60, 20)
    assert rows(got) == rows(want) and {x[1] for x in rows(got)} == {"stale", "fresh"}


def test_late_rows_change_no_closed_day(spark, tmp_path):
    r = random.Random(7)
    out = [(d, k, datetime(2024, 6, 1) + timedelta(days=d, minutes=r.randrange(1440)), r.gauss(d, 2) if k % 9 else None) for d in range(5) for k in range(60)]
    schema = "d int, k int, ts timestamp_ntz, value double"
    of = lambda keep: spark.createDataFrame([x for x in out if keep(x)], schema)
    late = lambda x: x[0] in (1, 2) and x[1] % 10 == 0
    full = of(lambda x: True)
    references = SD.daily_references(day_values(full, "t", Partitioning("ts", "day"), ["value"])).cache()
    parts = [of(lambda x, a=a: x[0] in a and not late(x)) for a in ((0, 1), (2, 3), (4,))] + [of(late)]
    closed = replay(spark, parts, str(tmp_path), lambda s: SD.drift_stream(s, "t", Partitioning("ts", "day"), ["value"], references, 10)).cache()
    # days 1 to 3 closed once, without the late rows (day 0 has no reference, day 4 is open)
    per = closed.where("kind = 'closed' AND range_name = 'dod'").groupBy("day").agg(F.sum("rows").alias("n"), F.count_distinct("bucket").alias("b"), F.count("bucket").alias("c"))
    assert [(str(x["day"]), x["n"]) for x in per.orderBy("day").collect()] == [("2024-06-02", 54), ("2024-06-03", 54), ("2024-06-04", 60)]
    assert all(x["b"] == x["c"] for x in per.collect())
    assert rows(SD.late_rows(closed), "partition_value", "metric_value") == [("2024-06-02", 6.0), ("2024-06-03", 6.0)]
    assert SD.closed_drift(closed, references).count() == 3


# ---------------------------------------------------------------- segments
def segments_by_hand(data, dims, threshold, min_rows):
    found = {}
    for k in range(len(dims) + 1):
        for combo in itertools.combinations(range(len(dims)), k):
            groups = {}
            for row in data:
                groups.setdefault(tuple((i, row[i]) for i in combo), []).append(row[-1] is None)
            for key, nulls in groups.items():
                if len(nulls) >= min_rows and sum(nulls) / len(nulls) > threshold:
                    found[key] = (len(nulls), sum(nulls))
    least = {k: v for k, v in found.items() if not any(set(o) < set(k) for o in found)}
    text = lambda key: ", ".join(f"{dims[i]}={'<null>' if v is None else v}" for i, v in key)
    return sorted((len(k), text(k), *v) for k, v in least.items())


@pytest.mark.parametrize(("threshold", "min_rows"), [(0.5, 5), (0.35, 1), (0.9, 2), (0.01, 1)])
def test_failing_segments_are_those_of_the_cube(spark, threshold, min_rows):
    r = random.Random(9)
    dims, data = ["a", "b", "c", "d"], []
    for _ in range(500):
        row = [r.choice([None, "x", "y"]), r.choice(["=", "~", "null"]), r.randrange(4), r.choice([True, False])]
        bad = (row[0] == "x" and row[2] == 1) or row[1] == "~" and row[3] and row[2] == 3
        data.append((*row, None if r.random() < (0.9 if bad else 0.15) else 1))
    df = spark.createDataFrame(data, "a string, b string, c int, d boolean, v int")
    got = smallest_failing_segments(df, "v", [*dims, "absent"], threshold, min_rows)
    want = [(n, t.replace("True", "true").replace("False", "false"), *x) for n, t, *x in segments_by_hand(data, dims, threshold, min_rows)]
    assert rows(got.segments, "level", "segment", "rows", "null_rows") == sorted(want)
    levels = rows(got.levels)
    assert levels[0][1] == 1 and all(n >= 0 for row in levels for n in row)


def test_failing_segments_of_nothing(spark):
    df = spark.createDataFrame([], "a string, v int")
    assert smallest_failing_segments(df, "v", ["a"]).segments.count() == 0
    one = spark.createDataFrame([("x", None)], "a string, v int")
    assert rows(smallest_failing_segments(one, "v", []).segments, "level", "segment") == [(0, "")]


# ---------------------------------------------------------------- publishing
@pytest.fixture
def publisher(spark, tmp_path):
    p = Publisher(spark, "publish_test", "p", str(tmp_path))
    yield p
    for t in p.tables():
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def _unique(staged):
    return pk_duplicates(staged, ["k"], "publish_test")


def _frame(spark, *out):
    return spark.createDataFrame(list(out), "k int, p string")


def test_a_failing_check_leaves_the_table(spark, publisher):
    publisher.publish(_frame(spark, (1, "x"), (2, "y")), [_unique])
    with pytest.raises(PublishRefused) as e:
        publisher.publish(_frame(spark, (7, "x"), (7, "x"), (8, "z")), [_unique])
    assert e.value.failed[0][0] == "pk_duplicates"
    assert rows(spark.table("publish_test")) == [(1, "x"), (2, "y")]
    publisher.publish(_frame(spark, (7, "x"), (8, "a b%/=c"), (9, "it's")), [_unique])
    assert rows(spark.table("publish_test")) == [(2, "y"), (7, "x"), (8, "a b%/=c"), (9, "it's")]


@pytest.mark.parametrize("dies_at", [1, 2, 3])
def test_a_publication_that_died_is_carried_through(spark, publisher, monkeypatch, dies_at):
    first = publisher.publish(_frame(spark, (1, "x"), (2, "y"), (3, "w")))
    point, calls = Publisher._point, []

    def dies(self, *args):
        calls.append(args)
        if len(calls) == dies_at:
            raise RuntimeError("died")
        return point(self, *args)

    monkeypatch.setattr(Publisher, "_point", dies)
    with pytest.raises(RuntimeError, match="died"):
        publisher.publish(_frame(spark, (10, "x"), (20, "y"), (30, "z")))
    monkeypatch.setattr(Publisher, "_point", point)
    (run,) = publisher.repair()
    new = [(3, "w"), (10, "x"), (20, "y"), (30, "z")]
    assert rows(spark.table("publish_test")) == new and publisher.repair() == []
    back = publisher.revert(run)
    assert rows(spark.table("publish_test")) == [(1, "x"), (2, "y"), (3, "w")]
    publisher.revert(back)
    assert rows(spark.table("publish_test")) == new and first < run < back


# ---------------------------------------------------------------- nested schemas
def _t(text):
    return T._parse_datatype_string(text)


def test_types_widen_but_never_narrow():
    assert merge_types(_t("int"), _t("long")) == merge_types(_t("long"), _t("short")) == T.LongType()
    assert merge_types(_t("float"), _t("double")) == T.DoubleType()
    assert merge_types(_t("decimal(5,2)"), _t("decimal(9,2)")) == T.DecimalType(9, 2)
    assert merge_types(_t("struct<a:int,b:struct<c:float>>"), _t("struct<b:struct<c:double,d:int>,e:string>")).simpleString() == "struct<a:int,b:struct<c:double,d:int>,e:string>"
    assert merge_types(_t("array<array<int>>"), _t("array<array<long>>")).simpleString() == "array<array<bigint>>"
    for a, b in (("int", "string"), ("long", "double"), ("map<int,int>", "map<long,int>"), ("decimal(5,2)", "decimal(5,3)"), ("date", "timestamp"), ("array<int>", "int")):
        with pytest.raises(SchemaConflict):
            merge_types(_t(a), _t(b))
    with pytest.raises(SchemaConflict, match=r"s\.x\[\]"):
        merge_schemas(_t("struct<s:struct<x:array<int>>>"), _t("struct<s:struct<x:array<string>>>"))
    with pytest.raises(SchemaConflict, match="case"):
        merge_schemas(_t("struct<name:int>"), _t("struct<Name:int>"))


def test_null_structs_stay_null(spark):
    df = spark.createDataFrame([(1, (1, [None, (2,)])), (2, None)], "k int, s struct<a:int,l:array<struct<x:int>>>")
    out = align_nested(df, _t("struct<k:bigint,s:struct<a:bigint,l:array<struct<x:bigint,y:string>>,z:int>,n:map<string,int>>")).orderBy("k").collect()
    assert out[0].asDict(True) == {"k": 1, "s": {"a": 1, "l": [None, {"x": 2, "y": None}], "z": None}, "n": None}
    assert out[1]["s"] is None


def test_nested_tables_grow_both_ways(spark, tmp_path):
    path, fqn = str(tmp_path / "t"), "nested_test"
    old = spark.createDataFrame([("p", 1, (1, [1]), {"a": 1.5})], "p string, k int, s struct<a:int,l:array<int>>, m map<string,float>")
    new = spark.createDataFrame([("q", 2**40, (2**41, [2**42], (True,)), {"b": 2.5})], "p string, k long, s struct<a:long,l:array<long>,`odd name`:struct<o:boolean>>, m map<string,double>")
    try:
        write_nested(spark, fqn, old, path, ["p"])
        write_nested(spark, fqn, new, path, ["p"])
        spark.sql(f"DROP TABLE {fqn}")  # as a run that died between leaving and entering the table
        write_nested(spark, fqn, old.withColumn("p", F.lit("r")), path, ["p"])
        got = {r["p"]: r.asDict(True) for r in spark.table(fqn).collect()}
        assert got["p"] == {"k": 1, "s": {"a": 1, "l": [1], "odd name": None}, "m": {"a": 1.5}, "p": "p"} == got["r"] | {"p": "p"}
        assert got["q"] == {"k": 2**40, "s": {"a": 2**41, "l": [2**42], "odd name": {"o": True}}, "m": {"b": 2.5}, "p": "q"}
        with pytest.raises(SchemaConflict):
            write_nested(spark, fqn, old.withColumn("k", F.lit("text")), path, ["p"])
        assert spark.table(fqn).count() == 3
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {fqn}")
