"""Queries over the test tables for what is kept between runs: sketches, stored partition rows, alerts without metrics."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepulse.functions.exprs import as_instant
from tablepulse.functions.partitioning import Partitioning
from tablepulse.operators import sketches as SK
from tablepulse.operators.alert_state import AlertState
from tablepulse.operators.drift import day_values
from tablepulse.operators.lattice import smallest_failing_segments
from tablepulse.operators.policy import evaluate, events_from_results
from tablepulse.operators.rowcounts import row_count_changes
from tablepulse.operators.uniqueness import pk_duplicates
from tablepulse.plans import demo
from tablepulse.plans.changed import FileTable, RunState, run_changed
from tablepulse.plans.profile import TableSpec, partition_info, run_profile, stored_rows
from tablepulse.session import checkpointed, work_path
from tablepulse.sinks.nested import write_nested
from tablepulse.sinks.publish import Publisher, PublishRefused
from tablepulse.sinks.writer import write_table
from tablepulse.sources.rules_asof import resolve_rules_asof
from tablepulse.sources.stats import history_from_column, partition_stats
from tablepulse.streaming.drift import closed_drift, daily_references, drift_stream, late_rows
from tablepulse.streaming.freshness import freshness_stream, use_timers

AS_OF = demo.AS_OF
DAY = Partitioning("ts", "day")


def fresh_table(spark: SparkSession, prefix: str) -> tuple[str, str]:
    """A name and a folder for a table of one query."""
    return f"tp_{prefix}_{uuid.uuid4().hex[:10]}", work_path(spark, prefix)


def taken(rows: DataFrame, *tables: str) -> DataFrame:
    """``rows`` read from tables that were made for a query only, which are dropped."""
    out = checkpointed(rows)
    for fqn in tables:
        rows.sparkSession.sql(f"DROP TABLE IF EXISTS {fqn}")
    return out


# ---------------------------------------------------------------- sketches
EVENT_KEYS = {"event": ["event_id"], "user": ["user_id"], "user_type": ["user_id", "event_type"]}


def q_sketch_distinct_ranges(spark, sf):
    """Distinct keys of each week that ends on a stored day, from stored sketches alone; beside them the exact counts,
    and whether the estimate is within four standard errors of them."""
    ev = demo.read(spark, sf, "events")
    fqn, path = fresh_table(spark, "sketches")
    SK.ensure_sketch_table(spark, fqn, path)
    SK.save_sketches(SK.partition_sketches(ev, "events", DAY, EVENT_KEYS, ts=AS_OF), fqn)
    merged = SK.distinct_keys(SK.trailing(SK.latest_sketches(spark.table(fqn)), 7), ["range_value"])
    exact = None
    for name, cols in EVENT_KEYS.items():
        keys = ev.select(F.to_date("ts").alias("_day"), *cols).distinct()
        weeks = keys.withColumn("_end", F.explode(F.sequence("_day", F.date_add("_day", 6)))).select("_end", *cols).distinct()
        n = weeks.groupBy("_end").agg(F.count(F.lit(1)).alias("exact_keys")).select(F.lit(name).alias("name"), F.date_format("_end", "yyyy-MM-dd").alias("range_value"), "exact_keys")
        exact = n if exact is None else exact.unionByName(n)
    close = F.abs(F.col("distinct_keys") - F.col("exact_keys")) <= 4 * SK.key_error() * F.col("exact_keys")
    out = merged.join(exact, ["name", "range_value"]).select("table_name", "name", "range_value", "partitions", "record_count", "exact_keys", close.alias("close"))
    return taken(out, fqn)


def q_pk_duplicates_stored(spark, sf):
    """Duplicate rules of three whole tables from their stored partition sketches."""
    fqn, path = fresh_table(spark, "sketches")
    SK.ensure_sketch_table(spark, fqn, path)
    tables = {t.name: t for t in demo.tables(spark, sf)}
    for name in ("events", "orders", "lineitem"):
        t = tables[name]
        SK.save_sketches(SK.partition_sketches(t.df, name, t.partitioning, {"pk": t.key_cols}, ts=AS_OF), fqn)
    rules = SK.pk_duplicates_stored(SK.latest_sketches(spark.table(fqn)), ts=AS_OF)
    return taken(rules.select("table_name", "partition_value", "rule_id", "passed", "sampled_rows", "severity", "expected"), fqn)


def q_drift_from_sketches(spark, sf):
    """Drift of two days against the week and the four weeks before them, whose rows are not read: the rows of the
    references, and whether every cut, every share of a reference and the score are as exact as the sketches promise."""
    ev, columns, today = demo.read(spark, sf, "events"), ["value", "user_id"], ["2024-01-15", "2024-01-30"]
    fqn, path = fresh_table(spark, "sketches")
    SK.ensure_sketch_table(spark, fqn, path)
    SK.save_sketches(SK.partition_sketches(ev, "events", DAY, values=columns, ts=AS_OF), fqn)
    stored = SK.latest_sketches(spark.table(fqn))
    found = checkpointed(SK.drift_from_sketches(ev, "events", DAY, columns, today, stored, ts=AS_OF))
    hist = checkpointed(SK.reference_histograms(SK.references_before("events", columns, today, stored, SK.DEFAULT_RANGES, SK.K)).drop("sketch"))
    # the same references from their rows
    rows = day_values(ev, "events", DAY, columns).withColumnRenamed("day", "ref_day")
    keys = ["column_name", "day", "range_name"]
    days = {r.name: r.days for r in SK.DEFAULT_RANGES}
    span = F.element_at(F.create_map(*[F.lit(x) for kv in days.items() for x in kv]), F.col("range_name"))
    near = (F.col("ref_day") < F.col("day")) & (F.col("ref_day") >= F.date_sub("day", span))
    # six small rows of cuts: a column, day and range each
    both = rows.join(F.broadcast(hist.select(*keys, "cuts", "shares")), "column_name").where(near)
    inside = [F.count_if(F.col("value") <= F.get("cuts", F.lit(i))) for i in range(9)]
    below = [F.count_if(F.col("value") < F.get("cuts", F.lit(i))) for i in range(9)]
    exact = both.groupBy(*keys, "shares").agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("k"), F.array(*inside).alias("inside"), F.array(*below).alias("below")
    )
    error = SK.rank_error() + 1 / SK.GRID
    wanted = [F.lit((i + 1) / 10) for i in range(9)]
    cuts_ok = F.lit(True)
    for i, r in enumerate(wanted):
        cuts_ok = cuts_ok & (F.col("below")[i] / F.col("k") <= r + error) & (F.col("inside")[i] / F.col("k") >= r - error)
    edges = [F.lit(0), *[F.col("inside")[i] for i in range(9)], F.col("k")]
    shares_ok = F.abs(F.col("shares")[10] - (F.col("n") - F.col("k")) / F.col("n")) < 1e-9
    for i in range(10):
        shares_ok = shares_ok & (F.abs(F.col("shares")[i] - (edges[i + 1] - edges[i]) / F.col("n")) <= 2 * error)
    checked = exact.select(*keys, "n", cuts_ok.alias("cuts_ok"), shares_ok.alias("shares_ok"))
    scored = found.select(
        F.col("details")["column"].alias("column_name"), F.col("partition_value").cast("date").alias("day"), F.col("reference").alias("range_name"),
        "metric_name", F.col("details")["reference_rows"].cast("long").alias("reference_rows"), (F.col("score") >= 0).alias("scored"),
    )
    out = scored.join(checked, keys).select(
        "metric_name", F.date_format("day", "yyyy-MM-dd").alias("partition_value"), "reference_rows", (F.col("n") == F.col("reference_rows")).alias("rows_ok"),
        "cuts_ok", "shares_ok", "scored",
    )
    return taken(out, fqn)


def q_cuts_from_sketches(spark, sf):
    """Saved cuts made from stored sketches, and whether each is within the sketches' rank error of its quantile."""
    ev = demo.read(spark, sf, "events")
    fqn, path = fresh_table(spark, "sketches")
    SK.ensure_sketch_table(spark, fqn, path)
    SK.save_sketches(SK.partition_sketches(ev, "events", DAY, values=["value"], ts=AS_OF), fqn)
    cuts = SK.stored_cuts(SK.latest_sketches(spark.table(fqn)), 10, AS_OF)
    each = cuts.select("partition_value", F.posexplode("cuts").alias("idx", "cut"))
    rows = ev.select(DAY.value().alias("partition_value"), "value").where(F.col("value").isNotNull() & ~F.isnan("value"))
    n = F.count(F.lit(1))
    ranked = rows.join(each, "partition_value").groupBy("partition_value", "idx").agg(
        n.alias("rows"), (F.count_if(F.col("value") < F.col("cut")) / n).alias("below"), (F.count_if(F.col("value") <= F.col("cut")) / n).alias("inside")
    )
    rank, error = (F.col("idx") + 1) / 10, SK.rank_error()
    ok = (F.col("below") <= rank + error) & (F.col("inside") >= rank - error)
    return taken(ranked.select("partition_value", F.col("idx").cast("int").alias("idx"), "rows", ok.alias("close")), fqn)


# ---------------------------------------------------------------- runs with stored history
def q_run_partition_stored(spark, sf):
    """A run over one day that knows the other days only from the stored partition tables."""
    ev, day = demo.read(spark, sf, "events"), "2024-01-20"
    earlier = ev.where(F.col("ts") < F.lit(day).cast("timestamp_ntz"))
    (stats_fqn, stats_path), (info_fqn, info_path) = fresh_table(spark, "pstats"), fresh_table(spark, "pinfo")
    write_table(spark, stats_fqn, partition_stats(earlier, "events", DAY), path=stats_path)
    write_table(spark, info_fqn, partition_info(spark, [TableSpec("events", earlier, DAY, average_columns=["value"])]), path=info_path)
    stored = stored_rows(spark.table(stats_fqn), spark.table(info_fqn))
    spec = TableSpec("events", ev, DAY, expected=demo.EVENT_DAYS, null_columns=["value"], average_columns=["value"], partitions=[day], stored=stored)
    alone = TableSpec("alone", ev, DAY, average_columns=["value"], partitions=[day])
    found = run_profile(spark, [spec, alone], as_of=AS_OF).findings().withColumn("value", F.round("value", 6))
    return taken(found, stats_fqn, info_fqn)


def q_alerts_without_snapshots(spark, sf):
    """Freshness decisions of a table with snapshots and of two that have none."""
    ev = demo.read(spark, sf, "events")
    history = history_from_column(ev, "events", "ts")
    specs = [TableSpec(n, demo.read(spark, sf, n), history=history) for n in ("events", "labels", "pages")]
    p = run_profile(spark, specs, mode="availability", as_of=AS_OF)
    d = evaluate(events_from_results(p.metrics, p.drift, AS_OF, p.rules), demo.rules(spark), demo.RULES_ROWS)
    return d.select("behavior", "table_name", "severity", "status", "reason", "message", "threshold", "alert_key")


def q_run_changed_files(spark, sf):
    """A table of four folders is profiled; one folder goes, one is replaced, one is added; a second run reads what
    changed. Its findings, and the partitions that it read again."""
    ev, (prefix, folder) = demo.read(spark, sf, "events"), fresh_table(spark, "changed")
    day, data = F.to_date("ts"), work_path(spark, "changed_data")

    def put(name: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{data}/{name}")

    def run(names: str):
        root = f"{data}/{{{names}}}"
        spec = TableSpec(
            "events", spark.read.parquet(root), DAY, expected=demo.EVENT_DAYS, key_cols=["event_id"], drift_columns=["value"],
            null_columns=["value", "props"], average_columns=["value"], time_column="ts", segment_column="value", segment_dims=["event_type"],
        )
        return run_changed(spark, [FileTable(spec, root)], state, AS_OF)

    state = RunState(spark, prefix, folder)
    put("a", ev.where(day <= "2024-01-10"))
    put("b", ev.where(day.between("2024-01-11", "2024-01-12")))
    put("c", ev.where(day.between("2024-01-13", "2024-01-20")))
    run("a,b,c")
    put("c", ev.where(day.between("2024-01-13", "2024-01-20") & (F.col("event_id") % 2 == 0)))
    put("d", ev.where(day > "2024-01-20"))
    second = run("a,c,d")
    again = [(p,) for p in second.affected["events"]]
    read = spark.createDataFrame(again, "partition_value string").select(
        F.lit("read again").alias("kind"), F.lit("events").alias("table_name"), "partition_value", *[F.lit(None).cast(t).alias(n) for n, t in (("name", "string"), ("value", "double"), ("passed", "boolean"), ("severity", "string"))]
    )
    found = second.profile.findings().unionByName(read)
    return taken(found.withColumn("value", F.round("value", 6)), *state.tables())


# ---------------------------------------------------------------- streams with state
def _replayed(spark: SparkSession, parts: list[DataFrame], name: str) -> tuple[DataFrame, str]:
    """A stream that brings the parts one after the other, a micro-batch each, and a folder for its output."""
    data = work_path(spark, name)
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{data}/in/{i}")
    stream = spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{data}/in/*")
    return stream, data


def _stream_to_end(out: DataFrame, folder: str) -> DataFrame:
    spark = out.sparkSession
    use_timers(spark)
    try:
        query = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True)
        query.start(f"{folder}/out").awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    return spark.read.parquet(f"{folder}/out")


def q_stream_freshness(spark, sf):
    """The table is replayed in four parts; each user's feed is stale after a day without events."""
    ev = demo.read(spark, sf, "events")
    day = F.dayofmonth("ts")
    stream, folder = _replayed(spark, [ev.where((day > 8 * i) & (day <= 8 * i + 8)) for i in range(4)], "stream_freshness")
    feed = F.concat(F.lit("user_"), F.col("user_id"))
    out = _stream_to_end(freshness_stream(stream, feed, "ts", 24 * 60), folder)
    return out.select("table_name", "status", F.date_format("at", "yyyy-MM-dd HH:mm").alias("at"))


def q_stream_drift(spark, sf):
    """The table is replayed in three parts of ten days and a last one of rows that come late: the drift of each closed
    day, and the late rows."""
    ev = demo.read(spark, sf, "events")
    day, late = F.dayofmonth("ts"), (F.col("event_id") % 50 == 0) & (F.dayofmonth("ts") <= 20)
    parts = [ev.where((day > 10 * i) & (day <= 10 * i + 10) & ~late) for i in range(3)]
    stream, folder = _replayed(spark, [*parts, ev.where(late)], "stream_drift")
    references = checkpointed(daily_references(day_values(ev, "events", DAY, ["value"])))
    closed = _stream_to_end(drift_stream(stream, "events", DAY, ["value"], references, references.count()), folder)
    drifted = closed_drift(closed, references, ts=AS_OF).select("partition_value", "metric_name", F.round("score", 6).alias("value"), "severity")
    lost = late_rows(closed).select("partition_value", "metric_name", F.col("metric_value").alias("value"), F.lit(None).cast("string").alias("severity"))
    return drifted.unionByName(lost)


# ---------------------------------------------------------------- alerts over runs, settings over time
ALERT_DAYS = ["2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05"]


def _day_decisions(spark: SparkSession, sf: str, day: str) -> DataFrame:
    """Decisions of one day's run: the change of each group's rows against the day before."""
    ev = demo.read(spark, sf, "events").withColumn("day", F.to_date("ts"))
    pair = ev.where(F.col("day").between(F.date_sub(F.lit(day).cast("date"), 1), F.lit(day).cast("date")))
    group = F.concat_ws("_", "event_type", F.col("user_id") % 6)
    stats = pair.groupBy(group.alias("table_name"), F.date_format("day", "yyyy-MM-dd").alias("partition_value")).agg(F.count(F.lit(1)).alias("record_count"))
    changes = row_count_changes(stats, as_of=day)
    return evaluate(events_from_results(changes, None, f"{day}T12:00:00Z"))


def q_alert_state_runs(spark, sf):
    """Four daily runs with a cap of five alerts each: what each run sends, and the state that is left after the last."""
    prefix, folder = fresh_table(spark, "alerts")
    state = AlertState(spark, prefix, folder)
    sent = None
    for day in ALERT_DAYS:
        ts = f"{day}T12:00:00Z"
        out = state.run(_day_decisions(spark, sf, day), ts, 5)
        part = out.select(F.lit(day).alias("run"), "table_name", F.col("waiting").alias("what"), F.lit(None).cast("long").alias("runs"))
        sent = part if sent is None else sent.unionByName(part)
    left = state.read("alerts").select(F.lit("state").alias("run"), "table_name", F.concat_ws("/", "status", F.coalesce("waiting", F.lit("-"))).alias("what"), "runs")
    return taken(sent.unionByName(left), *state.tables())


#: settings of the query below: (table, behaviour, enabled, threshold, severity, from)
TIMED_SETTINGS = [
    (None, "row_count_dod", None, 0.30, "WARN", "2024-01-01 00:00:00"),
    (None, "row_count_dod", None, 0.50, None, "2024-01-12 06:00:00"),
    ("click", "row_count_dod", None, 0.10, "CRITICAL", "2024-01-05 00:00:00"),
    ("click", "row_count_dod", False, None, None, "2024-01-10 12:30:00"),
    ("click", "row_count_dod", True, 0.20, None, "2024-01-10 18:00:00"),
    ("view", "row_count_dod", None, None, "INFO", "2024-01-20 23:59:59"),
]


def q_rules_asof(spark, sf):
    """Settings that hold at the time of each event of the table, as events of its type's row count."""
    rows = [(t, b, e, x, None, sev, at) for t, b, e, x, sev, at in TIMED_SETTINGS]
    settings = spark.createDataFrame(rows, "table_name string, behavior string, enabled boolean, threshold double, stale_hours int, severity string, at string")
    settings = settings.withColumn("valid_from", F.col("at").cast("timestamp")).drop("at")
    ev = demo.read(spark, sf, "events")
    events = ev.select("event_id", F.col("event_type").alias("table_name"), F.lit("row_count_dod").alias("behavior"), as_instant(F.col("ts"), ev.schema["ts"].dataType).alias("ts"))
    return resolve_rules_asof(events, settings).select("event_id", "table_name", "enabled", "threshold", "severity")


# ---------------------------------------------------------------- segments
def _segments(spark: SparkSession, sf: str):
    docs = demo.read(spark, sf, "documents").join(demo.read(spark, sf, "labels"), "doc_id", "left")
    docs = docs.withColumn("size", F.floor(F.log10(F.col("n_chars") + 1))).withColumn("third", F.col("doc_id") % 3)
    return smallest_failing_segments(docs, "quality", ["lang", "source", "size", "third"], 0.7, 15)


def q_failing_segments(spark, sf):
    """The smallest combinations of four dimensions with more than 70 % of unlabelled documents."""
    return _segments(spark, sf).segments.withColumn("null_rate", F.round("null_rate", 6))


def q_failing_segments_levels(spark, sf):
    """How many segments each level of the search looked at."""
    return _segments(spark, sf).levels


# ---------------------------------------------------------------- publishing, nested schemas
def q_publish_checked(spark, sf):
    """Months are published after a check, a month with repeated keys is refused, other months are replaced, and one
    publication is taken back."""
    fqn, folder = fresh_table(spark, "publish")
    orders = demo.read(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    table = Publisher(spark, fqn, "month", folder)

    def unique(staged: DataFrame) -> DataFrame:
        return pk_duplicates(staged, ["o_orderkey"], fqn, ts=AS_OF)

    in_1998 = orders.where(F.col("month").startswith("1998"))
    table.publish(orders, [unique])
    refused = 0
    try:
        table.publish(in_1998.unionByName(in_1998), [unique])
    except PublishRefused:
        refused = 1
    table.publish(in_1998.where("o_orderstatus = 'F'"), [unique])
    table.revert(table.publish(orders.where(F.col("month").startswith("1997")).withColumn("o_totalprice", F.lit(0.0)), [unique]))
    return taken(spark.table(fqn).withColumn("refused", F.lit(refused)), *table.tables())


def q_write_nested(spark, sf):
    """Orders as nested rows are appended in three shapes (old, wider with new fields, old again) and read back flat."""
    fqn, folder = fresh_table(spark, "nested")
    o = demo.read(spark, sf, "orders").where(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    key, line = F.col("o_orderkey"), F.col("o_custkey").cast("int")
    price = F.struct(F.floor("o_totalprice").cast("int").alias("whole"), F.col("o_orderstatus").alias("status"))
    narrow = o.where(key % 3 != 1).select(
        key.cast("int").alias("k"), price.alias("price"), F.array(F.struct(line.alias("cust"))).alias("lines"), F.create_map(F.lit("n"), line).alias("tags")
    )
    more = F.struct(F.lit(5_000_000_000).alias("whole"), F.struct(F.col("o_orderpriority").alias("name")).alias("priority"))
    wide = o.where(key % 3 == 1).select(
        key.alias("k"), more.alias("price"), F.array(F.struct(F.col("o_custkey").alias("cust"), F.lit("x").alias("note"))).alias("lines"),
        F.create_map(F.lit("n"), F.col("o_custkey") + 5_000_000_000).alias("tags"), F.lit("late").alias("batch"),
    )
    write_nested(spark, fqn, narrow.where(key % 3 == 0), folder)
    write_nested(spark, fqn, wide, folder)
    write_nested(spark, fqn, narrow.where(key % 3 == 2), folder)
    t = spark.table(fqn)
    flat = t.select(
        "k", F.col("price.whole").alias("whole"), F.col("price.status").alias("status"), F.col("price.priority.name").alias("priority"),
        F.col("lines")[0]["cust"].alias("cust"), F.col("lines")[0]["note"].alias("note"), F.col("tags")["n"].alias("tag"), "batch",
    )
    return taken(flat, fqn)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sketch_distinct_ranges": q_sketch_distinct_ranges,
    "pk_duplicates_stored": q_pk_duplicates_stored,
    "drift_from_sketches": q_drift_from_sketches,
    "cuts_from_sketches": q_cuts_from_sketches,
    "run_partition_stored": q_run_partition_stored,
    "alerts_without_snapshots": q_alerts_without_snapshots,
    "run_changed_files": q_run_changed_files,
    "stream_freshness": q_stream_freshness,
    "stream_drift": q_stream_drift,
    "alert_state_runs": q_alert_state_runs,
    "rules_asof": q_rules_asof,
    "failing_segments": q_failing_segments,
    "failing_segments_levels": q_failing_segments_levels,
    "publish_checked": q_publish_checked,
    "write_nested": q_write_nested,
}
