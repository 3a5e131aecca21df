"""Queries over the bundled test tables, one per operator (keys of ``queries()``).

Each takes ``(spark, sf_dir)`` and returns a DataFrame with flat columns
(dates and timestamps as text, arrays joined, doubles that come from sums
rounded to 6 places) so that an SQL engine can produce the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepulse import schemas as S
from tablepulse.functions.exprs import as_instant
from tablepulse.functions.partitioning import Partitioning
from tablepulse.operators import availability as A
from tablepulse.operators import dispatch as D
from tablepulse.operators.averages import average_change
from tablepulse.operators.drift import (
    compute_cuts,
    drift,
    drift_with_cuts,
    histograms,
    long_values,
    materialize_cuts,
    psi_scores,
)
from tablepulse.operators.nulls import null_ratio_by_partition, segment_nulls
from tablepulse.operators.policy import evaluate, events_from_results
from tablepulse.operators.rowcounts import row_count_change_by_date, row_count_changes
from tablepulse.operators.sampling import sample_bernoulli, sample_by_key
from tablepulse.operators.uniqueness import duplicate_keys, pk_duplicates
from tablepulse.plans import demo
from tablepulse.plans.alerts import run_alerts
from tablepulse.plans.profile import (
    Profile,
    TableSpec,
    partition_info,
    partition_null_stats,
    partition_status,
    run_profile,
    write_results,
)
from tablepulse.sinks import storage as K
from tablepulse.sinks import writer as W
from tablepulse.session import checkpointed, work_path
from tablepulse.sources import readers as R
from tablepulse.sources.cuts import latest_cuts
from tablepulse.sources.rules import resolve_rules
from tablepulse.sources.scan import scan_partition, scan_partitions
from tablepulse.sources.stats import (
    history_from_column,
    history_from_files,
    latest_snapshot,
    partition_stats,
    stats_from_metadata,
)

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = demo.AS_OF
DAY = Partitioning("ts", "day")


def _txt_date(c: str) -> Column:
    return F.date_format(F.col(c), "yyyy-MM-dd").alias(c)


def _txt_ts(c: str) -> Column:
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)


def _r6(c: str, name: str | None = None) -> Column:
    return F.round(F.col(c), 6).alias(name or c)


def flat_metrics(m: DataFrame) -> DataFrame:
    return m.select("table_name", "partition_value", _txt_date("metric_date"), "metric_name", _r6("metric_value"))


def flat_rules(r: DataFrame) -> DataFrame:
    return r.select(
        "table_name", "partition_value", "rule_id", "passed", _r6("fail_rate"), "sampled_rows", "severity", "observed",
        "expected", F.array_join("examples", ",").alias("examples"),
    )


def flat_drift(d: DataFrame) -> DataFrame:
    return d.select(
        "table_name", "partition_value", "metric_name", _r6("score"), "severity", "reference",
        F.col("details")["reference_partition"].alias("reference_partition"),
    )


def flat_decisions(d: DataFrame) -> DataFrame:
    return d.select(
        "behavior", "table_name", "partition_value", _r6("actual"), "threshold", "severity", "message", "status",
        "reason", "alert_key",
    )


# ---------------------------------------------------------------- shared parts
def _stats(spark: SparkSession, sf: str) -> DataFrame:
    t = {x.name: x for x in demo.tables(spark, sf)}
    return (
        partition_stats(t["events"].df, "events", t["events"].partitioning)
        .unionByName(partition_stats(t["orders"].df, "orders", t["orders"].partitioning))
        .unionByName(partition_stats(t["lineitem"].df, "lineitem", t["lineitem"].partitioning))
    )


def _history(spark: SparkSession, sf: str) -> DataFrame:
    return (
        history_from_column(demo.read(spark, sf, "events"), "events", "ts")
        .unionByName(history_from_column(demo.read(spark, sf, "orders"), "orders", "o_orderdate"))
        .unionByName(history_from_column(demo.read(spark, sf, "lineitem"), "lineitem", "l_shipdate"))
    )


def _counts(spark: SparkSession, sf: str) -> DataFrame:
    exp = A.expected_partitions(spark, {"events": demo.EVENT_DAYS, "orders": demo.ORDER_MONTHS})
    return A.partition_counts(_stats(spark, sf), exp, len(demo.EVENT_DAYS) + len(demo.ORDER_MONTHS))


def _profile(spark: SparkSession, sf: str, mode: str = "all") -> Profile:
    return run_profile(spark, demo.tables(spark, sf), mode=mode, as_of=AS_OF)


def _decisions(spark: SparkSession, sf: str) -> DataFrame:
    p = _profile(spark, sf)
    ev = events_from_results(p.metrics, p.drift, AS_OF)
    return evaluate(ev, demo.rules(spark), demo.RULES_ROWS)


def _events_value_cuts(spark: SparkSession, sf: str, bins: int = 10) -> DataFrame:
    return compute_cuts(long_values(demo.read(spark, sf, "events"), "events", DAY, ["value", "user_id"]), bins)


def _explode_cuts(c: DataFrame) -> DataFrame:
    return c.select("table_name", "column_name", "partition_value", F.posexplode("cuts").alias("idx", "cut")).select(
        "table_name", "column_name", "partition_value", F.col("idx").cast("int").alias("idx"), "cut"
    )


def _views(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {n: demo.read(spark, sf, n) for n in ("orders", "lineitem")}


# ---------------------------------------------------------------- sources
def q_scan_partitions(spark, sf):
    ev = demo.read(spark, sf, "events")
    rows = scan_partitions(ev, DAY, demo.days("2024-01-24", "2024-01-30"))
    return rows.select("event_id", DAY.value().alias("partition_value"), "event_type", "value")


def q_scan_reference_day(spark, sf):
    ev = demo.read(spark, sf, "events")
    return scan_partition(ev, DAY, "2024-01-07").select("event_id", DAY.value().alias("partition_value"), "user_id", "value")


def q_partition_stats(spark, sf):
    return _stats(spark, sf)


def q_latest_snapshot(spark, sf):
    return latest_snapshot(_history(spark, sf)).select("table_name", _txt_ts("made_current_at"))


def q_source_sql_views(spark, sf):
    sql = (
        "SELECT o_orderstatus, count(*) AS orders, min(o_totalprice) AS min_price, max(o_totalprice) AS max_price "
        "FROM orders GROUP BY o_orderstatus"
    )
    return R.read_sql(spark, sql, _views(spark, sf))


def q_source_dispatch(spark, sf):
    sql = "SELECT l_returnflag, l_linestatus, count(*) AS line_count FROM lineitem GROUP BY l_returnflag, l_linestatus"
    return R.read_source(spark, {"reader": "Catalog"}, sql, _views(spark, sf))


def q_source_check(spark, sf):
    return R.source_check(R.read_source(spark, {"reader": "sql"}, "SELECT o_orderkey FROM orders", _views(spark, sf)))


def q_resolve_rules(spark, sf):
    p = _profile(spark, sf)
    ev = events_from_results(p.metrics, p.drift, AS_OF)
    r = resolve_rules(ev, demo.rules(spark), demo.RULES_ROWS)
    return r.select(
        "behavior", "table_name", "partition_value", F.col("extra")["metric"].alias("metric"),
        F.col("extra")["column"].alias("column_name"), F.col("extra")["reference"].alias("reference"),
        "enabled", "severity", "threshold", "stale_hours",
    )


def q_load_cuts(spark, sf):
    old = _events_value_cuts(spark, sf, 4).withColumn("created_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    new = _events_value_cuts(spark, sf, 10).withColumn("created_at", F.lit("2024-01-31 12:00:00").cast("timestamp"))
    return _explode_cuts(latest_cuts(old.unionByName(new)))


# ---------------------------------------------------------------- sampling / projection
def q_sample_bernoulli(spark, sf):
    """The sample's share of the table is near the fraction (six standard deviations), and all its rows are the table's."""
    rows = demo.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    keys = rows.columns
    sampled = sample_bernoulli(rows).groupBy(*keys).agg(F.count(F.lit(1)).alias("sampled"))
    both = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).join(sampled, keys, "full")
    n, k, p = F.sum("n"), F.coalesce(F.sum("sampled"), F.lit(0)), S.SAMPLE_FRACTION
    return both.agg(
        n.alias("table_rows"),
        (F.abs(k - n * p) <= 6 * F.sqrt(n * (p * (1 - p)))).alias("share_ok"),
        F.count_if(F.coalesce("sampled", F.lit(0)) > F.coalesce("n", F.lit(0))).alias("foreign_rows"),
    )


def q_sample_by_key(spark, sf):
    return sample_by_key(demo.read(spark, sf, "orders"), ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_totalprice")


def q_store_projection(spark, sf):
    r = A.availability_rules(_counts(spark, sf), AS_OF).unionByName(
        pk_duplicates(demo.read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem", ts=AS_OF)
    )
    s = K.to_storage(r, "rules")
    return s.select(
        "table_name", "partition_value", "rule_id", "passed", _r6("fail_rate"), "sampled_rows", "severity", "observed",
        "expected", F.array_join("examples", ",").alias("examples"), _txt_ts("ts"), _txt_date("ts_date"),
    )


def q_encode_json(spark, sf):
    return K.encode_json(A.availability_metrics(_counts(spark, sf), "ts", AS_OF), "metrics")


# ---------------------------------------------------------------- checks
def q_availability_metrics(spark, sf):
    return flat_metrics(A.availability_metrics(_counts(spark, sf), None, AS_OF))


def q_availability_rules(spark, sf):
    return flat_rules(A.availability_rules(_counts(spark, sf), AS_OF))


def q_freshness_metrics(spark, sf):
    return flat_metrics(A.freshness_metrics(latest_snapshot(_history(spark, sf)), AS_OF))


def q_freshness_rules(spark, sf):
    names = ["events", "orders", "lineitem", "labels"]
    return flat_rules(A.freshness_rules(A.table_list(spark, names), _history(spark, sf), AS_OF, S.SLA_HOURS, AS_OF, 4))


def q_row_count_dod(spark, sf):
    m = row_count_changes(_stats(spark, sf), as_of=AS_OF)
    return flat_metrics(m.where(F.col("metric_name") == "row_count_dod_delta"))


def q_row_count_wow(spark, sf):
    m = row_count_changes(_stats(spark, sf), as_of=AS_OF)
    return flat_metrics(m.where(F.col("metric_name") == "row_count_wow_delta"))


def q_row_count_wow_by_date(spark, sf):
    st = partition_stats(demo.read(spark, sf, "events"), "events", DAY)
    return flat_metrics(row_count_change_by_date(st, 7))


def q_pk_duplicates_unique(spark, sf):
    return flat_rules(pk_duplicates(demo.read(spark, sf, "orders"), ["o_orderkey"], "orders", ts=AS_OF))


def q_pk_duplicates_composite(spark, sf):
    return flat_rules(
        pk_duplicates(demo.read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem", ts=AS_OF)
    )


def q_pk_duplicate_keys(spark, sf):
    return duplicate_keys(demo.read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem")


def q_pk_duplicates_approx(spark, sf):
    """The approximate rule, and whether its rate is within three standard errors of the exact one."""
    rows, keys, rsd = demo.read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], 0.05
    approx = pk_duplicates(rows, keys, "lineitem", method="approx", rsd=rsd, tolerance=0.01, ts=AS_OF)
    exact = pk_duplicates(rows, keys, "lineitem", ts=AS_OF).select("table_name", F.col("fail_rate").alias("exact_rate"))
    close = F.abs(F.col("fail_rate") - F.col("exact_rate")) <= 3 * rsd
    return approx.join(exact, "table_name").select("table_name", "rule_id", "passed", "sampled_rows", close.alias("close"))


def q_null_ratio_by_partition(spark, sf):
    m = null_ratio_by_partition(demo.documents_with_labels(spark, sf), "documents", "lang", ["quality", "toxic"], AS_OF)
    return m.select(
        "table_name", "partition_value", _txt_date("metric_date"), "metric_name",
        F.col("details")["column"].alias("column_name"), _r6("metric_value"),
    )


def q_average_change(spark, sf):
    t = {x.name: x for x in demo.tables(spark, sf)}
    m = average_change(t["events"].df, "events", DAY, ["value"], AS_OF).unionByName(
        average_change(t["orders"].df, "orders", t["orders"].partitioning, ["o_totalprice"], AS_OF)
    )
    return m.select(
        "table_name", "partition_value", _txt_date("metric_date"), "metric_name",
        F.col("details")["column"].alias("column_name"), _r6("metric_value"),
    )


def q_segment_nulls(spark, sf):
    df = demo.documents_with_labels(spark, sf)
    return flat_rules(segment_nulls(df, "quality", ["lang", "source", "geo_value"], 0.2, "documents", AS_OF))


def q_segment_nulls_null_segment(spark, sf):
    df = demo.with_null_segment(demo.documents_with_labels(spark, sf))
    return flat_rules(segment_nulls(df, "quality", ["lang"], 0.6, "documents", AS_OF))


# ---------------------------------------------------------------- drift
def q_reference_cuts(spark, sf):
    return _explode_cuts(_events_value_cuts(spark, sf))


def q_histogram_shares(spark, sf):
    vals = long_values(demo.read(spark, sf, "events"), "events", DAY, ["value"])
    cuts, n, m = materialize_cuts(compute_cuts(vals))
    h = histograms(vals, cuts, cuts_rows=n, max_cuts=m)
    return h.select("table_name", "column_name", "cut_partition", "partition_value", "bucket", "rows", _r6("share"))


def q_psi_score(spark, sf):
    vals = long_values(demo.read(spark, sf, "events"), "events", DAY, ["value", "user_id"])
    cuts, n, m = materialize_cuts(compute_cuts(vals))
    s = psi_scores(histograms(vals, cuts, cuts_rows=n, max_cuts=m))
    return s.select("table_name", "column_name", "partition_value", "reference_partition", "ref_name", _r6("score"))


def q_drift_dod_wow(spark, sf):
    return flat_drift(drift(demo.read(spark, sf, "events"), "events", DAY, ["value"], today="2024-01-08", ts=AS_OF))


def q_drift_multi_column(spark, sf):
    ev = drift(demo.read(spark, sf, "events"), "events", DAY, ["value", "user_id"], ts=AS_OF)
    li = drift(demo.read(spark, sf, "lineitem"), "lineitem", Partitioning("l_shipdate", "day"),
               ["l_extendedprice", "l_discount"], ts=AS_OF)
    return flat_drift(ev.unionByName(li))


def q_drift_with_saved_cuts(spark, sf):
    saved = (
        _events_value_cuts(spark, sf, 5)
        .where(F.col("column_name") == "value")
        .where(F.col("partition_value") < "2024-01-15")
        .withColumn("created_at", F.lit("2024-01-15 00:00:00").cast("timestamp"))
    )
    return flat_drift(drift(demo.read(spark, sf, "events"), "events", DAY, ["value"], saved_cuts=saved, ts=AS_OF))


# ---------------------------------------------------------------- policy
def q_events_from_results(spark, sf):
    p = _profile(spark, sf)
    ev = events_from_results(p.metrics, p.drift, AS_OF)
    return ev.select(
        "behavior", "table_name", "partition_value", F.map_keys("metrics")[0].alias("metric_key"),
        F.round(F.map_values("metrics")[0], 6).alias("metric_value"), F.col("extra")["metric"].alias("metric"),
        F.col("extra")["column"].alias("column_name"), F.col("extra")["reference"].alias("reference"),
    )


def _policy(behavior: str | None = None, status: str | None = None) -> Query:
    def q(spark, sf):
        d = _decisions(spark, sf)
        if behavior is not None:
            d = d.where(F.col("behavior") == behavior)
        if status is not None:
            d = d.where(F.col("status") == status)
        return flat_decisions(d)

    return q


def q_alert_key(spark, sf):
    return _decisions(spark, sf).select("behavior", "table_name", "partition_value", "alert_key")


def _level(ch: D.Channel) -> Query:
    return lambda spark, sf: flat_decisions(D.level_filter(_decisions(spark, sf), ch.level))


def _alert_cols(a: DataFrame) -> DataFrame:
    return a.select("alert_key", "behavior", "table_name", "partition_value", "severity", "message", _r6("actual"))


def q_alerts_dedup(spark, sf):
    return _alert_cols(D.dedup_alerts(D.sendable(_decisions(spark, sf), "detailed")))


def q_alert_batches(spark, sf):
    a = D.dedup_alerts(D.sendable(_decisions(spark, sf), "advanced"))
    return D.number_batches(a, S.BATCH_SIZE).select("alert_key", "severity", "seq", "batch_no", "position")


def q_alert_rate_limit(spark, sf):
    return D.messages(_decisions(spark, sf), demo.CHANNEL_DETAILED).select("batch_no", "alerts", "text", "items")


def q_alert_text(spark, sf):
    a = D.sendable(_decisions(spark, sf), "advanced")
    return a.select("alert_key", "behavior", "table_name", "partition_value", D.render_text(demo.CHANNEL_ADVANCED).alias("text"))


def q_batch_text(spark, sf):
    return D.messages(_decisions(spark, sf), demo.CHANNEL_ADVANCED, cap=False).select("batch_no", "alerts", "text", "items")


def q_alert_payload(spark, sf):
    m = D.messages(_decisions(spark, sf), demo.CHANNEL_ADVANCED, cap=False)
    blocks = F.from_json("blocks", "array<struct<type:string,text:struct<type:string,text:string>>>")
    m = m.withColumn("_b", blocks)
    return m.select(
        "batch_no", "alerts", F.size("_b").alias("blocks"), F.col("_b")[0]["text"]["text"].alias("first_text"),
        F.get("_b", F.lit(1))["text"]["text"].alias("second_text"),
    )


def q_audit_rows(spark, sf):
    return D.audit_rows(_decisions(spark, sf), "advanced")


def q_messages_dry_run(spark, sf):
    return D.dry_run(_decisions(spark, sf), demo.CHANNEL_DETAILED).select("batch_no", "alerts", "text", "items")


# ---------------------------------------------------------------- sinks
def _tables(spark: SparkSession, kinds: list[str]) -> dict[str, str]:
    import uuid

    tag = uuid.uuid4().hex[:10]
    loc = work_path(spark, "tables")
    names = {k: f"tp_{k}_{tag}" for k in kinds}
    return K.ensure_tables(spark, names, location=loc)


def _taken(rows: DataFrame, *tables: str) -> DataFrame:
    """``rows`` read from tables that were made for a query only, which are dropped."""
    out = checkpointed(rows)
    for fqn in tables:
        rows.sparkSession.sql(f"DROP TABLE IF EXISTS {fqn}")
    return out


def _profile_results(spark: SparkSession, sf: str, mode: str) -> Profile:
    return run_profile(spark, demo.tables(spark, sf), mode=mode, as_of=AS_OF)


def q_sink_tables(spark, sf):
    names = _tables(spark, ["metrics", "rules", "drift", "cuts"])
    p = _profile_results(spark, sf, "availability")
    K.append_results(p.metrics, "metrics", names["metrics"])
    K.append_results(p.rules, "rules", names["rules"])
    rows = [
        spark.table(fqn).groupBy().agg(F.count(F.lit(1)).alias("rows")).select(F.lit(k).alias("kind"), "rows")
        for k, fqn in names.items()
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return _taken(out, *names.values())


def q_sink_metrics(spark, sf):
    names = _tables(spark, ["metrics"])
    K.append_results(_profile_results(spark, sf, "availability").metrics, "metrics", names["metrics"])
    return _taken(flat_metrics(spark.table(names["metrics"])), names["metrics"])


def q_sink_rules(spark, sf):
    names = _tables(spark, ["rules"])
    K.append_results(_profile_results(spark, sf, "rules").rules, "rules", names["rules"])
    return _taken(flat_rules(spark.table(names["rules"])), names["rules"])


def q_sink_drift(spark, sf):
    names = _tables(spark, ["drift"])
    d = drift(demo.read(spark, sf, "events"), "events", DAY, ["value"], ts=AS_OF)
    K.append_results(d, "drift", names["drift"])
    return _taken(flat_drift(spark.table(names["drift"])), names["drift"])


def q_sink_ndjson(spark, sf):
    base = work_path(spark, "ndjson")
    path = K.write_ndjson(A.availability_metrics(_counts(spark, sf), "ts", AS_OF), "metrics", base, AS_OF)
    return K.read_ndjson(spark, path)


def q_sink_audit(spark, sf):
    base = work_path(spark, "audit")
    path = K.write_ndjson(D.audit_rows(_decisions(spark, sf), "basic"), "audit", base, AS_OF, "alerts_audit")
    return K.read_ndjson(spark, path)


def q_save_cuts(spark, sf):
    names = _tables(spark, ["cuts"])
    _, new = drift_with_cuts(demo.read(spark, sf, "events"), "events", DAY, ["value"], ts=AS_OF)
    K.save_cuts(new, names["cuts"])
    return _taken(_explode_cuts(latest_cuts(spark.table(names["cuts"]))), names["cuts"])


def _order_stats(spark: SparkSession, sf: str) -> DataFrame:
    o = demo.read(spark, sf, "orders")
    return o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("max_price")
    )


def q_align_to_schema(spark, sf):
    target = S._schema(("month", S.STR), ("o_orderstatus", S.STR), ("orders", S.LONG), ("note", S.STR), ("min_price", S.DBL))
    return W.align_to_schema(_order_stats(spark, sf), target)


def _new_table(spark: SparkSession, prefix: str) -> tuple[str, str]:
    import uuid

    return f"tp_{prefix}_{uuid.uuid4().hex[:10]}", work_path(spark, prefix)


def q_add_missing_columns(spark, sf):
    fqn, path = _new_table(spark, "evolve")
    st = _order_stats(spark, sf)
    W.write_table(spark, fqn, st.select("month", "o_orderstatus", "orders"), partition_by=["month"], path=path)
    W.add_missing_columns(spark, fqn, st)
    return _taken(spark.table(fqn).select("month", "o_orderstatus", "orders", "max_price"), fqn)


def q_write_create(spark, sf):
    fqn, path = _new_table(spark, "create")
    W.write_table(spark, fqn, _order_stats(spark, sf), partition_by=["month"], path=path)
    return _taken(spark.table(fqn).select("month", "o_orderstatus", "orders", "max_price"), fqn)


def q_write_append(spark, sf):
    fqn, path = _new_table(spark, "append")
    st = _order_stats(spark, sf)
    W.write_table(spark, fqn, st.where(F.col("o_orderstatus") == "F"), partition_by=["month"], path=path)
    W.write_table(spark, fqn, st.where(F.col("o_orderstatus") != "F"), mode="append")
    return _taken(spark.table(fqn).select("month", "o_orderstatus", "orders", "max_price"), fqn)


def q_write_overwrite_partitions(spark, sf):
    fqn, path = _new_table(spark, "overwrite")
    st = _order_stats(spark, sf)
    W.write_table(spark, fqn, st, partition_by=["month"], path=path)
    # rewrite the 1998 months with only their F orders; other months stay
    W.write_table(spark, fqn, st.where(F.col("month").startswith("1998") & (F.col("o_orderstatus") == "F")), mode="overwrite")
    return _taken(spark.table(fqn).select("month", "o_orderstatus", "orders", "max_price"), fqn)


def q_reconcile_schema(spark, sf):
    fqn, path = _new_table(spark, "reconcile")
    st = _order_stats(spark, sf)
    W.write_table(spark, fqn, st.select("month", "o_orderstatus", "orders"), partition_by=["month"], path=path)
    W.write_table(spark, fqn, st.select("month", "o_orderstatus", "max_price").where(F.col("o_orderstatus") == "O"))
    return _taken(spark.table(fqn).select("month", "o_orderstatus", "orders", "max_price"), fqn)


def q_write_telemetry(spark, sf):
    """A write that works and one that fails (text into a number) both leave their row in the telemetry table."""
    fqn, path = _new_table(spark, "telemetry")
    log, _ = _new_table(spark, "log")
    st = _order_stats(spark, sf)
    W.write_with_telemetry(spark, fqn, st, partition_by=["month"], path=path, telemetry=log)
    W.write_with_telemetry(spark, fqn, st.withColumn("orders", F.array("month")), telemetry=log, raise_error=False)
    return _taken(spark.table(log).select("status", "error", "rows"), fqn, log)


# ---------------------------------------------------------------- runs
def _run(mode: str) -> Query:
    return lambda spark, sf: _profile(spark, sf, mode).findings().withColumn("value", F.round("value", 6))


def q_run_alerts(spark, sf):
    run = run_alerts(_profile(spark, sf), demo.CHANNEL_ADVANCED, demo.rules(spark), AS_OF, demo.RULES_ROWS)
    return run.messages.select("batch_no", "alerts", "text", "items")


RUN_DAYS = ["2024-01-10", "2024-01-11", "2024-01-20"]


def q_run_partitions(spark, sf):
    """A daily run: three partitions are read (drift also reads their reference days), counts come from metadata."""
    ev = demo.read(spark, sf, "events")
    meta = ev.groupBy(DAY.value().alias("ts"), "event_type").agg(F.count(F.lit(1)).alias("record_count"))
    spec = TableSpec(
        "events", ev, DAY, expected=demo.EVENT_DAYS, key_cols=["event_id"], drift_columns=["value"], null_columns=["value"],
        average_columns=["value"], partitions=RUN_DAYS, metadata=meta,
    )
    found = run_profile(spark, [spec], as_of=AS_OF).findings()
    return found.withColumn("value", F.round("value", 6))


def q_run_write(spark, sf):
    """A whole run stored in the four result tables and read back."""
    names = _tables(spark, ["metrics", "rules", "drift", "cuts"])
    write_results(_profile(spark, sf), names)
    stored = Profile(*(spark.table(names[k]) for k in ("metrics", "rules", "drift", "cuts")))
    total = F.aggregate("cuts", F.lit(0.0), lambda x, y: x + y)
    cuts = stored.new_cuts.select(F.lit("cuts").alias("kind"), "table_name", "partition_value", F.col("column_name").alias("name"), total.alias("value"))
    found = stored.findings().select("kind", "table_name", "partition_value", "name", "value").unionByName(cuts)
    return _taken(found.withColumn("value", F.round("value", 6)), *names.values())


def q_partition_stats_metadata(spark, sf):
    """Counts per partition from a metadata table that has several keys per partition, some without a count."""
    o = demo.read(spark, sf, "orders")
    meta = o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderstatus").agg(F.count(F.lit(1)).alias("record_count"))
    meta = meta.withColumn("record_count", F.when(F.col("o_orderstatus") != "P", F.col("record_count")))
    return stats_from_metadata(meta, "orders", "month")


def q_latest_snapshot_files(spark, sf):
    """Newest file time of each table (it differs between copies of the data, so only that it is known)."""
    parts = [history_from_files(demo.read(spark, sf, n), n) for n in ("events", "orders", "lineitem")]
    found = latest_snapshot(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    return found.select("table_name", F.col("made_current_at").isNotNull().alias("known"))


def q_freshness_history(spark, sf):
    """Freshness over many snapshots per table: the newest one decides."""
    def snapshots(name: str, column: str) -> DataFrame:
        rows = demo.read(spark, sf, name)
        each = rows.groupBy(F.date_trunc("day", F.col(column))).agg(F.max(column).alias("m"))
        return each.select(F.lit(name).alias("table_name"), as_instant(F.col("m"), each.schema["m"].dataType).alias("made_current_at"))

    history = snapshots("events", "ts").unionByName(snapshots("orders", "o_orderdate")).unionByName(snapshots("lineitem", "l_shipdate"))
    m = A.freshness_metrics(history, AS_OF)
    r = A.freshness_rules(A.table_list(spark, ["events", "orders", "lineitem", "labels"]), history, AS_OF, S.SLA_HOURS, AS_OF, 4)
    none = F.lit(None).cast("string")
    return m.select("table_name", F.col("metric_name").alias("name"), F.col("metric_value").alias("value"), none.alias("observed")).unionByName(
        r.select("table_name", F.col("rule_id").alias("name"), F.col("fail_rate").alias("value"), "observed")
    )


def q_store_partition_status(spark, sf):
    st = partition_status(spark, demo.tables(spark, sf), AS_OF)
    return st.withColumn("row_count_dod_delta", F.round("row_count_dod_delta", 6))


def q_store_partition_stats(spark, sf):
    return partition_null_stats(spark, demo.tables(spark, sf))


def q_store_partition_info(spark, sf):
    return partition_info(spark, demo.tables(spark, sf)).withColumn("average", F.round("average", 6))


def q_store_alerts(spark, sf):
    return flat_decisions(_decisions(spark, sf).where(F.col("status") == S.STATUS_SENT))


QUERIES: dict[str, Query] = {
    "scan_partitions": q_scan_partitions,
    "scan_reference_day": q_scan_reference_day,
    "partition_stats": q_partition_stats,
    "latest_snapshot": q_latest_snapshot,
    "source_sql_views": q_source_sql_views,
    "source_dispatch": q_source_dispatch,
    "source_check": q_source_check,
    "resolve_rules": q_resolve_rules,
    "load_cuts": q_load_cuts,
    "sample_bernoulli": q_sample_bernoulli,
    "sample_by_key": q_sample_by_key,
    "store_projection": q_store_projection,
    "encode_json": q_encode_json,
    "availability_metrics": q_availability_metrics,
    "availability_rules": q_availability_rules,
    "freshness_metrics": q_freshness_metrics,
    "freshness_rules": q_freshness_rules,
    "row_count_dod": q_row_count_dod,
    "row_count_wow": q_row_count_wow,
    "row_count_wow_by_date": q_row_count_wow_by_date,
    "pk_duplicates_unique": q_pk_duplicates_unique,
    "pk_duplicates_composite": q_pk_duplicates_composite,
    "pk_duplicate_keys": q_pk_duplicate_keys,
    "pk_duplicates_approx": q_pk_duplicates_approx,
    "null_ratio_by_partition": q_null_ratio_by_partition,
    "average_change": q_average_change,
    "segment_nulls": q_segment_nulls,
    "segment_nulls_null_segment": q_segment_nulls_null_segment,
    "reference_cuts": q_reference_cuts,
    "histogram_shares": q_histogram_shares,
    "psi_score": q_psi_score,
    "drift_dod_wow": q_drift_dod_wow,
    "drift_multi_column": q_drift_multi_column,
    "drift_with_saved_cuts": q_drift_with_saved_cuts,
    "events_from_results": q_events_from_results,
    "policy_muted": _policy(status="muted"),
    "policy_availability": _policy("availability"),
    "policy_freshness": _policy("freshness"),
    "policy_drift": _policy("drift"),
    "policy_null_ratio": _policy("null_ratio"),
    "policy_row_count": _policy("row_count_dod"),
    "policy_average_change": _policy("average_change"),
    "policy_all": _policy(),
    "alert_key": q_alert_key,
    "level_basic": _level(demo.CHANNEL_BASIC),
    "level_advanced": _level(demo.CHANNEL_ADVANCED),
    "level_detailed": _level(demo.CHANNEL_DETAILED),
    "alerts_dedup": q_alerts_dedup,
    "alert_batches": q_alert_batches,
    "alert_rate_limit": q_alert_rate_limit,
    "alert_text": q_alert_text,
    "batch_text": q_batch_text,
    "alert_payload": q_alert_payload,
    "audit_rows": q_audit_rows,
    "messages_dry_run": q_messages_dry_run,
    "sink_tables": q_sink_tables,
    "sink_metrics": q_sink_metrics,
    "sink_rules": q_sink_rules,
    "sink_drift": q_sink_drift,
    "sink_ndjson": q_sink_ndjson,
    "sink_audit": q_sink_audit,
    "save_cuts": q_save_cuts,
    "align_to_schema": q_align_to_schema,
    "add_missing_columns": q_add_missing_columns,
    "write_create": q_write_create,
    "write_append": q_write_append,
    "write_overwrite_partitions": q_write_overwrite_partitions,
    "reconcile_schema": q_reconcile_schema,
    "write_telemetry": q_write_telemetry,
    "run_availability": _run("availability"),
    "run_rules": _run("rules"),
    "run_drift": _run("drift"),
    "run_all": _run("all"),
    "run_alerts": q_run_alerts,
    "run_partitions": q_run_partitions,
    "run_write": q_run_write,
    "partition_stats_metadata": q_partition_stats_metadata,
    "latest_snapshot_files": q_latest_snapshot_files,
    "freshness_history": q_freshness_history,
    "store_partition_status": q_store_partition_status,
    "store_partition_stats": q_store_partition_stats,
    "store_partition_info": q_store_partition_info,
    "store_alerts": q_store_alerts,
}


# ---------------------------------------------------------------- streaming
def q_stream_partition_stats(spark, sf):
    """A stream over the table's files keeps per-day statistics; the statistics table is read back."""
    from tablepulse.streaming.incremental import running_partition_stats, start_stats_stream, stream_files

    ev = demo.read(spark, sf, "events")
    stream = stream_files(spark, f"{sf.rstrip('/')}/events.parquet*", ev.schema, max_files_per_trigger=3)
    stats = running_partition_stats(stream, "events", DAY, ["value"], ["value"], "ts")
    fqn, path = _new_table(spark, "streamstats")
    q = start_stats_stream(stats, fqn, path, work_path(spark, "stream-ckpt"))
    q.awaitTermination()
    stats = spark.table(fqn).select(
        "table_name", "partition_value", "record_count", F.col("null_value").alias("null_count"),
        F.round(F.col("sum_value") / F.col("count_value"), 6).alias("average"), _txt_ts("max_ts"),
    )
    return _taken(stats, fqn)


QUERIES["stream_partition_stats"] = q_stream_partition_stats
