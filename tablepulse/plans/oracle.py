"""DuckDB SQL giving the same rows as each registered query (keys of ``oracle_sql()``).

Written independently of the Spark code, over the raw tables: the shared
CTE fragments below rebuild partition statistics, cuts, histograms, PSI,
events and decisions in SQL.
"""

from __future__ import annotations

AS_OF_TS = "TIMESTAMP '2024-01-31 12:00:00'"
AS_OF_DAY = "'2024-01-31'"
Q9 = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]"
Q4 = "[0.25, 0.5, 0.75]"
Q5 = "[0.2, 0.4, 0.6, 0.8]"
SEV_RANK = "CASE severity WHEN 'CRITICAL' THEN 0 WHEN 'WARN' THEN 1 WHEN 'INFO' THEN 2 ELSE 3 END"
PREFIX = "[tablepulse|dev] "


def metric_date(p: str) -> str:
    return f"strftime(coalesce(try_strptime({p}, '%Y-%m-%d')::DATE, DATE {AS_OF_DAY}), '%Y-%m-%d')"


STATS = """stats AS (
  SELECT 'events' AS table_name, strftime(ts, '%Y-%m-%d') AS partition_value, count(*)::BIGINT AS record_count FROM events GROUP BY 1, 2
  UNION ALL SELECT 'orders', strftime(o_orderdate, '%Y-%m'), count(*)::BIGINT FROM orders GROUP BY 1, 2
  UNION ALL SELECT 'lineitem', strftime(l_shipdate, '%Y-%m'), count(*)::BIGINT FROM lineitem GROUP BY 1, 2)"""

EXPECTED = """expected AS (
  SELECT 'events' AS table_name, strftime(d, '%Y-%m-%d') AS partition_value
    FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-01', INTERVAL 1 DAY) t(d)
  UNION ALL SELECT 'orders', strftime(d, '%Y-%m')
    FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-09-01', INTERVAL 1 MONTH) t(d))"""

COUNTS = f"""{STATS}, {EXPECTED},
counts AS (SELECT e.table_name, e.partition_value, coalesce(s.record_count, 0)::BIGINT AS record_count
  FROM expected e LEFT JOIN stats s ON s.table_name = e.table_name AND s.partition_value = e.partition_value)"""

AVAIL_METRICS = """avail_metrics AS (
  SELECT table_name, partition_value, 'partition_row_count' AS metric_name, record_count::DOUBLE AS metric_value FROM counts
  UNION ALL SELECT table_name, partition_value, 'partition_exists', CASE WHEN record_count > 0 THEN 1.0 ELSE 0.0 END::DOUBLE FROM counts)"""

AVAIL_RULES = """avail_rules AS (
  SELECT table_name, partition_value, 'availability' AS rule_id, false AS passed, 1.0::DOUBLE AS fail_rate,
         record_count AS sampled_rows, 'high' AS severity, 'record_count<=0' AS observed, 'record_count>0' AS expected,
         '' AS examples
  FROM counts WHERE record_count <= 0)"""

HISTORY = """hist AS (
  SELECT 'events' AS table_name, max(ts) AS made_current_at FROM events
  UNION ALL SELECT 'orders', max(o_orderdate) FROM orders
  UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem)"""

AGE = f"""aged AS (SELECT table_name, made_current_at,
  floor((epoch({AS_OF_TS}) - epoch(made_current_at)) / 3600)::BIGINT AS age_hours FROM hist)"""

FRESH_METRICS = """fresh_metrics AS (
  SELECT table_name, NULL::VARCHAR AS partition_value, 'snapshot_age_hours' AS metric_name, age_hours::DOUBLE AS metric_value FROM aged)"""

FRESH_RULES = """fresh_rules AS (
  SELECT t.table_name, NULL::VARCHAR AS partition_value, 'freshness' AS rule_id, false AS passed, 1.0::DOUBLE AS fail_rate,
         CASE WHEN a.made_current_at IS NULL THEN 0 ELSE 1 END::BIGINT AS sampled_rows, 'high' AS severity,
         CASE WHEN a.made_current_at IS NULL THEN 'no_history' ELSE 'ageHours=' || a.age_hours::VARCHAR END AS observed,
         CASE WHEN a.made_current_at IS NULL THEN 'recent_snapshot' ELSE '<= 6' END AS expected, '' AS examples
  FROM (SELECT unnest(TBLS) AS table_name) t LEFT JOIN aged a ON a.table_name = t.table_name
  WHERE a.made_current_at IS NULL OR a.age_hours > 6)"""

ROWCOUNT = """rc AS (
  SELECT table_name, partition_value, record_count::DOUBLE AS rc,
    lag(record_count::DOUBLE, 1) OVER (PARTITION BY table_name ORDER BY partition_value) AS prev1,
    lag(record_count::DOUBLE, 7) OVER (PARTITION BY table_name ORDER BY partition_value) AS prev7,
    row_number() OVER (PARTITION BY table_name ORDER BY partition_value DESC) AS age_rank
  FROM stats),
rc_metrics AS (
  SELECT table_name, partition_value, 'row_count_dod_delta' AS metric_name,
         CASE WHEN prev1 = 0 THEN 0.0 ELSE (rc - prev1) / prev1 END AS metric_value
  FROM rc WHERE prev1 IS NOT NULL
  UNION ALL
  SELECT table_name, partition_value, 'row_count_wow_delta',
         CASE WHEN prev7 = 0 THEN 0.0 ELSE (rc - prev7) / prev7 END
  FROM rc WHERE prev7 IS NOT NULL)"""

DOCS = """docs AS (SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

NULLS = f"""{DOCS},
null_long AS (
  SELECT 'events' AS table_name, strftime(ts, '%Y-%m-%d') AS partition_value, count(*)::BIGINT AS record_count,
         'value' AS column_name, count(*) FILTER (WHERE value IS NULL)::BIGINT AS null_count FROM events GROUP BY 1, 2
  UNION ALL SELECT 'events', strftime(ts, '%Y-%m-%d'), count(*), 'event_type', count(*) FILTER (WHERE event_type IS NULL) FROM events GROUP BY 1, 2
  UNION ALL SELECT 'events', strftime(ts, '%Y-%m-%d'), count(*), 'props', count(*) FILTER (WHERE props IS NULL) FROM events GROUP BY 1, 2
  UNION ALL SELECT 'orders', strftime(o_orderdate, '%Y-%m'), count(*), 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus IS NULL) FROM orders GROUP BY 1, 2
  UNION ALL SELECT 'orders', strftime(o_orderdate, '%Y-%m'), count(*), 'o_totalprice', count(*) FILTER (WHERE o_totalprice IS NULL) FROM orders GROUP BY 1, 2
  UNION ALL SELECT 'documents', lang, count(*), 'quality', count(*) FILTER (WHERE quality IS NULL) FROM docs GROUP BY 1, 2
  UNION ALL SELECT 'documents', lang, count(*), 'toxic', count(*) FILTER (WHERE toxic IS NULL) FROM docs GROUP BY 1, 2),
null_metrics AS (
  SELECT table_name, partition_value, 'null_ratio' AS metric_name, column_name,
         null_count::DOUBLE / record_count::DOUBLE AS metric_value FROM null_long)"""

AVGS = """avg_long AS (
  SELECT 'events' AS table_name, strftime(ts, '%Y-%m-%d') AS partition_value, 'value' AS column_name, avg(value::DOUBLE) AS average FROM events GROUP BY 1, 2
  UNION ALL SELECT 'orders', strftime(o_orderdate, '%Y-%m'), 'o_totalprice', avg(o_totalprice::DOUBLE) FROM orders GROUP BY 1, 2
  UNION ALL SELECT 'lineitem', strftime(l_shipdate, '%Y-%m'), 'l_quantity', avg(l_quantity::DOUBLE) FROM lineitem GROUP BY 1, 2
  UNION ALL SELECT 'lineitem', strftime(l_shipdate, '%Y-%m'), 'l_extendedprice', avg(l_extendedprice::DOUBLE) FROM lineitem GROUP BY 1, 2
  UNION ALL SELECT 'lineitem', strftime(l_shipdate, '%Y-%m'), 'l_discount', avg(l_discount::DOUBLE) FROM lineitem GROUP BY 1, 2),
avg_lag AS (SELECT *, lag(average) OVER (PARTITION BY table_name, column_name ORDER BY partition_value) AS prev FROM avg_long),
avg_metrics AS (
  SELECT table_name, partition_value, 'average_change' AS metric_name, column_name,
         CASE WHEN prev = 0 THEN 0.0 ELSE (average - prev) / prev END AS metric_value
  FROM avg_lag WHERE prev IS NOT NULL AND average IS NOT NULL)"""


def values_cte(name: str, table: str, part: str, cols: list[str]) -> str:
    parts = [
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, {part} AS p, "
        f"CASE WHEN isnan(TRY_CAST({c} AS DOUBLE)) THEN NULL ELSE TRY_CAST({c} AS DOUBLE) END AS x FROM {table}"
        for c in cols
    ]
    return f"{name} AS ({' UNION ALL '.join(parts)})"


def cuts_cte(name: str, values: str, probs: str = Q9, where: str = "TRUE") -> str:
    return (
        f"{name} AS (SELECT table_name, column_name, p AS cp, quantile_disc(x, {probs}) AS cuts "
        f"FROM {values} WHERE x IS NOT NULL AND ({where}) GROUP BY 1, 2, 3)"
    )


def hist_cte(name: str, values: str, cuts: str) -> str:
    """Counts under own cuts (ref role) and the cuts of 1 and 7 days before (current role), with shares."""
    return f"""{name}_roles AS (
  SELECT table_name, column_name, p, x, p AS cp FROM {values}
  UNION ALL SELECT table_name, column_name, p, x, strftime(p::DATE - 1, '%Y-%m-%d') FROM {values}
  UNION ALL SELECT table_name, column_name, p, x, strftime(p::DATE - 7, '%Y-%m-%d') FROM {values}),
{name}_b AS (
  SELECT r.table_name, r.column_name, r.cp, r.p,
         CASE WHEN r.x IS NULL THEN len(c.cuts) + 1 ELSE len(list_filter(c.cuts, lambda k: r.x > k)) END AS bucket
  FROM {name}_roles r JOIN {cuts} c ON c.table_name = r.table_name AND c.column_name = r.column_name AND c.cp = r.cp),
{name} AS (
  SELECT table_name, column_name, cp, p, bucket::INTEGER AS bucket, count(*)::BIGINT AS rows,
         count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY table_name, column_name, cp, p)::DOUBLE AS share
  FROM {name}_b GROUP BY 1, 2, 3, 4, 5)"""


def psi_cte(name: str, hist: str) -> str:
    return f"""{name}_rows AS (
  SELECT table_name, column_name, cp, bucket, k AS lag_days, share AS p, 0.0::DOUBLE AS q
    FROM {hist}, (VALUES (1), (7)) t(k) WHERE cp = p
  UNION ALL
  SELECT table_name, column_name, cp, bucket, (p::DATE - cp::DATE) AS lag_days, 0.0::DOUBLE, share
    FROM {hist} WHERE cp <> p AND (p::DATE - cp::DATE) IN (1, 7)),
{name}_b AS (SELECT table_name, column_name, cp, lag_days, bucket, sum(p) AS p, sum(q) AS q FROM {name}_rows GROUP BY 1, 2, 3, 4, 5),
{name} AS (
  SELECT table_name, column_name, strftime(cp::DATE + lag_days::INTEGER, '%Y-%m-%d') AS partition_value, cp AS reference_partition,
         CASE lag_days WHEN 1 THEN 'dod' ELSE 'wow' END AS ref_name,
         CASE lag_days WHEN 1 THEN 'yesterday' ELSE 'week' END AS reference,
         sum((greatest_p - greatest_q) * ln(greatest_p / greatest_q)) AS score
  FROM (SELECT *, CASE WHEN p <= 0 THEN 1e-9 ELSE p END AS greatest_p, CASE WHEN q <= 0 THEN 1e-9 ELSE q END AS greatest_q FROM {name}_b)
  GROUP BY table_name, column_name, cp, lag_days
  HAVING sum(p) > 0 AND sum(q) > 0)"""


def drift_rows(psi: str) -> str:
    return (
        f"SELECT table_name, partition_value, column_name || '_psi_' || ref_name AS metric_name, round(score, 6) AS score, "
        f"CASE WHEN score >= 0.2 THEN 'high' ELSE 'medium' END AS severity, reference, reference_partition FROM {psi}"
    )


EV_VALUES = values_cte("ev_vals", "events", "strftime(ts, '%Y-%m-%d')", ["value"])
EV_DRIFT = f"{EV_VALUES}, {cuts_cte('ev_cuts', 'ev_vals')}, {hist_cte('ev_hist', 'ev_vals', 'ev_cuts')}, {psi_cte('ev_psi', 'ev_hist')}"

RULES = """rules_cfg AS (SELECT * FROM (VALUES
    (NULL, 'availability', true, NULL, NULL, 'WARN'),
    (NULL, 'freshness', true, NULL, 36, 'CRITICAL'),
    (NULL, 'drift', true, 0.25, NULL, 'CRITICAL'),
    (NULL, 'null_ratio', true, 0.15, NULL, 'CRITICAL'),
    (NULL, 'row_count_dod', true, 0.35, NULL, 'CRITICAL'),
    (NULL, 'average_change', true, 0.12, NULL, 'INFO'),
    ('lineitem', 'average_change', NULL, 0.05, NULL, NULL),
    ('orders', 'row_count_dod', false, NULL, NULL, NULL),
    ('orders', 'freshness', NULL, NULL, NULL, 'WARN'),
    ('events', 'drift', NULL, 0.08, NULL, 'WARN'))
  t(table_name, behavior, enabled, threshold, stale_hours, severity))"""

EVENTS = f"""{COUNTS}, {HISTORY}, {AGE}, {ROWCOUNT}, {NULLS}, {AVGS}, {EV_DRIFT},
ev AS (
  SELECT 'availability' AS behavior, table_name, partition_value, 'available' AS metric_key,
         CASE WHEN record_count > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS metric_value, 'partition_exists' AS metric,
         NULL::VARCHAR AS column_name, NULL::VARCHAR AS reference FROM counts
  UNION ALL SELECT 'freshness', table_name, NULL, 'age_hours', age_hours::DOUBLE, 'snapshot_age_hours', NULL, NULL FROM aged
  UNION ALL SELECT 'null_ratio', table_name, partition_value, 'null_ratio', metric_value, 'null_ratio', column_name, NULL FROM null_metrics
  UNION ALL SELECT 'row_count_dod', table_name, partition_value, 'delta_pct', metric_value, metric_name, NULL, NULL
    FROM rc_metrics WHERE metric_name = 'row_count_dod_delta'
  UNION ALL SELECT 'average_change', table_name, partition_value, 'change_ratio', metric_value, 'average_change', column_name, NULL FROM avg_metrics
  UNION ALL SELECT 'drift', table_name, partition_value, 'drift_score', score, column_name || '_psi_' || ref_name, column_name, reference FROM ev_psi)"""

RESOLVED = f"""{EVENTS}, {RULES},
resolved AS (
  SELECT e.*,
    coalesce(o.enabled, d.enabled, true) AS enabled,
    upper(coalesce(o.severity, d.severity, CASE e.behavior WHEN 'availability' THEN 'CRITICAL' ELSE 'WARN' END)) AS severity,
    coalesce(o.threshold, d.threshold, CASE WHEN e.behavior = 'drift' THEN 0.30 WHEN e.behavior IN ('null_ratio', 'row_count_dod', 'average_change') THEN 0.20 END)::DOUBLE AS threshold,
    coalesce(o.stale_hours, d.stale_hours, CASE WHEN e.behavior = 'freshness' THEN 24 END)::INTEGER AS stale_hours
  FROM ev e
  LEFT JOIN (SELECT * FROM rules_cfg WHERE table_name IS NOT NULL) o ON o.table_name = e.table_name AND o.behavior = e.behavior
  LEFT JOIN (SELECT * FROM rules_cfg WHERE table_name IS NULL) d ON d.behavior = e.behavior)"""

DECISIONS = f"""{RESOLVED},
dec0 AS (
  SELECT *,
    CASE WHEN behavior = 'availability' THEN CASE WHEN metric_value >= 1.0 THEN 1.0 ELSE 0.0 END
         WHEN behavior IN ('row_count_dod', 'average_change') THEN abs(metric_value) ELSE metric_value END AS act,
    CASE WHEN behavior = 'freshness' THEN coalesce(stale_hours, 24)::DOUBLE ELSE threshold END AS lim
  FROM resolved),
dec1 AS (SELECT *, CASE WHEN behavior = 'availability' THEN act < 1.0 ELSE act > lim END AS send FROM dec0),
decisions AS (
  SELECT behavior, table_name, partition_value, column_name, reference,
    CASE WHEN NOT enabled THEN metric_value ELSE act END AS actual,
    CASE WHEN NOT enabled THEN CASE WHEN behavior IN ('availability', 'freshness') THEN NULL ELSE threshold END
         WHEN behavior = 'availability' THEN NULL ELSE lim END AS threshold,
    CASE WHEN NOT enabled THEN severity WHEN send THEN CASE WHEN behavior = 'availability' THEN 'CRITICAL' ELSE severity END
         ELSE 'INFO' END AS severity,
    CASE WHEN NOT enabled THEN 'Muted by rule'
         WHEN send THEN CASE behavior
           WHEN 'availability' THEN 'Availability failure'
           WHEN 'freshness' THEN 'Stale by ' || (metric_value - lim)::VARCHAR || 'h'
           WHEN 'drift' THEN 'Drift above threshold'
           WHEN 'null_ratio' THEN 'Null ratio high'
           WHEN 'row_count_dod' THEN 'Row count DoD large change'
           ELSE 'Average change high' END
         ELSE CASE behavior
           WHEN 'availability' THEN 'Available' WHEN 'freshness' THEN 'Fresh' WHEN 'drift' THEN 'Drift normal'
           WHEN 'null_ratio' THEN 'Null ratio ok' WHEN 'row_count_dod' THEN 'Row count DoD normal'
           ELSE 'Average change normal' END
    END AS message,
    CASE WHEN NOT enabled THEN 'muted' WHEN send THEN 'sent' ELSE 'skipped' END AS status,
    CASE WHEN NOT enabled THEN 'rule_disabled'
         WHEN send THEN CASE behavior WHEN 'availability' THEN 'availability_failed' WHEN 'freshness' THEN 'freshness_stale'
           WHEN 'drift' THEN 'drift_high' WHEN 'null_ratio' THEN 'null_high' WHEN 'row_count_dod' THEN 'dod_large' ELSE 'avg_high' END
         ELSE CASE behavior WHEN 'availability' THEN 'availability_ok' WHEN 'freshness' THEN 'freshness_within_sla'
           WHEN 'drift' THEN 'drift_low' WHEN 'null_ratio' THEN 'null_low' WHEN 'row_count_dod' THEN 'dod_small' ELSE 'avg_low' END
    END AS reason,
    behavior || '|' || table_name || '|' || coalesce(partition_value, '-') || '|' || {AS_OF_DAY} AS alert_key
  FROM dec1)"""

FLAT_DEC = "SELECT behavior, table_name, partition_value, round(actual, 6) AS actual, threshold, severity, message, status, reason, alert_key FROM decisions"

# what an alert is about beyond its key
SUBJECT = "concat_ws('/', column_name, reference)"
ALERT_COLS = "behavior, table_name, partition_value, column_name, reference, actual, threshold, severity, message, alert_key"


def sendable(level: str) -> str:
    if level == "basic":
        cond = "status = 'sent' AND (behavior IN ('availability', 'freshness') OR severity = 'CRITICAL')"
    elif level == "advanced":
        cond = "status = 'sent'"
    else:
        cond = "status = 'sent' OR (status = 'skipped' AND severity = 'INFO')"
    return f"SELECT {ALERT_COLS} FROM decisions WHERE {cond}"


def dedup(src: str) -> str:
    return (
        f"SELECT {ALERT_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY alert_key ORDER BY {SEV_RANK}, actual DESC, "
        f"message, {SUBJECT}) AS rn FROM ({src})) WHERE rn = 1"
    )


def numbered(src: str, batch: int = 10) -> str:
    return (
        f"SELECT *, seq // {batch} AS batch_no, (seq % {batch})::INTEGER AS position FROM ("
        f"SELECT *, (row_number() OVER (ORDER BY {SEV_RANK}, table_name NULLS FIRST, partition_value NULLS FIRST, behavior, "
        f"alert_key, message, actual, {SUBJECT}) - 1)::BIGINT AS seq FROM ({src}))"
    )


def text_expr(mention: bool = True) -> str:
    m = "CASE WHEN severity = 'CRITICAL' THEN ' @duty' ELSE '' END" if mention else "''"
    return (
        f"'{PREFIX}' || table_name || CASE WHEN partition_value IS NULL THEN '' ELSE '/' || partition_value END || ' ' || "
        f"behavior || ' ' || severity || ': ' || message || ' actual=' || printf('%.4f', actual) || "
        f"CASE WHEN threshold IS NULL THEN '' ELSE printf(' (thr=%.3f)', threshold) END || '.' || {m}"
    )


def messages_sql(src: str, cap: int | None) -> str:
    item = (
        "'• ' || table_name || CASE WHEN partition_value IS NULL THEN '' ELSE '/' || partition_value END || ':' || "
        "behavior || ' ' || severity || ' ' || message"
    )
    counts = (
        "concat_ws(', ', CASE WHEN n_c > 0 THEN 'CRITICAL=' || n_c END, CASE WHEN n_w > 0 THEN 'WARN=' || n_w END, "
        "CASE WHEN n_i > 0 THEN 'INFO=' || n_i END)"
    )
    capped = f"QUALIFY batch_no < {cap}" if cap is not None else ""
    held = "count(*) FILTER (WHERE batch_no >= {0}) OVER ()".format(cap)
    held_alerts = "sum(CASE WHEN batch_no >= {0} THEN alerts ELSE 0 END) OVER ()".format(cap)
    note = (
        f" || CASE WHEN batch_no = {cap - 1} AND {held} > 0 THEN ' (+' || ({held_alerts})::BIGINT || ' alerts in ' || {held} "
        "|| ' more messages not sent)' ELSE '' END"
        if cap is not None
        else ""
    )
    return f"""SELECT batch_no, alerts,
    CASE WHEN alerts = 1 THEN single ELSE '{PREFIX}' || alerts || ' alerts (' || {counts} || ')' END{note} AS text,
    CASE WHEN alerts = 1 THEN NULL ELSE items END AS items
  FROM (
    SELECT batch_no, count(*)::BIGINT AS alerts, min({text_expr()}) AS single,
      string_agg(CASE WHEN position < 10 THEN {item} END, chr(10) ORDER BY position) AS items,
      count(*) FILTER (WHERE severity = 'CRITICAL') AS n_c, count(*) FILTER (WHERE severity = 'WARN') AS n_w,
      count(*) FILTER (WHERE severity = 'INFO') AS n_i
    FROM ({numbered(src)}) GROUP BY batch_no) {capped}"""


def flat_metrics(src: str) -> str:
    return (
        f"SELECT table_name, partition_value, {metric_date('partition_value')} AS metric_date, metric_name, "
        f"round(metric_value, 6) AS metric_value FROM {src}"
    )


def flat_rules(src: str) -> str:
    return (
        "SELECT table_name, partition_value, rule_id, passed, round(fail_rate, 6) AS fail_rate, sampled_rows, severity, "
        f"observed, expected, examples FROM {src}"
    )


def pk_rule(table: str, keys: list[str], name: str) -> str:
    kt = " || '||' || ".join(f"coalesce({k}::VARCHAR, '<null>')" for k in keys)
    ks = ", ".join(keys)
    return f"""{name}_k AS (SELECT {ks}, count(*) AS n FROM {table} GROUP BY {ks}),
{name}_s AS (SELECT sum(n)::BIGINT AS total, count(*)::BIGINT AS distinct_keys FROM {name}_k),
{name}_top AS (SELECT coalesce(string_agg(kt, ',' ORDER BY n DESC, kt), '') AS ex FROM (
  SELECT {kt} AS kt, n FROM {name}_k WHERE n > 1 ORDER BY n DESC, kt LIMIT 5)),
{name}_r AS (SELECT *, CASE WHEN total = 0 THEN 0.0 ELSE greatest(0.0, 1.0 - distinct_keys::DOUBLE / total::DOUBLE) END AS rate
  FROM {name}_s, {name}_top),
{name} AS (
  SELECT '{table}' AS table_name, NULL::VARCHAR AS partition_value, 'pk_duplicates' AS rule_id, (rate <= 0.0) AS passed,
    CASE WHEN rate <= 0.0 THEN 0.0 ELSE rate END AS fail_rate, total AS sampled_rows,
    CASE WHEN rate <= 0.0 THEN 'medium' ELSE 'high' END AS severity,
    printf('dupRate=%.5f acd=%d total=%d', rate, distinct_keys, total) AS observed, 'dupRate==0' AS expected,
    CASE WHEN rate <= 0.0 THEN '' ELSE ex END AS examples
  FROM {name}_r)"""


def segment_rule(dims: dict[str, str], threshold: float, name: str = "seg") -> str:
    parts = [
        f"SELECT '{d}' AS dim, ({expr})::VARCHAR AS segment, count(*) AS rows, count(*) FILTER (WHERE quality IS NULL) AS nr "
        f"FROM docs GROUP BY 1, 2"
        for d, expr in dims.items()
    ]
    return f"""{DOCS}, {name}_g AS ({' UNION ALL '.join(parts)}),
{name} AS (
  SELECT 'documents' AS table_name, NULL::VARCHAR AS partition_value, 'null_rate_quality_by_' || dim AS rule_id,
    (nr::DOUBLE / rows <= {threshold}) AS passed,
    CASE WHEN nr::DOUBLE / rows <= {threshold} THEN 0.0 ELSE nr::DOUBLE / rows END AS fail_rate, rows::BIGINT AS sampled_rows,
    CASE WHEN nr::DOUBLE / rows <= {threshold} THEN 'medium' ELSE 'high' END AS severity,
    printf('rate=%.4f', nr::DOUBLE / rows) AS observed, '<= {threshold}' AS expected,
    CASE WHEN nr::DOUBLE / rows <= {threshold} THEN '' ELSE coalesce(segment, '<null>') END AS examples
  FROM {name}_g)"""


def cuts_exploded(cuts: str) -> str:
    return (
        f"SELECT table_name, column_name, cp AS partition_value, (generate_subscripts(cuts, 1) - 1)::INTEGER AS idx, "
        f"unnest(cuts) AS cut FROM {cuts}"
    )


METRIC_JSON = (
    "json_object('table', table_name, 'partition', partition_value, 'metricDate', '2024-01-31', 'name', metric_name, "
    "'value', metric_value, 'details', json_object('partitionKey', 'ts'))::VARCHAR AS value"
)

ORDER_STATS = """ostats AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus, count(*)::BIGINT AS orders,
  max(o_totalprice) AS max_price FROM orders GROUP BY 1, 2)"""

EV_VU = values_cte("vu_vals", "events", "strftime(ts, '%Y-%m-%d')", ["value", "user_id"])
LI_VALS = values_cte("li_vals", "lineitem", "strftime(l_shipdate, '%Y-%m-%d')", ["l_extendedprice", "l_discount"])

RUN_AVAIL = f"""WITH {COUNTS}, {AVAIL_METRICS}, {AVAIL_RULES}, {HISTORY}, {AGE}, {FRESH_METRICS},
{FRESH_RULES.replace('TBLS', "['events', 'orders', 'lineitem']")}, {ROWCOUNT.replace('stats)', 'stats)')},
av AS (
  SELECT 'metric' AS kind, table_name, partition_value, metric_name AS name, metric_value AS value, NULL::BOOLEAN AS passed, NULL::VARCHAR AS severity FROM avail_metrics
  UNION ALL SELECT 'metric', table_name, partition_value, metric_name, metric_value, NULL, NULL FROM rc_metrics
  UNION ALL SELECT 'metric', table_name, partition_value, metric_name, metric_value, NULL, NULL FROM fresh_metrics
  UNION ALL SELECT 'rule', table_name, partition_value, rule_id, fail_rate, passed, severity FROM avail_rules
  UNION ALL SELECT 'rule', table_name, partition_value, rule_id, fail_rate, passed, severity FROM fresh_rules)"""

RUN_RULES = f"""WITH {pk_rule('events', ['event_id'], 'pk_e')}, {pk_rule('orders', ['o_orderkey'], 'pk_o')},
{pk_rule('lineitem', ['l_orderkey', 'l_linenumber'], 'pk_l')}, {segment_rule({'lang': 'lang', 'source': 'source'}, 0.2)},
{NULLS.replace(DOCS + ',', '')}, {AVGS},
ru AS (
  SELECT 'rule' AS kind, table_name, partition_value, rule_id AS name, fail_rate AS value, passed, severity FROM pk_e
  UNION ALL SELECT 'rule', table_name, partition_value, rule_id, fail_rate, passed, severity FROM pk_o
  UNION ALL SELECT 'rule', table_name, partition_value, rule_id, fail_rate, passed, severity FROM pk_l
  UNION ALL SELECT 'rule', table_name, partition_value, rule_id, fail_rate, passed, severity FROM seg
  UNION ALL SELECT 'metric', table_name, partition_value, metric_name, metric_value, NULL, NULL FROM null_metrics
  UNION ALL SELECT 'metric', table_name, partition_value, metric_name, metric_value, NULL, NULL FROM avg_metrics)"""

RUN_DRIFT = f"""WITH {EV_DRIFT},
dr AS (SELECT 'drift' AS kind, table_name, partition_value, column_name || '_psi_' || ref_name AS name, score AS value,
  NULL::BOOLEAN AS passed, CASE WHEN score >= 0.2 THEN 'high' ELSE 'medium' END AS severity FROM ev_psi)"""

FINDINGS = "SELECT kind, table_name, partition_value, name, round(value, 6) AS value, passed, severity FROM {}"

SQL: dict[str, str] = {
    "scan_partitions": """SELECT event_id, strftime(ts, '%Y-%m-%d') AS partition_value, event_type, value FROM events
        WHERE ts >= TIMESTAMP '2024-01-24' AND ts < TIMESTAMP '2024-01-31'""",
    "scan_reference_day": """SELECT event_id, strftime(ts, '%Y-%m-%d') AS partition_value, user_id, value FROM events
        WHERE ts >= TIMESTAMP '2024-01-07' AND ts < TIMESTAMP '2024-01-08'""",
    "partition_stats": f"WITH {STATS} SELECT * FROM stats",
    "latest_snapshot": f"WITH {HISTORY} SELECT table_name, strftime(made_current_at, '%Y-%m-%d %H:%M:%S.%f') AS made_current_at FROM hist",
    "source_sql_views": """SELECT o_orderstatus, count(*)::BIGINT AS orders, min(o_totalprice) AS min_price, max(o_totalprice) AS max_price
        FROM orders GROUP BY o_orderstatus""",
    "source_dispatch": """SELECT l_returnflag, l_linestatus, count(*)::BIGINT AS line_count FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "source_check": "SELECT true AS ok, count(*)::BIGINT AS rows FROM orders",
    "resolve_rules": f"""WITH {RESOLVED} SELECT behavior, table_name, partition_value, metric, column_name, reference, enabled,
        severity, threshold, stale_hours FROM resolved""",
    "load_cuts": f"WITH {EV_VU}, {cuts_cte('c', 'vu_vals')} {cuts_exploded('c')}",
    "sample_by_key": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 8))::BIGINT < 42949673""",
    "store_projection": f"""WITH {COUNTS}, {AVAIL_RULES}, {pk_rule('lineitem', ['l_orderkey', 'l_linenumber'], 'pk_l')}
        SELECT *, '2024-01-31 12:00:00.000000' AS ts, '2024-01-31' AS ts_date FROM (
          {flat_rules('avail_rules')} UNION ALL {flat_rules('pk_l')})""",
    "encode_json": f"WITH {COUNTS}, {AVAIL_METRICS} SELECT {METRIC_JSON} FROM avail_metrics",
    "availability_metrics": f"WITH {COUNTS}, {AVAIL_METRICS} " + flat_metrics("avail_metrics").replace(
        metric_date("partition_value"), AS_OF_DAY),
    "availability_rules": f"WITH {COUNTS}, {AVAIL_RULES} {flat_rules('avail_rules')}",
    "freshness_metrics": f"WITH {HISTORY}, {AGE}, {FRESH_METRICS} {flat_metrics('fresh_metrics')}",
    "freshness_rules": f"WITH {HISTORY}, {AGE}, "
    + FRESH_RULES.replace("TBLS", "['events', 'orders', 'lineitem', 'labels']")
    + f" {flat_rules('fresh_rules')}",
    "row_count_dod": f"WITH {STATS}, {ROWCOUNT} {flat_metrics('rc_metrics')} WHERE metric_name = 'row_count_dod_delta'",
    "row_count_wow": f"WITH {STATS}, {ROWCOUNT} {flat_metrics('rc_metrics')} WHERE metric_name = 'row_count_wow_delta'",
    "row_count_wow_by_date": """WITH s AS (SELECT strftime(ts, '%Y-%m-%d') AS p, count(*)::DOUBLE AS rc FROM events GROUP BY 1)
        SELECT 'events' AS table_name, cur.p AS partition_value, cur.p AS metric_date, 'row_count_wow_delta' AS metric_name,
          round(CASE WHEN prev.rc = 0 THEN 0.0 ELSE (cur.rc - prev.rc) / prev.rc END, 6) AS metric_value
        FROM s cur JOIN s prev ON prev.p = strftime(cur.p::DATE - 7, '%Y-%m-%d')""",
    "pk_duplicates_unique": f"WITH {pk_rule('orders', ['o_orderkey'], 'pk')} {flat_rules('pk')}",
    "pk_duplicates_composite": f"WITH {pk_rule('lineitem', ['l_orderkey', 'l_linenumber'], 'pk')} {flat_rules('pk')}",
    "pk_duplicate_keys": """SELECT 'lineitem' AS table_name, l_orderkey, l_linenumber,
          coalesce(l_orderkey::VARCHAR, '<null>') || '||' || coalesce(l_linenumber::VARCHAR, '<null>') AS key_text,
          count(*)::BIGINT AS occurrences
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "null_ratio_by_partition": f"""WITH {NULLS} SELECT table_name, partition_value, {metric_date('partition_value')} AS metric_date,
        metric_name, column_name, round(metric_value, 6) AS metric_value FROM null_metrics WHERE table_name = 'documents'""",
    "average_change": f"""WITH {AVGS} SELECT table_name, partition_value, {metric_date('partition_value')} AS metric_date,
        metric_name, column_name, round(metric_value, 6) AS metric_value FROM avg_metrics WHERE table_name IN ('events', 'orders')""",
    "segment_nulls": f"WITH {segment_rule({'lang': 'lang', 'source': 'source'}, 0.2)} {flat_rules('seg')}",
    "segment_nulls_null_segment": f"WITH {segment_rule({'lang': 'nullif(lang, ' + chr(39) + 'de' + chr(39) + ')'}, 0.6)} {flat_rules('seg')}",
    "reference_cuts": f"WITH {EV_VU}, {cuts_cte('c', 'vu_vals')} {cuts_exploded('c')}",
    "histogram_shares": f"""WITH {EV_VALUES}, {cuts_cte('ev_cuts', 'ev_vals')}, {hist_cte('h', 'ev_vals', 'ev_cuts')}
        SELECT table_name, column_name, cp AS cut_partition, p AS partition_value, bucket, rows, round(share, 6) AS share FROM h""",
    "psi_score": f"""WITH {EV_VU}, {cuts_cte('c', 'vu_vals')}, {hist_cte('h', 'vu_vals', 'c')}, {psi_cte('ps', 'h')}
        SELECT table_name, column_name, partition_value, reference_partition, ref_name, round(score, 6) AS score FROM ps""",
    "drift_dod_wow": f"WITH {EV_DRIFT} {drift_rows('ev_psi')} WHERE partition_value = '2024-01-08'",
    "drift_multi_column": f"""WITH {EV_VU}, {cuts_cte('c1', 'vu_vals')}, {hist_cte('h1', 'vu_vals', 'c1')}, {psi_cte('ps1', 'h1')},
        {LI_VALS}, {cuts_cte('c2', 'li_vals')}, {hist_cte('h2', 'li_vals', 'c2')}, {psi_cte('ps2', 'h2')}
        {drift_rows('ps1')} UNION ALL {drift_rows('ps2')}""",
    "drift_with_saved_cuts": f"""WITH {EV_VALUES},
        {cuts_cte('c_old', 'ev_vals', Q5, "p < '2024-01-15'")}, {cuts_cte('c_new', 'ev_vals', Q9, "p >= '2024-01-15'")},
        c AS (SELECT * FROM c_old UNION ALL SELECT * FROM c_new), {hist_cte('h', 'ev_vals', 'c')}, {psi_cte('ps', 'h')}
        {drift_rows('ps')}""",
    "events_from_results": f"""WITH {EVENTS} SELECT behavior, table_name, partition_value, metric_key,
        round(metric_value, 6) AS metric_value, metric, column_name, reference FROM ev""",
    "policy_muted": f"WITH {DECISIONS} {FLAT_DEC} WHERE status = 'muted'",
    "policy_availability": f"WITH {DECISIONS} {FLAT_DEC} WHERE behavior = 'availability'",
    "policy_freshness": f"WITH {DECISIONS} {FLAT_DEC} WHERE behavior = 'freshness'",
    "policy_drift": f"WITH {DECISIONS} {FLAT_DEC} WHERE behavior = 'drift'",
    "policy_null_ratio": f"WITH {DECISIONS} {FLAT_DEC} WHERE behavior = 'null_ratio'",
    "policy_row_count": f"WITH {DECISIONS} {FLAT_DEC} WHERE behavior = 'row_count_dod'",
    "policy_average_change": f"WITH {DECISIONS} {FLAT_DEC} WHERE behavior = 'average_change'",
    "policy_all": f"WITH {DECISIONS} {FLAT_DEC}",
    "alert_key": f"WITH {DECISIONS} SELECT behavior, table_name, partition_value, alert_key FROM decisions",
    "level_basic": f"""WITH {DECISIONS} {FLAT_DEC}
        WHERE status = 'sent' AND (behavior IN ('availability', 'freshness') OR severity = 'CRITICAL')""",
    "level_advanced": f"WITH {DECISIONS} {FLAT_DEC} WHERE status = 'sent'",
    "level_detailed": f"WITH {DECISIONS} {FLAT_DEC}",
    "alerts_dedup": f"""WITH {DECISIONS} SELECT alert_key, behavior, table_name, partition_value, severity, message,
        round(actual, 6) AS actual FROM ({dedup(sendable('detailed'))})""",
    "alert_batches": f"""WITH {DECISIONS} SELECT alert_key, severity, seq, batch_no, position
        FROM ({numbered(dedup(sendable('advanced')))})""",
    "alert_rate_limit": f"WITH {DECISIONS} {messages_sql(dedup(sendable('detailed')), 20)}",
    "alert_text": f"""WITH {DECISIONS} SELECT alert_key, behavior, table_name, partition_value, {text_expr()} AS text
        FROM ({sendable('advanced')})""",
    "batch_text": f"WITH {DECISIONS} {messages_sql(dedup(sendable('advanced')), None)}",
    "audit_rows": f"""WITH {DECISIONS} SELECT alert_key AS key, 'advanced' AS level, severity, table_name AS "table", behavior,
        status, reason, '2024-01-31T12:00:00Z' AS timestamp FROM decisions""",
    "messages_dry_run": f"WITH {DECISIONS} {messages_sql(sendable('detailed'), None)}",
    "sink_metrics": f"""{RUN_AVAIL} SELECT table_name, partition_value,
        CASE WHEN name IN ('partition_row_count', 'partition_exists', 'snapshot_age_hours') THEN {AS_OF_DAY}
             ELSE {metric_date('partition_value')} END AS metric_date,
        name AS metric_name, round(value, 6) AS metric_value FROM av WHERE kind = 'metric'""",
    "sink_rules": f"""{RUN_RULES} SELECT * FROM ({flat_rules('pk_e')} UNION ALL {flat_rules('pk_o')} UNION ALL {flat_rules('pk_l')}
        UNION ALL {flat_rules('seg')})""",
    "sink_drift": f"WITH {EV_DRIFT} {drift_rows('ev_psi')}",
    "sink_ndjson": f"WITH {COUNTS}, {AVAIL_METRICS} SELECT {METRIC_JSON} FROM avail_metrics",
    "sink_audit": f"""WITH {DECISIONS} SELECT json_object('key', alert_key, 'level', 'basic', 'severity', severity,
        'table', table_name, 'behavior', behavior, 'status', status, 'reason', reason,
        'timestamp', '2024-01-31T12:00:00Z')::VARCHAR AS value FROM decisions""",
    "save_cuts": f"WITH {EV_VALUES}, {cuts_cte('c', 'ev_vals')} {cuts_exploded('c')}",
    "align_to_schema": f"""WITH {ORDER_STATS} SELECT month, o_orderstatus, orders, NULL::VARCHAR AS note, NULL::DOUBLE AS min_price,
        max_price FROM ostats""",
    "add_missing_columns": f"WITH {ORDER_STATS} SELECT month, o_orderstatus, orders, NULL::DOUBLE AS max_price FROM ostats",
    "write_create": f"WITH {ORDER_STATS} SELECT month, o_orderstatus, orders, max_price FROM ostats",
    "write_append": f"WITH {ORDER_STATS} SELECT month, o_orderstatus, orders, max_price FROM ostats",
    "write_overwrite_partitions": f"""WITH {ORDER_STATS} SELECT month, o_orderstatus, orders, max_price FROM ostats
        WHERE NOT (month LIKE '1998%' AND o_orderstatus <> 'F')""",
    "reconcile_schema": f"""WITH {ORDER_STATS} SELECT month, o_orderstatus, orders, NULL::DOUBLE AS max_price FROM ostats
        UNION ALL SELECT month, o_orderstatus, NULL::BIGINT, max_price FROM ostats WHERE o_orderstatus = 'O'""",
    "run_availability": f"{RUN_AVAIL} " + FINDINGS.format("av"),
    "run_rules": f"{RUN_RULES} " + FINDINGS.format("ru"),
    "run_drift": f"{RUN_DRIFT} " + FINDINGS.format("dr"),
    "run_alerts": f"WITH {DECISIONS} {messages_sql(dedup(sendable('advanced')), 20)}",
    "store_partition_status": f"""WITH {STATS.replace(
        "UNION ALL SELECT 'lineitem', strftime(l_shipdate, '%Y-%m'), count(*)::BIGINT FROM lineitem GROUP BY 1, 2)",
        "UNION ALL SELECT 'lineitem', strftime(l_shipdate, '%Y-%m'), count(*)::BIGINT FROM lineitem GROUP BY 1, 2 "
        "UNION ALL SELECT 'documents', lang, count(*)::BIGINT FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1, 2)")},
        {HISTORY}, {AGE},
        lagged AS (SELECT *, lag(record_count::DOUBLE) OVER (PARTITION BY table_name ORDER BY partition_value) AS prev FROM stats)
        SELECT l.table_name, l.partition_value, l.record_count,
          round(CASE WHEN prev IS NULL THEN NULL WHEN prev = 0 THEN 0.0 ELSE (record_count - prev) / prev END, 6) AS row_count_dod_delta,
          a.age_hours AS snapshot_age_hours
        FROM lagged l LEFT JOIN aged a ON a.table_name = l.table_name""",
    "store_partition_stats": f"""WITH {NULLS} SELECT table_name, partition_value, record_count, column_name, null_count,
        null_count::DOUBLE / record_count::DOUBLE AS null_ratio FROM null_long""",
}

# run_all = the three runs together
SQL["run_all"] = (
    RUN_AVAIL
    + ", "
    + RUN_RULES[len("WITH "):]
    + ", "
    + RUN_DRIFT[len("WITH "):]
    + " "
    + FINDINGS.format("(SELECT * FROM av UNION ALL SELECT * FROM ru UNION ALL SELECT * FROM dr)")
)

SQL["stream_partition_stats"] = """SELECT 'events' AS table_name, strftime(ts, '%Y-%m-%d') AS partition_value,
    count(*)::BIGINT AS record_count, count(*) FILTER (WHERE value IS NULL)::BIGINT AS null_count,
    round(avg(value), 6) AS average, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS max_ts
  FROM events GROUP BY 1, 2"""

SQL["store_partition_info"] = f"""WITH {AVGS}, cnt AS (
    SELECT 'events' AS table_name, strftime(ts, '%Y-%m-%d') AS partition_value, count(*)::BIGINT AS rows FROM events GROUP BY 1, 2
    UNION ALL SELECT 'orders', strftime(o_orderdate, '%Y-%m'), count(*)::BIGINT FROM orders GROUP BY 1, 2
    UNION ALL SELECT 'lineitem', strftime(l_shipdate, '%Y-%m'), count(*)::BIGINT FROM lineitem GROUP BY 1, 2)
  SELECT a.table_name, a.partition_value, c.rows, a.column_name, round(a.average, 6) AS average
  FROM avg_long a JOIN cnt c ON c.table_name = a.table_name AND c.partition_value = a.partition_value"""
SQL["store_alerts"] = f"WITH {DECISIONS} {FLAT_DEC} WHERE status = 'sent'"

# the reference days of an all-days run that lie within the table but have no cuts
MISSING = """ev_days AS (SELECT DISTINCT p::DATE AS d FROM ev_vals),
missing AS (
  SELECT 'events' AS table_name, strftime(d, '%Y-%m-%d') AS partition_value, 'reference_missing' AS metric_name, 1.0::DOUBLE AS metric_value
  FROM ev_days, (VALUES (1), (7)) t(k)
  WHERE d - k >= (SELECT min(d) FROM ev_days) AND strftime(d - k, '%Y-%m-%d') NOT IN (SELECT cp FROM ev_cuts WHERE column_name = 'value'))"""
MISSING_ROWS = "SELECT 'metric', table_name, partition_value, metric_name, metric_value, NULL, NULL FROM missing"
SQL["run_drift"] = f"{RUN_DRIFT}, {MISSING} " + FINDINGS.format(f"(SELECT * FROM dr UNION ALL {MISSING_ROWS})")
SQL["run_all"] = (
    ", ".join([RUN_AVAIL, RUN_RULES[len("WITH "):], RUN_DRIFT[len("WITH "):], MISSING])
    + " "
    + FINDINGS.format(f"(SELECT * FROM av UNION ALL SELECT * FROM ru UNION ALL SELECT * FROM dr UNION ALL {MISSING_ROWS})")
)
SQL["partition_stats_metadata"] = """SELECT 'orders' AS table_name, strftime(o_orderdate, '%Y-%m') AS partition_value,
    count(*) FILTER (WHERE o_orderstatus <> 'P')::BIGINT AS record_count FROM orders GROUP BY 1, 2"""
SQL["latest_snapshot_files"] = "SELECT unnest(['events', 'orders', 'lineitem']) AS table_name, true AS known"
SQL["freshness_history"] = f"""WITH {HISTORY}, {AGE}, {FRESH_METRICS}, {FRESH_RULES.replace('TBLS', "['events', 'orders', 'lineitem', 'labels']")}
  SELECT table_name, metric_name AS name, metric_value AS value, NULL::VARCHAR AS observed FROM fresh_metrics
  UNION ALL SELECT table_name, rule_id, fail_rate, observed FROM fresh_rules"""
SQL["sample_bernoulli"] = "SELECT count(*)::BIGINT AS table_rows, true AS share_ok, 0::BIGINT AS foreign_rows FROM lineitem"
SQL["pk_duplicates_approx"] = """SELECT 'lineitem' AS table_name, 'pk_duplicates' AS rule_id, false AS passed, count(*)::BIGINT AS sampled_rows,
    true AS close FROM lineitem"""
SQL["alert_payload"] = f"""WITH {DECISIONS}, payload AS ({messages_sql(dedup(sendable('advanced')), None)})
  SELECT batch_no, alerts, 2 AS blocks, text AS first_text, items AS second_text FROM payload"""
SQL["sink_tables"] = f"""{RUN_AVAIL} SELECT 'metrics' AS kind, count(*)::BIGINT AS rows FROM av WHERE kind = 'metric'
  UNION ALL SELECT 'rules', count(*)::BIGINT FROM av WHERE kind = 'rule' UNION ALL SELECT 'drift', 0::BIGINT UNION ALL SELECT 'cuts', 0::BIGINT"""
SQL["write_telemetry"] = f"""WITH {ORDER_STATS} SELECT 'success' AS status, NULL::VARCHAR AS error, count(*)::BIGINT AS rows FROM ostats
  UNION ALL SELECT 'failure', 'AnalysisException', NULL"""
RUN_DAYS = "('2024-01-10', '2024-01-11', '2024-01-20')"
SQL["run_partitions"] = f"""WITH {STATS}, {ROWCOUNT}, {EV_DRIFT}, {NULLS},
  pk AS (SELECT count(*)::BIGINT AS total, count(DISTINCT event_id)::BIGINT AS d FROM events WHERE strftime(ts, '%Y-%m-%d') IN {RUN_DAYS}),
  avgs AS (SELECT strftime(ts, '%Y-%m-%d') AS p, avg(value) AS average FROM events WHERE strftime(ts, '%Y-%m-%d') IN {RUN_DAYS} GROUP BY 1),
  lagged AS (SELECT p, average, lag(average) OVER (ORDER BY p) AS prev FROM avgs),
  f AS (
    SELECT 'metric' AS kind, table_name, partition_value, metric_name AS name, metric_value AS value, NULL::BOOLEAN AS passed, NULL::VARCHAR AS severity
      FROM rc_metrics WHERE table_name = 'events' AND partition_value IN {RUN_DAYS}
    UNION ALL SELECT 'metric', table_name, partition_value, n, v, NULL, NULL FROM (
      SELECT table_name, partition_value, unnest(['partition_row_count', 'partition_exists']) AS n, unnest([record_count::DOUBLE, 1.0]) AS v
      FROM stats WHERE table_name = 'events' AND partition_value IN {RUN_DAYS})
    UNION ALL SELECT 'metric', table_name, partition_value, metric_name, metric_value, NULL, NULL FROM null_metrics
      WHERE table_name = 'events' AND column_name = 'value' AND partition_value IN {RUN_DAYS}
    UNION ALL SELECT 'metric', 'events', p, 'average_change', (average - prev) / prev, NULL, NULL FROM lagged WHERE prev IS NOT NULL
    UNION ALL SELECT 'metric', 'events', min(p), 'no_history', 1.0, NULL, NULL FROM avgs WHERE average IS NOT NULL
    UNION ALL SELECT 'rule', 'events', NULL, 'pk_duplicates', 1.0 - d::DOUBLE / total::DOUBLE, d = total, CASE WHEN d = total THEN 'medium' ELSE 'high' END FROM pk
    UNION ALL SELECT 'drift', table_name, partition_value, column_name || '_psi_' || ref_name, score, NULL, CASE WHEN score >= 0.2 THEN 'high' ELSE 'medium' END
      FROM ev_psi WHERE partition_value IN {RUN_DAYS})
  {FINDINGS.format('f')}"""
SQL["run_write"] = (
    ", ".join([RUN_AVAIL, RUN_RULES[len("WITH "):], RUN_DRIFT[len("WITH "):], MISSING])
    + f""" SELECT kind, table_name, partition_value, name, round(value, 6) AS value FROM (
      SELECT * FROM av UNION ALL SELECT * FROM ru UNION ALL SELECT * FROM dr UNION ALL {MISSING_ROWS}
      UNION ALL SELECT 'cuts', table_name, cp, column_name, list_sum(cuts), NULL, NULL FROM ev_cuts)"""
)
