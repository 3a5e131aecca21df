"""DuckDB SQL of the queries in ``registered_stored``."""

from __future__ import annotations

from tablepulse.plans import oracle as O

DAYS = "(SELECT strftime(ts, '%Y-%m-%d') AS p, * FROM events)"

SQL: dict[str, str] = {
    "sketch_distinct_ranges": """
        WITH k AS (
            SELECT 'event' AS name, ts::DATE AS d, event_id::VARCHAR AS a, '' AS b FROM events
            UNION ALL SELECT 'user', ts::DATE, user_id::VARCHAR, '' FROM events
            UNION ALL SELECT 'user_type', ts::DATE, user_id::VARCHAR, event_type FROM events
        ), ends AS (
            SELECT DISTINCT d AS e FROM k
        )
        SELECT 'events' AS table_name, name, strftime(e, '%Y-%m-%d') AS range_value, count(DISTINCT d) AS partitions, count(*) AS record_count,
               count(DISTINCT (a, b)) AS exact_keys, true AS close
        FROM k JOIN ends ON d <= e AND d > e - 7 GROUP BY name, e
    """,
    "pk_duplicates_stored": """
        WITH c AS (
            SELECT 'events' AS table_name, count(*) AS n, count(DISTINCT event_id) AS k FROM events
            UNION ALL SELECT 'orders', count(*), count(DISTINCT o_orderkey) FROM orders
            UNION ALL SELECT 'lineitem', count(*), count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
        )
        SELECT table_name, NULL::VARCHAR AS partition_value, 'pk_duplicates_pk' AS rule_id, 1 - k / n <= 3 * 1.04 / 64 AS passed, n AS sampled_rows,
               CASE WHEN 1 - k / n <= 3 * 1.04 / 64 THEN 'medium' ELSE 'high' END AS severity, 'dupRate<=0.04875' AS expected
        FROM c
    """,
    "drift_from_sketches": """
        SELECT c.column_name || '_psi_' || r.name AS metric_name, strftime(t.d, '%Y-%m-%d') AS partition_value,
               (SELECT count(*) FROM events WHERE ts::DATE < t.d AND ts::DATE >= t.d - r.days) AS reference_rows,
               true AS rows_ok, true AS cuts_ok, true AS shares_ok, true AS scored
        FROM (VALUES ('value'), ('user_id')) c(column_name), (VALUES ('7d', 7), ('28d', 28)) r(name, days),
             (VALUES (DATE '2024-01-15'), (DATE '2024-01-30')) t(d)
    """,
    "cuts_from_sketches": """
        SELECT strftime(ts, '%Y-%m-%d') AS partition_value, i::INTEGER AS idx, count(*) AS rows, true AS close
        FROM events, range(9) t(i) WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY 1, 2
    """,
    "run_partition_stored": f"""
        WITH d AS (
            SELECT p, count(*)::DOUBLE AS n, avg(value) AS a, count(*) FILTER (value IS NULL) AS nulls FROM {DAYS} GROUP BY p
        ), w AS (
            SELECT *, lag(n) OVER (ORDER BY p) AS n1, lag(n, 7) OVER (ORDER BY p) AS n7, lag(a) OVER (ORDER BY p) AS a1 FROM d
        ), t AS (
            SELECT * FROM w WHERE p = '2024-01-20'
        ), f AS (
            SELECT 'events' AS table_name, 'row_count_dod_delta' AS name, (n - n1) / n1 AS value FROM t
            UNION ALL SELECT 'events', 'row_count_wow_delta', (n - n7) / n7 FROM t
            UNION ALL SELECT 'events', 'average_change', (a - a1) / a1 FROM t
            UNION ALL SELECT 'events', 'partition_row_count', n FROM t
            UNION ALL SELECT 'events', 'partition_exists', 1.0 FROM t
            UNION ALL SELECT 'events', 'null_ratio', nulls / n FROM t
            UNION ALL SELECT 'alone', 'no_history', 1.0 FROM t
            UNION ALL SELECT 'alone', 'no_history', 1.0 FROM t
        )
        SELECT 'metric' AS kind, table_name, '2024-01-20' AS partition_value, name, round(value, 6) AS value, NULL::BOOLEAN AS passed, NULL::VARCHAR AS severity FROM f
    """,
    "alerts_without_snapshots": """
        WITH a AS (
            SELECT 'events' AS table_name, (date_diff('microsecond', max(ts), TIMESTAMP '2024-01-31 12:00:00') // 3600000000)::DOUBLE AS age FROM events
            UNION ALL SELECT 'labels', NULL UNION ALL SELECT 'pages', NULL
        ), s AS (
            SELECT *, coalesce(age > 36, true) AS sent FROM a
        )
        SELECT 'freshness' AS behavior, table_name, CASE WHEN sent THEN 'CRITICAL' ELSE 'INFO' END AS severity, CASE WHEN sent THEN 'sent' ELSE 'skipped' END AS status,
               CASE WHEN sent THEN 'freshness_stale' ELSE 'freshness_within_sla' END AS reason,
               CASE WHEN NOT sent THEN 'Fresh' WHEN age IS NULL THEN 'No snapshot known' ELSE 'Stale by ' || (age - 36)::VARCHAR || 'h' END AS message,
               36.0::DOUBLE AS threshold, 'freshness|' || table_name || '|-|2024-01-31' AS alert_key
        FROM s
    """,
}

# the table that the second run sees, profiled in full
_SEEN = """ev2 AS (SELECT * FROM main.events WHERE ts::DATE <= DATE '2024-01-10' OR ts::DATE > DATE '2024-01-20'
  OR (ts::DATE BETWEEN DATE '2024-01-13' AND DATE '2024-01-20' AND event_id % 2 = 0))"""
_RUN = f"""{O.STATS}, {O.EXPECTED}, {O.ROWCOUNT}, {O.EV_DRIFT}, {O.MISSING},
counts AS (SELECT e.partition_value, coalesce(s.record_count, 0) AS n FROM expected e LEFT JOIN stats s
  ON s.table_name = e.table_name AND s.partition_value = e.partition_value WHERE e.table_name = 'events'),
age AS (SELECT floor((epoch({O.AS_OF_TS}) - epoch(max(ts))) / 3600) AS hours FROM events),
per AS (SELECT strftime(ts, '%Y-%m-%d') AS p, count(*) AS n, avg(value) AS a, count(*) FILTER (value IS NULL) AS n1, count(*) FILTER (props IS NULL) AS n2 FROM events GROUP BY 1),
lagged AS (SELECT *, lag(a) OVER (ORDER BY p) AS prev FROM per),
pk AS (SELECT count(*) AS total, count(DISTINCT event_id) AS d FROM events),
seg AS (SELECT event_type, count(*) FILTER (value IS NULL) / count(*) AS rate FROM events GROUP BY 1),
f AS (
  SELECT 'metric' AS kind, 'events' AS table_name, partition_value, 'partition_row_count' AS name, n::DOUBLE AS value, NULL::BOOLEAN AS passed, NULL::VARCHAR AS severity FROM counts
  UNION ALL SELECT 'metric', 'events', partition_value, 'partition_exists', CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END, NULL, NULL FROM counts
  UNION ALL SELECT 'rule', 'events', partition_value, 'availability', 1.0, false, 'high' FROM counts WHERE n = 0
  UNION ALL SELECT 'metric', table_name, partition_value, metric_name, metric_value, NULL, NULL FROM rc_metrics WHERE table_name = 'events'
  UNION ALL SELECT 'metric', 'events', NULL, 'snapshot_age_hours', hours, NULL, NULL FROM age
  UNION ALL SELECT 'rule', 'events', NULL, 'freshness', 1.0, false, 'high' FROM age WHERE hours > 6
  UNION ALL SELECT 'metric', 'events', p, 'null_ratio', unnest([n1 / n, n2 / n]), NULL, NULL FROM per
  UNION ALL SELECT 'metric', 'events', p, 'average_change', (a - prev) / prev, NULL, NULL FROM lagged WHERE prev IS NOT NULL
  UNION ALL SELECT 'rule', 'events', NULL, 'pk_duplicates', 1 - d / total, d = total, CASE WHEN d = total THEN 'medium' ELSE 'high' END FROM pk
  UNION ALL SELECT 'rule', 'events', NULL, 'null_rate_value_by_event_type', CASE WHEN rate <= 0.2 THEN 0.0 ELSE rate END, rate <= 0.2, CASE WHEN rate <= 0.2 THEN 'medium' ELSE 'high' END FROM seg
  UNION ALL SELECT 'drift', table_name, partition_value, column_name || '_psi_' || ref_name, score, NULL, CASE WHEN score >= 0.2 THEN 'high' ELSE 'medium' END FROM ev_psi
  UNION ALL {O.MISSING_ROWS})""".replace(" FROM events", " FROM ev2")
SQL["run_changed_files"] = f"""WITH {_SEEN}, {_RUN}
  SELECT kind, table_name, partition_value, name, round(value, 6) AS value, passed, severity FROM f
  UNION ALL SELECT DISTINCT 'read again', 'events', strftime(ts, '%Y-%m-%d'), NULL, NULL, NULL, NULL FROM main.events WHERE ts::DATE > DATE '2024-01-10'"""

SQL["stream_freshness"] = """
    WITH m AS (
        SELECT DISTINCT 'user_' || user_id AS table_name, date_trunc('minute', ts) AS minute FROM events
    ), k AS (
        SELECT max(minute) - INTERVAL 10 MINUTE AS mark FROM m
    ), g AS (
        SELECT table_name, minute + INTERVAL 1 DAY AS due, mark, lead(minute) OVER (PARTITION BY table_name ORDER BY minute) AS next
        FROM m, k WHERE minute + INTERVAL 1 MINUTE <= mark
    )
    SELECT table_name, 'stale' AS status, strftime(due, '%Y-%m-%d %H:%M') AS at FROM g WHERE coalesce(next > due, due + INTERVAL 1 MINUTE <= mark)
    UNION ALL SELECT table_name, 'fresh', strftime(next, '%Y-%m-%d %H:%M') FROM g WHERE next > due
"""

# a day closes when a row comes an hour after its end; the last part's rows are all of closed days
SQL["stream_drift"] = f"""
    WITH v AS (
        SELECT ts::DATE AS d, CASE WHEN isnan(value) THEN NULL ELSE value END AS x, event_id % 50 = 0 AND day(ts) <= 20 AS late FROM events
    ), c AS (
        SELECT d, quantile_disc(x, {O.Q9}) AS cuts FROM v WHERE x IS NOT NULL GROUP BY d
    ), r AS (
        SELECT v.d, CASE WHEN x IS NULL THEN 10 ELSE len(list_filter(cuts, lambda q: x > q)) END AS b, count(*) AS n FROM v JOIN c ON c.d = v.d GROUP BY 1, 2
    ), p AS (
        SELECT d, b, n / sum(n) OVER (PARTITION BY d) AS share FROM r
    ), refs AS (
        SELECT c.d AS ref, c.d + k AS d, name, cuts FROM c, (VALUES (1, 'dod'), (7, 'wow')) t(k, name)
    ), closing AS (
        SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events
    ), q AS (
        SELECT refs.ref, refs.d, name, CASE WHEN x IS NULL THEN 10 ELSE len(list_filter(cuts, lambda q: x > q)) END AS b, count(*) AS n
        FROM refs JOIN v ON v.d = refs.d, closing WHERE NOT late AND refs.d + 1 <= mark GROUP BY 1, 2, 3, 4
    ), cur AS (
        SELECT *, n / sum(n) OVER (PARTITION BY d, name) AS share FROM q
    ), both_sides AS (
        SELECT s.d, s.name, i AS b, coalesce(max(p.share), 0) AS p, coalesce(max(cur.share), 0) AS q
        FROM (SELECT DISTINCT ref, d, name FROM cur) s CROSS JOIN range(11) t(i)
        LEFT JOIN p ON p.d = s.ref AND p.b = i LEFT JOIN cur ON cur.d = s.d AND cur.name = s.name AND cur.b = i GROUP BY 1, 2, 3
    ), scored AS (
        SELECT d, name, sum((greatest(p, 1e-9) - greatest(q, 1e-9)) * ln(greatest(p, 1e-9) / greatest(q, 1e-9))) AS score FROM both_sides GROUP BY 1, 2
    )
    SELECT strftime(d, '%Y-%m-%d') AS partition_value, 'value_psi_' || name AS metric_name, round(score, 6) AS value, CASE WHEN score >= 0.2 THEN 'high' ELSE 'medium' END AS severity FROM scored
    UNION ALL SELECT strftime(v.d, '%Y-%m-%d'), 'late_rows', count(*), NULL FROM v WHERE late AND v.d > (SELECT min(d) FROM v) GROUP BY v.d
"""

# a run sends the five that have waited longest (CRITICAL first among equals, then by name); the machine is unrolled by run
_RUN_DAYS = ["2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05"]


def _alert_runs() -> str:
    ctes = ["""n AS (SELECT event_type || '_' || user_id % 6 AS t, ts::DATE AS d, count(*)::DOUBLE AS n FROM events GROUP BY 1, 2)""",
            """c AS (SELECT a.t, a.d, abs((a.n - b.n) / b.n) > 0.2 AS fires FROM n a JOIN n b ON a.t = b.t AND a.d = b.d + 1)""",
            """s0 AS (SELECT DISTINCT t, NULL::VARCHAR AS status, NULL::VARCHAR AS waiting, NULL::INTEGER AS since, 0::BIGINT AS runs FROM n)"""]
    for i, day in enumerate(_RUN_DAYS, 1):
        ctes.append(f"""m{i} AS (
            SELECT s.t, coalesce(s.status = 'open', false) AS was, c.fires, s.status, s.waiting, s.since, s.runs FROM s{i - 1} s LEFT JOIN c ON c.t = s.t AND c.d = DATE '{day}')""")
        ctes.append(f"""u{i} AS (
            SELECT t, CASE WHEN fires THEN 'open' WHEN fires IS NOT NULL AND was THEN 'resolved' ELSE status END AS status,
                   CASE WHEN fires AND NOT was THEN CASE WHEN waiting = 'resolved' THEN NULL ELSE 'opened' END
                        WHEN NOT fires AND was THEN CASE WHEN waiting = 'opened' THEN NULL ELSE 'resolved' END ELSE waiting END AS waiting,
                   CASE WHEN fires <> was THEN {i} ELSE since END AS since,
                   CASE WHEN fires AND NOT was THEN 1 WHEN fires THEN runs + 1 ELSE runs END AS runs FROM m{i})""")
        ctes.append(f"o{i} AS (SELECT t, waiting FROM u{i} WHERE waiting IS NOT NULL ORDER BY since, t LIMIT 5)")
        ctes.append(f"s{i} AS (SELECT u.t, u.status, CASE WHEN o.t IS NULL THEN u.waiting END AS waiting, u.since, u.runs FROM u{i} u LEFT JOIN o{i} o ON o.t = u.t)")
    last = len(_RUN_DAYS)
    sent = " UNION ALL ".join(f"SELECT '{day}' AS run, t AS table_name, waiting AS what, NULL::BIGINT AS runs FROM o{i}" for i, day in enumerate(_RUN_DAYS, 1))
    return f"WITH {', '.join(ctes)} {sent} UNION ALL SELECT 'state', t, status || '/' || coalesce(waiting, '-'), runs FROM s{last} WHERE status IS NOT NULL"


SQL["alert_state_runs"] = _alert_runs()

SQL["rules_asof"] = """
    WITH cfg AS (SELECT * FROM (VALUES
        (NULL, NULL::BOOLEAN, 0.30::DOUBLE, 'WARN', TIMESTAMP '2024-01-01 00:00:00'),
        (NULL, NULL, 0.50, NULL, TIMESTAMP '2024-01-12 06:00:00'),
        ('click', NULL, 0.10, 'CRITICAL', TIMESTAMP '2024-01-05 00:00:00'),
        ('click', false, NULL, NULL, TIMESTAMP '2024-01-10 12:30:00'),
        ('click', true, 0.20, NULL, TIMESTAMP '2024-01-10 18:00:00'),
        ('view', NULL, NULL, 'INFO', TIMESTAMP '2024-01-20 23:59:59')) v(t, enabled, threshold, severity, since)
    ), over AS (SELECT * FROM cfg WHERE t IS NOT NULL), dflt AS (SELECT * FROM cfg WHERE t IS NULL)
    SELECT e.event_id, e.event_type AS table_name, coalesce(o.enabled, d.enabled, true) AS enabled, coalesce(o.threshold, d.threshold, 0.20) AS threshold,
           coalesce(o.severity, d.severity, 'WARN') AS severity
    FROM events e ASOF LEFT JOIN over o ON o.t = e.event_type AND e.ts >= o.since ASOF LEFT JOIN dflt d ON e.ts >= d.since
"""

# the brute force: the whole cube, and of its failing cells those without a failing part
_CUBE = """base AS (
        SELECT lang, source, floor(log10(n_chars + 1))::BIGINT AS size, d.doc_id % 3 AS third, l.quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
    ), cube AS (
        SELECT GROUPING(lang) = 0 AS u1, GROUPING(source) = 0 AS u2, GROUPING(size) = 0 AS u3, GROUPING(third) = 0 AS u4, lang, source, size, third,
               count(*) AS rows, count(*) FILTER (quality IS NULL) AS null_rows
        FROM base GROUP BY CUBE (lang, source, size, third)
    ), cells AS (
        SELECT *, u1::INT + u2::INT + u3::INT + u4::INT AS level, null_rows / rows > 0.7 AND rows >= 15 AS fails FROM cube
    )"""
_PART = """p.level < c.level AND (NOT p.u1 OR (c.u1 AND p.lang IS NOT DISTINCT FROM c.lang)) AND (NOT p.u2 OR (c.u2 AND p.source IS NOT DISTINCT FROM c.source))
        AND (NOT p.u3 OR (c.u3 AND p.size IS NOT DISTINCT FROM c.size)) AND (NOT p.u4 OR (c.u4 AND p.third IS NOT DISTINCT FROM c.third))"""
SQL["failing_segments"] = f"""
    WITH {_CUBE}
    SELECT level, concat_ws(', ', CASE WHEN u1 THEN 'lang=' || coalesce(lang, '<null>') END, CASE WHEN u2 THEN 'source=' || coalesce(source, '<null>') END,
               CASE WHEN u3 THEN 'size=' || coalesce(size::VARCHAR, '<null>') END, CASE WHEN u4 THEN 'third=' || coalesce(third::VARCHAR, '<null>') END) AS segment,
           rows, null_rows, round(null_rows / rows, 6) AS null_rate
    FROM cells c WHERE fails AND NOT EXISTS (SELECT 1 FROM cells p WHERE p.fails AND {_PART})
"""
# a cell is looked at when no part of it fails or is hopeless
SQL["failing_segments_levels"] = f"""
    WITH {_CUBE}, seen AS (
        SELECT * FROM cells c WHERE NOT EXISTS (SELECT 1 FROM cells p WHERE (p.fails OR p.rows < 15 OR p.null_rows = 0) AND {_PART})
    ), per AS (
        SELECT level, count(*) AS candidates, count(*) FILTER (fails) AS failing, count(*) FILTER (NOT fails AND rows >= 15 AND null_rows > 0) AS alive FROM seen GROUP BY level
    )
    SELECT l::INTEGER AS level, coalesce(candidates, 0) AS candidates, coalesce(failing, 0) AS failing, coalesce(alive, 0) AS alive
    FROM range(5) t(l) LEFT JOIN per ON per.level = l
    WHERE l = 0 OR EXISTS (SELECT 1 FROM per q WHERE q.level = l - 1 AND q.alive > 0)
"""

SQL["publish_checked"] = """
    SELECT o_orderkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m') AS month, 1 AS refused FROM orders
    WHERE strftime(o_orderdate, '%Y') <> '1998' OR o_orderstatus = 'F'
       OR strftime(o_orderdate, '%Y-%m') NOT IN (SELECT strftime(o_orderdate, '%Y-%m') FROM orders WHERE o_orderstatus = 'F')
"""

SQL["write_nested"] = """
    SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 1 THEN 5000000000 ELSE floor(o_totalprice)::BIGINT END AS whole,
           CASE WHEN o_orderkey % 3 <> 1 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority END AS priority,
           o_custkey AS cust, CASE WHEN o_orderkey % 3 = 1 THEN 'x' END AS note, o_custkey + CASE WHEN o_orderkey % 3 = 1 THEN 5000000000 ELSE 0 END AS tag,
           CASE WHEN o_orderkey % 3 = 1 THEN 'late' END AS batch
    FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'
"""
