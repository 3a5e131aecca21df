"""Registered queries against their DuckDB SQL at sf0.01 (all of them when TABLEPULSE_FULL_ORACLE=1)."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from tablepulse.plans import oracle, oracle_stored, registered, registered_stored
from conftest import SF01

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FAST = [
    "partition_stats", "availability_rules", "freshness_rules", "row_count_dod", "pk_duplicates_composite",
    "null_ratio_by_partition", "segment_nulls_null_segment", "drift_dod_wow", "drift_with_saved_cuts",
    "policy_all", "batch_text", "write_overwrite_partitions", "run_all", "run_partitions", "sample_by_key", "sample_bernoulli",
    "freshness_history", "partition_stats_metadata", "write_telemetry", "pk_duplicates_approx",
    "pk_duplicates_stored", "sketch_distinct_ranges", "drift_from_sketches", "run_partition_stored", "alerts_without_snapshots", "rules_asof",
    "failing_segments", "failing_segments_levels", "write_nested", "store_partition_status",
]
NAMES = list(oracle.SQL | oracle_stored.SQL) if os.environ.get("TABLEPULSE_FULL_ORACLE") else FAST


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


def _bag(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: round(v, 6) if isinstance(v, float) and not math.isnan(v) else v
    return Counter(tuple(norm(r[i]) for i in order) for r in rs)


def test_every_query_has_sql_or_is_rows_only():
    rows_only = set(registered.QUERIES | registered_stored.QUERIES) - set(oracle.SQL | oracle_stored.SQL)
    assert rows_only == set()
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_matches_duckdb(spark, duck, name):
    df = E.queries()[name](spark, SF01)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(dcols, cur.fetchall())


def test_entry_runs_on_smallest_scale(spark):
    df = E.entry(spark)
    assert df.columns == ["batch_no", "alerts", "text", "items"]
    got = df.collect()
    assert got and sum(r["alerts"] for r in got) > 0
    assert [r["batch_no"] for r in sorted(got)] == list(range(len(got)))
