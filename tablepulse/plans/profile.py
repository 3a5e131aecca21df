"""Profile runs over several tables and the partition tables built from them.

Checks that work per partition run once over all tables' rows; key duplicates,
segment nulls and drift, whose columns differ, contribute one frame per table,
which are ``unionByName``-ed, so Spark schedules all tables together. The per-table
partition aggregate (counts, null counts, averages, newest time) is
computed by one scan per table; all tables' aggregates are unioned and
checkpointed in one job when the run is built; the checks read that small
frame.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablepulse import schemas as S
from tablepulse.functions.exprs import as_instant, partition_order, str_map
from tablepulse.functions.partitioning import Partitioning
from tablepulse.operators import availability as A
from tablepulse.operators.averages import average_change_metrics, partition_averages
from tablepulse.operators.drift import drift_parts, reference_missing
from tablepulse.operators.nulls import (
    null_counts_by_partition,
    null_ratio_by_partition,
    null_ratio_metrics,
    segment_nulls,
)
from tablepulse.operators.partition_profile import (
    averages_of_normalized,
    history_of_normalized,
    normalized_profile,
    null_counts_of_normalized,
    partition_profile,
    stats_of,
)
from tablepulse.operators.results import metric_date_of, metric_rows
from tablepulse.operators.rowcounts import row_count_changes
from tablepulse.operators.sampling import sample_bernoulli, sample_by_key
from tablepulse.operators.uniqueness import pk_duplicates
from tablepulse.session import checkpointed
from tablepulse.sinks.storage import append_results
from tablepulse.sources.scan import scan_partitions
from tablepulse.sources.stats import history_from_column, latest_snapshot, stats_from_metadata

MODES = ("availability", "rules", "drift", "all")


@dataclass
class TableSpec:
    """What to profile in one table."""

    name: str
    df: DataFrame
    partitioning: Partitioning | None = None
    expected: Sequence[str] = ()
    key_cols: Sequence[str] = ()
    drift_columns: Sequence[str] = ()
    today: str | None = None  # current partition for drift; None compares every partition
    null_columns: Sequence[str] = ()
    segment_column: str | None = None
    segment_dims: Sequence[str] = tuple(S.SEGMENT_DIMS)
    average_columns: Sequence[str] = ()
    time_column: str | None = None  # newest value stands for the newest snapshot
    history: DataFrame | None = None  # table_name, made_current_at (overrides time_column)
    stats: DataFrame | None = None  # table_name, partition_value, record_count (overrides counting)
    row_counts: bool = True  # report row-count change between consecutive partitions
    partitions: Sequence[str] = ()  # only these are read and reported (drift also reads their reference days)
    metadata: DataFrame | None = None  # a catalog's partitions table: counts (and the lag history) without reading rows
    metadata_key: str | None = None  # its key column; the partition column by default
    stored: DataFrame | None = None  # partition rows of earlier runs (see ``stored_rows``): known, but not read again
    report_stored: bool = False  # report on stored partitions, too, and not only compare with them
    scan: bool = True  # False: no partition is read, all are stored


@dataclass
class Profile:
    metrics: DataFrame
    rules: DataFrame
    drift: DataFrame
    new_cuts: DataFrame
    extras: dict = field(default_factory=dict)

    def findings(self) -> DataFrame:
        """All results in one long shape: ``kind, table_name, partition_value, name, value, passed, severity``."""
        m = self.metrics.select(
            F.lit("metric").alias("kind"), "table_name", "partition_value", F.col("metric_name").alias("name"),
            F.col("metric_value").alias("value"), F.lit(None).cast("boolean").alias("passed"),
            F.lit(None).cast("string").alias("severity"),
        )
        r = self.rules.select(
            F.lit("rule").alias("kind"), "table_name", "partition_value", F.col("rule_id").alias("name"),
            F.col("fail_rate").alias("value"), "passed", "severity",
        )
        d = self.drift.select(
            F.lit("drift").alias("kind"), "table_name", "partition_value", F.col("metric_name").alias("name"),
            F.col("score").alias("value"), F.lit(None).cast("boolean").alias("passed"), "severity",
        )
        return m.unionByName(r).unionByName(d)


def write_results(profile: Profile, names: Mapping[str, str]) -> None:
    """Append a run's metrics, rules, drift rows and new cuts to their tables (``ensure_tables`` makes them)."""
    for kind, frame in (("metrics", profile.metrics), ("rules", profile.rules), ("drift", profile.drift), ("cuts", profile.new_cuts)):
        append_results(frame, kind, names[kind])


def _union(spark: SparkSession, frames: list[DataFrame], schema) -> DataFrame:
    if not frames:
        return spark.createDataFrame([], schema)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def known_stats(t: TableSpec) -> DataFrame | None:
    """Row counts that need no scan: given ones, or those of a partitions metadata table."""
    if t.stats is not None:
        return t.stats.select("table_name", "partition_value", F.col("record_count").cast("long").alias("record_count"))
    if t.metadata is not None:
        return stats_from_metadata(t.metadata, t.name, t.metadata_key or t.partitioning.column)
    return None


def stored_rows(partition_stats: DataFrame, partition_info: DataFrame | None = None) -> DataFrame:
    """Partition rows for ``TableSpec.stored`` from stored tables: ``table_name, partition_value, record_count`` and,
    for averages, ``table_name, partition_value, column_name, average``."""
    keys = ["table_name", "partition_value"]
    out = partition_stats.select(*keys, F.col("record_count").cast("long").alias("record_count")).withColumn("nulls", F.create_map().cast("map<string,bigint>"))
    none = F.create_map().cast("map<string,double>")
    if partition_info is None:
        out = out.withColumn("averages", none)
    else:
        pairs = F.map_from_entries(F.collect_list(F.struct("column_name", F.col("average").cast("double"))))
        averages = partition_info.groupBy(*keys).agg(pairs.alias("averages"))
        out = out.join(averages, keys, "left").withColumn("averages", F.coalesce("averages", none))
    return out.withColumn("max_ts", F.lit(None).cast("timestamp"))


def _is_profiled(t: TableSpec, rules: bool) -> bool:
    return t.partitioning is not None and (known_stats(t) is None or (rules and bool(t.null_columns or t.average_columns)))


def partition_rows(tables: Sequence[TableSpec], rules: bool = True, availability: bool = True) -> DataFrame | None:
    """The partition aggregates that all partition checks read, one row per table and partition: those of the partitions
    that are read (``reported``), and the stored rows of the others."""
    parts = []
    for t in tables:
        if not _is_profiled(t, rules):
            continue
        nulls = list(t.null_columns) if rules else []
        avgs = list(t.average_columns) if rules else []
        counted_elsewhere = known_stats(t) is not None
        tcol = t.time_column if availability and t.history is None and not counted_elsewhere else None
        if t.scan:
            rows = scan_partitions(t.df, t.partitioning, t.partitions)
            pp = normalized_profile(partition_profile(rows, t.name, t.partitioning, nulls, avgs, tcol), nulls, avgs, tcol is not None)
            # counts come from the metadata where there is some
            parts.append(pp.withColumn("counted", F.lit(not counted_elsewhere)).withColumn("reported", F.lit(True)))
        if t.stored is not None:
            own = t.stored.where(F.col("table_name") == t.name)
            if t.scan:
                # a partition that is read again is not taken from the store; without a list all are read
                known = F.coalesce(F.col("partition_value").isin([p for p in t.partitions if p is not None]), F.lit(None in t.partitions))
                own = own.where(~known) if t.partitions else own.where(F.lit(False))
            flags = [F.lit(not counted_elsewhere).alias("counted"), F.lit(t.report_stored).alias("reported")]
            parts.append(own.select("table_name", "partition_value", "record_count", "nulls", "averages", "max_ts", *flags))
    if not parts:
        return None
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def _without_history(rows: DataFrame, group: Sequence[str], check: str, as_of: datetime | str | None) -> DataFrame:
    """Metric ``no_history`` = 1 for the first known partition of each group: nothing is there to compare it with."""
    w = Window.partitionBy(*group).orderBy(*partition_order(F.col("partition_value")))
    first = rows.where("partition_value IS NOT NULL").withColumn("_n", F.row_number().over(w)).where("_n = 1")
    column = {"column": F.col("column_name")} if "column_name" in group else {}
    return metric_rows(
        first, F.col("table_name"), F.col("partition_value"), metric_date_of(F.col("partition_value"), as_of), F.lit("no_history"), F.lit(1.0),
        str_map(check=check, **column),
    )


def run_profile(
    spark: SparkSession,
    tables: Sequence[TableSpec],
    mode: str = "all",
    as_of: datetime | str | None = None,
    run_ts: datetime | str | None = None,
    sla_hours: int = S.SLA_HOURS,
    null_threshold: float = S.NULL_RATE_THRESHOLD,
    bins: int = S.DRIFT_BINS,
    psi_threshold: float = S.PSI_THRESHOLD,
    saved_cuts: DataFrame | None = None,
    dup_method: str = "exact",
    sample_fraction: float | None = None,
    sample_method: str = "key",
    row_count_last: int | None = None,
    quantile_accuracy: int = S.QUANTILE_ACCURACY,
    dup_examples: int = 5,
) -> Profile:
    """Run ``mode`` (availability | rules | drift | all) over ``tables``.

    availability: partition availability, row-count change and freshness.
    rules: key duplicates, segment null rates, null ratio and average change.
    drift: PSI against the previous day and week (cuts reused when saved).
    ``sample_fraction`` samples the rows checked by the rules (by key when
    ``sample_method="key"``); ``None`` checks every row. ``row_count_last``
    reports row-count change for the newest partitions only, by default for
    all. ``dup_examples`` is the number of example keys a duplicates rule shows.
    A table's ``partitions`` restrict what is read and reported; changes are then
    taken against the partitions that ``stored``, ``metadata`` or ``stats`` know, and
    a partition without a known earlier one gives ``no_history``.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    run_ts = run_ts if run_ts is not None else as_of
    metrics: list[DataFrame] = []
    rules: list[DataFrame] = []
    drifts: list[DataFrame] = []
    cuts: list[DataFrame] = []
    do = lambda m: mode in (m, "all")

    # One partition aggregate per table feeds counts, null ratios, averages and
    # history. It is small (one row per partition) and is checkpointed to the
    # session's checkpoint folder so that every check reads it instead of
    # rescanning the table (per-branch column pruning would defeat exchange reuse).
    every = partition_rows(tables, do("rules"), do("availability"))
    profiled = {t.name for t in tables if _is_profiled(t, do("rules"))}
    if every is not None:
        # one job for all tables; small frames are put together, as every check would read each of their partitions
        every = checkpointed(every.hint("rebalance"))

    # every check runs once over all tables' rows (table_name keeps them apart), so the plan does not grow with the tables
    keys = {t.name: t.partitioning.column for t in tables if t.partitioning is not None}
    named = {t.name for t in tables}
    restricted = {t.name for t in tables if t.partitions and not t.report_stored}

    def only(df: DataFrame, names: Iterable[str]) -> DataFrame:
        """The rows of some tables, of the partitions that the run is about."""
        limited = {t.name: list(t.partitions) for t in tables if t.partitions and not t.report_stored}
        wanted = F.col("table_name").isin(sorted(names))
        for name, values in limited.items():
            wanted = wanted & ((F.col("table_name") != name) | F.col("partition_value").isin(values))
        return df.where(wanted) if set(names) != named or limited else df

    if do("availability"):
        counted = [t for t in tables if t.partitioning is not None or known_stats(t) is not None]
        stats = [stats_of(every.where("counted"))] if every is not None else []
        stats = _union(spark, stats + [known_stats(t) for t in counted if known_stats(t) is not None], S.PARTITION_STATS)
        exp = {t.name: [p for p in t.expected if not t.partitions or p in t.partitions] for t in counted if t.expected}
        if exp:
            n_exp = sum(len(v) for v in exp.values())
            counts = A.partition_counts(stats, A.expected_partitions(spark, exp), n_exp)
            metrics.append(A.availability_metrics(counts, keys, as_of))
            rules.append(A.availability_rules(counts, run_ts))
        changing = [t.name for t in counted if t.row_counts]
        if changing:
            changes = row_count_changes(stats.where(F.col("table_name").isin(changing)), keys, row_count_last, as_of=as_of)
            metrics.append(only(changes, changing))
            some = [n for n in changing if n in restricted]
            if some:
                metrics.append(only(_without_history(stats.where(F.col("table_name").isin(some)), ["table_name"], "row_count_dod_delta", as_of), changing))
        names = [t.name for t in tables if t.history is not None or t.time_column]
        if names:
            hist = [t.history.select("table_name", F.col("made_current_at").cast("timestamp").alias("made_current_at")) for t in tables if t.history is not None]
            if every is not None:
                hist.append(history_of_normalized(every.where("max_ts IS NOT NULL")))
            hist += [history_from_column(t.df, t.name, t.time_column) for t in tables if t.history is None and t.time_column and t.name not in profiled]
            h = checkpointed(_union(spark, hist, S.HISTORY))
            metrics.append(A.freshness_metrics(h, as_of))
            rules.append(A.freshness_rules(A.table_list(spark, names), h, as_of, sla_hours, run_ts, len(names)))
    if do("rules"):
        for t in tables:
            checked = scan_partitions(t.df, t.partitioning, t.partitions)
            if sample_fraction is not None:
                checked = sample_by_key(checked, t.key_cols, sample_fraction) if sample_method == "key" and t.key_cols \
                    else sample_bernoulli(checked, sample_fraction)
            if t.key_cols:
                rules.append(pk_duplicates(checked, t.key_cols, t.name, method=dup_method, examples=dup_examples, ts=run_ts))
            if t.segment_column:
                rules.append(segment_nulls(checked, t.segment_column, t.segment_dims, null_threshold, t.name, run_ts))
            if t.null_columns and t.name not in profiled:
                metrics.append(null_ratio_by_partition(checked, t.name, t.partitioning, t.null_columns, as_of))
        if every is not None:
            if any(t.null_columns for t in tables):
                metrics.append(null_ratio_metrics(null_counts_of_normalized(every.where("reported")), keys, as_of))
            if any(t.average_columns for t in tables):
                averages = averages_of_normalized(every)
                metrics.append(only(average_change_metrics(averages, keys, as_of), named))
                if restricted:
                    some = averages.where(F.col("table_name").isin(sorted(restricted)) & F.col("average").isNotNull())
                    metrics.append(only(_without_history(some, ["table_name", "column_name"], "average_change", as_of), named))
    if do("drift"):
        for t in tables:
            if t.drift_columns and t.partitioning is not None:
                today = t.today if t.today is not None else (list(t.partitions) or None)
                d, c, used = drift_parts(
                    t.df, t.name, t.partitioning, t.drift_columns, today, bins=bins, threshold=psi_threshold,
                    saved_cuts=saved_cuts, accuracy=quantile_accuracy, ts=run_ts,
                )
                drifts.append(d)
                cuts.append(c)
                if today is None and t.name in profiled:
                    today = every.where(F.col("table_name") == t.name)
                if today is not None:
                    metrics.append(reference_missing(used, t.name, t.drift_columns, today, as_of=as_of))
    return Profile(
        metrics=_union(spark, metrics, S.METRIC),
        rules=_union(spark, rules, S.RULE),
        drift=_union(spark, drifts, S.DRIFT),
        new_cuts=_union(spark, cuts, S.CUTS),
    )


def counted_partitions(spark: SparkSession, tables: Sequence[TableSpec]) -> DataFrame:
    """``table_name, partition_value, record_count, max_ts`` of all tables from one aggregation over their rows.

    A table brings its partition as a date (day and month grain) or as text, and its time column in its own type, so
    no row is formatted. Known counts (metadata, ``stats``) need no rows; ``partitions`` limit what is read.
    """
    scanned = [t for t in tables if t.partitioning is not None and known_stats(t) is None]
    kinds = {"timestamp": "_zoned", "timestamp_ntz": "_plain", "date": "_zoned"}
    rows, formats = None, F.lit(None).cast("string")
    for t in scanned:
        key, df = t.partitioning.key(), scan_partitions(t.df, t.partitioning, t.partitions)
        as_day = t.partitioning.grain != "value"
        kind = kinds.get(dict(df.dtypes).get(t.time_column or "", ""), "_zoned")
        newest = {c: F.lit(None).cast(d) for c, d in (("_zoned", "timestamp"), ("_plain", "timestamp_ntz"))}
        if t.time_column and t.history is None:
            newest[kind] = F.col(t.time_column).cast("timestamp_ntz" if kind == "_plain" else "timestamp")
        part = df.select(
            F.lit(t.name).alias("table_name"), (key if as_day else F.lit(None)).cast("date").alias("_day"),
            (F.lit(None) if as_day else key).cast("string").alias("_text"), *[c.alias(n) for n, c in newest.items()],
        )
        rows = part if rows is None else rows.unionByName(part)
        if as_day:
            formats = F.when(F.col("table_name") == t.name, t.partitioning.text_of(F.col("_day"))).otherwise(formats)
    known = [known_stats(t).withColumn("max_ts", F.lit(None).cast("timestamp")) for t in tables if known_stats(t) is not None]
    out = None
    if rows is not None:
        counted = rows.groupBy("table_name", "_day", "_text").agg(F.count(F.lit(1)).alias("record_count"), F.max("_zoned").alias("_zoned"), F.max("_plain").alias("_plain"))
        at = F.coalesce("_zoned", as_instant(F.col("_plain"), counted.schema["_plain"].dataType))
        out = counted.select("table_name", F.coalesce("_text", formats).alias("partition_value"), "record_count", at.alias("max_ts"))
    for x in known:
        out = x if out is None else out.unionByName(x)
    return out if out is not None else spark.createDataFrame([], "table_name string, partition_value string, record_count long, max_ts timestamp")


def partition_status(
    spark: SparkSession, tables: Sequence[TableSpec], as_of: datetime | str | None = None
) -> DataFrame:
    """``table_name, partition_value, record_count, row_count_dod_delta, snapshot_age_hours`` per partition.

    One branch for all tables. Of a table with ``partitions`` only these are read and reported; its changes are taken
    against the partitions that ``stored``, ``metadata`` or ``stats`` know.
    """
    read = checkpointed(counted_partitions(spark, tables))
    limited = {t.name: list(t.partitions) for t in tables if t.partitions}
    stats = read.select("table_name", "partition_value", "record_count")
    for t in tables:
        if t.stored is not None and t.partitions and known_stats(t) is None:
            own = t.stored.where((F.col("table_name") == t.name) & ~F.col("partition_value").isin(list(t.partitions)))
            stats = stats.unionByName(own.select(*stats.columns))
    dod = row_count_changes(stats, last=None, as_of=as_of).where(F.col("metric_name") == "row_count_dod_delta").select(
        "table_name", "partition_value", F.col("metric_value").alias("row_count_dod_delta")
    )
    wanted = F.lit(True)
    for name, values in limited.items():
        wanted = wanted & ((F.col("table_name") != name) | F.col("partition_value").isin(values))
    s = read.where(wanted).select("table_name", "partition_value", "record_count").join(dod, ["table_name", "partition_value"], "left")
    given = [t.history.where(F.col("table_name") == t.name).select("table_name", F.col("made_current_at").cast("timestamp").alias("made_current_at")) for t in tables if t.history is not None]
    given += [history_from_column(t.df, t.name, t.time_column) for t in tables if t.history is None and t.time_column and known_stats(t) is not None]
    history = _union(spark, [history_of_normalized(read.where("max_ts IS NOT NULL")), *given], S.HISTORY)
    age = A.snapshot_age(latest_snapshot(history), as_of).select("table_name", F.col("age_hours").cast("long").alias("snapshot_age_hours"))
    # one row per table
    s = s.join(F.broadcast(age), "table_name", "left")
    return s.select("table_name", "partition_value", "record_count", "row_count_dod_delta", "snapshot_age_hours")


def partition_null_stats(spark: SparkSession, tables: Sequence[TableSpec]) -> DataFrame:
    """``table_name, partition_value, column_name, record_count, null_count, null_ratio`` per partition and column."""
    parts = [
        null_counts_by_partition(t.df, t.name, t.partitioning, t.null_columns).withColumn(
            "null_ratio", F.col("null_count") / F.col("record_count")
        )
        for t in tables
        if t.null_columns
    ]
    return _union(
        spark, parts,
        "table_name string, partition_value string, record_count long, column_name string, null_count long, null_ratio double",
    )


def partition_info(spark: SparkSession, tables: Sequence[TableSpec]) -> DataFrame:
    """``table_name, partition_value, rows, column_name, average`` per partition and column."""
    parts = [partition_averages(t.df, t.name, t.partitioning, t.average_columns) for t in tables
             if t.average_columns and t.partitioning is not None]
    return _union(spark, parts, "table_name string, partition_value string, rows long, column_name string, average double")
