"""X1, change-driven: a run reads the partitions of new, changed and removed files only.

A state of six tables keeps what the last run knew: the manifest of files, one
row of aggregates per partition, quantile cuts and drift rows per day, and the
rules over whole tables. Each run writes its state under a number of its own and
enters the number in the table of runs last, so a run that dies leaves the state
before it in force, and nobody reads its half-written rows.

What depends on a changed partition is worked out again, not only the partition:

* row-count and average changes, availability, null ratios and freshness come from
  the partition rows, stored and new, of the whole table (no scan of the stored ones);
* drift is computed again for changed days and for the days that have a changed day
  as a reference; cuts of unchanged days are taken from the state;
* key duplicates and segment null rates are rules over all rows of a table: a table with a
  changed file is read in full for them (their columns only), a table without one is not read.

So the findings are those of a full run.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepulse import schemas as S
from tablepulse.functions.exprs import lit_ts
from tablepulse.operators.drift import DEFAULT_REFERENCES, drift_parts, reference_missing
from tablepulse.plans.profile import Profile, TableSpec, partition_rows, run_profile
from tablepulse.session import checkpointed
from tablepulse.sinks.versions import Versions
from tablepulse.sources.manifest import MANIFEST, changed_files, list_files, partitions_of_files

ROWS = "table_name string, partition_value string, record_count long, nulls map<string,bigint>, averages map<string,double>, max_ts timestamp"
SCHEMAS = {"manifest": MANIFEST, "rows": ROWS, "cuts": S.CUTS, "drift": S.DRIFT, "rules": S.RULE}


@dataclass
class FileTable:
    """A table whose data files lie in a folder (or a glob of folders), which ``spec.df``, made for this run, reads.
    Of the spec ``partitions``, ``stored`` and ``today`` are set by the run."""

    spec: TableSpec
    folder: str
    pattern: str = "*.parquet"
    base: str | None = None  # root of folders named after partition columns


@dataclass
class ChangedRun:
    profile: Profile
    files: DataFrame  # table_name, path, status
    affected: dict[str, list[str | None]]  # partitions that were read again
    run_id: int


class RunState(Versions):
    """The state tables ``<prefix>_<kind>`` in ``folder``."""

    def __init__(self, spark: SparkSession, prefix: str, folder: str):
        super().__init__(spark, prefix, folder, SCHEMAS)


def _shifted(days: Sequence[str | None], by: Sequence[int]) -> set[str]:
    out = set()
    for d in days:
        try:
            day = date.fromisoformat(d or "")
        except ValueError:
            continue
        out |= {(day + timedelta(days=k)).isoformat() for k in by}
    return out


def _union(frames: list[DataFrame], spark: SparkSession, schema) -> DataFrame:
    out = spark.createDataFrame([], schema)
    for f in frames:
        out = out.unionByName(f.select(*out.columns))
    return out


def run_changed(
    spark: SparkSession,
    tables: Sequence[FileTable],
    state: RunState,
    as_of: datetime | str | None = None,
    run_ts: datetime | str | None = None,
    bins: int = S.DRIFT_BINS,
    psi_threshold: float = S.PSI_THRESHOLD,
    quantile_accuracy: int = S.QUANTILE_ACCURACY,
    **options,
) -> ChangedRun:
    """The findings of ``run_profile(mode="all")`` over ``tables``, reading only what changed since the state's last run.

    ``options`` go to :func:`run_profile`. The new state is written before the findings are returned.
    """
    run_ts = run_ts if run_ts is not None else as_of
    listing = _union([list_files(spark, t.spec.name, t.folder, t.pattern) for t in tables], spark, "table_name string, path string, length long, modified_at timestamp")
    files = checkpointed(changed_files(listing, state.read("manifest")))
    stored_rows, stored_cuts, stored_drift = state.read("rows"), state.read("cuts"), state.read("drift")
    manifest, specs, again, affected = [], [], [], {}
    for t in tables:
        own = files.where(F.col("table_name") == t.spec.name)
        fresh = own.where(F.col("status").isin("new", "changed"))
        found = checkpointed(partitions_of_files(t.spec.df, t.base, t.spec.partitioning, fresh, fresh.count()))
        new = fresh.drop("partitions").join(found, "path", "left").withColumn("partitions", F.coalesce("partitions", F.array().cast("array<string>")))
        manifest += [new, own.where("status = 'same'")]
        touched = found.select(F.explode("partitions").alias("p")).unionByName(own.where("status IN ('changed', 'removed')").select(F.explode("partitions").alias("p")))
        # a value per partition that has to be read again: the predicates of its scan
        parts = sorted((r["p"] for r in touched.distinct().collect()), key=lambda p: (p is None, p or ""))
        affected[t.spec.name] = parts
        specs.append(replace(t.spec, partitions=parts, scan=bool(parts), stored=stored_rows))
        if parts:
            again.append(t.spec.name)
    # one job aggregates the changed partitions of all tables; a stored row of a partition without rows is left out
    rows = checkpointed(partition_rows(specs).select("table_name", "partition_value", "record_count", "nulls", "averages", "max_ts"))

    checked = [replace(t.spec, key_cols=(), segment_column=None, drift_columns=(), partitions=(), scan=False, stored=rows, report_stored=True) for t in tables]
    p = run_profile(spark, checked, "all", as_of, run_ts, **options)
    metrics, drifts, cuts = [p.metrics], [], []
    steps = [r.days for r in DEFAULT_REFERENCES]
    for t in tables:
        s, mine = t.spec, F.col("table_name") == t.spec.name
        if not s.drift_columns:
            continue
        changed = _shifted(affected[s.name], [0])
        days = sorted(_shifted(affected[s.name], [0, *steps]))
        old_cuts = stored_cuts.where(mine & ~F.col("partition_value").isin(sorted(changed)))
        drifts.append(stored_drift.where(mine & ~F.col("partition_value").isin(days)))
        if days:
            d, _, used = drift_parts(
                s.df, s.name, s.partitioning, s.drift_columns, days, bins=bins, threshold=psi_threshold, saved_cuts=old_cuts, accuracy=quantile_accuracy, ts=run_ts
            )
            drifts.append(d)
            # every changed day is a reference of a later one, so its new cuts are among these
            new_cuts = used.where(F.col("partition_value").isin(sorted(changed)))
            old_cuts = old_cuts.unionByName(new_cuts.withColumn("created_at", lit_ts(run_ts)).select(*old_cuts.columns))
        old_cuts = checkpointed(old_cuts)
        cuts.append(old_cuts)
        metrics.append(reference_missing(old_cuts, s.name, s.drift_columns, rows.where(mine), as_of=as_of))
    whole = [replace(t.spec, partitioning=None, null_columns=(), average_columns=(), drift_columns=(), partitions=(), stored=None) for t in tables if t.spec.name in again]
    kept = state.read("rules").where(~F.col("table_name").isin(again))
    rules = run_profile(spark, whole, "rules", as_of, run_ts, **options).rules.unionByName(kept) if whole else kept
    rules = checkpointed(rules)
    drift = checkpointed(_union(drifts, spark, S.DRIFT))

    run_id = state.next_run()
    state.write(run_id, {"manifest": _union(manifest, spark, MANIFEST), "rows": rows, "cuts": _union(cuts, spark, S.CUTS), "drift": drift, "rules": rules})
    profile = Profile(_union(metrics, spark, S.METRIC), p.rules.unionByName(rules), drift, _union(cuts, spark, S.CUTS))
    return ChangedRun(profile, files.select("table_name", "path", "status"), affected, run_id)
