"""Stored sketches: distinct keys (C7, S3) and quantiles (D1, D5) of any range of partitions without a scan.

:func:`partition_sketches` reads a table (or only its changed partitions) once and
gives one row per partition and key (a HyperLogLog sketch of the key's values)
or numeric column (a KLL quantile sketch). The rows are appended to a table;
the newest row of a partition counts (:func:`latest_sketches`). A sketch is a few
kilobytes whatever the partition's rows, and sketches of several partitions merge
into the sketch of all of them:

* :func:`distinct_keys` and :func:`pk_duplicates_stored` merge key sketches over groups
  of partitions: distinct keys and the duplicate rate of a week, a month or the
  whole table are a union of stored rows.
* :func:`stored_cuts` turns merged value sketches into quantile cuts, and
  :func:`drift_from_sketches` compares current days with references of several
  earlier days: only the current days' rows are scanned.

Both kinds of sketch are built by aggregate functions with partial merge, so a
partition with a third of the rows is split over tasks.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepulse import schemas as S
from tablepulse.functions.exprs import lit_ts, nan_to_null, str_map
from tablepulse.functions.joins import bounded_broadcast
from tablepulse.functions.partitioning import Partitioning, as_partitioning
from tablepulse.operators.drift import bucket_of, day_values, psi
from tablepulse.operators.results import pass_severity, rule_rows
from tablepulse.session import checkpointed

#: 2**LG_K registers of a key sketch: relative standard error 1.04 / sqrt(2**LG_K), 1.6 %
LG_K = 12
#: size of a value sketch: rank error 2.296 / K**0.9021, 0.13 %
K = 4096
#: quantiles that shares of a value sketch are read from
GRID = 2000
KEYS, VALUES = "keys", "values"
SKETCHES = "table_name STRING, partition_value STRING, kind STRING, name STRING, record_count BIGINT, null_count BIGINT, sketch BINARY, created_at TIMESTAMP"


def key_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a distinct count from merged key sketches."""
    return 1.04 / math.sqrt(2**lg_k)


def rank_error(k: int = K) -> float:
    """How far, as a share of all values, a quantile of a value sketch may be from its rank (with 99 % confidence)."""
    return 2.296 / k**0.9021


def key_hash(cols: Sequence[str]) -> Column:
    """A 64-bit hash of a key in which nulls are values of their own, so ('a', null) and (null, 'a') differ."""
    return F.xxhash64(*[x for c in cols for x in (F.col(c).isNull(), F.col(c))])


def partition_sketches(
    df: DataFrame,
    table_name: str,
    partitioning: Partitioning | str,
    keys: Mapping[str, Sequence[str]] | None = None,
    values: Sequence[str] = (),
    ts: datetime | str | None = None,
    lg_k: int = LG_K,
    k: int = K,
) -> DataFrame:
    """``table_name, partition_value, kind, name, record_count, null_count, sketch, created_at`` from one scan.

    ``keys`` maps a name to its columns (a null is a value of a key). ``values`` are numeric
    columns (text is cast; NaN and what is not a number count as null). A column without any
    value in a partition has an empty sketch and ``null_count = record_count``.
    """
    p = as_partitioning(partitioning)
    keys = keys or {}
    number = {c: nan_to_null(F.expr(f"try_cast(`{c}` AS DOUBLE)")) for c in values}
    aggs = [F.count(F.lit(1)).alias("record_count")]
    aggs += [F.hll_sketch_agg(key_hash(cols), lg_k).alias(f"k{i}") for i, cols in enumerate(keys.values())]
    aggs += [x for i, c in enumerate(values) for x in (F.kll_sketch_agg_double(number[c], k).alias(f"v{i}"), F.count_if(number[c].isNull()).alias(f"n{i}"))]
    per = df.groupBy(p.key().alias("_key")).agg(*aggs)

    def row(kind: str, name: str, nulls: Column, sketch: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name"), nulls.cast("long").alias("null_count"), F.col(sketch).alias("sketch"))

    each = [row(KEYS, name, F.lit(0), f"k{i}") for i, name in enumerate(keys)] + [row(VALUES, c, F.col(f"n{i}"), f"v{i}") for i, c in enumerate(values)]
    long = per.select(p.text_of(F.col("_key")).alias("partition_value"), "record_count", F.inline(F.array(*each)))
    return long.select(
        F.lit(table_name).alias("table_name"), "partition_value", "kind", "name", "record_count", "null_count", "sketch", lit_ts(ts).alias("created_at")
    )


def ensure_sketch_table(spark: SparkSession, fqn: str, location: str | None = None, fmt: str = "parquet") -> str:
    """The table of sketches, partitioned by the day a row was made."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {fqn} ({SKETCHES}, created_date DATE) USING {fmt} PARTITIONED BY (created_date){where}")
    return fqn


def save_sketches(sketches: DataFrame, fqn: str) -> None:
    """Append sketches of new or changed partitions; older rows of these partitions no longer count."""
    target = sketches.sparkSession.table(fqn).columns
    sketches.withColumn("created_date", F.to_date("created_at")).select(*target).write.mode("append").insertInto(fqn)


def latest_sketches(saved: DataFrame) -> DataFrame:
    """The newest row of each partition, kind and name."""
    keys = ["table_name", "partition_value", "kind", "name"]
    parts = ["record_count", "null_count", "sketch"]
    newest = saved.groupBy(*keys).agg(F.max_by(F.struct(*parts), "created_at").alias("_r"), F.max("created_at").alias("created_at"))
    return newest.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in parts], "created_at")


def trailing(sketches: DataFrame, days: int, name: str = "range_value") -> DataFrame:
    """Each stored day once for every stored day whose last ``days`` days it is one of (day partitions only).

    ``name`` is the last day of the range. A day goes to at most ``days`` ranges.
    """
    day = F.col("partition_value").try_cast("date")
    ends = sketches.select("table_name", day.alias("_end")).where("_end IS NOT NULL").distinct()
    spread = sketches.where(day.isNotNull()).withColumn("_end", F.explode(F.sequence(day, F.date_add(day, days - 1))))
    return spread.join(ends, ["table_name", "_end"]).withColumn(name, F.date_format("_end", "yyyy-MM-dd")).drop("_end")


def distinct_keys(sketches: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``table_name, name, <group>, partitions, record_count, distinct_keys`` of stored key sketches merged by ``group``."""
    by = ["table_name", "name", *group]
    merged = sketches.where(F.col("kind") == KEYS).groupBy(*by).agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("record_count").alias("record_count"), F.hll_union_agg("sketch").alias("_s")
    )
    return merged.select(*by, "partitions", "record_count", F.hll_sketch_estimate("_s").alias("distinct_keys"))


def pk_duplicates_stored(
    sketches: DataFrame, group: Sequence[str] = (), tolerance: float | None = None, lg_k: int = LG_K, ts: datetime | str | None = None
) -> DataFrame:
    """``pk_duplicates`` rule rows of every stored key over all its partitions, or over those of each ``group``.

    The rate 1 - distinct/total is an estimate: a rule fails when it is above ``tolerance``, by
    default three standard errors. ``partition_value`` names the group, ``expected`` the tolerance.
    """
    limit = 3 * key_error(lg_k) if tolerance is None else tolerance
    counts = distinct_keys(sketches, group)
    total = F.col("record_count")
    rate = F.when(total == 0, 0.0).otherwise(F.greatest(F.lit(0.0), 1.0 - F.col("distinct_keys") / total))
    x = counts.withColumn("rate", rate).withColumn("ok", F.col("rate") <= F.lit(limit))
    return rule_rows(
        x,
        F.col("table_name"),
        F.concat_ws("/", *[F.col(g) for g in group]) if group else F.lit(None),
        F.concat(F.lit("pk_duplicates_"), F.col("name")),
        F.col("ok"),
        F.when(F.col("ok"), 0.0).otherwise(F.col("rate")),
        total,
        pass_severity(F.col("ok")),
        F.format_string("dupRate=%.5f acd=%d total=%d", F.col("rate"), F.col("distinct_keys"), total),
        F.lit(f"dupRate<={limit:.5f}"),
        ts=ts,
    )


@dataclass(frozen=True)
class ReferenceRange:
    """The ``days`` days before the current one, as one reference."""

    name: str
    days: int


#: fixed values: the week and the four weeks before a day
DEFAULT_RANGES = (ReferenceRange("7d", 7), ReferenceRange("28d", 28))


def merged_references(sketches: DataFrame, today: DataFrame, ranges: Sequence[ReferenceRange] = DEFAULT_RANGES, k: int = K) -> DataFrame:
    """``table_name, column_name, day, range_name, record_count, null_count, sketch``: for each day of ``today``
    (``table_name, day``) the merged value sketches of the stored days before it."""
    day = F.col("partition_value").try_cast("date")
    stored = sketches.where((F.col("kind") == VALUES) & day.isNotNull())

    def days_after(r: ReferenceRange) -> Column:
        return F.transform(F.sequence(F.date_add(day, 1), F.date_add(day, r.days)), lambda d: F.struct(d.alias("day"), F.lit(r.name).alias("range_name")))

    spread = F.flatten(F.array(*map(days_after, ranges)))
    spread = stored.select("table_name", F.col("name").alias("column_name"), "record_count", "null_count", "sketch", F.inline(spread))
    by = ["table_name", "column_name", "day", "range_name"]
    return spread.join(today, ["table_name", "day"], "left_semi").groupBy(*by).agg(
        F.sum("record_count").alias("record_count"), F.sum("null_count").alias("null_count"), F.kll_merge_agg_double("sketch", k).alias("sketch")
    )


def _quantiles(sketch: Column, bins: int) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(i / bins) for i in range(1, bins)]))


def stored_cuts(sketches: DataFrame, bins: int = S.DRIFT_BINS, ts: datetime | str | None = None) -> DataFrame:
    """CUTS rows (quantiles i/bins of each partition and column) from stored sketches, for use as saved cuts."""
    known = sketches.where((F.col("kind") == VALUES) & (F.col("null_count") < F.col("record_count")))
    # the guard is repeated: a projection may be evaluated before the filter
    cuts = F.when(F.col("null_count") < F.col("record_count"), _quantiles(F.col("sketch"), bins))
    return known.select("table_name", F.col("name").alias("column_name"), "partition_value", cuts.alias("cuts"), lit_ts(ts).alias("created_at"))


def reference_histograms(references: DataFrame, bins: int = S.DRIFT_BINS) -> DataFrame:
    """``… cuts, shares`` of merged references: shares of the buckets 0 … bins-1 and, last, of nulls, in ``record_count``.

    Only references with a value have cuts. Equal cuts leave the buckets between them empty, as in a counted histogram.
    A share of values up to a cut is read off ``GRID`` quantiles, which adds 1/GRID to the sketch's error.
    """
    known = F.col("null_count") < F.col("record_count")
    grid = F.when(known, F.kll_sketch_get_quantile_double("sketch", F.lit(np.arange(1, GRID + 1) / GRID)))
    with_cuts = references.where(known).withColumn("cuts", F.when(known, _quantiles(F.col("sketch"), bins))).withColumn("_grid", grid)
    below = F.transform("cuts", lambda c: F.size(F.filter("_grid", lambda g: g <= c)) / F.lit(GRID))
    filled = (F.col("record_count") - F.col("null_count")) / F.col("record_count")
    ranked = with_cuts.withColumn("_below", F.concat(F.array(F.lit(0.0)), below, F.array(F.lit(1.0))))
    shares = F.transform(F.sequence(F.lit(1), F.size("_below") - 1), lambda i: (F.get("_below", i) - F.get("_below", i - 1)) * filled)
    return ranked.withColumn("shares", F.concat(shares, F.array(F.col("null_count") / F.col("record_count")))).drop("_below", "_grid")


def drift_from_sketches(
    df: DataFrame,
    table_name: str,
    partitioning: Partitioning | str,
    columns: Sequence[str],
    today: Sequence[str],
    sketches: DataFrame,
    ranges: Sequence[ReferenceRange] = DEFAULT_RANGES,
    bins: int = S.DRIFT_BINS,
    threshold: float = S.PSI_THRESHOLD,
    k: int = K,
    ts: datetime | str | None = None,
) -> DataFrame:
    """DRIFT rows ``<column>_psi_<range>`` of the days ``today`` against merged stored sketches of the days before.

    Of ``df`` only the days ``today`` are scanned. A range without any stored value gives no row; ranges use the days
    that are stored, however many of them are missing (``details`` has their rows).
    """
    hist = reference_histograms(references_before(table_name, columns, today, sketches, ranges, k), bins)
    n = len(today) * len(columns) * len(ranges)
    hist = checkpointed(hist.drop("sketch"))
    counted = current_buckets(df, table_name, partitioning, columns, today, hist, n, bins)
    keys = ["table_name", "column_name", "day", "range_name"]
    ref = hist.select(*keys, F.posexplode("shares").alias("bucket", "share"))
    scores = psi(ref, counted, keys).join(bounded_broadcast(counted.select(*keys).distinct(), n), keys, "left_semi")
    scores = scores.join(bounded_broadcast(hist.select(*keys, "record_count"), n), keys)
    return scores.select(
        "table_name",
        F.date_format("day", "yyyy-MM-dd").alias("partition_value"),
        F.concat(F.col("column_name"), F.lit("_psi_"), F.col("range_name")).alias("metric_name"),
        "score",
        F.when(F.col("score") >= F.lit(threshold), F.lit(S.RESULT_FAIL_SEVERITY)).otherwise(F.lit(S.RESULT_PASS_SEVERITY)).alias("severity"),
        F.col("range_name").alias("reference"),
        str_map(column=F.col("column_name"), reference_rows=F.col("record_count").cast("string"), bins=str(bins)).alias("details"),
        lit_ts(ts).alias("ts"),
    )


def references_before(table_name: str, columns: Sequence[str], today: Sequence[str], sketches: DataFrame, ranges: Sequence[ReferenceRange], k: int) -> DataFrame:
    days = sketches.sparkSession.createDataFrame([(table_name, d) for d in today], "table_name string, day string")
    days = bounded_broadcast(days.select("table_name", F.col("day").cast("date").alias("day")), len(today))
    wanted = sketches.where((F.col("table_name") == table_name) & F.col("name").isin(list(columns)))
    return merged_references(wanted, days, ranges, k)


def current_buckets(
    df: DataFrame, table_name: str, partitioning: Partitioning | str, columns: Sequence[str], today: Sequence[str], hist: DataFrame, hist_rows: int, bins: int
) -> DataFrame:
    """``table_name, column_name, day, range_name, bucket, rows, share`` of the current days under their references' cuts
    (bucket ``bins`` holds the nulls)."""
    p = as_partitioning(partitioning)
    values = day_values(df.where(p.where_in(df, sorted(set(today)))), table_name, p, columns)
    # a row per current day, column and range
    cuts = bounded_broadcast(hist.select("table_name", "column_name", "day", "range_name", "cuts"), hist_rows, 200 + 8 * bins)
    bucket = F.least(bucket_of(F.col("value"), F.col("cuts"), max_cuts=bins - 1), F.lit(bins))
    keys = ["table_name", "column_name", "day", "range_name"]
    counted = values.join(cuts, ["table_name", "column_name", "day"]).groupBy(*keys, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
    totals = counted.groupBy(*keys).agg(F.sum("rows").alias("_all"))
    return counted.join(totals, keys).select(*keys, "bucket", "rows", (F.col("rows") / F.col("_all")).alias("share"))
