"""Distribution drift by PSI against saved or computed quantile cuts.

One plan covers every column and every comparison:

1. ``long_values``: the profiled columns unpivoted to
   ``(table_name, column_name, partition_value, value)``; NaN is null and
   text that is not a number is null (``try_cast``).
2. ``compute_cuts``: ``percentile_approx`` per (table, column, partition)
   at i/bins — one aggregation for all columns and days.
3. ``histograms``: each value is bucketed against the cuts it is compared
   under (its own day's cuts as a reference, the earlier days' cuts as
   a current day) through one join with the small cuts table, then counted
   per bucket (partial aggregation map-side, so skewed days cost nothing
   extra in the shuffle).
4. ``psi_scores``: reference and current shares aligned on the bucket
   (union + group by, no outer join), Σ (p−q)·ln(p/q) with shares floored
   at 1e-9.

A value v falls in bucket = number of cuts strictly below v (v equal to a
cut stays left). Nulls have their own bucket ``len(cuts)+1`` by default;
``null_bucket="top"`` puts them in bucket ``len(cuts)`` instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablepulse import schemas as S
from tablepulse.functions.exprs import lit_date, lit_ts, str_map
from tablepulse.functions.joins import bounded_broadcast
from tablepulse.functions.partitioning import Partitioning, as_partitioning
from tablepulse.operators.results import metric_rows
from tablepulse.session import checkpointed
from tablepulse.sources.cuts import latest_cuts


@dataclass(frozen=True)
class Reference:
    name: str  # suffix of the metric name
    days: int  # days before the current partition
    label: str  # value of the ``reference`` column


# fixed values: the two comparisons of a drift run
DEFAULT_REFERENCES = (Reference("dod", 1, "yesterday"), Reference("wow", 7, "week"))


def long_values(df: DataFrame, table_name: str, partitioning: Partitioning | str, columns: Sequence[str]) -> DataFrame:
    """``table_name, column_name, partition_value, value`` for the profiled columns."""
    p = as_partitioning(partitioning)
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.expr(f"try_cast(`{c}` AS DOUBLE)").alias("value"))
            for c in columns
        ]
    )
    x = df.select(p.value().alias("partition_value"), F.inline(pairs))
    return x.select(
        F.lit(table_name).alias("table_name"),
        "column_name",
        "partition_value",
        F.when(~F.isnan("value"), F.col("value")).alias("value"),
    )


def day_values(df: DataFrame, table_name: str, partitioning: Partitioning | str, columns: Sequence[str]) -> DataFrame:
    """Like :func:`long_values` but keyed by ``day`` (DATE): cheap to shift, join and group.

    Day grain takes the date of the timestamp; a value-grain key is read as
    an ISO date (other text gives null and is left out).
    """
    p = _day_partitioning(partitioning)
    day = F.to_date(F.col(p.column)) if p.grain == "day" else F.col(p.column).cast("string").try_cast("date")
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.expr(f"try_cast(`{c}` AS DOUBLE)").alias("value"))
            for c in columns
        ]
    )
    x = df.select(day.alias("day"), F.inline(pairs)).where(F.col("day").isNotNull())
    return x.select(
        F.lit(table_name).alias("table_name"),
        "column_name",
        "day",
        F.when(~F.isnan("value"), F.col("value")).alias("value"),
    )


def _day_partitioning(partitioning: Partitioning | str) -> Partitioning:
    p = as_partitioning(partitioning)
    if p.grain == "month":
        raise ValueError("drift compares days; a month grain has no day before or week before")
    return p


def _key(values: DataFrame) -> str:
    return "day" if "day" in values.columns else "partition_value"


def compute_cuts(values: DataFrame, bins: int = S.DRIFT_BINS, accuracy: int = S.QUANTILE_ACCURACY) -> DataFrame:
    """``table_name, column_name, partition_value, cuts``: quantiles i/bins for i = 1..bins-1.

    ``values`` is keyed by ``partition_value`` or ``day``. Groups with no
    non-null value give no row (no reference).
    """
    probs = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    key = _key(values)
    out = (
        values.where(F.col("value").isNotNull())
        .groupBy("table_name", "column_name", key)
        .agg(F.percentile_approx("value", probs, accuracy).alias("cuts"))
    )
    if key == "day":
        out = out.select("table_name", "column_name", F.date_format("day", "yyyy-MM-dd").alias("partition_value"), "cuts")
    return out


def bucket_of(value: Column, cuts: Column, null_bucket: str = "own", max_cuts: int | None = None) -> Column:
    """Number of cuts strictly below ``value``; nulls in their own (or the top) bucket.

    With ``max_cuts`` known the count is unrolled into ``max_cuts``
    comparisons (``get`` is null past the end), which stays inside whole-stage
    codegen; otherwise a ``filter`` lambda is used.
    """
    null_idx = F.size(cuts) + (1 if null_bucket == "own" else 0)
    if max_cuts is None:
        below = F.size(F.filter(cuts, lambda c: value > c))
    elif max_cuts == 0:
        below = F.lit(0)
    else:
        terms = [F.when(value > F.get(cuts, i), 1).otherwise(0) for i in range(max_cuts)]
        below = terms[0]
        for t in terms[1:]:
            below = below + t
    return F.when(value.isNull(), null_idx).otherwise(below)


def materialize_cuts(cuts: DataFrame) -> tuple[DataFrame, int, int]:
    """Checkpoint the (small) cuts table; return it with its row count and longest cut list.

    The count is the checked size bound that decides the broadcast; the
    reliable checkpoint (in ``spark.checkpoint.dir``) means the cuts are
    computed once and survive executor loss.
    """
    c = checkpointed(cuts)
    row = c.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("cuts")).alias("m")).first()
    return c, int(row["n"] or 0), int(row["m"] or 0)


def histograms(
    values: DataFrame,
    cuts: DataFrame,
    references: Sequence[Reference] = DEFAULT_REFERENCES,
    current: Sequence[str] | None = None,
    null_bucket: str = "own",
    cuts_rows: int | None = None,
    max_cuts: int | None = None,
) -> DataFrame:
    """Bucket counts ``table_name, column_name, cut_partition, partition_value, bucket, rows, share``.

    ``cut_partition`` is the day whose cuts were used. Rows of a day are
    counted under their own cuts (reference role) and under the cuts of the
    days ``references`` before it (current role). With ``current`` given,
    only those days take the current role and only their reference days the
    reference role.

    The cuts that a day's values are compared under, its own and its earlier
    days', are put into one row per (column, day) first, so each value row
    takes one lookup. It is a broadcast while that table's measured rows, at
    the bytes of their cuts, stay small; otherwise a shuffle join on (column,
    day), whose hot days AQE can split. The large aggregation then sees every
    value once; its groups are bucket combinations per (column, day). The
    small result is split into one row per (cut day, bucket). Days are DATE
    values inside; text only in the result.
    """
    if "day" not in values.columns:
        values = values.withColumn("day", F.col("partition_value").try_cast("date"))
    day = F.col("day")
    roles = [("self", 0)] + [(f"r{i}", r.days) for i, r in enumerate(references)]
    c = cuts.select(
        "table_name",
        "column_name",
        F.col("partition_value").try_cast("date").alias("cut_day"),
        F.array_sort("cuts").alias("cuts"),
    )
    per_role = F.array(*[F.struct(F.date_add("cut_day", k).alias("day"), F.lit(n).alias("role")) for n, k in roles])
    c = c.select("table_name", "column_name", "cuts", F.inline(per_role)).groupBy("table_name", "column_name", "day")
    c = c.agg(*[F.max(F.when(F.col("role") == n, F.col("cuts"))).alias(f"c_{n}") for n, _ in roles])
    if cuts_rows is not None:
        c = bounded_broadcast(c, cuts_rows * len(roles), 100 + 8 * len(roles) * (max_cuts or S.DRIFT_BINS))
    if current is not None:
        cur = F.array(*[F.lit(x).cast("date") for x in current])
        refs = F.array(*[F.lit(d).cast("date") for d in _reference_days(current, references)])
    # a day without any cuts to compare with has no bucket
    x = values.select("table_name", "column_name", "day", "value").join(c, ["table_name", "column_name", "day"])
    buckets = []
    for name, _ in roles:
        b = bucket_of(F.col("value"), F.col(f"c_{name}"), null_bucket, max_cuts)
        applies = F.col(f"c_{name}").isNotNull()
        if current is not None:
            applies = applies & F.array_contains(refs if name == "self" else cur, day)
        buckets.append(F.when(applies, b).alias(f"b_{name}"))
    combos = x.groupBy("table_name", "column_name", "day", *buckets).agg(F.count(F.lit(1)).alias("n"))
    split = F.array(
        *[F.struct(F.date_sub(day, k).alias("cut_day"), F.col(f"b_{name}").alias("bucket")) for name, k in roles]
    )
    long = combos.select("table_name", "column_name", "day", "n", F.inline(split)).where(F.col("bucket").isNotNull())
    counted = long.groupBy("table_name", "column_name", "cut_day", "day", "bucket").agg(F.sum("n").alias("rows"))
    w = Window.partitionBy("table_name", "column_name", "cut_day", "day")
    return counted.select(
        "table_name",
        "column_name",
        F.date_format("cut_day", "yyyy-MM-dd").alias("cut_partition"),
        F.date_format("day", "yyyy-MM-dd").alias("partition_value"),
        F.col("bucket").cast("int").alias("bucket"),
        F.col("rows").cast("long").alias("rows"),
        (F.col("rows") / F.sum("rows").over(w)).alias("share"),
    )


def _reference_days(current: Sequence[str], references: Sequence[Reference]) -> list[str]:
    out: list[str] = []
    for t in current:
        d = date.fromisoformat(t)
        out += [(d - timedelta(days=r.days)).isoformat() for r in references]
    return sorted(set(out))


def psi_term(p: Column, q: Column, eps: float = S.PSI_EPSILON) -> Column:
    pp = F.when(p <= 0, F.lit(eps)).otherwise(p)
    qq = F.when(q <= 0, F.lit(eps)).otherwise(q)
    return (pp - qq) * F.ln(pp / qq)


def psi(ref: DataFrame, cur: DataFrame, keys: Sequence[str]) -> DataFrame:
    """PSI per ``keys`` from two share tables ``keys + bucket + share`` (missing buckets count 0)."""
    both = ref.select(*keys, "bucket", F.col("share").alias("p"), F.lit(0.0).alias("q")).unionByName(
        cur.select(*keys, "bucket", F.lit(0.0).alias("p"), F.col("share").alias("q"))
    )
    per_bucket = both.groupBy(*keys, "bucket").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    return per_bucket.groupBy(*keys).agg(F.sum(psi_term(F.col("p"), F.col("q"))).alias("score"))


def psi_scores(hist: DataFrame, references: Sequence[Reference] = DEFAULT_REFERENCES) -> DataFrame:
    """``table_name, column_name, partition_value, reference_partition, ref_name, label, score``.

    One pass over the histogram: a reference-role row (counted under its
    own cuts) is sent to each day ``k`` days later as share p, a
    current-role row goes to its own day as share q; p and q meet in one
    group-by per (comparison, bucket). A comparison is kept only when both
    sides have rows.
    """
    ks = [r.days for r in references]
    names = F.create_map(*[x for r in references for x in (F.lit(r.days), F.lit(r.name))])
    labels = F.create_map(*[x for r in references for x in (F.lit(r.days), F.lit(r.label))])
    is_ref = F.col("cut_partition") == F.col("partition_value")
    lag = F.datediff(F.to_date("partition_value"), F.to_date("cut_partition"))
    rows = hist.select(
        "table_name",
        "column_name",
        "cut_partition",
        "bucket",
        is_ref.alias("is_ref"),
        F.col("share"),
        F.explode(F.when(is_ref, F.array(*[F.lit(k) for k in ks])).otherwise(F.array(lag))).alias("lag_days"),
    ).where(F.col("lag_days").isin(ks))
    keys = ["table_name", "column_name", "cut_partition", "lag_days"]
    per_bucket = rows.groupBy(*keys, "bucket").agg(
        F.sum(F.when(F.col("is_ref"), F.col("share")).otherwise(0.0)).alias("p"),
        F.sum(F.when(~F.col("is_ref"), F.col("share")).otherwise(0.0)).alias("q"),
    )
    scores = per_bucket.groupBy(*keys).agg(
        F.sum(psi_term(F.col("p"), F.col("q"))).alias("score"),
        F.sum("p").alias("p_total"),
        F.sum("q").alias("q_total"),
    ).where((F.col("p_total") > 0) & (F.col("q_total") > 0))
    return scores.select(
        "table_name",
        "column_name",
        F.date_format(F.date_add(F.to_date("cut_partition"), F.col("lag_days").cast("int")), "yyyy-MM-dd").alias(
            "partition_value"
        ),
        F.col("cut_partition").alias("reference_partition"),
        F.element_at(names, F.col("lag_days")).alias("ref_name"),
        F.element_at(labels, F.col("lag_days")).alias("label"),
        "score",
    )


def resolve_cuts(
    values: DataFrame,
    days: Sequence[str] | None,
    saved: DataFrame | None = None,
    bins: int = S.DRIFT_BINS,
    accuracy: int = S.QUANTILE_ACCURACY,
    max_rows: int | None = None,
) -> DataFrame:
    """Cuts to use, with ``is_new`` marking computed ones. Saved cuts win; cuts are computed only where missing."""
    key = _key(values)
    if days is None:
        src = values
    else:
        lits = [F.lit(d).cast("date") for d in days] if key == "day" else [F.lit(d) for d in days]
        src = values.where(F.col(key).isin(*lits))
    if saved is None:
        return compute_cuts(src, bins, accuracy).withColumn("is_new", F.lit(True))
    have = latest_cuts(saved).select("table_name", "column_name", "partition_value", "cuts")
    if days is not None:
        have = have.where(F.col("partition_value").isin(list(days)))
    have_keys = have.select(
        "table_name", "column_name", (F.col("partition_value").try_cast("date") if key == "day" else F.col("partition_value")).alias(key)
    )
    missing = src.join(bounded_broadcast(have_keys, max_rows), ["table_name", "column_name", key], "left_anti")
    new = compute_cuts(missing, bins, accuracy)
    return have.withColumn("is_new", F.lit(False)).unionByName(new.withColumn("is_new", F.lit(True)))


def drift(
    df: DataFrame,
    table_name: str,
    partitioning: Partitioning | str,
    columns: Sequence[str],
    today: str | Sequence[str] | None = None,
    references: Sequence[Reference] = DEFAULT_REFERENCES,
    bins: int = S.DRIFT_BINS,
    threshold: float = S.PSI_THRESHOLD,
    saved_cuts: DataFrame | None = None,
    accuracy: int = S.QUANTILE_ACCURACY,
    null_bucket: str = "own",
    ts: datetime | str | None = None,
) -> DataFrame:
    """DRIFT rows ``<column>_psi_<ref>`` for each current day and reference.

    ``today`` is the current partition (or several); ``None`` compares every
    partition of the table with its references. Only the needed days are
    scanned when ``today`` is given (range filters pushed to the scan).
    """
    return drift_parts(
        df, table_name, partitioning, columns, today, references, bins, threshold, saved_cuts, accuracy, null_bucket, ts
    )[0]


def drift_with_cuts(
    df: DataFrame,
    table_name: str,
    partitioning: Partitioning | str,
    columns: Sequence[str],
    today: str | Sequence[str] | None = None,
    references: Sequence[Reference] = DEFAULT_REFERENCES,
    bins: int = S.DRIFT_BINS,
    threshold: float = S.PSI_THRESHOLD,
    saved_cuts: DataFrame | None = None,
    accuracy: int = S.QUANTILE_ACCURACY,
    null_bucket: str = "own",
    ts: datetime | str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(drift rows, newly computed cuts as CUTS rows to append to the saved cuts)."""
    return drift_parts(
        df, table_name, partitioning, columns, today, references, bins, threshold, saved_cuts, accuracy, null_bucket, ts
    )[:2]


def drift_parts(
    df: DataFrame,
    table_name: str,
    partitioning: Partitioning | str,
    columns: Sequence[str],
    today: str | Sequence[str] | None = None,
    references: Sequence[Reference] = DEFAULT_REFERENCES,
    bins: int = S.DRIFT_BINS,
    threshold: float = S.PSI_THRESHOLD,
    saved_cuts: DataFrame | None = None,
    accuracy: int = S.QUANTILE_ACCURACY,
    null_bucket: str = "own",
    ts: datetime | str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(drift rows, newly computed cuts as CUTS rows, all cuts that were used)."""
    p = _day_partitioning(partitioning)
    current = [today] if isinstance(today, str) else (list(today) if today is not None else None)
    if current is not None:
        current = [c for c in current if _is_day(c)]
        if not current:
            empty = df.sparkSession.createDataFrame([], S.DRIFT)
            none = df.sparkSession.createDataFrame([], S.CUTS)
            return empty, none, none
        ref_days = _reference_days(current, references)
        src = df.where(p.where_in(df, sorted(set(current) | set(ref_days))))
        bound = len(columns) * len(ref_days)
    else:
        ref_days, src, bound = None, df, None
    values = day_values(src, table_name, p, columns)
    cuts, n_cuts, max_cuts = materialize_cuts(resolve_cuts(values, ref_days, saved_cuts, bins, accuracy, bound))
    new_cuts = cuts.where("is_new")
    hist = histograms(values, cuts, references, current, null_bucket, n_cuts, max_cuts)
    scores = psi_scores(hist, references)
    out = scores.select(
        "table_name",
        "partition_value",
        F.concat(F.col("column_name"), F.lit("_psi_"), F.col("ref_name")).alias("metric_name"),
        F.col("score").cast("double").alias("score"),
        F.when(F.col("score") >= F.lit(threshold), F.lit(S.RESULT_FAIL_SEVERITY))
        .otherwise(F.lit(S.RESULT_PASS_SEVERITY))
        .alias("severity"),
        F.col("label").alias("reference"),
        str_map(column=F.col("column_name"), reference_partition=F.col("reference_partition"), bins=str(bins)).alias(
            "details"
        ),
        lit_ts(ts).alias("ts"),
    )
    created = new_cuts.select(
        "table_name", "column_name", "partition_value", F.col("cuts").cast("array<double>").alias("cuts"),
        lit_ts(ts).alias("created_at"),
    )
    return out, created, cuts


def reference_missing(
    cuts: DataFrame,
    table_name: str,
    columns: Sequence[str],
    today: str | Sequence[str] | DataFrame,
    references: Sequence[Reference] = DEFAULT_REFERENCES,
    as_of: date | datetime | str | None = None,
) -> DataFrame:
    """Metric ``reference_missing`` = 1 per (day, column, reference day) without cuts, that is without a value.

    ``today`` is one day, several, or a frame with ``partition_value``. For a
    frame (all days of a table) reference days before its first day are not
    missing: the table did not exist yet.
    """
    spark = cuts.sparkSession
    if isinstance(today, DataFrame):
        days = today.select(F.col("partition_value").try_cast("date").alias("day")).where("day IS NOT NULL").distinct()
    else:
        listed = [today] if isinstance(today, str) else list(today)
        days = spark.createDataFrame([(d,) for d in listed if _is_day(d)], "d string").select(F.col("d").cast("date").alias("day"))
    # days are one row per partition; the few columns and references multiply them
    each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(r.days).alias("k")) for c in columns for r in references])
    wanted = days.select("day", F.inline(each)).withColumn("ref_day", F.date_sub("day", F.col("k"))).drop("k").distinct()
    if isinstance(today, DataFrame):
        first = days.agg(F.min("day")).first()[0]
        wanted = wanted.where(F.col("ref_day") >= F.lit(first))
    have = cuts.where((F.col("table_name") == table_name) & (F.size("cuts") > 0)).select(
        "column_name", F.col("partition_value").try_cast("date").alias("ref_day")
    )
    missing = wanted.join(have, ["column_name", "ref_day"], "left_anti")
    return metric_rows(
        missing, F.lit(table_name), F.date_format("day", "yyyy-MM-dd"), lit_date(as_of), F.lit("reference_missing"), F.lit(1.0),
        str_map(column=F.col("column_name"), reference_partition=F.date_format("ref_day", "yyyy-MM-dd")),
    )


def _is_day(v: str) -> bool:
    try:
        date.fromisoformat(v)
        return len(v) == 10
    except (TypeError, ValueError):
        return False
