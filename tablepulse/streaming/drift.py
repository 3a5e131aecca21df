"""D4 on a stream: drift of each day against saved cuts, decided once, when the day closes.

Rows are bucketed under the cuts of their day's references (a broadcast table
with a row per day, column and reference) and counted per task; the counts of a
(column, day) meet in one stateful task, which holds one number per reference
and bucket. When the watermark reaches the end of the day and ``grace``, the
histogram goes out and the state is removed. Rows that come after that are counted
and reported as late; they change no closed day.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tablepulse import schemas as S
from tablepulse.functions.exprs import lit_ts, str_map
from tablepulse.functions.joins import bounded_broadcast
from tablepulse.functions.partitioning import Partitioning, as_partitioning
from tablepulse.operators.drift import DEFAULT_REFERENCES, Reference, bucket_of, compute_cuts, psi

DAY_MS = 86_400_000
CLOSED, LATE = "closed", "late"
COUNTS = "table_name string, column_name string, day date, range_name string, bucket int, rows long"
OUT = f"{COUNTS}, kind string"


class DayHistograms(StatefulProcessor):
    """Bucket counts of one (table, column, day) until the day closes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "range_name string, bucket int", "rows long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = pd.concat(list(rows)).groupby(["range_name", "bucket"], as_index=False)["rows"].sum()
        end = _end_ms(key[2])
        if end <= timerValues.getCurrentWatermarkInMs():
            yield _rows(key, new, LATE)
            return
        for name, bucket, n in new.itertuples(index=False):
            at = (name, int(bucket))
            before = self.counts.getValue(at) if self.counts.containsKey(at) else None
            self.counts.updateValue(at, (int(n) + (before[0] if before else 0),))
        self.handle.registerTimer(end)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = [(k[0], k[1], v[0]) for k, v in self.counts.iterator()]
        self.counts.clear()
        if held:
            yield _rows(key, pd.DataFrame(held, columns=["range_name", "bucket", "rows"]), CLOSED)

    def close(self) -> None:
        pass


def _end_ms(day) -> int:
    return pd.Timestamp(day).value // 1_000_000 + DAY_MS


def _rows(key, counts: pd.DataFrame, kind: str) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "table_name": key[0], "column_name": key[1], "day": key[2], "range_name": counts["range_name"], "bucket": counts["bucket"].astype("int32"),
            "rows": counts["rows"].astype("int64"), "kind": kind,
        }
    )


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Bucket counts of each batch of rows; the newest time goes along for the watermark."""
    keys = ["table_name", "column_name", "day", "range_name", "bucket"]
    for rows in batches:
        yield rows.groupby(keys, as_index=False).agg(rows=("rows", "sum"), seen=("seen", "max"))


def drift_stream(
    stream: DataFrame,
    table_name: str,
    partitioning: Partitioning | str,
    columns: Sequence[str],
    references: DataFrame,
    reference_rows: int | None = None,
    grace: str = "1 hour",
    bins: int = S.DRIFT_BINS,
) -> DataFrame:
    """``table_name, column_name, day, range_name, bucket, rows, kind``: the histogram of each closed day (``closed``, once) and
    counts of rows that came too late (``late``, per micro-batch).

    ``references`` (``table_name, column_name, day, range_name, cuts``) say under which cuts a day's values are counted:
    days without any are not counted. ``reference_rows`` is their proven number, for a broadcast. Days are those of a
    zone-less time or, for an instant, of the session's time zone, which must be UTC.
    """
    p = as_partitioning(partitioning)
    timed = stream.withColumn("_seen", F.col(p.column).cast("timestamp"))
    values = _values_with_time(timed, table_name, p, columns)
    cuts = bounded_broadcast(references.select("table_name", "column_name", "day", "range_name", "cuts"), reference_rows, 200 + 8 * bins)
    bucket = F.least(bucket_of(F.col("value"), F.col("cuts"), max_cuts=bins - 1), F.lit(bins)).cast("int")
    keyed = values.join(cuts, ["table_name", "column_name", "day"]).select(
        "table_name", "column_name", "day", "range_name", bucket.alias("bucket"), F.lit(1).cast("long").alias("rows"), F.col("_seen").alias("seen")
    )
    counted = keyed.mapInPandas(_counted, f"{COUNTS}, seen timestamp").withWatermark("seen", grace)
    # without its time a row is never dropped for being old: late rows reach the processor, which counts them
    return counted.drop("seen").groupBy("table_name", "column_name", "day").transformWithStateInPandas(
        statefulProcessor=DayHistograms(), outputStructType=OUT, outputMode="Append", timeMode="EventTime"
    )


def _values_with_time(df: DataFrame, table_name: str, p: Partitioning, columns: Sequence[str]) -> DataFrame:
    """Values by day, as in a batch, with the time of their row."""
    number = {c: F.expr(f"try_cast(`{c}` AS DOUBLE)") for c in columns}
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.when(~F.isnan(v), v).alias("value")) for c, v in number.items()])
    x = df.select(F.to_date(p.column).alias("day"), "_seen", F.inline(pairs)).where("day IS NOT NULL")
    return x.withColumn("table_name", F.lit(table_name))


def daily_references(values: DataFrame, references: Sequence[Reference] = DEFAULT_REFERENCES, bins: int = S.DRIFT_BINS) -> DataFrame:
    """``table_name, column_name, day, range_name, cuts, shares``: what each day is compared with, from the rows
    (``day_values``) of the days before it: their own cuts, and the shares of the buckets 0 … bins-1 and of nulls."""
    keys = ["table_name", "column_name", "day"]
    cuts = compute_cuts(values, bins).select("table_name", "column_name", F.col("partition_value").cast("date").alias("day"), "cuts")
    bucket = F.least(bucket_of(F.col("value"), F.col("cuts"), max_cuts=bins - 1), F.lit(bins))
    counted = values.join(cuts, keys).groupBy(*keys, "cuts", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
    # a bucket's number of rows, for the few buckets of a day
    per = counted.groupBy(*keys, "cuts").agg(F.sum("rows").alias("n"), F.map_from_entries(F.collect_list(F.struct("bucket", "rows"))).alias("of"))
    shares = F.transform(F.sequence(F.lit(0), F.lit(bins)), lambda i: F.coalesce(F.element_at("of", i), F.lit(0)) / F.col("n"))
    later = F.array(*[F.struct(F.date_add("day", r.days).alias("day"), F.lit(r.name).alias("range_name")) for r in references])
    return per.select("table_name", "column_name", "cuts", shares.alias("shares"), F.inline(later)).select(*keys, "range_name", "cuts", "shares")


def closed_drift(closed: DataFrame, references: DataFrame, threshold: float = S.PSI_THRESHOLD, bins: int = S.DRIFT_BINS, ts: datetime | str | None = None) -> DataFrame:
    """DRIFT rows of closed days (rows of :func:`drift_stream`) against the ``shares`` of their references."""
    keys = ["table_name", "column_name", "day", "range_name"]
    counted = closed.where(F.col("kind") == CLOSED).groupBy(*keys, "bucket").agg(F.sum("rows").alias("rows"))
    totals = counted.groupBy(*keys).agg(F.sum("rows").alias("_all"))
    current = counted.join(totals, keys).select(*keys, "bucket", (F.col("rows") / F.col("_all")).alias("share"))
    ref = references.select(*keys, F.posexplode("shares").alias("bucket", "share")).join(totals, keys, "left_semi")
    return psi(ref, current, keys).select(
        "table_name",
        F.date_format("day", "yyyy-MM-dd").alias("partition_value"),
        F.concat(F.col("column_name"), F.lit("_psi_"), F.col("range_name")).alias("metric_name"),
        "score",
        F.when(F.col("score") >= F.lit(threshold), F.lit(S.RESULT_FAIL_SEVERITY)).otherwise(F.lit(S.RESULT_PASS_SEVERITY)).alias("severity"),
        F.col("range_name").alias("reference"),
        str_map(column=F.col("column_name"), bins=str(bins)).alias("details"),
        lit_ts(ts).alias("ts"),
    )


def late_rows(closed: DataFrame) -> DataFrame:
    """Metric rows ``late_rows`` per (column, day): values that came after their day was closed."""
    keys = ["table_name", "column_name", "day"]
    per = closed.where(F.col("kind") == LATE).groupBy(*keys, "range_name").agg(F.sum("rows").alias("n")).groupBy(*keys).agg(F.max("n").alias("n"))
    return per.select(
        "table_name", F.date_format("day", "yyyy-MM-dd").alias("partition_value"), F.col("day").alias("metric_date"), F.lit("late_rows").alias("metric_name"),
        F.col("n").cast("double").alias("metric_value"), str_map(column=F.col("column_name")).alias("details"),
    )
