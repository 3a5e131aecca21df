"""C3, C4 on a stream: freshness by timer.

A feed (a table, or a partition of one) that brings no data for ``limit_minutes``
raises its alert when that time has passed, not when somebody looks, and clears
when data comes again. Time is event time in whole minutes: the watermark decides
which minutes are complete, so rows that come out of order within ``delay`` give the
same transitions as rows in order, and a replay gives what a batch query
(:func:`freshness_transitions`) gives over the same rows.

State per feed is its last complete minute with data, whether its alert is open,
and the minutes that are not complete yet, so it grows with ``delay`` and the number
of feeds, not with rows. Rows are cut down to one per feed and minute in each
task before they are moved to their feed's task, so a feed with a third of the rows
moves a row per task and minute. Spark offers timers to Python only through a
stateful processor, hence the Python code here; it needs the RocksDB state store
(:func:`use_timers`).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

MINUTE = 60_000
TRANSITIONS = "table_name string, status string, at timestamp"
STALE, FRESH = "stale", "fresh"


def use_timers(spark: SparkSession) -> None:
    """Stateful processors with timers need this state store; it is fixed for a query when the query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class FreshnessTimers(StatefulProcessor):
    """Transitions of one feed. A minute is complete when the watermark has reached its end."""

    def __init__(self, limit_minutes: int):
        self.limit = limit_minutes * MINUTE

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("feed", "at long, open boolean, waiting array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = {pd.Timestamp(m).value // 1_000_000 for frame in rows for m in frame["minute"].unique()}
        at, is_open, waiting = self._get()
        # the timer of the earliest minute is enough: when it expires the next one is set
        if not waiting or min(new) < min(waiting):
            self.handle.registerTimer(min(new) + MINUTE)
        self.state.update((at, is_open, sorted(new.union(waiting))))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        mark = timerValues.getCurrentWatermarkInMs()
        at, is_open, waiting = self._get()
        complete = [m for m in waiting if m + MINUTE <= mark]
        out = []
        for start in complete:
            if at is not None and start - at > self.limit:
                if not is_open:
                    out.append((STALE, at + self.limit))
                out.append((FRESH, start))
                is_open = False
            at = start
        waiting = waiting[len(complete) :]
        due = None if at is None or is_open else at + self.limit
        if due is not None and due + MINUTE <= mark:
            # nothing up to the last minute in time, which is complete, either
            out.append((STALE, due))
            is_open, due = True, None
        pending = waiting[:1] + ([] if due is None else [due])
        if pending:
            self.handle.registerTimer(min(pending) + MINUTE)
        self.state.update((at, is_open, waiting))
        if out:
            yield pd.DataFrame({"table_name": key[0], "status": [s for s, _ in out], "at": pd.to_datetime([t for _, t in out], unit="ms")})

    def _get(self) -> tuple[int | None, bool, list[int]]:
        found = self.state.get()
        return (None, False, []) if found is None else (found[0], found[1], list(found[2]))

    def close(self) -> None:
        pass


def _minutes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per feed and minute of each batch of rows."""
    for rows in batches:
        yield rows.drop_duplicates()


def feed_minutes(rows: DataFrame, feed: Column, time: str) -> DataFrame:
    """``table_name, minute`` of rows that have a feed and a time (zone-less times as UTC)."""
    zoned = F.col(time) if dict(rows.dtypes)[time] == "timestamp" else F.col(time).cast("timestamp")
    return rows.select(feed.cast("string").alias("table_name"), F.date_trunc("minute", zoned).alias("minute")).where("table_name IS NOT NULL AND minute IS NOT NULL")


def freshness_stream(stream: DataFrame, feed: Column, time: str, limit_minutes: int, delay: str = "10 minutes") -> DataFrame:
    """``table_name, status (stale | fresh), at``: each feed's transitions, appended when the watermark settles them.

    ``stale`` is at the end of the limit after the last minute with data, ``fresh`` at the next minute with data.
    A feed is known from its first row on. The session's time zone must be UTC for zone-less times.
    """
    minutes = feed_minutes(stream, feed, time).mapInPandas(_minutes, "table_name string, minute timestamp")
    marked = minutes.withWatermark("minute", delay).groupBy("table_name")
    return marked.transformWithStateInPandas(
        statefulProcessor=FreshnessTimers(limit_minutes), outputStructType=TRANSITIONS, outputMode="Append", timeMode="EventTime"
    )


def freshness_transitions(rows: DataFrame, feed: Column, time: str, limit_minutes: int, delay_minutes: int = 10) -> DataFrame:
    """What :func:`freshness_stream` has given when it has seen all of ``rows``, as a batch query."""
    minutes = feed_minutes(rows, feed, time).distinct()
    mark = minutes.agg((F.max("minute") - F.expr(f"INTERVAL '{delay_minutes}' MINUTE")).alias("mark"))
    minute, limit = F.expr("INTERVAL '1' MINUTE"), F.expr(f"INTERVAL '{limit_minutes}' MINUTE")
    # a row: the only global value; minutes are few per feed
    done = minutes.join(F.broadcast(mark)).where(F.col("minute") + minute <= F.col("mark"))
    w = Window.partitionBy("table_name").orderBy("minute")
    gaps = done.withColumn("next", F.lead("minute").over(w)).withColumn("due", F.col("minute") + limit)
    silent = F.when(F.col("next").isNull(), F.col("due") + minute <= F.col("mark")).otherwise(F.col("next") > F.col("due"))
    found = F.array(
        F.struct(F.lit(STALE).alias("status"), F.col("due").alias("at")), F.struct(F.lit(FRESH).alias("status"), F.col("next").alias("at"))
    )
    return gaps.where(silent).select("table_name", F.inline(found)).where("at IS NOT NULL").select("table_name", "status", "at")
