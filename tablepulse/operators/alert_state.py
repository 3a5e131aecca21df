"""E12, E14 over runs: an alert is sent once, its end is announced, and the cap is fair.

The state has one row per alert identity (behaviour, table and subject; not the
partition, which changes with the day):

* an alert that fires and is not open is opened and waits to be sent;
* one that fires while open is repeated: counted, not sent again;
* one that is open and evaluated without firing is resolved; the end is sent if its beginning was;
* one that a run does not evaluate, or that is muted, stays as it is.

A run sends what has waited longest first, up to its cap, and what it holds back waits
for the next run, so no alert is held back for good by newer ones.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepulse import schemas as S
from tablepulse.functions.exprs import lit_ts, severity_rank
from tablepulse.session import checkpointed
from tablepulse.sinks.versions import Versions

OPEN, RESOLVED = "open", "resolved"
OPENED = "opened"
STATE = (
    "identity string, behavior string, table_name string, subject string, status string, severity string, message string, actual double, "
    "opened_at timestamp, last_seen_at timestamp, resolved_at timestamp, runs long, waiting string, waiting_since timestamp"
)


def identity() -> Column:
    """What an alert is about, whatever the partition and the day."""
    subject = F.concat_ws("/", F.col("extra")["column"], F.col("extra")["reference"])
    return F.concat_ws("|", "behavior", "table_name", subject)


def evaluated(decisions: DataFrame) -> DataFrame:
    """One row per identity that a run evaluated: whether it fires, and its worst alert."""
    sent = F.col("status") == S.STATUS_SENT
    worst = F.struct(severity_rank(F.col("severity")).alias("r"), F.when(F.isnan("actual"), None).otherwise(-F.col("actual")).alias("v"), F.col("message"))
    rows = decisions.where(F.col("status").isin(S.STATUS_SENT, S.STATUS_SKIPPED)).withColumn("identity", identity())
    subject = F.concat_ws("/", F.col("extra")["column"], F.col("extra")["reference"])
    return rows.groupBy("identity").agg(
        F.first("behavior").alias("behavior"), F.first("table_name").alias("table_name"), F.first(subject).alias("subject"), F.bool_or(sent).alias("fires"),
        F.min_by(F.struct("severity", "message", "actual"), F.when(sent, worst)).alias("worst"),
    )


def merge_alert_state(state: DataFrame, decisions: DataFrame, run_ts: datetime | str, max_alerts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(the state after the run, what the run sends): ``decisions`` are one run's.

    What is sent are state rows with ``waiting`` (opened | resolved) and ``waiting_since``. ``max_alerts`` is the run's cap.
    """
    now = lit_ts(run_ts)
    old = state.select([F.col(c) if c == "identity" else F.col(c).alias(f"_{c}") for c in state.columns])
    x = evaluated(decisions).join(old, "identity", "full")
    was_open = F.coalesce(F.col("_status") == OPEN, F.lit(False))
    fires, seen = F.coalesce("fires", F.lit(False)), F.col("fires").isNotNull()
    opens, ends = fires & ~was_open, seen & ~fires & was_open
    # the end of an alert that was never sent, and the return of one whose end was not, need no message
    untold_end = opens & (F.col("_waiting") == RESOLVED)
    unsent = F.col("_waiting") == OPENED
    waiting = (
        F.when(F.coalesce(untold_end, F.lit(False)), F.lit(None).cast("string"))
        .when(opens, F.lit(OPENED))
        .when(ends, F.when(F.coalesce(unsent, F.lit(False)), F.lit(None).cast("string")).otherwise(F.lit(RESOLVED)))
        .otherwise(F.col("_waiting"))
    )
    new = x.select(
        "identity",
        F.coalesce("_behavior", "behavior").alias("behavior"),
        F.coalesce("_table_name", "table_name").alias("table_name"),
        F.coalesce("_subject", "subject").alias("subject"),
        F.when(fires, F.lit(OPEN)).when(ends, F.lit(RESOLVED)).otherwise(F.coalesce("_status", F.lit(RESOLVED))).alias("status"),
        *[F.when(fires, F.col(f"worst.{c}")).otherwise(F.col(f"_{c}")).alias(c) for c in ("severity", "message", "actual")],
        F.when(opens, now).otherwise(F.col("_opened_at")).alias("opened_at"),
        F.when(fires, now).otherwise(F.col("_last_seen_at")).alias("last_seen_at"),
        F.when(fires, F.lit(None).cast("timestamp")).when(ends, now).otherwise(F.col("_resolved_at")).alias("resolved_at"),
        F.when(opens, F.lit(1)).when(fires, F.col("_runs") + 1).otherwise(F.coalesce("_runs", F.lit(0))).cast("long").alias("runs"),
        waiting.alias("waiting"),
        F.when(opens | ends, F.when(waiting.isNotNull(), now)).otherwise(F.col("_waiting_since")).alias("waiting_since"),
    )
    # what never fired is not kept; one row per alert that ever did
    new = checkpointed(new.where(F.col("opened_at").isNotNull()))
    due = new.where(F.col("waiting").isNotNull())
    if max_alerts is not None:
        due = due.orderBy("waiting_since", severity_rank(F.col("severity")), "identity").limit(max_alerts)
    out = checkpointed(due)
    told = out.select("identity", F.lit(True).alias("_told"))
    if max_alerts is not None and max_alerts <= 100_000:
        told = F.broadcast(told)  # at most max_alerts names
    done = F.coalesce("_told", F.lit(False))
    after = new.join(told, "identity", "left").select(
        *[F.when(~done, F.col(c)).alias(c) if c in ("waiting", "waiting_since") else F.col(c) for c in new.columns]
    )
    return after, out


class AlertState(Versions):
    """The alert state, kept in tables: ``run`` merges one run's decisions and gives what it sends."""

    def __init__(self, spark: SparkSession, prefix: str, folder: str):
        super().__init__(spark, prefix, folder, {"alerts": STATE})

    def run(self, decisions: DataFrame, run_ts: datetime | str, max_alerts: int | None = None) -> DataFrame:
        """State rows to send. The new state is written first: a run that dies before has sent nothing."""
        after, out = merge_alert_state(self.read("alerts"), decisions, run_ts, max_alerts)
        self.write(self.next_run(), {"alerts": after})
        return out
