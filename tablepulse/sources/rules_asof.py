"""S9, E2 over time: rule settings with the time from which they hold.

A setting (``RULES`` columns and ``valid_from``) holds from its time until the next one of the
same table and behaviour, as a whole row; its empty fields fall back to the default
row that holds at the time, then to the built-in default, as in ``resolve_rules``.

The settings of a key are laid out by day first: what holds when the day begins
(the last non-null over a window of the key's settings and days) and what
changes within it. Events then meet their day's layout in an equi-join and pick the
last entry up to their time. So no window holds a key's events and no join is on a
range; a key and day with a third of all events is split like any skewed join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablepulse import schemas as S
from tablepulse.session import checkpointed
from tablepulse.sources.rules import FIELDS, collapse, merged_settings

SETTINGS = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in S.RULES.fields), "valid_from timestamp"])


def day_settings(settings: DataFrame, keys: list[str], days: DataFrame) -> DataFrame:
    """``keys, _day, _plan``: for each key and day of ``days`` the settings of the day, in order; the first one, without a
    time, holds when the day begins (and is empty if there is none)."""
    own = settings.select(*keys, F.col("valid_from").alias("_at"), F.struct(*FIELDS).alias("_s"))
    marks = days.select(*keys, "_day", F.col("_day").cast("timestamp").alias("_at"))
    rows = own.withColumn("_day", F.lit(None).cast("date")).unionByName(marks, allowMissingColumns=True)
    # a setting that begins with the day is in force at its first moment
    w = Window.partitionBy(*keys).orderBy("_at", F.col("_day").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    begin = rows.withColumn("_s", F.last("_s", ignorenulls=True).over(w)).where("_day IS NOT NULL").select(*keys, "_day", F.lit(None).cast("timestamp").alias("_at"), "_s")
    within = own.withColumn("_day", F.to_date("_at")).join(days, [*keys, "_day"], "left_semi")
    both = begin.unionByName(within)
    # a day's changes of one setting, and what holds before them
    return both.groupBy(*keys, "_day").agg(F.array_sort(F.collect_list(F.struct(F.coalesce(F.unix_micros("_at"), F.lit(-(1 << 62))).alias("at"), F.col("_s").alias("s")))).alias("_plan"))


def _in_force(plan: Column, ts: Column) -> Column:
    return F.element_at(F.filter(plan, lambda e: e["at"] <= F.unix_micros(ts)), -1)["s"]


def resolve_rules_asof(events: DataFrame, settings: DataFrame) -> DataFrame:
    """Add ``enabled, severity, threshold, stale_hours`` that hold for each event's (table, behaviour) at its ``ts``.

    Settings of the same key and time merge strictly, as in ``resolve_rules``. Events without a time get the built-in defaults.
    """
    rows = settings.select("table_name", "behavior", "valid_from", *FIELDS).where("valid_from IS NOT NULL")
    x = events.withColumn("_day", F.to_date("ts"))
    for prefix, keys, part in (
        ("o_", ["table_name", "behavior"], rows.where("table_name IS NOT NULL")),
        ("d_", ["behavior"], rows.where("table_name IS NULL")),
    ):
        own = collapse(part, [*keys, "valid_from"])
        days = x.where("_day IS NOT NULL").select(*keys, "_day").distinct().join(own.select(*keys).distinct(), keys, "left_semi")
        plan = checkpointed(day_settings(own, keys, days))
        x = x.join(plan, [*keys, "_day"], "left").withColumn("_now", _in_force(F.col("_plan"), F.col("ts")))
        x = x.select(*[c for c in x.columns if c not in ("_plan", "_now")], *[F.col(f"_now.{c}").alias(prefix + c) for c in FIELDS])
    return merged_settings(x, events.columns)
