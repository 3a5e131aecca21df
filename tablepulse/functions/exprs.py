"""Small expression builders used across operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lit_ts(ts: datetime | str | None) -> Column:
    """A TIMESTAMP literal (UTC when naive); ``None`` gives current_timestamp()."""
    if ts is None:
        return F.current_timestamp()
    if isinstance(ts, str):
        ts = datetime.fromisoformat(ts.replace("Z", "+00:00"))
    if ts.tzinfo is None:
        ts = ts.replace(tzinfo=timezone.utc)
    # explicit zone suffix: the instant does not depend on the session time zone
    return F.lit(ts.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")).cast("timestamp")


def as_instant(c: Column, dtype: T.DataType) -> Column:
    """A TIMESTAMP instant; zone-less (NTZ) wall-clock values are read as UTC."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.concat(c.cast("string"), F.lit("Z")).cast("timestamp")
    return c.cast("timestamp")


def lit_date(d: date | datetime | str | None) -> Column:
    if d is None:
        return F.current_date()
    if isinstance(d, datetime):
        d = (d if d.tzinfo is None else d.astimezone(timezone.utc)).date()
    return F.lit(str(d)).cast("date")


def empty_str_map() -> Column:
    # map() alone is MAP<VOID,VOID>; give it the stored type
    return F.create_map().cast("map<string,string>")


def str_map(**kv: Column | str) -> Column:
    parts: list[Column] = []
    for k, v in kv.items():
        parts += [F.lit(k), v if isinstance(v, Column) else F.lit(v)]
    return F.create_map(*parts)


def partition_key_details(keys: Mapping[str, str]) -> Column:
    """The details of each table's rows: its partition key, by ``table_name`` (an empty map for tables without one)."""
    out = empty_str_map()
    for table, key in keys.items():
        out = F.when(F.col("table_name") == table, str_map(partitionKey=key)).otherwise(out)
    return out


def parse_iso_date(c: Column) -> Column:
    """Strict yyyy-MM-dd parse; other text gives null (never an error)."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(c, "yyyy-MM-dd"))


def partition_order(c: Column) -> list[Column]:
    """Partition values in the order of their type: numbers by value, then everything else (dates, months, text) by text."""
    return [F.when(c.rlike(r"^[+-]?\d+(\.\d+)?$"), c.cast("double")).asc_nulls_last(), c.asc()]


def newest_first(c: Column) -> list[Column]:
    """The reverse of :func:`partition_order`."""
    return [F.when(c.rlike(r"^[+-]?\d+(\.\d+)?$"), c.cast("double")).desc_nulls_first(), c.desc()]


def change_ratio(cur: Column, prev: Column) -> Column:
    """(cur - prev) / prev; 0.0 when prev is 0; null when prev is null."""
    return F.when(prev.isNull(), F.lit(None).cast("double")).when(prev == 0, F.lit(0.0)).otherwise(
        (cur - prev) / prev
    )


def nan_to_null(c: Column) -> Column:
    d = c.cast("double")
    return F.when(~F.isnan(d), d)


def composite_key(cols: Sequence[str]) -> Column:
    """Null-safe composite key: a struct, so ('a',null,'b') and ('a||b',null,null) differ."""
    return F.struct(*[F.col(c) for c in cols])


def key_text(cols: Sequence[str]) -> Column:
    """Printable form of a key for examples: values joined by '||', nulls shown as <null>."""
    return F.concat_ws("||", *[F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in cols])


def java_double_text(c: Column) -> Column:
    """Double as text the way the JVM prints it (24.0, 0.1, 1.0E7)."""
    return c.cast("double").cast("string")


def iso_instant(ts: Column) -> Column:
    """ISO-8601 UTC instant text: seconds, or millis/micros only when present."""
    micros = F.unix_micros(ts) % 1_000_000
    return (
        F.when(micros == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(micros % 1000 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    )


def severity_rank(c: Column) -> Column:
    """CRITICAL first, then WARN, then INFO."""
    return F.when(c == "CRITICAL", 0).when(c == "WARN", 1).when(c == "INFO", 2).otherwise(3)
