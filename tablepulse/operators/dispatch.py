"""From decisions to messages.

Level filter, de-duplication by alert key, batching in a total order, a cap
on messages per run, message text and payload, and audit rows. All of it
is DataFrame work: de-duplication is an aggregation (``min_by``), batch
numbers come from a distributed global sequence, and a batch is at most
``batch_size`` alerts, so no step gathers an unbounded group.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepulse import schemas as S
from tablepulse.functions.exprs import empty_str_map, iso_instant, severity_rank, str_map
from tablepulse.functions.sequence import with_sequence

ALERT_COLS = ["behavior", "table_name", "partition_value", "actual", "threshold", "severity", "message", "ts", "extra", "alert_key"]


@dataclass(frozen=True)
class Channel:
    """Where and how messages go: level, naming, mentions, batching and cap."""

    level: str = "basic"
    product: str = S.PRODUCT
    environment: str = S.ENVIRONMENT
    channel: str = ""
    mentions: Mapping[str, str] = field(default_factory=dict)  # severity -> mention text
    batch_size: int = S.BATCH_SIZE
    max_messages: int = S.MAX_MESSAGES_PER_RUN

    def __post_init__(self) -> None:
        if self.level.lower() not in S.LEVELS:
            raise ValueError(f"Unknown notify level: {self.level}")
        object.__setattr__(self, "level", self.level.lower())


def level_filter(decisions: DataFrame, level: str) -> DataFrame:
    """basic: sent availability/freshness or any sent CRITICAL; advanced: all sent; detailed: all."""
    level = level.lower()
    sent = F.col("status") == S.STATUS_SENT
    if level == "basic":
        return decisions.where(sent & (F.col("behavior").isin("availability", "freshness") | (F.col("severity") == "CRITICAL")))
    if level == "advanced":
        return decisions.where(sent)
    if level == "detailed":
        return decisions
    raise ValueError(f"Unknown notify level: {level}")


def sendable(decisions: DataFrame, level: str) -> DataFrame:
    """Alerts that go out at ``level``: sent ones, plus INFO summaries at detailed (never muted)."""
    kept = level_filter(decisions, level)
    sent = F.col("status") == S.STATUS_SENT
    if level.lower() == "detailed":
        kept = kept.where(sent | ((F.col("status") == S.STATUS_SKIPPED) & (F.col("severity") == "INFO")))
    else:
        kept = kept.where(sent)
    return kept.select(*ALERT_COLS)


def _subject() -> Column:
    """What an alert is about beyond its key: column and reference."""
    return F.concat_ws("/", F.col("extra")["column"], F.col("extra")["reference"])


def _order_struct() -> Column:
    """The worst alert first: severity, then the largest value; the rest makes the order total."""
    return F.struct(
        severity_rank(F.col("severity")).alias("r"),
        F.when(F.isnan("actual"), F.lit(None)).otherwise(-F.col("actual")).isNull().alias("unknown"),
        (-F.col("actual")).alias("worst"),
        F.col("ts"),
        F.col("message"),
        _subject().alias("subject"),
        F.to_json("extra").alias("extra"),
    )


def dedup_alerts(alerts: DataFrame) -> DataFrame:
    """One alert per key: the worst, with all columns (and references) that share the key in ``extra['merged']``.

    A key's alerts are those of one check of one partition: a few columns and references.
    """
    cols = [c for c in ALERT_COLS if c != "alert_key"]
    first = alerts.groupBy("alert_key").agg(
        F.min_by(F.struct(*cols), _order_struct()).alias("a"), F.array_sort(F.collect_set(_subject())).alias("subjects")
    )
    merged = F.when(F.size("subjects") > 1, str_map(merged=F.array_join("subjects", ", "))).otherwise(empty_str_map())
    extra = F.map_concat(F.coalesce(F.col("a.extra"), empty_str_map()), merged)
    return first.select(*[(extra if c == "extra" else F.col(f"a.{c}")).alias(c) for c in cols], "alert_key").select(*ALERT_COLS)


def total_order() -> list[Column]:
    """Severity (CRITICAL first), table, partition, behaviour, key, then the rest for a total order."""
    return [
        severity_rank(F.col("severity")),
        F.col("table_name").asc_nulls_first(),
        F.col("partition_value").asc_nulls_first(),
        F.col("behavior"),
        F.col("alert_key"),
        F.col("ts"),
        F.col("message"),
        F.col("actual"),
        _subject(),
        F.to_json("extra"),
    ]


def number_batches(alerts: DataFrame, batch_size: int = S.BATCH_SIZE) -> DataFrame:
    """Add ``seq`` (global position), ``batch_no`` and ``position`` within the batch."""
    x = with_sequence(alerts, total_order(), "seq")
    return x.withColumn("batch_no", F.floor(F.col("seq") / batch_size).cast("long")).withColumn(
        "position", (F.col("seq") % batch_size).cast("int")
    )


def where_partition(partition: Column) -> Column:
    return F.when(partition.isNull(), F.lit("")).otherwise(F.concat(F.lit("/"), partition))


def mention_of(severity: Column, mentions: Mapping[str, str]) -> Column:
    pairs = [x for k, v in mentions.items() if v for x in (F.lit(k.upper()), F.lit(v))]
    if not pairs:
        return F.lit("")
    return F.coalesce(F.element_at(F.create_map(*pairs), severity), F.lit(""))


def render_text(ch: Channel, prefix: str = "") -> Column:
    """``[product|env] table/partition behavior SEV: message actual=%.4f (thr=%.3f). mention``."""
    c = (lambda n: F.col(prefix + n)) if prefix else F.col
    thr = F.when(c("threshold").isNull(), F.lit("")).otherwise(F.format_string(" (thr=%.3f)", c("threshold")))
    m = mention_of(c("severity"), ch.mentions)
    return F.concat(
        F.lit(f"[{ch.product}|{ch.environment}] "),
        c("table_name"),
        where_partition(c("partition_value")),
        F.lit(" "),
        c("behavior"),
        F.lit(" "),
        c("severity"),
        F.lit(": "),
        c("message"),
        F.lit(" actual="),
        F.format_string("%.4f", c("actual")),
        thr,
        F.lit("."),
        F.when(m == "", F.lit("")).otherwise(F.concat(F.lit(" "), m)),
    )


def _section_text(text: Column) -> Column:
    return F.struct(
        F.lit("section").alias("type"),
        F.struct(F.lit("mrkdwn").alias("type"), text.alias("text")).alias("text"),
        F.lit(None).cast("array<struct<type:string,text:string>>").alias("fields"),
    )


def _section_fields(fields: Column) -> Column:
    return F.struct(
        F.lit("section").alias("type"),
        F.lit(None).cast("struct<type:string,text:string>").alias("text"),
        fields.alias("fields"),
    )


def _field(name: str, value: Column) -> Column:
    return F.struct(F.lit("mrkdwn").alias("type"), F.concat(F.lit(f"*{name}*: "), value).alias("text"))


def render_blocks(ch: Channel, session_tz: str = "UTC", prefix: str = "") -> Column:
    """Payload blocks (JSON text) of a single alert for the channel's level."""
    c = (lambda n: F.col(prefix + n)) if prefix else F.col
    blocks = [_section_text(render_text(ch, prefix))]
    if ch.level in ("advanced", "detailed"):
        fields = F.array(
            _field("Table", F.concat(c("table_name"), where_partition(c("partition_value")))),
            _field("Behavior", c("behavior")),
            _field("Severity", c("severity")),
            _field("Actual", F.format_string("%.4f", c("actual"))),
            _field("Threshold", F.when(c("threshold").isNull(), F.lit("-")).otherwise(F.format_string("%.3f", c("threshold")))),
            _field("Run At", iso_instant(F.to_utc_timestamp(c("ts"), session_tz))),
        )
        blocks.append(_section_fields(fields))
    arr = F.array(*blocks)
    if ch.level == "detailed":
        extra_fields = F.transform(
            F.array_sort(F.map_entries(c("extra"))),
            lambda e: F.struct(F.lit("mrkdwn").alias("type"), F.concat(F.lit("*"), e["key"], F.lit("*: "), e["value"]).alias("text")),
        )
        arr = F.when(F.size(c("extra")) > 0, F.concat(arr, F.array(_section_fields(extra_fields)))).otherwise(arr)
    return F.to_json(arr)


def batch_messages(numbered: DataFrame, ch: Channel) -> DataFrame:
    """One message per batch: ``batch_no, alerts, text, items, blocks, channel``.

    A batch of one alert is rendered as that alert; larger batches get a
    header with counts per severity and at most 10 item lines, with a line that counts the rest.
    """
    single_text = render_text(ch)
    single_blocks = render_blocks(ch, numbered.sparkSession.conf.get("spark.sql.session.timeZone"))
    item = F.concat(
        F.lit("• "), F.col("table_name"), where_partition(F.col("partition_value")), F.lit(":"), F.col("behavior"),
        F.lit(" "), F.col("severity"), F.lit(" "), F.col("message"),
    )
    per = numbered.select(
        "batch_no",
        F.struct(
            F.col("position"), F.col("severity"), item.alias("item"), single_text.alias("text"), single_blocks.alias("blocks")
        ).alias("a"),
    )
    g = per.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("alerts"),
        F.array_sort(F.collect_list("a")).alias("items_arr"),
        F.count_if(F.col("a.severity") == "CRITICAL").alias("n_critical"),
        F.count_if(F.col("a.severity") == "WARN").alias("n_warn"),
        F.count_if(F.col("a.severity") == "INFO").alias("n_info"),
    )
    counts = F.concat_ws(
        ", ",
        *[
            F.when(F.col(n) > 0, F.concat(F.lit(f"{sev}="), F.col(n).cast("string")))
            for sev, n in (("CRITICAL", "n_critical"), ("WARN", "n_warn"), ("INFO", "n_info"))
        ],
    )
    header = F.concat(
        F.lit(f"[{ch.product}|{ch.environment}] "), F.col("alerts").cast("string"), F.lit(" alerts ("), counts, F.lit(")")
    )
    items = F.array_join(F.transform(F.slice(F.col("items_arr"), 1, S.BATCH_ITEM_LINES), lambda a: a["item"]), "\n")
    more = F.col("alerts") - S.BATCH_ITEM_LINES
    items = F.when(more > 0, F.concat(items, F.lit("\n… and "), more.cast("string"), F.lit(" more"))).otherwise(items)
    multi_blocks = F.to_json(F.array(_section_text(header), _section_text(items)))
    one = F.col("alerts") == 1
    return g.select(
        "batch_no",
        "alerts",
        F.when(one, F.col("items_arr")[0]["text"]).otherwise(header).alias("text"),
        F.when(one, F.lit(None).cast("string")).otherwise(items).alias("items"),
        F.when(one, F.col("items_arr")[0]["blocks"]).otherwise(multi_blocks).alias("blocks"),
        F.lit(ch.channel).alias("channel"),
    )


def messages(decisions: DataFrame, ch: Channel, dedup: bool = True, cap: bool = True) -> DataFrame:
    """Messages for the channel: level filter, optional dedup by key, batches, optional cap.

    With the cap, the last message says how many messages and alerts it holds back.
    """
    alerts = sendable(decisions, ch.level)
    if dedup:
        alerts = dedup_alerts(alerts)
    out = batch_messages(number_batches(alerts, ch.batch_size), ch)
    return capped(out, ch.max_messages)[0] if cap else out


def capped(batches: DataFrame, max_messages: int) -> tuple[DataFrame, int, int]:
    """(the first ``max_messages`` messages, number of messages and of alerts held back)."""
    rest = batches.where(F.col("batch_no") >= max_messages)
    row = rest.agg(F.count(F.lit(1)).alias("messages"), F.coalesce(F.sum("alerts"), F.lit(0)).alias("alerts")).first()
    out = batches.where(F.col("batch_no") < max_messages)
    if row["messages"]:
        note = f" (+{row['alerts']} alerts in {row['messages']} more messages not sent)"
        last = F.col("batch_no") == max_messages - 1
        out = out.withColumn("text", F.when(last, F.concat("text", F.lit(note))).otherwise(F.col("text")))
    return out, int(row["messages"]), int(row["alerts"])


def dry_run(decisions: DataFrame, ch: Channel) -> DataFrame:
    """The messages that would go out, without dedup and without the cap."""
    return messages(decisions, ch, dedup=False, cap=False)


def audit_rows(decisions: DataFrame, level: str) -> DataFrame:
    """AUDIT rows: one per decision, before any filter."""
    tz = decisions.sparkSession.conf.get("spark.sql.session.timeZone")
    return decisions.select(
        F.col("alert_key").alias("key"),
        F.lit(level.lower()).alias("level"),
        "severity",
        F.col("table_name").alias("table"),
        "behavior",
        "status",
        "reason",
        iso_instant(F.to_utc_timestamp(F.col("ts"), tz)).alias("timestamp"),
    )
