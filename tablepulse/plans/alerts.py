"""Results -> events -> rule settings -> decisions -> messages and audit."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from tablepulse.operators.dispatch import Channel, audit_rows, capped, messages
from tablepulse.operators.policy import evaluate, events_from_results
from tablepulse.plans.profile import Profile
from tablepulse.session import checkpointed


@dataclass
class AlertRun:
    events: DataFrame
    decisions: DataFrame
    messages: DataFrame
    audit: DataFrame
    suppressed_messages: int
    suppressed_alerts: int


def run_alerts(
    profile: Profile,
    channel: Channel,
    rules: DataFrame | None = None,
    run_ts: datetime | str | None = None,
    max_rule_rows: int | None = None,
    dedup: bool = True,
) -> AlertRun:
    """The alert path over a profile's results (the caller writes or sends the frames).

    ``suppressed_messages`` and ``suppressed_alerts`` count what the channel's cap
    holds back; the last message says so, too. Decisions (one per event: partitions x checks, not rows) are checkpointed
    once, so messages and audit rows read the same decided alerts.
    """
    ev = events_from_results(profile.metrics, profile.drift, run_ts, profile.rules)
    dec = checkpointed(evaluate(ev, rules, max_rule_rows))
    # messages are one row per batch of alerts: counting those beyond the cap reads the checkpointed alerts
    sent, held_messages, held_alerts = capped(messages(dec, channel, dedup=dedup, cap=False), channel.max_messages)
    return AlertRun(ev, dec, sent, audit_rows(dec, channel.level), held_messages, held_alerts)
