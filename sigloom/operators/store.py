"""The store of open events: which event a signal goes to, and what the store holds then.

The rule stands in for a model's grouping: signals of one type and place whose times are near belong to
one event, up to the end of its validity. ``decisions`` is the batch form, ``streaming.events`` keeps the open
events as state and gives the same rows for signals that come in the order of their times.

The signals of a clock hour of one key are decided together, as one slice: they lie nearer than any gap, and
an event's validity ends at a full hour. So a key with a third of all signals leaves a row per hour and
task, and what is folded in order is as long as the time is, not as the signals are many.

``apply_grouping`` puts a model's answers in the place of the rule.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..settings import DEFAULTS
from ..sources import scratch
from . import events as ev

HOUR = 3_600_000_000  # microseconds
DECISION = "slice long, began long, action string, n_signals long, max_severity int, first_us long, last_us long"
SLICE = ["slice", "first_us", "last_us", "n_signals", "max_severity"]


class Open(NamedTuple):
    """An event in the store: the hour it was created for, its first and last signal, and the hour from which it is closed."""

    began: int
    first: int
    last: int
    until: int


def sliced(signals: DataFrame, keys: list[str], ts: str = "ts", severity: str = "severity") -> DataFrame:
    """(keys, slice, first_us, last_us, n_signals, max_severity), a row per signal, to be added up; signals without a time are left out."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    return signals.where(F.col(ts).isNotNull()).select(*keys, F.floor(us / HOUR).cast("long").alias("slice"), us.alias("first_us"), us.alias("last_us"), F.lit(1).cast("long").alias("n_signals"), F.col(severity).cast("int").alias("max_severity"))


def added_up(slices: DataFrame, keys: list[str]) -> DataFrame:
    return slices.groupBy(*keys, "slice").agg(F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"), F.sum("n_signals").alias("n_signals"), F.max("max_severity").alias("max_severity"))


def fold(known: Iterable[Open], slices: pd.DataFrame, gap_hours: int, valid_days: int, late_hours: int) -> tuple[list[Open], pd.DataFrame]:
    """(open events, decisions) after the slices of one key, in the order of their hours.

    Its first signal decides for a slice. It goes to an event that isn't closed at that hour and whose signals are no further
    than the gap from it: of several to the one that began last among those that began before it, else
    to the one that begins next. Without such an event it creates one. A late slice follows the
    same rule, whichever events came in between. Events whose last signal is older than the newest by more than the gap and
    ``late_hours`` are forgotten: a signal that is later still creates an event of its own.
    """
    gap, events, out = gap_hours * HOUR, sorted(known), []
    for s, first, last, n, severity in slices.sort_values("slice")[SLICE].itertuples(index=False, name=None):
        s, first, last = int(s), int(first), int(last)
        near = [i for i, e in enumerate(events) if s < e.until and e.first - gap <= first <= e.last + gap]
        begun = [i for i in near if events[i].first <= first]
        if near:
            i = begun[-1] if begun else near[0]
            e = events[i] = events[i]._replace(first=min(events[i].first, first), last=max(events[i].last, last))
        else:
            e = Open(s, first, last, s + 24 * valid_days)
            events = sorted([*events, e])
        out.append((s, e.began, "add_to_existing" if near else "create_new", int(n), severity, first, last))
    newest = max((e.last for e in events), default=0)
    kept = [e for e in events if e.last >= newest - gap - late_hours * HOUR]
    return kept, pd.DataFrame(out, columns=["slice", "began", "action", "n_signals", "max_severity", "first_us", "last_us"])


def types_of(rows: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)


def decisions(signals: DataFrame, keys: list[str], gap_hours: int = DEFAULTS.session_gap_hours, valid_days: int = DEFAULTS.event_valid_days, ts: str = "ts", severity: str = "severity") -> DataFrame:
    """(keys, slice, began, action, n_signals, max_severity, first_us, last_us): a row per key and hour, as if all signals came in order."""
    slices = added_up(sliced(signals, keys, ts, severity), keys)

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        _, out = fold([], frame, gap_hours, valid_days, 0)
        for k in reversed(keys):
            out.insert(0, k, frame[k].iloc[0])
        return out

    return slices.groupBy(*keys).applyInPandas(one, f"{types_of(slices, keys)}, {DECISION}")  # a row per hour of the key


def event_id(keys: list[str]) -> Column:
    """Follows from the key and the hour that an event was created for, so a decision made twice names one event."""
    return F.sha2(F.concat_ws("/", F.lit("event"), *(F.coalesce(F.col(k).cast("string"), F.lit("~")) for k in keys), F.col("began")), 256)


def event_rows(decided: DataFrame, keys: list[str], valid_days: int = DEFAULTS.event_valid_days) -> DataFrame:
    """The store's events: event_id, keys, validFrom, validTo, lastSignalCreatedAt, n_signals, max_severity."""
    per = decided.groupBy(*keys, "began").agg(F.min("first_us").alias("first"), F.max("last_us").alias("last"), F.sum("n_signals").alias("n_signals"), F.max("max_severity").alias("max_severity"))
    start = F.timestamp_micros("first")
    return per.select(event_id(keys).alias("event_id"), *keys, start.alias("validFrom"), (start + F.expr(f"interval {valid_days} days")).alias("validTo"), F.timestamp_micros("last").alias("lastSignalCreatedAt"), "n_signals", "max_severity")


def signal_events(signals: DataFrame, decided: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    """``signals`` with the event_id of their slice. Of an hour that was decided in several batches each part went to one event, the first if they differ."""
    of = decided.groupBy(*keys, "slice").agg(F.min("began").alias("began")).select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("slice").alias("_of"), event_id(keys).alias("event_id"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    placed = signals.withColumn("_slice", F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / HOUR).cast("long"))
    return placed.join(of, [*same, F.col("_slice") == F.col("_of")], "left").drop("_slice", "_of", *(f"_{k}" for k in keys))


def apply_grouping(signals: DataFrame, answers: DataFrame, events: DataFrame, arrival: list[str]) -> tuple[DataFrame, DataFrame]:
    """(events after a model's answers, rejected signals with the reason).

    ``signals``: signal_id, title, ts, severity, disaster_types and ``arrival``; ``answers``: signal_id, action, event_id, title,
    types, failure; ``events``: the columns of ``events.new_events``. An answer adds its signal to the event it names or creates one; a
    signal is rejected if it has no answer or a failed one, or if that names no action or an event that isn't known. Signal ids of an event are one array.
    """
    told = answers.select("signal_id", "action", "event_id", F.col("title").alias("_title"), F.col("types").alias("event_types"), "failure")
    decided = scratch.written(ev.route(signals.join(told, "signal_id", "left")), "decided")  # read five times, and a model is asked once
    created = ev.new_events(decided.where("route = 'insert'").withColumn("title", F.coalesce("_title", "title")))
    updates = decided.where("route = 'update'").select("event_id", "signal_id", "ts", *(a for a in arrival if a not in ("signal_id", "ts")))
    changed, unknown = ev.apply_updates(events, updates, arrival)
    after = events.drop("signalIds", "lastSignalCreatedAt").join(changed.select("event_id", "signalIds", "lastSignalCreatedAt"), "event_id").select(*created.columns)
    reason = F.when(F.col("action").isNull(), F.coalesce("failure", F.lit("no answer"))).otherwise(F.concat(F.lit("unexpected action: "), "action"))
    rejected = decided.where("route = 'reject'").select("signal_id", reason.alias("reason")).unionByName(unknown.select("signal_id", F.concat(F.lit("unknown event: "), "event_id").alias("reason")))
    return after.unionByName(created), rejected
