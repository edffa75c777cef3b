"""Scoring, gates, grouping into events, escalation to alerts.

The scorer stands in for a language model: a rule set with the same output columns. It is a
substitution, not an equivalent. ``mode="reference"`` keeps the original pipeline's
per-signal behaviour, ``mode="intended"`` its documented purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..settings import DEFAULTS
from . import skew

#: Type code -> words that speak for it; the default lexicon of the rule scorer.
LEXICON = {
    "FL": ("flood", "river", "dam", "rain"),
    "CE": ("clash", "shelling", "attack", "militia", "airstrike"),
    "EP": ("cholera", "outbreak", "measles", "fever"),
    "DR": ("drought", "famine", "hunger"),
    "FR": ("fire", "blaze"),
    "PD": ("displaced", "refugees", "camp"),
}


def _counts(body: Column, lexicon: dict[str, tuple[str, ...]]) -> dict[str, Column]:
    """How often words of each class stand in a text: one pass for all classes where every entry is one word."""
    every = sorted({w for ws in lexicon.values() for w in ws})
    if all(w.isalnum() for w in every):
        found = F.regexp_extract_all(F.lower(body), F.lit(r"\b(" + "|".join(every) + r")\b"), F.lit(1))
        return {code: F.size(F.filter("_found", _one_of(ws))) for code, ws in lexicon.items()} | {"": found}
    return {code: F.regexp_count(F.lower(body), F.lit(r"\b(" + "|".join(ws) + r")\b")) for code, ws in lexicon.items()} | {"": F.lit(None)}


def _one_of(words: tuple[str, ...]):  # noqa: ANN202
    return lambda w: w.isin(*words)


def classify(signals: DataFrame, text: str = "text", title: str = "title", lexicon: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Adds disaster_types, relevance (0-1), severity (1-5) and summary."""
    lexicon = lexicon or LEXICON
    counts = _counts(F.coalesce(F.col(text), F.lit("")), lexicon)
    found = signals.withColumn("_found", counts.pop(""))
    scored = found.withColumns({f"_{code}": c for code, c in counts.items()})
    types = F.filter(F.array(*(F.when(F.col(f"_{code}") > 0, F.lit(code)) for code in lexicon)), lambda x: x.isNotNull())
    return scored.withColumn("_total", sum((F.col(f"_{code}") for code in lexicon), F.lit(0))).withColumns(
        {
            "disaster_types": types,
            "relevance": F.least(F.col("_total") / F.lit(4.0), F.lit(1.0)),
            "severity": F.least(F.lit(5), F.lit(1) + F.col("_total")).cast("int"),
            "summary": F.coalesce(F.col(title), F.lit("")),
        }
    ).drop("_total", "_found", *(f"_{code}" for code in lexicon))


def relevant(scored: DataFrame, threshold: float = DEFAULTS.relevance_threshold) -> DataFrame:
    """Not below the threshold; NaN passes."""
    return scored.where(~(F.col("relevance") < threshold))


def severe(scored: DataFrame, threshold: int = DEFAULTS.severity_threshold) -> DataFrame:
    return scored.where(F.col("event_id").isNotNull() & (F.col("severity") >= threshold))


def route(decisions: DataFrame) -> DataFrame:
    """Adds ``route``: update, insert or reject."""
    return decisions.withColumn("route", F.when((F.col("action") == "add_to_existing") & (F.coalesce("event_id", F.lit("")) != ""), "update").when(F.col("action") == "create_new", "insert").otherwise("reject"))


def new_events(signals: DataFrame, valid_days: int = DEFAULTS.event_valid_days) -> DataFrame:
    """Event columns of a signal that starts one: validity, first and last time, types, rank."""
    types = F.when(F.size("event_types") > 0, F.col("event_types")).otherwise(F.col("disaster_types"))
    return signals.select(
        F.sha2(F.concat_ws("/", F.lit("event"), F.col("signal_id")), 256).alias("event_id"),
        F.array("signal_id").alias("signalIds"),
        "title",
        F.col("ts").alias("validFrom"),
        (F.col("ts") + F.expr(f"interval {valid_days} days")).alias("validTo"),
        F.col("ts").alias("firstSignalCreatedAt"),
        F.col("ts").alias("lastSignalCreatedAt"),
        types.alias("types"),
        (F.col("severity") / F.lit(5.0)).alias("rank"),
    )


def _slices(signals: DataFrame, keys: list[str], gap_hours: int, ts: str, *more: Column) -> DataFrame:
    """A row per key and time slice of ``gap_hours``, with its first and last time and the number of its session.

    Signals of one slice lie nearer than the gap, so they are one session, and what a slice holds is
    pre-aggregated in the tasks that read it: a key with a third of all rows leaves a row per slice and task.
    The window behind sees as many rows of a key as its time has slices.
    """
    sliced = signals.where(F.col(ts).isNotNull()).groupBy(*keys, _slice(ts, gap_hours).alias("_slice"))
    per = sliced.agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), *more)
    w = Window.partitionBy(*keys).orderBy("_slice")
    new = F.when(F.col("first_ts") > F.lag("last_ts").over(w) + F.expr(f"interval {gap_hours} hours"), 1).otherwise(0)
    return per.withColumn("_new", new).withColumn("session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_new")


def _slice(ts: str, gap_hours: int) -> Column:
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(gap_hours * 3_600_000_000)).cast("long")


def sessions(signals: DataFrame, keys: list[str], gap_hours: int = DEFAULTS.session_gap_hours, ts: str = "ts") -> DataFrame:
    """Events: signals of one key whose gaps don't exceed ``gap_hours``; an exact gap still joins. Signals without a time have none."""
    per = _slices(signals, keys, gap_hours, ts, F.count("*").alias("n_signals"), F.max("severity").alias("max_severity"))
    merged = per.groupBy(*keys, "session").agg(F.sum("n_signals").alias("n_signals"), F.max("max_severity").alias("max_severity"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    return merged.drop("session")


def numbered_sessions(signals: DataFrame, keys: list[str], gap_hours: int = DEFAULTS.session_gap_hours, ts: str = "ts") -> DataFrame:
    """``signals`` with ``session``, the number of their event within the key; 0 for those without a time.

    The numbers are worked out per slice and joined to the signals on key and slice, so the rows of a key
    meet in as many tasks as it has slices.
    """
    per = _slices(signals, keys, gap_hours, ts).select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("_slice").alias("_of"), "session")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    found = signals.withColumn("_slice", _slice(ts, gap_hours)).join(per, [*same, F.col("_slice") == F.col("_of")], "left")
    return found.withColumn("session", F.coalesce("session", F.lit(0).cast("long"))).drop("_slice", "_of", *(f"_{k}" for k in keys))


def apply_updates(events: DataFrame, updates: DataFrame, arrival: list[str]) -> tuple[DataFrame, DataFrame]:
    """(events after the updates, updates without a known event).

    Signal ids are appended; the last time is that of the last arrival, as written by the
    original, and ``latest`` the newest of all. Updates are aggregated before the join.
    """
    per = updates.groupBy("event_id").agg(
        F.array_sort(F.collect_set("signal_id")).alias("added"), F.max_by("ts", F.struct(*arrival)).alias("last_arrived"), F.max("ts").alias("newest")
    )
    joined = events.join(per, "event_id", "left").select(
        "event_id",
        F.array_sort(F.array_union("signalIds", F.coalesce("added", F.array().cast("array<string>")))).alias("signalIds"),
        F.coalesce("last_arrived", "lastSignalCreatedAt").alias("lastSignalCreatedAt"),
        F.greatest("newest", "lastSignalCreatedAt").alias("latest"),
    )
    return joined, updates.join(events, "event_id", "left_anti")


#: A bucket of level l is 2 ** l hours long; events that stay open for good are on the last one.
_HOUR, _LAST_LEVEL = 3_600_000_000, 40


def _hours(ts: Column) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / _HOUR).cast("long")


def candidates(signals: DataFrame, events: DataFrame, keys: list[str], ts: str = "ts", share: int = skew.SHARE, few: int = skew.FEW) -> DataFrame:
    """``signals`` with the columns of every event of the same ``keys`` that began before the signal and was still open.

    An event is open up to its validTo, for good if that is null. Signals without such an event have no
    row; nor has one with a null key. An event lies in the time buckets that its validity meets, of the
    level at which they are as long as it is, so in two or three. A signal looks into its bucket of each level
    that there is. Rows meet by equality of keys, level and bucket, and the signals of a hot bucket are dealt to many tasks.
    """
    ends = F.coalesce(_hours(F.col("validTo")), F.lit(1 << _LAST_LEVEL).cast("long") - 1)
    known = events.where(F.col("validFrom").isNotNull() & (F.col("validTo").isNull() | (F.col("validTo") > F.col("validFrom")))).withColumns({"_from": _hours(F.col("validFrom")), "_to": ends})
    level = F.least(F.ceil(F.log2((F.col("_to") - F.col("_from") + 1).cast("double"))).cast("int"), F.lit(_LAST_LEVEL))
    width = lambda at: F.pow(F.lit(2.0), at).cast("long")
    bucket = lambda hour, at: F.floor(hour / width(at)).cast("long")
    known = known.withColumn("_level", level)
    known = known.withColumn("_bucket", F.explode(F.sequence(bucket(F.col("_from"), F.col("_level")), bucket(F.col("_to"), F.col("_level"))))).drop("_from", "_to")
    levels = sorted(r[0] for r in known.select("_level").distinct().collect())  # _LAST_LEVEL + 1 rows at most
    if not levels:
        levels = [0]
    placed = signals.where(F.col(ts).isNotNull()).withColumn("_level", F.explode(F.array(*map(F.lit, levels)))).withColumn("_bucket", bucket(_hours(F.col(ts)), F.col("_level")))
    on = [*keys, "_level", "_bucket"]
    found = skew.dealt_join(placed, known, on, skew.hot_keys(placed, on, share, few), F.xxhash64(ts))
    open_then = (F.col("validFrom") < F.col(ts)) & (F.col("validTo").isNull() | (F.col(ts) <= F.col("validTo")))
    rest = [c for c in events.columns if c not in keys]
    return found.where(open_then).select(*signals.columns, *rest)


def assess(events: DataFrame, min_severity: int = DEFAULTS.severity_threshold, min_signals: int = 1) -> DataFrame:
    """Adds should_alert and status, which is always ``draft``."""
    return events.withColumns({"should_alert": (F.col("max_severity") >= min_severity) & (F.col("n_signals") >= min_signals), "status": F.lit("draft")})


def alerts(severe_signals: DataFrame, mode: str = "reference") -> DataFrame:
    """(event_id, status): one per severe signal (reference) or one per event (intended)."""
    if mode not in ("reference", "intended"):
        raise ValueError(mode)
    out = severe_signals.select("event_id", F.lit("draft").alias("status"))
    return out if mode == "reference" else out.dropDuplicates(["event_id"])


def evidence(signals: DataFrame, mode: str = "intended") -> DataFrame:
    """What the assessment sees: the event's signals (intended), or each signal alone (reference)."""
    if mode == "reference":
        return signals.select("event_id", "signal_id", F.lit(1).cast("long").alias("n_signals"), F.col("severity").alias("max_severity"), F.array("summary").alias("summaries"))
    return signals.groupBy("event_id").agg(F.count("*").alias("n_signals"), F.max("severity").alias("max_severity"), F.transform(F.sort_array(F.collect_list(F.struct("ts", "signal_id", "summary"))), lambda x: x["summary"]).alias("summaries"))


def results(scored: DataFrame, events: DataFrame, made: DataFrame) -> DataFrame:
    """One schema per signal: signal_id, relevance, severity, event_id, alert_id; ids are null below the gates."""
    return scored.select("signal_id", "relevance", "severity").join(events.select("signal_id", "event_id"), "signal_id", "left").join(made.select("event_id", "alert_id").distinct(), "event_id", "left").select("signal_id", "relevance", "severity", "event_id", "alert_id")
