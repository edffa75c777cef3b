"""The store of open events as a stream's state, and the stream form of a signal's candidates."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import store
from ..settings import DEFAULTS


class EventStore(StatefulProcessor):
    """Open events of a key as list state. Decisions come out with the batch that brings the signals.

    An event is closed by the hour from which its validity has ended; it is forgotten by the rule of ``store.fold``
    when newer signals come, and by the time to live where none come any more.
    """

    def __init__(self, keys: list[str], gap_hours: int, valid_days: int, late_hours: int):
        self.keys, self.rule = keys, (gap_hours, valid_days, late_hours)
        self.ttl = (24 * valid_days + gap_hours + late_hours) * 3_600_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getListState("open", "began long, first long, last long, until long", ttlDurationMs=self.ttl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N803
        frame = pd.concat(list(rows))  # a row per hour and task
        whole = frame.groupby("slice", as_index=False).agg(first_us=("first_us", "min"), last_us=("last_us", "max"), n_signals=("n_signals", "sum"), max_severity=("max_severity", "max"))
        known = [store.Open(*map(int, e)) for e in self.open.get()] if self.open.exists() else []
        kept, decided = store.fold(known, whole, *self.rule)
        self.open.put([tuple(e) for e in kept])
        for name in reversed(self.keys):
            decided.insert(0, name, frame[name].iloc[0])
        yield decided

    def close(self) -> None:
        pass


def _combined(keys: list[str]):  # noqa: ANN202
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds up the slices of each batch before they are shuffled."""
        for batch in batches:
            sums = pa.Table.from_batches([batch]).group_by([*keys, "slice"]).aggregate([("first_us", "min"), ("last_us", "max"), ("n_signals", "sum"), ("max_severity", "max")])
            yield from sums.select([*keys, "slice", "first_us_min", "last_us_max", "n_signals_sum", "max_severity_max"]).rename_columns(batch.schema.names).to_batches()

    return combine


def event_store(signals: DataFrame, keys: list[str], gap_hours: int = DEFAULTS.session_gap_hours, valid_days: int = DEFAULTS.event_valid_days, late_hours: int | None = None, ts: str = "ts", severity: str = "severity") -> DataFrame:
    """A stream of ``store.decisions`` over a stream of signals. ``late_hours``: how long events that are over are kept for late signals; the validity if not given."""
    slices = store.sliced(signals, keys, ts, severity)
    slices = slices.mapInArrow(_combined(keys), slices.schema)
    late = 24 * valid_days if late_hours is None else late_hours
    one = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})  # a null in a key column isn't found again in the state
    return slices.withColumn("_group", one).groupBy("_group").transformWithStateInPandas(EventStore(keys, gap_hours, valid_days, late), f"{store.types_of(slices, keys)}, {store.DECISION}", "Append", "ProcessingTime")


def candidates_stream(signals: DataFrame, events: DataFrame, keys: list[str], ts: str = "ts", valid_days: int = DEFAULTS.event_valid_days, lateness: str = "0 seconds") -> DataFrame:
    """``events.candidates`` of two streams, whose events are open for ``valid_days`` at most; state is dropped behind the watermarks."""
    known = events.withColumnsRenamed({k: f"_{k}" for k in keys}).withWatermark("validFrom", lateness)
    within = [F.col("validFrom") < F.col(ts), F.col(ts) <= F.col("validFrom") + F.expr(f"interval {valid_days} days")]
    joined = signals.withWatermark(ts, lateness).join(known, [*(F.col(k) == F.col(f"_{k}") for k in keys), *within])
    return joined.where(F.col("validTo").isNull() | (F.col(ts) <= F.col("validTo"))).drop(*(f"_{k}" for k in keys))
