"""From delivered pages to draft alerts as two streams with tables between.

The first keeps a record the first time it comes and stores it. The second reads the stored signals, scores them,
drops those that aren't relevant, lets the store of open events decide where they go, and keeps
decisions, events and alerts. Every table is keyed by batch, by event and version, or by event, so a repeated batch changes
nothing; a restart goes on from the checkpoints.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import events as ev
from ..operators import store
from ..settings import DEFAULTS
from ..sources import tables
from ..sources.versions import VersionedTable
from . import events as se
from . import ingest

Score = Callable[[DataFrame], DataFrame]


@dataclass
class Chain:
    """Tables and checkpoints below ``root``. ``score`` adds relevance, severity and ``keys``, the type and place of a signal, to stored signals."""

    spark: SparkSession
    root: str
    schema: StructType
    score: Score
    keys: tuple[str, ...] = ("type", "location")
    ts: str = "ts"
    gap_hours: int = DEFAULTS.session_gap_hours
    valid_days: int = DEFAULTS.event_valid_days
    threshold: float = DEFAULTS.relevance_threshold
    severity: int = DEFAULTS.severity_threshold

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def ingest(self, signals: DataFrame, key: str = "alertId", timeout: int = 600) -> None:
        """Everything that is available: each record once, as it first came, into the table ``signals``."""
        ingest.run_once(ingest.first_seen_stream(signals, key), self.path("signals"), self.path("checkpoint-signals"), timeout=timeout)

    def process(self, timeout: int = 600) -> None:
        """All stored signals that weren't processed yet."""
        stored = self.spark.readStream.schema(self.schema).parquet(self.path("signals"))
        relevant = ev.relevant(self.score(stored), self.threshold)
        decided = se.event_store(relevant, list(self.keys), self.gap_hours, self.valid_days, ts=self.ts)
        query = decided.writeStream.foreachBatch(self._keep).option("checkpointLocation", self.path("checkpoint-events")).trigger(availableNow=True).start()
        ingest.finish(query, timeout)

    def _keep(self, batch: DataFrame, batch_id: int) -> None:
        keys = list(self.keys)
        tables.append_once(batch, self.path("decisions"), batch_id)
        every = self.spark.read.parquet(self.path("decisions")).drop("batch")
        touched = self.spark.read.parquet(f"{self.path('decisions')}/batch={batch_id}").select(*keys, "began").distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in (*keys, "began")]
        own = every.join(touched.withColumnsRenamed({k: f"_{k}" for k in (*keys, "began")}), same, "left_semi")
        events = store.event_rows(own, keys, self.valid_days)
        VersionedTable(self.spark, self.path("events"), "event_id").update(events, batch_id)
        alerts = ev.assess(events, self.severity).where("should_alert").select("event_id", "status")
        tables.append_new(alerts, self.path("alerts"), "event_id", batch_id)

    def events(self) -> DataFrame:
        return VersionedTable(self.spark, self.path("events"), "event_id").read()
