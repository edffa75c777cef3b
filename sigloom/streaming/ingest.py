"""The streaming form: pages -> first-seen signals with a TTL -> idempotent sinks.

Pages come from the REST source or from files. Both keep the delivery order, (page, pos); broken pages
are a stream of their own, for a table that someone looks at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from ..operators import ingest, validate
from ..settings import DEFAULTS
from ..sources import tables

#: transformWithState needs the RocksDB store; without the second setting availableNow doesn't end in processing time.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def page_files(spark: SparkSession, path: str, files_per_batch: int = DEFAULTS.max_pages_per_poll) -> DataFrame:
    """Page files as a stream of (page, body); the number in a file's name is the page's. The files per batch are the page cap."""
    files = spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("wholetext", True).text(path)
    return files.select(F.regexp_extract(F.input_file_name(), r"(\d+)[^/\d]*$", 1).try_cast("long").alias("page"), F.col("value").alias("body"))


def signals(pages: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """(signals in delivery order, broken pages) of a stream of pages; records from a page's ``stop`` on are left out."""
    good, broken = ingest.parse_pages(pages, schema)
    place = [c for c in ("poll", "stop") if c in pages.columns]
    rows = good.select(*place, "page", F.posexplode(F.arrays_zip("alerts", "payloads")).alias("pos", "s"))
    if "stop" in place:
        rows = rows.where("stop is null or pos < stop").drop("stop")
    return rows.select("*", "s.alerts.*", F.col("s.payloads").alias("payload")).drop("s"), broken


def checked_signals(pages: DataFrame, schema: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signals in delivery order, rejected records with their reasons, broken pages): ``signals`` with every record held against the model."""
    found, rejected, broken = validate.records(pages, schema)
    within = "stop is null or pos < stop"
    if "stop" in pages.columns:
        found, rejected = (rows.where(within).drop("stop") for rows in (found, rejected))
    return found, rejected, broken


def read_pages(spark: SparkSession, path: str, schema: str, files_per_batch: int = DEFAULTS.max_pages_per_poll) -> DataFrame:
    """Page files as a stream of signals."""
    return signals(page_files(spark, path, files_per_batch), schema)[0]


#: The keys are dealt to so many groups, each with its keys as state: a group costs a call or two, however many keys a batch brings.
GROUPS = 4096


class FirstSeen(StatefulProcessor):
    """Emits each key's first row in delivery order and remembers the key for a while after that first sight; repeats don't extend it.

    A group holds many keys. Its state is a list with an entry per batch, the lines of which are the keys that came with that batch, so it
    is read and written by the batch and rows go out by the frame, not one by one.
    """

    def __init__(self, columns: list[str], ttl_hours: float):
        self.columns, self.ttl = columns, int(ttl_hours * 3_600_000)
        self.order = [c for c in ("poll", "page", "pos") if c in columns]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getListState("seen", "keys string", ttlDurationMs=self.ttl)

    def _firsts(self, rows: pd.DataFrame) -> pd.DataFrame:
        return (rows.sort_values(self.order, kind="stable") if self.order else rows).drop_duplicates("seen_key")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N803
        first = None
        for frame in rows:
            if len(frame):
                first = self._firsts(frame if first is None else pd.concat([first, frame]))
        if first is None:
            return
        if self.seen.exists():
            known = {k for (keys,) in self.seen.get() for k in keys.split("\n")}
            first = first[~first["seen_key"].isin(known)]
        if len(first):
            self.seen.appendValue(("\n".join(first["seen_key"]),))
            yield first[self.columns]

    def close(self) -> None:
        pass


def first_seen_stream(signals: DataFrame, key: str = "alertId", ttl_hours: float = DEFAULTS.dedup_ttl_hours, groups: int = GROUPS) -> DataFrame:
    """A stream with the first row of each key. ``groups`` can't change while a checkpoint is in use."""
    one = F.to_json(F.struct(key), {"ignoreNullFields": "false"})  # a line of text for keys of any type; a null is a key too
    dealt = signals.withColumns({"seen_key": one, "_group": F.pmod(F.xxhash64(one), F.lit(groups))})
    return dealt.groupBy("_group").transformWithStateInPandas(FirstSeen(signals.columns, ttl_hours), signals.schema, "Append", "ProcessingTime")


def sessions_stream(signals: DataFrame, keys: list[str], gap_hours: int = DEFAULTS.session_gap_hours, ts: str = "ts", lateness: str = "0 seconds") -> DataFrame:
    """Events by session window, emitted once the watermark has passed their gap; equals the batch form."""
    return (
        signals.withWatermark(ts, lateness)
        .groupBy(*keys, F.session_window(ts, f"{gap_hours} hours").alias("w"))
        .agg(F.count("*").alias("n_signals"), F.max("severity").alias("max_severity"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
        .drop("w")
    )


def run_once(stream: DataFrame, path: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df, timeout: int = 300) -> None:
    """Everything available now, into a table that replays don't change. Raises if it doesn't end in time."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        tables.append_once(prepare(batch), path, batch_id)

    finish(stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(), timeout)


def poll(stream: DataFrame, path: str, checkpoint: str, seconds: int = DEFAULTS.poll_interval_seconds) -> StreamingQuery:
    """The periodic form: a micro-batch every ``seconds``; a restart goes on from the checkpoint."""
    return stream.writeStream.foreachBatch(lambda batch, i: tables.append_once(batch, path, i)).option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()


def finish(query: StreamingQuery, timeout: int) -> None:
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"the stream was still running after {timeout} s")
