"""Streams give what the batch operators give, and replays add nothing."""

import json
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sigloom.operators import events as ev
from sigloom.sources import rest
from sigloom.streaming import ingest as st
from test_sources import Stub, record, stub  # noqa: F401

PAGE = "alerts ARRAY<STRUCT<alertId: STRING, n: BIGINT>>, nextPage STRING"


def write(folder, name, ids):
    (folder / name).write_text(json.dumps({"alerts": [{"alertId": i, "n": n} for n, i in enumerate(ids)], "nextPage": None}))


def test_first_seen_across_batches_and_restart(spark, tmp_path):
    pages, out, check = tmp_path / "pages", f"file://{tmp_path}/out", f"file://{tmp_path}/check"
    pages.mkdir()
    write(pages, "1.json", ["a", "b", "a"])
    stream = lambda: st.first_seen_stream(st.read_pages(spark, str(pages), PAGE, 1))
    st.run_once(stream(), out, check)
    assert sorted(r.alertId for r in spark.read.parquet(out).collect()) == ["a", "b"]
    write(pages, "2.json", ["b", "c"])
    st.run_once(stream(), out, check)
    assert sorted(r.alertId for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]
    st.run_once(stream(), out, check)  # nothing new
    assert spark.read.parquet(out).count() == 3


def test_sessions_equal_batch(spark, sf, tmp_path):
    rows = spark.read.parquet(f"{sf}/events.parquet").select("event_type", F.col("ts").cast("timestamp").alias("ts"), F.lit(1).alias("severity"))
    folder = f"file://{tmp_path}/in"
    rows.repartitionByRange(3, "ts").write.parquet(folder)
    last = spark.createDataFrame([("end", 1)], "event_type string, severity int").withColumn("ts", F.lit("2099-01-01").cast("timestamp")).select(*rows.columns)
    last.write.mode("append").parquet(folder)  # moves the watermark on
    stream = st.sessions_stream(spark.readStream.schema(rows.schema).parquet(folder), ["event_type"], 6)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    try:
        st.run_once(stream, f"file://{tmp_path}/out", f"file://{tmp_path}/check")
    finally:
        spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    want = ev.sessions(rows, ["event_type"], 6)
    got = spark.read.parquet(f"file://{tmp_path}/out").drop("batch").where("event_type <> 'end'")
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def rest_stream(spark, url, spool):
    spark.dataSource.register(rest.SignalPages)
    pages = spark.readStream.format("signal_pages").option("url", url).option("spool", spool).option("since", "2024-01-02T00:00:00Z").option("requests", "1000").load()
    return st.signals(pages, "alerts ARRAY<STRUCT<alertId: STRING, alertTimestamp: STRING>>, nextPage STRING")


def test_broken_pages_are_a_stream(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    write(pages, "1.json", ["a", "b"])
    (pages / "2.json").write_text("{oops")
    (pages / "3.json").write_text('{"nextPage": null}')
    good, bad = st.signals(st.page_files(spark, str(pages)), PAGE)
    st.run_once(good, f"file://{tmp_path}/good", f"file://{tmp_path}/c1")
    st.run_once(bad, f"file://{tmp_path}/bad", f"file://{tmp_path}/c2")
    assert sorted((r.page, r.pos, r.alertId, r.payload) for r in spark.read.parquet(f"file://{tmp_path}/good").collect()) == [(1, 0, "a", '{"alertId":"a","n":0}'), (1, 1, "b", '{"alertId":"b","n":1}')]
    assert sorted((r.page, r.body) for r in spark.read.parquet(f"file://{tmp_path}/bad").collect()) == [(2, "{oops"), (3, '{"nextPage": null}')]


def test_first_seen_is_the_first_in_delivery_order(spark, tmp_path):
    """Pages of one batch, the earlier page in the later file."""
    pages = tmp_path / "pages"
    pages.mkdir()
    for name, ids in (("3.json", ["x", "a", "b"]), ("2.json", ["b", "c"]), ("1.json", ["c", "c", "z"])):
        (pages / name).write_text(json.dumps({"alerts": [{"alertId": i, "n": 100 * int(name[0]) + n} for n, i in enumerate(ids)]}))
    st.run_once(st.first_seen_stream(st.read_pages(spark, str(pages), PAGE)), f"file://{tmp_path}/out", f"file://{tmp_path}/check")
    assert sorted((r.alertId, r.page, r.pos, r.n) for r in spark.read.parquet(f"file://{tmp_path}/out").collect()) == [("a", 3, 1, 301), ("b", 2, 0, 200), ("c", 1, 0, 100), ("x", 3, 0, 300), ("z", 1, 2, 102)]


def test_first_seen_ttl(spark, tmp_path):
    pages, out, check = tmp_path / "pages", f"file://{tmp_path}/out", f"file://{tmp_path}/check"
    pages.mkdir()
    write(pages, "1.json", ["a"])
    stream = lambda: st.first_seen_stream(st.read_pages(spark, str(pages), PAGE, 1), ttl_hours=3 / 3600)
    st.run_once(stream(), out, check)
    time.sleep(4)
    write(pages, "2.json", ["a"])
    st.run_once(stream(), out, check)
    assert spark.read.parquet(out).count() == 2  # forgotten by then


def test_rest_stream_goes_on_where_it_was(spark, stub, tmp_path):  # noqa: F811
    out, check, spool = f"file://{tmp_path}/out", f"file://{tmp_path}/check", str(tmp_path / "spool")
    Stub.script = {"/api/alerts": [(200, {"alerts": [record("b", "2024-01-03T00:00:00Z"), record("a", "2024-01-02T00:00:00Z"), record("old", "2024-01-01T00:00:00Z"), record("late", "2024-01-09T00:00:00Z")], "nextPage": "y"}, {})]}
    signals, _ = rest_stream(spark, f"{stub}/api/alerts", spool)
    st.run_once(st.first_seen_stream(signals), out, check)
    assert sorted(r.alertId for r in spark.read.parquet(out).collect()) == ["a", "b"]  # the scan stopped at the old one
    assert len(Stub.seen) >= 1
    Stub.script = {"/api/alerts": [(200, {"alerts": [record("d", "2024-01-09T00:00:00Z"), record("b", "2024-01-03T00:00:00Z")], "nextPage": None}, {})]}
    signals, _ = rest_stream(spark, f"{stub}/api/alerts", spool)
    st.run_once(st.first_seen_stream(signals), out, check)
    assert sorted(r.alertId for r in spark.read.parquet(out).collect()) == ["a", "b", "d"]


def test_failing_batch_is_repeated_as_it_was(spark, stub, tmp_path):  # noqa: F811
    """The sink fails once, the service has moved on: the same records come again, once."""
    out, check, spool = f"file://{tmp_path}/out", f"file://{tmp_path}/check", str(tmp_path / "spool")
    Stub.script = {"/api/alerts": [(200, {"alerts": [record("a", "2024-01-03T00:00:00Z")], "nextPage": None}, {})]}

    def fail(batch):
        raise RuntimeError("the sink is away")

    signals, _ = rest_stream(spark, f"{stub}/api/alerts", spool)
    with pytest.raises(Exception, match="the sink is away"):
        st.run_once(signals, out, check, fail)
    Stub.script = {"/api/alerts": [(200, {"alerts": [record("z", "2024-01-04T00:00:00Z")], "nextPage": None}, {})]}
    signals, _ = rest_stream(spark, f"{stub}/api/alerts", spool)
    st.run_once(signals, out, check)
    st.run_once(rest_stream(spark, f"{stub}/api/alerts", spool)[0], out, check)
    assert {"a", "z"} == {r.alertId for r in spark.read.parquet(out).collect()}
    assert spark.read.parquet(out).where("alertId = 'a'").count() == 1


def test_poll(spark, stub, tmp_path):  # noqa: F811
    Stub.script = {"/api/alerts": [(200, {"alerts": [record("a", "2024-01-03T00:00:00Z")], "nextPage": None}, {})]}
    signals, _ = rest_stream(spark, f"{stub}/api/alerts", str(tmp_path / "spool"))
    query = st.poll(st.first_seen_stream(signals), f"file://{tmp_path}/out", f"file://{tmp_path}/check", seconds=1)
    try:
        for _ in range(60):
            time.sleep(1)
            if len(Stub.seen) >= 3:
                break
    finally:
        query.stop()
    assert len(Stub.seen) >= 3
    assert [r.alertId for r in spark.read.parquet(f"file://{tmp_path}/out").collect()] == ["a"]


class Handle:
    """A state handle that counts the calls to its one list."""

    def __init__(self):
        self.held, self.calls = [], 0

    def getListState(self, name, schema, ttlDurationMs=None):  # noqa: N802, N803, ARG002
        return self

    def exists(self):
        self.calls += 1
        return bool(self.held)

    def get(self):
        self.calls += 1
        return iter(self.held)

    def appendValue(self, value):  # noqa: N802
        self.calls += 1
        self.held.append(value)


def test_first_seen_asks_the_state_by_the_group():
    """A few calls and one frame for the many keys of a batch; with a call and a frame per key millions of keys don't end in time."""
    processor, handle = st.FirstSeen(["alertId", "page", "pos"], 48), Handle()
    processor.init(handle)
    frame = lambda ids, page: pd.DataFrame({"alertId": ids, "page": page, "pos": range(len(ids)), "seen_key": [json.dumps({"alertId": i}) for i in ids]})
    ids = [f"a{i}\n" for i in range(2000)] + [None]
    out = list(processor.handleInputRows((7,), iter([frame(ids[1000:], 2), frame(ids, 1), frame(ids[:0], 1)]), None))
    assert len(out) == 1 and list(out[0].columns) == ["alertId", "page", "pos"] and len(out[0]) == 2001 and set(out[0]["page"]) == {1}
    again = list(processor.handleInputRows((7,), iter([frame([*ids, "new"], 3)]), None))
    assert [list(f["alertId"]) for f in again] == [["new"]]
    assert not list(processor.handleInputRows((7,), iter([frame(ids, 4)]), None))
    assert handle.calls <= 9
