"""The REST source, the GraphQL executor and the tables, against stubs in this process."""

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from sigloom.sources import graphql, rest, tables


class Stub(BaseHTTPRequestHandler):
    script: dict = {}
    seen: list = []

    def _answer(self):
        self.seen.append((self.command, self.path, self.headers.get("Authorization")))
        queue = self.script[self.path.split("?")[0] if self.path not in self.script else self.path]
        status, body, headers = queue.pop(0) if len(queue) > 1 else queue[0]
        self.rfile.read(int(self.headers.get("Content-Length") or 0))
        self.send_response(status)
        for k, v in headers.items():
            self.send_header(k, v)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    do_GET = do_POST = _answer  # noqa: N815

    def log_message(self, *args):
        pass


@pytest.fixture
def stub():
    Stub.script, Stub.seen = {}, []
    server = ThreadingHTTPServer(("127.0.0.1", 0), Stub)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def page(ids, following):
    return (200, {"alerts": [{"alertId": i, "alertTimestamp": "2024-01-01T00:00:00Z"} for i in ids], "nextPage": following}, {})


def test_pages_token_refresh_and_wait(stub):
    Stub.script = {
        "/login": [(200, {"access_token": "t0"}, {}), (200, {"dmaToken": "t1", "access_token": "no"}, {})],
        "/api/alerts": [(401, {}, {}), (429, {}, {"Retry-After": "3"}), page(["a"], "/v2?c=1")],
        "/api/v2?c=1": [page([], "cursor")],
        "/api/alerts?nextPage=cursor": [page(["b"], None)],
    }
    waits = []
    client = rest.Client({"url": f"{stub}/api/alerts", "authurl": f"{stub}/login", "user": "u", "password": "p"}, sleep=waits.append)
    got = [(n, [a["alertId"] for a in json.loads(body)["alerts"]]) for n, body, _ in client.pages()]
    assert got == [(1, ["a"]), (2, []), (3, ["b"])]
    assert (waits, client.token) == ([3.0], "t1")


def test_page_cap(stub):
    Stub.script = {"/api/alerts": [page(["a"], "x")], "/api/alerts?nextPage=x": [page(["a"], "x")]}
    assert len(list(rest.Client({"url": f"{stub}/api/alerts", "requests": "100"}).pages())) == 50
    assert len(list(rest.Client({"url": f"{stub}/api/alerts", "maxpages": "51", "requests": "100"}).pages())) == 51


def test_data_source(spark, stub):
    Stub.script = {"/api/alerts": [page(["a", "b"], None)]}
    spark.dataSource.register(rest.SignalPages)
    rows = spark.read.format("signal_pages").option("url", f"{stub}/api/alerts").load().collect()
    assert [r.page for r in rows] == [1]


def test_rate_limiter():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    limiter = rest.RateLimiter(2, 60, lambda: now[0], sleep)
    for _ in range(5):
        limiter.acquire()
    assert slept == [60.0, 60.0]


def record(i, at):
    return {"alertId": i, "alertTimestamp": at}


def test_scan_stops_at_the_first_old_record(stub):
    """By the instant, not by the text; records without a time stop nothing."""
    Stub.script = {
        "/api/alerts": [(200, {"alerts": [record("a", "2024-01-03T01:00:00+03:00"), record("b", "junk"), record("c", None)], "nextPage": "x"}, {})],
        "/api/alerts?nextPage=x": [(200, {"alerts": [record("d", "2024-01-02T23:30:00Z"), record("e", "2024-01-02T23:00:00+02:00"), record("f", "2024-01-09T00:00:00Z")], "nextPage": "y"}, {})],
    }
    client = rest.Client({"url": f"{stub}/api/alerts"})
    assert [(n, stop) for n, _, stop in client.pages("2024-01-02T21:30:00Z")] == [(1, None), (2, 1)]
    assert rest.newest([body for _, body, _ in client.pages("2024-01-02T21:30:00Z")]) == "2024-01-09T00:00:00Z"


def test_stream_offsets_and_replay(stub, tmp_path):
    """A poll that is repeated has the pages that it had; the next one starts from the newest timestamp."""
    options = {"url": f"{stub}/api/alerts", "spool": str(tmp_path / "spool"), "since": "2024-01-01T00:00:00Z"}
    Stub.script = {"/api/alerts": [(200, {"alerts": [record("a", "2024-01-05T00:00:00Z"), record("b", "2024-01-04T00:00:00Z")], "nextPage": None}, {}), (200, {"alerts": [record("c", "2024-01-06T00:00:00Z"), record("a", "2024-01-05T00:00:00Z"), record("b", "2024-01-04T00:00:00Z")], "nextPage": "old"}, {})]}
    reader = rest.PagesStreamReader(options)
    start = reader.initialOffset()
    rows, end = reader.read(start)
    first = list(rows)
    assert end == {"poll": 1, "since": "2024-01-05T00:00:00Z", "capped": False}
    assert list(rest.PagesStreamReader(options).readBetweenOffsets(start, end)) == [tuple(r) for r in first]
    again, same = rest.PagesStreamReader(options).read(start)  # failed before the offset was committed
    assert (list(again), same) == (first, end) and len(Stub.seen) == 1
    rows, after = reader.read(end)
    second = list(rows)
    assert after == {"poll": 2, "since": "2024-01-06T00:00:00Z", "capped": False}
    assert [(r[0], r[1], r[3]) for r in second] == [(1, 1, 2)]  # b is older than the newest of before: the scan stops there
    reader.commit(after)
    assert list(reader.readBetweenOffsets(end, after)) == second
    with pytest.raises(FileNotFoundError):
        list(reader.readBetweenOffsets(start, end))
    with pytest.raises(ValueError, match="spool"):
        rest.PagesStreamReader({"url": "x"})
    import datetime as dt

    since = rest.instant(rest.PagesStreamReader({"spool": "x"}).initialOffset()["since"])
    assert dt.timedelta(days=6.9) < dt.datetime.now(dt.UTC) - since < dt.timedelta(days=7.1)


def test_page_cap_is_told(stub, tmp_path):
    Stub.script = {"/api/alerts": [page(["a"], "x")], "/api/alerts?nextPage=x": [page(["a"], "x")]}
    reader = rest.PagesStreamReader({"url": f"{stub}/api/alerts", "spool": str(tmp_path), "since": "2023-01-01T00:00:00Z", "maxpages": "3"})
    assert reader.read(reader.initialOffset())[1]["capped"]


def test_resume_from_stored_signals(spark, tmp_path):
    path = f"file://{tmp_path}/signals"
    ago = rest.instant(tables.resume_since(spark, path, 3))
    import datetime as dt

    assert dt.timedelta(days=2.9) < dt.datetime.now(dt.UTC) - ago < dt.timedelta(days=3.1)
    spark.createDataFrame([("2024-01-01T05:00:00+03:00",), ("2024-01-01T04:00:00Z",), (None,)], "publishedAt string").write.parquet(path)
    assert tables.resume_since(spark, path) == "2024-01-01T04:00:00+00:00"


def test_graphql(stub):
    Stub.script = {"/q": [(500, {}, {}), (200, {"errors": [{"message": "no"}]}, {}), (200, {"data": {"id": "1"}}, {})]}
    waits = []
    assert graphql.insert_rows(graphql.Executor(f"{stub}/q", sleep=waits.append), "mutation", [{"a": 1}]) == [{"id": "1"}]
    assert waits == [2.0, 4.0]
    for errors in (["x"], [], None):  # the key alone is a failure
        Stub.script = {"/q": [(200, {"errors": errors, "data": {}}, {})]}
        with pytest.raises(graphql.GraphQLError):
            graphql.Executor(f"{stub}/q", sleep=waits.append).execute("q")


def test_tables(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    assert tables.read_or_empty(spark, path, "id string").count() == 0
    rows = spark.createDataFrame([("a",), ("b",)], "id string")
    tables.append_new(rows, path, "id")
    tables.append_new(rows.unionByName(spark.createDataFrame([("c",), ("c",)], "id string")), path, "id")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == ["a", "b", "c"]


def test_broken_append_is_repeated(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id string")
    tables.append_new(rows("a"), path, "id", batch_id=0)
    rows("b").write.parquet(f"{path}/batch=1")  # half of a batch, from an attempt that broke off
    for _ in range(2):
        tables.append_new(rows("a", "b", "c", "c"), path, "id", batch_id=1)
        assert sorted((r.id, r.batch) for r in spark.read.parquet(path).collect()) == [("a", 0), ("b", 1), ("c", 1)]


def login_stub(answers):
    Stub.script = {"/login": [(200, {"token": "t"}, {})], "/api/alerts": answers}


def test_limit_holds_over_polls_and_logins(stub, tmp_path, monkeypatch):
    """Four polls of a source within a minute, a restart in between: never more than the limit in any window, logins included; one login."""
    login_stub([(200, {"alerts": [record(str(i), "2024-01-05T00:00:00Z") for i in range(3)], "nextPage": "x"}, {})])
    Stub.script["/api/alerts?nextPage=x"] = [(200, {"alerts": [], "nextPage": "x"}, {})]
    options = {"url": f"{stub}/api/alerts", "authurl": f"{stub}/login", "auth.grant_type": "api_key", "auth.client_id": "me", "auth.client_secret": "s", "spool": f"file://{tmp_path}/spool", "since": "2024-01-01T00:00:00Z", "maxpages": "6", "requests": "10", "window": "2"}
    times, acquire = [], rest.RateLimiter.acquire
    monkeypatch.setattr(rest.RateLimiter, "acquire", lambda self: (acquire(self), times.append(self.clock()))[0])
    reader, offset = rest.PagesStreamReader(options), None
    offset = reader.initialOffset()
    for poll in range(4):
        if poll == 2:
            reader = rest.PagesStreamReader(options)  # a new driver
        _, offset = reader.read(offset)
        reader.commit(offset)
    assert [c for c, p, _ in Stub.seen].count("POST") == 2 and len(Stub.seen) == 26 == len(times)
    assert all(sum(t <= u < t + 1.99 for u in times) <= 10 for t in times)


def test_token_has_a_life(stub):
    login_stub([page(["a"], None)])
    now = [0.0]
    limiter = rest.RateLimiter(100, 60, lambda: now[0])
    client = rest.Client({"url": f"{stub}/api/alerts", "authurl": f"{stub}/login", "auth.client_id": "me"}, limiter)
    for at, logins in ((0, 1), (12_599, 1), (12_600, 2)):
        now[0] = float(at)
        list(client.pages())
        assert [c for c, _, _ in Stub.seen].count("POST") == logins
    assert client.credentials == {"client_id": "me"}


FORMS = """2025-W44-3 2025W443 2025-W44 2025W44T10 20251029T174845Z 2025-10-29_17:48Z 2025-10-29T17 2025-10-29T1748 2025-10-29T17:4845 2025-10-29T17:48:45.1234567+01:00 2025-10-29T17:48:45,5
2025-10-29T17:48:45+0100 2025-10-29T17:48:45+01 2025-10-29T17:48:45+01:00:30 2025-10-29T17:48:45+05:75 2025-10-29T24:00:00 2025-302 20251029174845 2025-10-29+01:00 0000-01-01 0000-01-01T00:00:00Z 2025-W53-1 2026-W53-1
2026-W53-7 2025-W44-0 2025-W44-8 2025-W00-1 2025-10-29x17:48:60 2025-10-29T17:48:45. 2025-10-29T 2025-10-29T17:48:45+24:00 2025-10-29T17:48:45-23:59 2025-10-29T17:48:45-00:00 2025-10-29T17:48:45z 2025-10 20251029T1748 2025-10-29T174845.5
2025-10-29é17:48 2025-10-29T17:48:45+0100:30 2025-W01-1 2024-W01-1 2021-W01-1 2020-W53-7 2025-02-29 2024-02-29T00:00:00Z 2025-13-01 2025-10-29T17:61Z 2025-10-29T17:48:45.25-0330 junk 2025-10-29T17:48:45.123456Z 2025 T10:00 2025-10-29T17:48:45+18:30 1969-12-31T23:59:59.999999Z""".split() + ["", " 2025-10-29", "2025-10-29 ", "2025-10-29 17:48:45", "2025-10-29\n17:48"]


def test_engine_and_reader_agree_with_python(spark):
    import datetime as dt

    from sigloom.functions import scalar

    def python(text):
        try:
            found = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
        except ValueError:
            return None
        return (found if found.tzinfo else found.replace(tzinfo=dt.UTC)).astimezone(dt.UTC)

    rows = spark.createDataFrame([(i, t) for i, t in enumerate(FORMS)] + [(-1, None)], "i int, t string")
    us = {r.i: r.us for r in rows.selectExpr("i", "t").withColumn("us", __import__("pyspark.sql.functions", fromlist=["x"]).unix_micros(scalar.parse_timestamp(rows.t))).collect()}
    assert us.pop(-1) is None
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.UTC)
    for i, text in enumerate(FORMS):
        want = python(text)
        assert (rest.instant(text) is None) == (want is None) and (want is None or rest.instant(text) == want), text
        assert us[i] == (None if want is None else (want - epoch) // dt.timedelta(microseconds=1)), text


def feeds(stub, tmp_path, **more):
    return {"feeds": " ".join(f"{stub}/api/f{i}" for i in range(3)), "spool": f"file://{tmp_path}/spool", "since": "2024-01-01T00:00:00Z", "requests": "30"} | more


def test_feeds_are_read_by_tasks(spark, stub, tmp_path):
    """Three feeds in three partitions; a failed batch is repeated as it was, a restart goes on where each feed was."""
    from sigloom.streaming import ingest as st

    spark.dataSource.register(rest.FeedPages)
    Stub.script = {f"/api/f{i}": [(200, {"alerts": [record(f"f{i}a", f"2024-01-0{i + 2}T00:00:00Z")], "nextPage": None}, {})] for i in range(3)}
    schema = "alerts ARRAY<STRUCT<alertId: STRING, alertTimestamp: STRING>>, nextPage STRING"
    out, check = f"file://{tmp_path}/out", f"file://{tmp_path}/check"

    def run(prepare=lambda df: df):
        pages = spark.readStream.format("feed_pages").options(**feeds(stub, tmp_path)).load()
        st.run_once(st.signals(pages, schema)[0], out, check, prepare)

    def fail(batch):
        assert batch.rdd.getNumPartitions() == 3 and batch.count() == 3
        raise RuntimeError("the sink is away")

    with pytest.raises(Exception, match="the sink is away"):
        run(fail)
    seen = len(Stub.seen)
    for i in range(3):  # the service has moved on
        Stub.script[f"/api/f{i}"] = [(200, {"alerts": [record(f"f{i}b", f"2024-01-1{i}T00:00:00Z"), record(f"f{i}a", f"2024-01-0{i + 2}T00:00:00Z"), record("old", "2024-01-01T12:00:00Z")], "nextPage": None}, {})]
    run()
    first = {r.alertId for r in spark.read.parquet(out).where("batch = 0").collect()}
    assert first == {"f0a", "f1a", "f2a"} and seen == 3
    run()
    rows = [r.alertId for r in spark.read.parquet(out).collect()]
    assert set(rows) == {f"f{i}{x}" for i in range(3) for x in "ab"}  # nothing older than where each feed was
    assert len(list((tmp_path / "spool").rglob("*.part"))) == 0


def test_feeds_share_the_limit(stub, tmp_path):
    Stub.script = {f"/api/f{i}": [page(["a"], "x")] for i in range(3)} | {f"/api/f{i}?nextPage=x": [page(["a"], "x")] for i in range(3)}
    options = feeds(stub, tmp_path, requests="6", window="1", maxpages="3")
    reader = rest.FeedsStreamReader(options)
    import time

    began = time.time()
    for poll in range(2):
        assert reader.latestOffset() == {"poll": poll + 1}
        for part in reader.partitions({"poll": poll}, {"poll": poll + 1}):
            got = list(reader.read(part))
            assert [(r[1], r[2]) for r in got] == [(poll, 1), (poll, 2), (poll, 3)]
            assert list(rest.FeedsStreamReader(options).read(part)) == [tuple(r[:3]) + tuple(r[3:]) for r in got]
        reader.commit({"poll": poll + 1})
    assert len(Stub.seen) == 18 and time.time() - began >= 2  # two requests of a feed in a second
    with pytest.raises(ValueError, match="two requests"):
        rest.FeedsStreamReader(feeds(stub, tmp_path, requests="5"))
    with pytest.raises(FileNotFoundError):
        list(reader.read(rest.FeedPartition(0, f"{stub}/api/f0", 7, 8)))
    assert reader.partitions({"poll": 2}, {"poll": 2}) == []
