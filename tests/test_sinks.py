"""The remote sink against a service that fails at times, and the versioned table against plain Python."""

import json
import random
import re
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from sigloom.sources import scratch
from sigloom.sources.sink import GraphQLRows, Rows, mutation
from sigloom.sources.versions import VersionedTable
from sigloom.streaming import ingest as st


class Service(BaseHTTPRequestHandler):
    """Keeps what it is sent; heeds the rows' own keys if ``heeds``; fails when ``fails`` says so."""

    rows: dict = {}
    arrivals: list = []
    headers_seen: set = set()
    heeds = True
    fails = staticmethod(lambda keys: False)
    lock = threading.Lock()

    def do_POST(self):  # noqa: N802
        sent = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        given = sent["variables"]
        with self.lock:
            self.headers_seen.add(self.headers.get("X-Own"))
            inputs = [(given.get(f"k{i[1:]}"), given[i]) for i in given if i[0] == "i"]
            keys = [x["clientMutationId"] for _, x in inputs]
            if self.fails(keys):
                self.send_response(500)
                self.end_headers()
                return
            assert len(re.findall(r"r\d+: \w+\(", sent["query"])) == len(inputs)
            for own, (changed, values) in zip(keys, inputs, strict=True):
                self.arrivals.append(own)
                values = {k: v for k, v in values.items() if k != "clientMutationId"}
                if changed is not None:
                    self.rows[changed] = self.rows.get(changed, {}) | values
                elif own not in self.rows or not self.heeds:
                    self.rows[own] = values
        body = json.dumps({"data": {f"r{i}": {"id": k} for i, k in enumerate(keys)}}).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


@pytest.fixture
def service():
    Service.rows, Service.arrivals, Service.headers_seen, Service.fails, Service.heeds = {}, [], set(), staticmethod(lambda keys: False), True
    server = ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def options(url, tmp_path, **more):
    return {"url": url, "operation": "createSignal", "key": "id", "batch": "3", "ledger": f"file://{tmp_path}/ledger", "waitScale": "0", "header.X-Own": "yes"} | more


def start(spark, folder, schema, opts, checkpoint):
    rows = spark.readStream.schema(schema).parquet(folder)
    return rows.writeStream.format("graphql_rows").options(**opts).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


@pytest.mark.parametrize("heeds", [True, False])
def test_failing_batch_is_repeated(spark, service, tmp_path, heeds):
    """One request of a batch fails for good; the batch comes again after a restart, and every row takes effect once."""
    spark.dataSource.register(GraphQLRows)
    folder, check = f"file://{tmp_path}/in", f"file://{tmp_path}/check"
    rows = spark.range(40).selectExpr("concat('s', id) as id", "if(id % 3 = 0, null, concat('t', id)) as title", "timestamp_seconds(id) as at", "array(named_struct('n', id)) as parts").repartition(4)
    rows.write.parquet(folder)
    Service.heeds = heeds
    Service.fails = staticmethod(lambda keys: "s17" in keys)
    query = start(spark, folder, rows.schema, options(service, tmp_path), check)
    with pytest.raises(Exception, match=r"500|WRITE|Python|failed"):
        query.awaitTermination(200)
    assert "s17" not in Service.rows and len(Service.rows) > 0
    Service.fails = staticmethod(lambda keys: False)
    st.finish(start(spark, folder, rows.schema, options(service, tmp_path), check), 200)
    assert {k: v["title"] for k, v in Service.rows.items()} == {f"s{i}": None if i % 3 == 0 else f"t{i}" for i in range(40)}
    assert Service.rows["s5"]["parts"] == [{"n": 5}] and Service.rows["s5"]["at"].startswith("1970-01-01T00:00:05")
    assert sorted(Service.arrivals) == sorted(set(Service.arrivals))  # no row was sent twice
    assert Service.headers_seen <= {"yes", None}
    before = len(Service.arrivals)
    st.finish(start(spark, folder, rows.schema, options(service, tmp_path), check), 200)  # nothing new
    assert len(Service.arrivals) == before
    assert not list((tmp_path / "ledger").glob("batch-*"))


def test_batch_and_partial_updates(spark, service, tmp_path):
    spark.dataSource.register(GraphQLRows)
    made = spark.createDataFrame([(f"e{i}", f"title {i}", i / 5, ["FL"]) for i in range(7)], "id string, title string, rank double, types array<string>")
    made.write.format("graphql_rows").options(**options(service, tmp_path, operation="createEvent")).mode("append").save()
    changes = spark.createDataFrame([("e1", None, 0.9, None), ("e2", "late", None, ["CE", "FR"])], made.schema)
    changes.write.format("graphql_rows").options(**options(service, tmp_path, operation="updateEvent")).mode("append").save()
    assert Service.rows["e1"] == {"id": "e1", "title": "title 1", "rank": 0.9, "types": ["FL"]}
    assert Service.rows["e2"] == {"id": "e2", "title": "late", "rank": 0.4, "types": ["CE", "FR"]}
    assert len(Service.rows) == 7


def test_requests(spark):
    assert mutation("createAlert", 2) == "mutation($i0: CreateAlertInput!, $i1: CreateAlertInput!) { r0: createAlert(input: $i0) { id } r1: createAlert(input: $i1) { id } }"
    assert mutation("updateEvent", 1) == "mutation($k0: String!, $i0: UpdateEventInput!) { r0: updateEvent(id: $k0, input: $i0) { id } }"
    schema = spark.range(1).schema
    for wrong in ({"operation": "dropAll", "key": "id"}, {"operation": "createAlert", "key": "x"}, {"operation": "createAlert"}):
        with pytest.raises(ValueError, match="must be"):
            Rows(wrong, schema)


def test_versions_against_plain_python(spark):
    """50 versions, some twice: what is read, and how many files a read opens."""
    rng = random.Random(3)
    events, want = VersionedTable(spark, scratch.new_folder(spark, "versions"), "id", most=4, buckets=2), {}
    assert events.read() is None
    for version in range(50):
        rows = {f"e{rng.randint(0, 30)}": (rng.choice([None, f"t{version}"]), rng.choice([None, version])) for _ in range(5)}
        for key, values in rows.items():
            old = want.get(key, (None, None))
            want[key] = tuple(n if n is not None else o for n, o in zip(values, old, strict=True))
        frame = spark.createDataFrame([(k, *v) for k, v in rows.items()], "id string, title string, rank int")
        for _ in range(2 if version % 7 == 0 else 1):
            events.update(frame, version)
        assert len(events.folders()) <= 4
        if version % 10 == 9:
            assert {r.id: (r.title, r.rank) for r in events.read().collect()} == want
    assert len(events.read().inputFiles()) <= 4 * 2


def test_broken_merge_changes_nothing(spark, monkeypatch):
    events = VersionedTable(spark, scratch.new_folder(spark, "versions"), "id", most=100)
    for version in range(5):
        events.update(spark.createDataFrame([("a", version), ("b", None)], "id string, n int"), version)
    before = sorted(map(tuple, events.read().collect()))
    held = events.read()

    def fail(folders):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as m:
        m.setattr(events, "_commit", fail)
        with pytest.raises(RuntimeError, match="gone"):
            events.merge()
    again = VersionedTable(spark, events.path, "id", most=100)
    assert sorted(map(tuple, again.read().collect())) == before and len(again.folders()) == 5
    again.merge()
    assert len(again.folders()) == 1 and sorted(map(tuple, held.collect())) == before  # a reader that began before the merge
    again.update(spark.createDataFrame([("a", 77)], "id string, n int"), 3)  # a version that is merged already
    again.update(spark.createDataFrame([("c", 1, "new")], "id string, n int, more string"), 9)
    assert sorted(map(tuple, again.read().select("id", "n", "more").collect())) == [("a", 4, None), ("b", None, None), ("c", 1, "new")]
    again.update(spark.createDataFrame([("c", 2, None)], "id string, n int, more string"), 9)  # the same batch again
    assert {r.id: r.n for r in again.read().collect()}["c"] == 2
    orphans = {s.getPath().getName() for s in again._fs.listStatus(again._of("")) if s.getPath().getName().startswith("d-")}
    assert len(orphans) <= 4


def test_ledger_is_read_by_any_task(spark, tmp_path):
    rows = Rows({"operation": "createAlert", "key": "id", "ledger": f"file://{tmp_path}/l"}, spark.range(1).schema)
    rows._note("4", ["a", "b"])
    rows._note("4", ["c"])
    rows._note("5", ["z"])
    assert rows._through("4") == {"a", "b", "c"}
    rows.forget("4")
    assert rows._through("4") == set() and rows._through("5") == {"z"}
