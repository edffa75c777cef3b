"""Edge cases worked out by hand, and properties."""

import random

import pytest
from pyspark.sql import functions as F

from sigloom import schemas
from sigloom.functions import scalar
from sigloom.operators import events as ev
from sigloom.operators import geo, ingest
from sigloom.plans import catalog
from sigloom.settings import Settings


def value(spark, column, **given):
    row = spark.range(1).select(*(F.lit(v).alias(k) if not hasattr(v, "_jc") else v.alias(k) for k, v in given.items())) if given else spark.range(1)
    return row.select(column.alias("v")).first()["v"]


def delivered(spark, rows):
    return spark.createDataFrame(rows, "page long, pos long, alertId string, alertTimestamp string")


def test_take_while_stops_for_good(spark):
    rows = [(1, 0, "a", "2024-01-03T00:00:00Z"), (1, 1, "b", "junk"), (1, 2, "c", "2024-01-02T00:00:00Z"), (1, 3, "d", "2024-01-01T23:59:59Z"), (1, 4, "e", "2024-01-03T00:00:00Z"), (2, 0, "f", "2024-01-04T00:00:00+02:00")]
    signals = ingest.with_timestamp(delivered(spark, rows))
    since = F.lit("2024-01-02T00:00:00Z").cast("timestamp")
    assert sorted(r.alertId for r in ingest.take_while(signals, since).collect()) == ["a", "c"]  # equal to since: kept
    assert str(ingest.high_water(signals, since).first().latest) == "2024-01-03 00:00:00"
    assert ingest.take_while(signals, F.lit("2020-01-01").cast("timestamp")).count() == 5
    assert ingest.take_while(signals.where("false"), since).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_take_while_is_a_prefix(spark, seed):
    rng = random.Random(seed)
    rows = [(i // 4, i % 4, str(i), rng.choice([f"2024-01-0{rng.randint(1, 9)}T00:00:00Z", "x"])) for i in range(20)]
    signals = ingest.with_timestamp(delivered(spark, rows))
    since = F.lit("2024-01-03").cast("timestamp")
    want, got = [], sorted(int(r.alertId) for r in ingest.take_while(signals, since).collect())
    for i, r in enumerate(rows):
        if r[3] != "x":
            if r[3] < "2024-01-03":
                break
            want.append(i)
    assert got == want
    assert got == sorted(int(r.alertId) for r in ingest.running_take_while(signals, since).collect())


def test_first_seen_is_idempotent(spark):
    rows = [(1, 0, "a", "t1"), (1, 1, "a", "t2"), (2, 0, "b", "t3"), (3, 0, "a", "t4"), (3, 1, "b", "t5")]
    once = ingest.first_seen(delivered(spark, rows))
    assert sorted(map(tuple, once.collect())) == [(1, 0, "a", "t1"), (2, 0, "b", "t3")]
    assert sorted(map(tuple, ingest.first_seen(once).collect())) == sorted(map(tuple, once.collect()))


def test_broken_pages_are_quarantined(spark):
    pages = spark.createDataFrame([(1, '{"alerts": [{"alertId": "a", "alertTimestamp": "t"}], "nextPage": "/x"}'), (2, "{oops"), (3, '{"nextPage": null}'), (4, '{"alerts": []}')], "page int, body string")
    good, bad = ingest.parse_pages(pages, schemas.page_ddl("alertUrl"))
    assert sorted(r.page for r in good.collect()) == [1, 4]
    assert sorted(r.page for r in bad.collect()) == [2, 3]
    assert ingest.flatten(good).count() == 1


@pytest.mark.parametrize(("title", "rest", "want"), [("a", "b", "a — b"), ("a", "", "a"), (None, "b", "b"), ("", "", None), (None, None, None)])
def test_description(spark, title, rest, want):
    row = spark.createDataFrame([((title, rest),)], "subHeadline struct<title: string, subHeadlines: string>")
    assert row.select(scalar.description().alias("d")).first().d == want


@pytest.mark.parametrize(("coordinates", "want"), [(None, (None, None)), ([1.0], (None, None)), ([1.0, 2.0], (1.0, 2.0)), ([1.0, 2.0, 3.0], (1.0, 2.0))])
def test_coordinates(spark, coordinates, want):
    row = spark.createDataFrame([(coordinates,)], "c array<double>").select(scalar.coordinate(F.col("c"), 0).alias("a"), scalar.coordinate(F.col("c"), 1).alias("b")).first()
    assert tuple(row) == want


def test_grid_cells_round_half_to_even(spark):
    rows = spark.createDataFrame([(x,) for x in (0.25, 0.35, 0.45, -0.04, -179.95, 12.0)], "x double")
    assert [r.c for r in rows.select(scalar.grid_cell(F.col("x")).alias("c")).collect()] == [f"{x:.1f}" for x in (0.25, 0.35, 0.45, -0.04, -179.95, 12.0)]


@pytest.mark.parametrize(("text", "want"), [("```json\n{\"a\": 1}\n```", '{"a": 1}'), ("  ```\nx\n  ```  \ny", "x\ny"), ("plain", "plain"), ("a\n```\nb", "a\n```\nb")])
def test_fence(spark, text, want):
    assert value(spark, scalar.strip_fence(F.lit(text))) == want


def test_iso_format(spark):
    assert value(spark, scalar.iso_format(F.lit("2024-12-31 23:59:59").cast("timestamp"))) == "2024-12-31T23:59:59+00:00"
    assert value(spark, scalar.iso_format(F.lit("2024-12-31 23:59:59.000250").cast("timestamp"))) == "2024-12-31T23:59:59.000250+00:00"


@pytest.mark.parametrize(("given", "want"), [(None, None), ("", None), ("https://x/y", "https://x/y"), ("/v1/a", "https://h/feed/v1/a"), ("/feed/a", "https://h/feed/a"), ("abc", "https://h/feed/alerts?nextPage=abc")])
def test_next_url(spark, given, want):
    from sigloom.sources.rest import absolute

    assert value(spark, scalar.next_url(F.lit(given).cast("string"), "https://h", "/feed", "https://h/feed/alerts")) == want
    assert absolute(given, "https://h/feed/alerts", "/feed") == want


def test_raw_context(spark):
    ddl = "publicPost struct<text: string, translatedText: string>, intelAgents array<struct<summary: array<struct<title: string, content: array<string>>>>>, eventCorroboration struct<summary: array<struct<content: string>>>, liveBrief array<struct<summary: string>>"
    rows = [(("p", ""), [([("t", ["one", "two"]), ("t", [])],), (None,)], ([("c",), ("",)],), [("b",), (None,)]), (None, None, None, None), (("x" * 2500, None), None, None, None)]
    out = [r.c for r in spark.createDataFrame(rows, ddl).select(scalar.raw_context(limit=2000).alias("c")).collect()]
    assert out[0] == "Post text: p\nIntel: one\nCorroboration: c\nBrief: b"
    assert out[1] == "(no additional context)"
    assert len(out[2]) == 2000


def test_truncation_counts_code_points(spark):
    assert value(spark, F.char_length(F.substring(F.lit("😀" * 2001), 1, 2000))) == 2000


def test_gates(spark):
    rows = spark.createDataFrame([("a", 0.49, 3, "e"), ("b", 0.5, 4, "e"), ("c", float("nan"), 9, None)], "id string, relevance double, severity int, event_id string")
    assert sorted(r.id for r in ev.relevant(rows).collect()) == ["b", "c"]
    assert [r.id for r in ev.severe(rows).collect()] == ["b"]
    assert ev.relevant(rows, 0.9).count() <= ev.relevant(rows, 0.1).count()


def test_routing(spark):
    rows = spark.createDataFrame([("add_to_existing", "e1"), ("add_to_existing", None), ("add_to_existing", ""), ("create_new", None), ("merge", "e1"), (None, None)], "action string, event_id string")
    assert [r.route for r in ev.route(rows).collect()] == ["update", "reject", "reject", "insert", "reject", "reject"]


def test_session_gap(spark):
    rows = spark.createDataFrame([("k", "2024-01-01 00:00:00"), ("k", "2024-01-02 23:59:59"), ("k", "2024-01-04 23:59:59"), ("k", "2024-01-07 00:00:00")], "key string, t string").select("key", F.col("t").cast("timestamp").alias("ts"), F.lit(1).alias("severity"))
    assert sorted(r.n_signals for r in ev.sessions(rows, ["key"]).collect()) == [1, 3]  # exactly 48 h joins
    numbered = ev.numbered_sessions(rows, ["key"]).collect()
    assert sorted(r.session for r in numbered) == [0, 0, 0, 1]


def test_alert_modes(spark):
    rows = spark.createDataFrame([("e", 5), ("e", 4)], "event_id string, severity int")
    assert ev.alerts(ev.severe(rows)).count() == 2
    assert ev.alerts(ev.severe(rows), "intended").count() == 1
    with pytest.raises(ValueError):
        ev.alerts(rows, "other")


def test_top_level_location(spark):
    schema = "id string, level int, pos long"
    assert geo.top_level(spark.createDataFrame([("a", 1, 0), ("b", 2, 1), ("c", 2, 2), ("d", None, 3)], schema)).first()[0] == "b"
    assert geo.top_level(spark.createDataFrame([], schema)).first()[0] is None


def plain_sessions(rows, gap):
    """key -> [(n, most, first, last), ...], from sorted times."""
    out = {}
    for key, at, severity in sorted((r for r in rows if r[1] is not None), key=lambda r: (str(r[0]), r[1])):
        own = out.setdefault(key, [])
        if own and at - own[-1][3] <= gap * 3600:
            n, most, first, _ = own[-1]
            own[-1] = (n + 1, max(most, severity), first, at)
        else:
            own.append((1, severity, at, at))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_sessions_against_sorted_times(spark, seed):
    rng = random.Random(seed)
    gap = rng.choice([1, 6, 48])
    rows = [(rng.choice(["a", "a", "a", None]), rng.choice([None, *[rng.randint(-10**6, 10**6) // rng.choice([1, 3600]) * rng.choice([1, 3600]) for _ in range(9)]]), rng.randint(1, 5)) for _ in range(400)]
    table = spark.createDataFrame(rows, "key string, t long, severity int").withColumn("ts", F.timestamp_seconds("t"))
    want = plain_sessions(rows, gap)
    got = {}
    for r in ev.sessions(table, ["key"], gap).selectExpr("key", "n_signals", "max_severity", "unix_seconds(first_ts) as a", "unix_seconds(last_ts) as b").collect():
        got.setdefault(r.key, []).append((r.n_signals, r.max_severity, r.a, r.b))
    assert {k: sorted(v, key=lambda x: x[2]) for k, v in got.items()} == want
    numbered = ev.numbered_sessions(table, ["key"], gap).collect()
    assert len(numbered) == len(rows)
    for r in numbered:
        number = 0 if r.t is None else next(i for i, x in enumerate(want[r.key]) if x[2] <= r.t <= x[3])
        assert r.session == number


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_task_has_all_rows_of_a_hot_key(spark):
    """One key, 20,000 rows in ten days: what crosses the shuffle is a row per slice and task, whatever the rows."""
    rows = spark.range(0, 20_000, 1, 4).selectExpr("'hot' as key", "timestamp_seconds(id * 43) as ts", "1 as severity")
    found = ev.sessions(rows, ["key"], 6)
    assert found.collect()[0].n_signals == 20_000
    text = plan(found)
    assert "SessionWindow" not in text and "partial_count" in text[text.rindex("Exchange hashpartitioning") :]
    moved = ev._slices(rows, ["key"], 6, "ts", F.count("*").alias("n")).count()
    assert moved <= 20_000 * 43 // (6 * 3600) + 2


def test_nearest_meets_few_places(spark):
    rng = random.Random(3)
    places = [(f"p{i:04}", rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(1500)]
    places += [(f"q{i}", lat, lon) for i, (lat, lon) in enumerate([(90.0, 0.0), (-90.0, 10.0), (0.0, 180.0), (0.0, -180.0), (0.0, 179.999), (45.0, 0.0), (45.0, 0.0)])]
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(300)] + [(900, 89.9, 170.0), (901, -89.99, -30.0), (902, 0.001, -179.9999), (903, 45.0, 0.0), (904, None, 1.0), (905, 1.0, None), (906, 0.0, 0.0)]
    table = spark.createDataFrame(places, "id string, lat double, lon double")
    signals = spark.createDataFrame(points, "i long, lat double, lon double")

    def km(a, b):
        import math

        x = math.sin(math.radians(b[0] - a[0]) / 2) ** 2 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
        return 6371.0 * 2 * math.atan2(math.sqrt(x), math.sqrt(max(0.0, 1 - x)))

    for given in ({}, {"few": 0}, {"level": 3}, {"level": 0}, {"level": 9}):
        got = {r.i: (r.location_id, r.distance_km) for r in geo.nearest(signals, table, **given).collect()}
        for i, lat, lon in points:
            if lat is None or lon is None:
                assert got[i] == (None, None)
                continue
            best = min(km((lat, lon), p[1:]) for p in places)
            assert abs(got[i][1] - best) < 1e-6
            if sum(abs(km((lat, lon), p[1:]) - best) < 1e-9 for p in places) == 1:
                assert km((lat, lon), next(p[1:] for p in places if p[0] == got[i][0])) == pytest.approx(best)
    assert {r.i: r.location_id for r in geo.nearest(signals, table).where("i = 903").collect()} == {903: "q5"}
    assert geo.nearest(signals, table.where("false")).where("location_id is not null").count() == 0
    assert geo.start_level(len(places)) >= 4
    most = geo._around(table, geo.start_level(len(places))).selectExpr("max(size(_places))").first()[0]
    assert most < len(places) / 10  # a signal meets the places of nine cells, not all


def test_cell_memo(spark):
    points = spark.createDataFrame([(1, 10.01, 20.01), (2, 10.04, 20.04), (3, 50.0, 60.0), (4, -5.0, 7.0), (5, None, None)], "i long, lat double, lon double")
    places = spark.createDataFrame([("a", 10.0, 20.0), ("b", 50.0, 61.0)], "id string, lat double, lon double")
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    memo = spark.createDataFrame([("50.0", "60.0", None, 1), ("-5.0", "7.0", "old", 7)], "cell_lat string, cell_lon string, location_id string, hours int").select("cell_lat", "cell_lon", "location_id", (now - F.make_interval(hours="hours")).alias("resolved_at"))
    placed, fresh = geo.resolve_cells(points, places, memo, now, ["i"])
    assert {r.i: r.location_id for r in placed.collect()} == {1: "a", 2: "a", 3: None, 4: "a", 5: None}
    assert sorted((r.cell_lat, r.location_id) for r in fresh.collect()) == [("-5.0", "a"), ("10.0", "a")]
    placed, fresh = geo.resolve_cells(points, places.where("false"), memo, now, ["i"])
    assert fresh.count() == 0 and placed.where("location_id is not null").count() == 0


def test_scorer_counts(spark):
    rows = spark.createDataFrame([("Flood and flood; FIRE! firewall", "t"), (None, None), ("a forest fire", "x")], "text string, title string")
    got = [(r.disaster_types, r.severity) for r in ev.classify(rows).collect()]
    assert got == [(["FL", "FR"], 4), ([], 1), (["FR"], 2)]
    phrases = ev.classify(rows, lexicon={"A": ("forest fire",), "B": ("fire",)}).collect()
    assert [r.disaster_types for r in phrases] == [["B"], [], ["A", "B"]]


def test_model_answers(spark):
    from sigloom.operators import model

    requests = spark.createDataFrame([(i, f"request {i}") for i in range(6)], "signal_id long, request string").repartition(2)

    def connect():
        calls = []

        def send(request):
            calls.append(request)
            n = int(request.split()[1])
            if n == 4 or n == 5 and calls.count(request) == 1 and len(calls) > 1:
                raise ConnectionError("refused")
            return {0: '{"relevance": 0.5, "severity": 3}', 1: '```json\n{"relevance": 1.0, "severity": 4}\n```', 2: "no JSON", 3: "[]", 5: '{"severity": 1}'}[n]

        return send

    rows = {r.signal_id: r for r in model.answers(requests, connect, "relevance DOUBLE, severity INT").collect()}
    assert [(rows[i].relevance, rows[i].severity, rows[i].failure) for i in (0, 1)] == [(0.5, 3, None), (1.0, 4, None)]
    assert rows[2].failure == "the answer is not the JSON that was asked for" and rows[2].severity is None
    assert rows[4].failure == "ConnectionError: refused" and rows[5].severity == 1 and rows[5].failure is None
    signals = requests.select("signal_id").withColumn("title", F.lit("t"))
    scored = model.classified(signals, requests, connect, schemas.CLASSIFICATION)
    assert scored.count() == 6 and ev.relevant(scored.where("failure is null")).where("signal_id = 1").count() == 1


def test_requests_are_json(spark):
    import json

    from sigloom.functions import prompts

    empty = spark.range(1).select(prompts.group(F.lit(None).cast("string"), F.lit(""), F.lit('a"b'), F.array().cast("array<string>"), F.lit(3), F.lit("s\n"), F.lit("t"), F.lit(None).cast("array<struct<id: string, title: string, types: array<string>, location: string, validFrom: string, validTo: string>>")).alias("r")).first().r
    found = json.loads(empty)
    assert found["task"] == "group" and found["input"]["title"] == "(no title)" and found["input"]["location"] == 'a"b' and found["input"]["types"] == "(none)" and found["input"]["events"] == []
    assert found["answer"] == schemas.GROUPING and len(found["rules"]) == 3


def test_new_event_over_the_year_end(spark):
    row = spark.createDataFrame([("s", "t", 9, [], ["FL"])], "signal_id string, title string, severity int, event_types array<string>, disaster_types array<string>").withColumn("ts", F.lit("2024-12-28 10:00:00").cast("timestamp"))
    out = ev.new_events(row).first()
    assert (str(out.validTo), out.types, out["rank"]) == ("2025-01-04 10:00:00", ["FL"], 1.8)


def test_unknown_source_fails(spark):
    sources = spark.createDataFrame([("1", "a"), ("0", "a")], "id string, name string")
    assert ingest.source_id(sources, "a").first()[0] == "0"
    with pytest.raises(Exception, match="no data source named b"):
        ingest.source_id(sources, "b").collect()


def test_settings(monkeypatch):
    monkeypatch.setenv("SIGLOOM_MAX_PAGES_PER_POLL", "7")
    assert (Settings.from_env().max_pages_per_poll, Settings.from_env().relevance_threshold) == (7, 0.5)


def test_settings_reach_the_operators():
    import subprocess
    import sys

    code = "from sigloom.operators import events, ingest; import inspect; print(inspect.signature(events.relevant).parameters['threshold'].default, inspect.signature(ingest.page_cap).parameters['cap'].default)"
    out = subprocess.run([sys.executable, "-c", code], env={**__import__("os").environ, "SIGLOOM_RELEVANCE_THRESHOLD": "0.9", "SIGLOOM_MAX_PAGES_PER_POLL": "3"}, capture_output=True, text=True, check=True)
    assert out.stdout.split() == ["0.9", "3"]


def test_schemas_parse(spark):
    from pyspark.sql import types as T

    assert len(T.StructType.fromDDL(schemas.signal_ddl("link")).fields) == 15
    assert T.StructType.fromDDL(schemas.page_ddl("alertUrl")).fieldNames() == ["alerts", "nextPage"]
    for name in ("LOCATION", "DATA_SOURCE", "DISASTER_TYPE", "STORED_SIGNAL", "EVENT", "ALERT", "CLASSIFICATION", "GROUPING", "ASSESSMENT", "LEGACY_SIGNAL"):
        assert T.StructType.fromDDL(getattr(schemas, name)).fields


def test_candidates(spark):
    t = "timestamp_ntz '2024-01-{:02} 00:00:00'".format
    events = spark.sql(f"select * from values ('e1', 'flood', 'x', {t(1)}, {t(8)}), ('e2', 'flood', 'x', {t(5)}, null), ('e3', 'flood', 'y', {t(1)}, {t(8)}), ('e4', 'fire', 'x', {t(1)}, {t(8)}) as v(event_id, type, location, validFrom, validTo)")
    signals = spark.sql(f"select * from values ('a', 'flood', 'x', {t(1)}), ('b', 'flood', 'x', {t(8)}), ('c', 'flood', 'x', {t(9)}), ('d', 'fire', 'x', {t(2)}), ('e', 'fire', null, {t(2)}) as v(signal_id, type, location, ts)")
    rows = ev.candidates(signals, events, ["type", "location"]).select("signal_id", "event_id").collect()
    assert sorted(map(tuple, rows)) == [("b", "e1"), ("b", "e2"), ("c", "e2"), ("d", "e4")]


def test_whole_texts_reach_the_limit(spark, sf):
    found = catalog.queries()
    sizes = [len(r.raw_context) for r in found["p8_o3_o4_raw_context"](spark, sf).collect()]
    assert max(sizes) == 2000 and any(200 < n < 2000 for n in sizes)
    longest = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id % 13 <> 0").selectExpr("max(length(text))").first()[0]
    assert max(len(r.headline or "") for r in found["p1_p2_parse_flatten"](spark, sf).collect()) == longest


def test_payload_keeps_every_field(spark):
    pages = spark.createDataFrame([(1, '{"alerts": [{"alertId": "a", "own": "l", "more": {"x": [1, 2]}}, {"alertId": "b"}], "nextPage": null}')], "page int, body string")
    rows = ingest.flatten(ingest.parse_pages(pages, schemas.page_ddl("own"))[0]).orderBy("pos").collect()
    assert [(r.alertId, r.own, r.payload) for r in rows] == [("a", "l", '{"alertId":"a","own":"l","more":{"x":[1,2]}}'), ("b", None, '{"alertId":"b"}')]
