"""Records that don't fit are named and set aside; the others of their page go on."""

import json

from sigloom import schemas
from sigloom.operators import validate

GOOD = {"alertId": "a", "alertTimestamp": "2024-01-01T00:00:00Z"}
CASES = [
    ({}, []),
    ({"headline": None, "extra": {"deep": [1]}}, []),
    ({"headline": {"t": 1}}, ["type headline"]),
    ({"headline": 5}, ["type headline"]),
    ({"headline": True}, ["type headline"]),
    ({"alertId": None}, ["missing alertId"]),
    ({"alertId": 7}, ["type alertId"]),
    ({"alertTimestamp": ""}, []),
    ({"estimatedEventLocation": {"name": "x", "coordinates": [1, 2.5]}}, []),
    ({"estimatedEventLocation": {"coordinates": ["1.5", " -2e1 "]}}, []),
    ({"estimatedEventLocation": {"coordinates": ["1.5", "x"]}}, ["type estimatedEventLocation.coordinates[]"]),
    ({"estimatedEventLocation": {"coordinates": ["", "NaN", [1]]}}, ["type estimatedEventLocation.coordinates[]"]),
    ({"estimatedEventLocation": {"coordinates": 3}}, ["type estimatedEventLocation.coordinates"]),
    ({"estimatedEventLocation": "here"}, ["type estimatedEventLocation"]),
    ({"estimatedEventLocation": []}, ["type estimatedEventLocation"]),
    ({"linkedAlerts": [{"count": 3}, {"count": "3"}, {"count": 3.0}, {"count": None}, {}]}, []),
    ({"linkedAlerts": [{"count": 3.5}, {"parentAlertId": 1}]}, ["type linkedAlerts[].count", "type linkedAlerts[].parentAlertId"]),
    ({"linkedAlerts": [7, None]}, ["type linkedAlerts[]"]),
    ({"linkedAlerts": {}}, ["type linkedAlerts"]),
    ({"intelAgents": [{"summary": [{"title": "t", "content": ["a", None]}]}]}, []),
    ({"intelAgents": [{"summary": [{"content": [1]}]}]}, ["type intelAgents[].summary[].content[]"]),
    ({"publicPost": {"text": ["x"], "media": ["m"]}}, ["type publicPost.text"]),
    ({"publicPost": {"media": "m"}, "headline": 1}, ["type headline", "type publicPost.media"]),
]


def test_faults(spark):
    records = [{**GOOD, **more} for more, _ in CASES]
    body = json.dumps({"alerts": [*records, "text", None, 4, []]})
    pages = spark.createDataFrame([(1, body), (2, "{oops"), (3, '{"alerts": []}'), (4, '{"nextPage": "x"}')], "page int, body string")
    signals, rejected, broken = validate.records(pages, schemas.page_ddl("alertUrl"))
    found = {r.pos: sorted(r.reasons) for r in rejected.collect()}
    n = len(CASES)
    assert found == {i: sorted(want) for i, (_, want) in enumerate(CASES) if want} | {n: ["type record"], n + 1: ["missing record"], n + 2: ["type record"], n + 3: ["type record"]}
    good = {r.pos: r for r in signals.collect()}
    assert sorted(good) == [i for i, (_, want) in enumerate(CASES) if not want]
    assert good[9].estimatedEventLocation.coordinates == [1.5, -20.0] and good[8].estimatedEventLocation.coordinates == [1.0, 2.5]
    assert [x["count"] for x in good[15].linkedAlerts] == [3, 3, 3, None, None]
    assert json.loads(good[1].payload)["extra"] == {"deep": [1]} and good[1].headline is None
    assert sorted(r.page for r in broken.collect()) == [2, 4]


def test_a_record_is_parsed_once(spark):
    """The optimizer doesn't put the parse of a text into every place of the model."""
    pages = spark.createDataFrame([(1, '{"alerts": [{"alertId": "a", "alertTimestamp": "t"}, {"alertId": 5}]}'), (2, "{oops")], "page int, body string")
    good, rejected, broken = validate.records(pages, schemas.page_ddl("alertUrl"))
    for rows in (good, rejected):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert 1 <= plan.count("parseJson") <= 2, plan.count("parseJson")
    assert [r.alertId for r in good.collect()] == ["a"] and [r.reasons for r in rejected.collect()] == [["type alertId", "missing alertTimestamp"]] and [r.page for r in broken.collect()] == [2]
