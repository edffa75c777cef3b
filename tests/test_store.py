"""The store of open events: rules by hand, stream against batch with late signals, candidates under skew."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sigloom import schemas
from sigloom.operators import events as ev
from sigloom.operators import model, skew, store
from sigloom.streaming import events as se
from sigloom.streaming import ingest as st

H = store.HOUR


def slices(*rows):
    return pd.DataFrame([(h, int(a * H), int(b * H), n, 3) for h, a, b, n in rows], columns=store.SLICE)


def test_rule():
    fold = lambda known, *rows: store.fold(known, slices(*rows), 48, 7, 168)
    kept, out = fold([], (0, 0.5, 0.6, 2), (48, 48.6, 48.6, 1), (97, 97.0, 97.1, 1), (170, 170.0, 170.0, 1))
    assert out["action"].tolist() == ["create_new", "add_to_existing", "create_new", "create_new"]  # gap of 48 h exactly; more than that; again
    assert out["began"].tolist() == [0, 0, 97, 170]
    assert kept == [store.Open(0, H // 2, int(48.6 * H), 168), store.Open(97, 97 * H, int(97.1 * H), 265), store.Open(170, 170 * H, 170 * H, 338)]
    _, out = fold([], *((h, h, h, 1) for h in range(0, 400, 40)))  # closed after seven days, however near the signals are
    assert out["began"].tolist() == [0, 0, 0, 0, 0, 200, 200, 200, 200, 200]


def test_late_signals():
    """Joins the event that it lies in, or the one that begins next, or creates its own; an event keeps its id when its beginning moves."""
    known = [store.Open(100, 100 * H, 120 * H, 268), store.Open(300, 300 * H, 310 * H, 468)]
    for hour, began, action in ((110, 100, "add_to_existing"), (160, 100, "add_to_existing"), (60, 100, "add_to_existing"), (200, 200, "create_new"), (260, 300, "add_to_existing"), (269, 300, "add_to_existing"), (20, 20, "create_new")):
        kept, out = store.fold(known, slices((hour, hour, hour, 1)), 48, 7, 10_000)
        assert (out["began"][0], out["action"][0]) == (began, action)
        assert {e.began for e in kept} == {100, 300, began}
    kept, _ = store.fold(known, slices((60, 60, 60, 1)), 48, 7, 10_000)
    assert kept[0] == store.Open(100, 60 * H, 120 * H, 268)
    assert [e.began for e in store.fold(known, slices((400, 400, 400, 1)), 48, 7, 20)[0]] == [300 + 100]  # both forgotten


def plain(batches, gap=48, days=7):
    """The rule in plain loops, in the order of arrival; late ones included."""
    events, totals = {}, {}
    for batch in batches:
        of = {}  # the first signal of an hour decides for those that come with it
        for key, t, severity in sorted(batch, key=lambda r: (repr(r[0]), r[1])):
            hour = t // H
            e = of.get((key, hour))
            if e is None:
                near = [e for e in events.setdefault(key, []) if hour < e["until"] and t <= e["last"] + gap * H and t >= e["first"] - gap * H]
                begun = [e for e in near if e["first"] <= t]
                e = max(begun, key=lambda e: e["began"]) if begun else min(near, key=lambda e: e["began"], default=None)
            if e is None:
                events[key].append(e := {"began": hour, "first": t, "last": t, "until": hour + 24 * days})
            of[key, hour] = e
            e["first"], e["last"] = min(e["first"], t), max(e["last"], t)
            n, most = totals.get((key, e["began"]), (0, 0))
            totals[key, e["began"]] = n + 1, max(most, severity)
    return {(*key, began, *totals[key, began], e["first"], e["last"]) for key, es in events.items() for e in es for began in [e["began"]]}


def test_stream_with_restart_and_late_signals(spark, tmp_path):
    rng = random.Random(4)
    keys = [("FL", 1), ("FL", 2), ("CE", None)]
    rows = sorted((rng.choice(keys), int(rng.uniform(0, 40 * 24) * H) // 1000 * 1000, rng.randint(1, 5)) for _ in range(400))
    rows.sort(key=lambda r: r[1])
    batches = [rows[:100] + rows[150:250], rows[250:320], rows[100:150] + rows[320:]]  # the last brings late ones
    table = lambda rs: spark.createDataFrame([(*k, t, s) for k, t, s in rs], "type string, location int, us long, severity int").select("type", "location", F.timestamp_micros("us").alias("ts"), "severity")
    folder, out, check = (f"file://{tmp_path}/{n}" for n in ("in", "out", "check"))
    for batch in batches:
        table(batch).write.mode("append").parquet(folder)
        signals = spark.readStream.schema(table([]).schema).parquet(folder)
        st.run_once(se.event_store(signals, ["type", "location"], late_hours=10_000), out, check)
    decided = spark.read.parquet(out)
    per = decided.groupBy("type", "location", "began").agg(F.sum("n_signals"), F.max("max_severity"), F.min("first_us"), F.max("last_us"))
    got = {tuple(r) for r in per.collect()}
    assert got == plain(batches)
    st.run_once(se.event_store(spark.readStream.schema(table([]).schema).parquet(folder), ["type", "location"], late_hours=10_000), out, check)
    assert spark.read.parquet(out).count() == decided.count()  # nothing new
    whole = store.decisions(table(rows), ["type", "location"]).groupBy("type", "location", "began").agg(F.sum("n_signals"), F.max("max_severity"), F.min("first_us"), F.max("last_us"))
    assert {tuple(r) for r in whole.collect()} == plain([rows])


def test_hot_key_leaves_a_row_per_hour(spark):
    """A third of all signals have one key: what is folded doesn't grow with them."""
    rows = spark.range(60_000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 50)) as type", "timestamp_seconds(id * 7) as ts", "1 as severity")
    slices = store.added_up(store.sliced(rows, ["type"]), ["type"])
    assert slices.where("type = 'hot'").count() <= 60_000 * 7 // 3600 + 1
    assert store.event_rows(store.decisions(rows, ["type"]), ["type"]).agg(F.sum("n_signals")).first()[0] == 60_000


def test_signals_without_time_or_key(spark):
    rows = spark.createDataFrame([("a", "FL", None, 1), ("b", None, dt.datetime(2024, 1, 1), None)], "signal_id string, type string, ts timestamp, severity int")
    found = store.signal_events(rows, store.decisions(rows, ["type"]), ["type"])
    assert {r.signal_id: r.event_id is None for r in found.collect()} == {"a": True, "b": False}
    assert store.decisions(rows.where("false"), ["type"]).count() == 0


NOW = dt.datetime(2024, 1, 10)


def test_grouping_answers(spark):
    signals = spark.createDataFrame([(s, f"t {s}", NOW, 4, ["FL"], n) for n, s in enumerate("abcdefg")], "signal_id string, title string, ts timestamp, severity int, disaster_types array<string>, n int")
    answers = spark.createDataFrame(
        [("a", "create_new", None, "own title", ["CE"], None), ("b", "create_new", None, None, [], None), ("c", "add_to_existing", "e1", None, None, None), ("d", "add_to_existing", "gone", None, None, None), ("e", "add_to_existing", "", None, None, None), ("f", None, None, None, None, "the model is away"), ("c", "add_to_existing", "e1", None, None, None)],
        "signal_id string, action string, event_id string, title string, types array<string>, failure string",
    )
    events = ev.new_events(spark.createDataFrame([("old", "o", NOW, 1, ["DR"], [])], "signal_id string, title string, ts timestamp, severity int, disaster_types array<string>, event_types array<string>")).withColumn("event_id", F.lit("e1"))
    after, rejected = store.apply_grouping(signals, answers, events, ["n"])
    rows = {r.event_id if r.event_id == "e1" else r.signalIds[0]: r for r in after.collect()}
    assert rows["e1"].signalIds == ["c", "old"] and rows["e1"].types == ["DR"]
    assert (rows["a"].title, rows["a"].types, rows["a"].rank) == ("own title", ["CE"], 0.8)
    assert (rows["b"].title, rows["b"].types, rows["b"].validTo) == ("t b", ["FL"], NOW + dt.timedelta(days=7))
    assert {r.signal_id: r.reason for r in rejected.collect()} == {"d": "unknown event: gone", "e": "unexpected action: add_to_existing", "f": "the model is away", "g": "no answer"}


def test_grouping_asks_the_model_once(spark):
    """Events after the answers and rejected signals come from one answer to each request."""
    calls = spark.sparkContext.accumulator(0)

    def connect():
        def send(request):
            calls.add(1)
            return '{"action": "%s"}' % request
        return send

    signals = spark.createDataFrame([(s, f"t {s}", NOW, 4, ["FL"], n) for n, s in enumerate("abc")], "signal_id string, title string, ts timestamp, severity int, disaster_types array<string>, n int")
    requests = spark.createDataFrame([("a", "create_new"), ("b", "wait"), ("c", "create_new")], "signal_id string, request string")
    events = ev.new_events(signals.where("false").withColumn("event_types", F.array().cast("array<string>")))
    after, rejected = store.apply_grouping(signals, model.answers(requests, connect, schemas.GROUPING), events, ["n"])
    assert sorted(r.signalIds[0] for r in after.collect()) == ["a", "c"] and [r.signal_id for r in rejected.collect()] == ["b"]
    assert calls.value == 3


def some(spark, n, events, seed=0):
    rng = random.Random(seed)
    day = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randint(0, 86_400 * 60))
    kind = lambda: rng.choice(["hot", "a", "b", None])
    signals = [(i, kind(), rng.choice([day(), day(), day(), None]) if i % 5 == 0 else day()) for i in range(n)]
    known = [(f"e{i}", kind(), f := day(), rng.choice([f + dt.timedelta(days=7), f + dt.timedelta(hours=1), f + dt.timedelta(days=200), None, f])) for i in range(events)] + [("edge", "a", signals[1][2] or day(), signals[1][2])]
    return spark.createDataFrame(signals, "id int, type string, ts timestamp"), spark.createDataFrame(known, "event_id string, type string, validFrom timestamp, validTo timestamp"), signals, known


@pytest.mark.parametrize("few", [skew.FEW, 1])
def test_candidates_of_any_validity(spark, few):
    """Short, long, open for good, empty; with and without hot buckets."""
    signals, known, ss, es = some(spark, 300, 60)
    got = ev.candidates(signals, known, ["type"], share=5, few=few)
    assert got.columns == ["id", "type", "ts", "event_id", "validFrom", "validTo"]
    pairs = sorted((r.id, r.event_id) for r in got.collect())
    assert pairs == sorted((i, e) for i, k, t in ss for e, k2, a, b in es if t and k and k == k2 and a < t and (b is None or t <= b))
    assert ev.candidates(signals, known.where("false"), ["type"]).count() == 0


def test_no_task_has_a_hot_key(spark):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("64", "false"), strict=True):
        spark.conf.set(n, v)
    try:
        signals = spark.range(60_000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('k', id % 997)) as type", "timestamp_seconds(1704067200 + id * 13) as ts")
        known = spark.range(2000).selectExpr("concat('e', id) as event_id", "if(id % 3 = 0, 'hot', concat('k', id % 997)) as type", "timestamp_seconds(1704067200 + id * 300) as validFrom", "timestamp_seconds(1704067200 + id * 300 + 7 * 86400) as validTo")
        level = F.lit(8)
        placed = signals.withColumns({"_level": level, "_bucket": F.floor(F.unix_micros("ts") / store.HOUR / 256)})
        hot = skew.hot_keys(placed, ["type", "_level", "_bucket"], share=1000, few=100)
        events = known.withColumns({"_level": level, "_bucket": F.explode(F.sequence(F.floor(F.unix_micros("validFrom") / store.HOUR / 256), F.floor(F.unix_micros("validTo") / store.HOUR / 256)))})
        spread = skew.dealt_join(placed.withColumn("one", F.lit(1)), events.select("type", "_level", "_bucket").distinct(), ["type", "_level", "_bucket"], hot, F.xxhash64("ts"))
        per = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per) >= 20_000 and max(per) < sum(per) / 20
    finally:
        for n, v in zip(names, before, strict=True):
            spark.conf.set(n, v)


def test_stream_candidates_equal_batch(spark, tmp_path):
    signals, known, ss, es = some(spark, 200, 40, seed=2)
    known = known.where("validTo <= validFrom + interval 7 days")
    a, b = f"file://{tmp_path}/s", f"file://{tmp_path}/e"
    signals.write.parquet(a)
    known.write.parquet(b)
    joined = se.candidates_stream(spark.readStream.schema(signals.schema).parquet(a), spark.readStream.schema(known.schema).parquet(b), ["type"], lateness="100 days")
    st.run_once(joined, f"file://{tmp_path}/out", f"file://{tmp_path}/check")
    got = sorted((r.id, r.event_id) for r in spark.read.parquet(f"file://{tmp_path}/out").collect())
    assert got == sorted((r.id, r.event_id) for r in ev.candidates(signals, known, ["type"]).collect()) and got
