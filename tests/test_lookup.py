"""Answers remembered, points in polygons and phrases of a lexicon, against plain Python."""

import datetime as dt
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sigloom.operators import memo, model, phrases, polygons

NOW = dt.datetime(2024, 6, 1, 12)


def test_memo(spark):
    """Asked once per key, young answers stand to the second, old and failed ones are asked again, hot keys and all."""
    calls = spark.sparkContext.accumulator(0)

    def connect():
        def send(request):
            calls.add(1)
            if request == "bad":
                raise RuntimeError("away")
            return '{"severity": %d}' % len(request)
        return send

    ask = lambda asked: model.answers(asked, connect, "severity INT", attempts=1)
    ago = lambda seconds: NOW - dt.timedelta(seconds=seconds)
    kept = spark.createDataFrame([("young", 50, ago(86_399)), ("old", 51, ago(86_400)), ("twice", 52, ago(90)), ("twice", 53, ago(10)), ("null", None, ago(5))], "signal_id string, severity int, answered_at timestamp")
    rows = [(k, r, i) for i, (k, r) in enumerate([("young", "xxx"), ("old", "xx"), ("twice", "x"), ("null", "x"), ("new", "xxxx"), ("new", "xxxx"), ("fails", "bad"), (None, "x")] + [("hot", "xxxxx")] * 3000)]
    requests = spark.createDataFrame(rows, "signal_id string, request string, i int")
    answers, added = memo.answered(requests, kept, ask, F.lit(NOW))
    got = {(r.signal_id, r.i): (r.severity, r.failure is not None) for r in answers.collect()}
    assert len(got) == len(rows) - 1 and added.count() == 3
    want = {"young": 50, "old": 2, "twice": 53, "null": None, "new": 4, "fails": None, "hot": 5}
    assert all(v == (want[k], k == "fails") for (k, _), v in got.items())
    assert calls.value == 4  # old, new, fails, hot
    later, _ = memo.answered(requests, kept.unionByName(added), ask, F.lit(NOW))
    assert later.count() == len(rows) - 1 and calls.value == 5  # only what failed
    assert memo.answered(requests.where("false"), kept, ask, F.lit(NOW))[0].count() == 0 and calls.value == 5


def inside(rings, lat, lon):
    crossed = 0
    for ring in rings:
        if len(ring) < 3 or any(p is None or None in p for p in ring):
            continue
        for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (d - b) * (lat - a) - (c - a) * (lon - b) == 0 and min(a, c) <= lat <= max(a, c) and min(b, d) <= lon <= max(b, d):
                return True
            crossed += (a > lat) != (c > lat) and lon < (d - b) * (lat - a) / (c - a) + b
    return crossed % 2 == 1


@pytest.mark.parametrize("level", [2, 8, 11])
def test_polygons(spark, level):
    rng = random.Random(level)
    star = lambda lat, lon, r: [(lat + round(k * r * 16) / 16, lon + round(s * r * 16) / 16) for k, s in [(1, 0), (0.25, 0.375), (0, 1), (-0.5, 0.5), (-1, 0), (-0.375, -0.25), (0, -1), (0.5, -0.5)]]
    shapes = {f"s{i}": [star(rng.randint(-60, 60), rng.randint(-150, 150), rng.choice([0.5, 2, 8]))] for i in range(8)}
    shapes |= {
        "square": [[(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0)], [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0)], [(1.25, 1.25), (1.25, 1.5), (1.5, 1.5), (1.5, 1.25)]],
        "line": [[(5.0, 5.0), (6.0, 6.0)]], "broken": [[(5.0, 5.0), None, (6.0, 7.0), (9.0, 9.0)]], "empty": [], "pole": [[(89.0, -180.0), (89.0, 180.0), (90.0, 180.0), (90.0, -180.0)]], "flat": [[(7.0, 7.0), (7.0, 9.0), (7.0, 8.0)]],
    }
    points = [(rng.randint(-80, 80) / 16, rng.randint(-80, 80) / 16) for _ in range(150)] + [(lat + rng.randint(-40, 40) / 16, lon + rng.randint(-40, 40) / 16) for i in range(8) for lat, lon in [shapes[f"s{i}"][0][0]] for _ in range(20)]
    points += [(0.0, 0.0), (4.0, 2.0), (1.0, 1.5), (1.5, 1.75), (1.4, 1.4), (89.5, 0.0), (90.0, 180.0), (7.0, 7.5), (None, 1.0), (1.0, None)]
    table = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, lat double, lon double")
    shaped = spark.createDataFrame([(k, v) for k, v in shapes.items()], "id string, rings array<array<struct<lat: double, lon: double>>>")
    got = sorted((r.i, r.polygon_id) for r in polygons.within(table, shaped, level).collect())
    assert got == sorted((i, k) for i, (lat, lon) in enumerate(points) for k, v in shapes.items() if lat is not None and lon is not None and inside(v, lat, lon))
    if level == 8:
        cells = polygons.covered(shaped.where("id = 'square'"), level)
        assert cells.where("sides is null").count() > 0  # decided without a ray


def split(text):
    return [w for w in re.split(r"[^\w]+", text.lower()) if w]


def brute(texts, lexicon):
    out, by = Counter(), {}
    for phrase, code in set(lexicon):
        by.setdefault(tuple(split(phrase)), set()).add(code)
    longest = max(map(len, by), default=0)
    for i, text in texts:
        w = split(text or "")
        for a in range(len(w)):
            for b in range(a + 1, min(len(w), a + longest) + 1):
                for code in by.get(tuple(w[a:b]), ()):
                    out[i, code] += 1
    return dict(out)


@pytest.mark.parametrize("part", [phrases.PART, 7])
def test_phrases(spark, part):
    rng = random.Random(part)
    vocabulary = ["flood", "river", "dam", "fire", "Überflutung", "im", "bridge", "über", "x_1"]
    texts = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40)))) for i in range(60)] + [(60, None), (61, ""), (62, "FLOOD!flood")]
    lexicon = [(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 4))), rng.choice(["A", "B"])) for _ in range(40)] + [("flood", "A"), ("FLOOD", "A"), ("flood", "B"), ("river-dam", "B")]
    docs, lex = spark.createDataFrame(texts, "doc_id int, text string"), spark.createDataFrame(lexicon, "phrase string, code string")
    assert {(r.doc_id, r.code): r.n for r in phrases.matches(docs, lex, part=part).collect()} == brute(texts, lexicon)
    assert phrases.matches(docs, lex.where("false")).count() == 0
    signals = docs.select(F.col("doc_id").alias("signal_id"), "text", F.lit("title").alias("title"))
    rows = {r.signal_id: r for r in phrases.classify(signals, lex).collect()}
    assert len(rows) == len(texts) and rows[60].disaster_types == [] and rows[60].severity == 1
    assert rows[62].disaster_types == ["A", "B"] and rows[62].severity == 5 and rows[62].relevance == 1.0


def test_phrases_that_are_none(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id int, text string")
    for bad in ("...", "one two three four five six seven eight nine"):
        with pytest.raises(Exception, match="not a phrase"):
            phrases.matches(docs, spark.createDataFrame([(bad, "A")], "phrase string, code string")).collect()


def test_time_hangs_little_on_the_number_of_phrases(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    took = {}
    for n in (200, 20_000, 200, 20_000):
        lex = spark.range(n).selectExpr("concat('the phrase ', id) as phrase", "'A' as code")
        began = time.perf_counter()
        phrases.matches(docs, lex).collect()
        took[n] = time.perf_counter() - began  # the second time counts, when code is compiled
    assert took[20_000] < 2 * took[200] + 1


def test_a_text_is_read_once_for_all_phrases(spark):
    """However many parts the lexicon has, the texts are read once, and few runs that are no phrases get as far as a join."""
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    docs = spark.range(400).selectExpr("id as doc_id", "concat('flood w', id, ' river ', id % 7, ' dam over x', id) as text").mapInArrow(seen, "doc_id long, text string")
    lex = spark.range(300).selectExpr("concat('w', id, ' River') as phrase", "concat('C', id % 3) as code").union(spark.sql("select 'dam over', 'D'")).union(spark.sql("select 'flood', 'D'"))
    got = {(r.doc_id, r.code): r.n for r in phrases.matches(docs, lex, part=20).collect()}
    assert got == {(i, f"C{i % 3}"): 1 for i in range(300)} | {(i, "D"): 2 for i in range(400)}
    assert reads.value == 400
    known = phrases.lexicon(lex)
    assert phrases._counted(docs, known, [1, 2], "doc_id", "text").count() <= 300 + 800 + 5
