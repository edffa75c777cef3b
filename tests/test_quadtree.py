"""Nearest of very many places against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigloom.operators import geo, quadtree
from sigloom.sources import scratch


def brute(signals, places):
    out = {}
    la, lo, ids = np.array([p[1] for p in places]), np.array([p[2] for p in places]), [p[0] for p in places]
    for i, lat, lon in signals:
        if lat is None or lon is None:
            out[i] = None
            continue
        d = np.sin(np.radians(la - lat) / 2) ** 2 + np.cos(np.radians(lat)) * np.cos(np.radians(la)) * np.sin(np.radians(lo - lon) / 2) ** 2
        out[i] = float(d.min()), {ids[k] for k in np.flatnonzero(d <= d.min() * (1 + 1e-12) + 1e-18)}
    return out


def check(spark, signals, places, **more):
    s, p = spark.createDataFrame(signals, "n int, lat double, lon double"), places if not isinstance(places, list) else spark.createDataFrame(places, "id string, lat double, lon double")
    rows = [tuple(r) for r in p.select("id", "lat", "lon").toPandas().itertuples(index=False)] if not isinstance(places, list) else places
    want = brute(signals, [r for r in rows if -90 <= r[1] <= 90])
    got = geo.nearest(s, p, few=10, **more).collect()
    assert len(got) == len(signals)
    for r in got:
        if want[r.n] is None:
            assert r.location_id is None and r.distance_km is None
        else:
            assert r.location_id in want[r.n][1]
            assert abs(r.distance_km - 6371.0 * 2 * np.arctan2(np.sqrt(want[r.n][0]), np.sqrt(max(0.0, 1 - want[r.n][0])))) < 1e-6


@pytest.mark.parametrize(("leaf", "nodes"), [(1, 100_000), (8, 0)])
def test_against_brute_force(spark, monkeypatch, leaf, nodes):
    """Poles, the date line, points beyond the poles, clusters, places on one spot, with and without broadcast."""
    monkeypatch.setattr(quadtree, "BROADCAST_NODES", nodes)
    monkeypatch.setattr(quadtree.nearest, "__defaults__", (quadtree.LEAF, nodes))
    rng = np.random.default_rng(leaf)
    places = [(f"p{i:04d}", float(a), float(b)) for i, (a, b) in enumerate(np.column_stack([rng.uniform(-90, 90, 300), rng.uniform(-180, 180, 300)]))]
    places += [(f"c{i}", 48.0 + float(x) * 1e-4, 11.0 + float(y) * 1e-4) for i, (x, y) in enumerate(rng.normal(size=(300, 2)))]
    places += [("same2", 10.0, 10.0), ("same1", 10.0, 10.0), ("north", 90.0, 77.0), ("south", -90.0, -3.0), ("date", 0.0, 180.0), ("date2", 5.0, -180.0), ("far", 1.0, 541.0)]
    signals = [(i, float(a), float(b)) for i, (a, b) in enumerate(np.column_stack([rng.uniform(-90, 90, 120), rng.uniform(-180, 180, 120)]))]
    signals += [(200 + i, 48.0 + float(x) * 1e-4, 11.0 + float(y) * 1e-4) for i, (x, y) in enumerate(rng.normal(size=(60, 2)) * 3)]
    signals += [(300, 10.0, 10.0), (301, 90.0, 0.0), (302, -90.0, 0.0), (303, 0.1, -179.99), (304, 95.0, 20.0), (305, -100.0, 170.0), (306, 20.0, 400.0), (307, None, 1.0), (308, 1.0, None), (309, 89.9, -100.0)]
    check(spark, signals, places, leaf=leaf)


@pytest.mark.parametrize("spread", ["city", "globe"])
def test_a_million_places(spark, spark_scratch, spread):
    """All in one city, or spread: the largest array is a leaf, and a signal holds few cells."""
    lat, lon = ("15.5 + randn(1) * 0.05", "32.5 + randn(2) * 0.05") if spread == "city" else ("degrees(asin(rand(1) * 2 - 1))", "rand(2) * 360 - 180")
    places = scratch.written(spark.range(1_000_000).selectExpr("concat('p', id) as id", f"{lat} as lat", f"{lon} as lon"), "million")
    rng = np.random.default_rng(1)
    signals = [(i, 15.5 + float(x) * 0.1, 32.5 + float(y) * 0.1) for i, (x, y) in enumerate(rng.normal(size=(40, 2)))] + [(100 + i, float(a), float(b)) for i, (a, b) in enumerate(np.column_stack([rng.uniform(-90, 90, 40), rng.uniform(-180, 180, 40)]))]
    check(spark, signals, places)
    fronts = [n for n in spark_scratch if "front-" in n]
    assert fronts and max(spark_scratch[n].groupBy("_sid").count().agg(F.max("count")).first()[0] for n in fronts) < 1000
    leaves = next(spark_scratch[n] for n in spark_scratch if "leaves-" in n)
    assert leaves.agg(F.max(F.size("places"))).first()[0] <= quadtree.LEAF
    assert leaves.agg(F.sum(F.size("places"))).first()[0] == places.select("lat", "lon").distinct().count()


@pytest.fixture
def spark_scratch(monkeypatch):
    """The written tables by folder, which are kept for a look."""
    kept = {}
    real = scratch.written

    def written(df, name):
        table = real(df, name)
        kept[table._written_at] = table
        return table

    monkeypatch.setattr(scratch, "written", written)
    monkeypatch.setattr(scratch, "drop", lambda *tables: None)
    return kept
