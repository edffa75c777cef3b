"""Points in polygons, by cells of a grid.

A polygon is cut into bands of the grid. A band holds the sides that meet it; the cells of a band that a
side meets are the polygon's border, and each of the others lies inside as a whole or outside as a whole. So points meet polygons
by equality of cells, a point in an inner cell is decided by that, and one in a border cell by casting a ray
through the sides of its band alone.

Degrees are taken as plane coordinates: a polygon over the date line is given as two. Rings are closed by themselves; what lies in an even number of rings
is a hole. A point on a side is inside, that of a hole too. A ring of fewer than three points, or with a null in it, has no sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import skew

LEVEL = 8


def _cells(level: int) -> float:
    return 180 / (1 << level)


def _on(side: Column, lat: Column, lon: Column) -> Column:
    turn = (side["lon2"] - side["lon1"]) * (lat - side["lat1"]) - (side["lat2"] - side["lat1"]) * (lon - side["lon1"])
    return (turn == 0) & lat.between(F.least(side["lat1"], side["lat2"]), F.greatest(side["lat1"], side["lat2"])) & lon.between(F.least(side["lon1"], side["lon2"]), F.greatest(side["lon1"], side["lon2"]))


def _crosses(side: Column, lat: Column, lon: Column) -> Column:
    """Whether a ray to the east from the point crosses the side."""
    at = (side["lon2"] - side["lon1"]) * (lat - side["lat1"]) / (side["lat2"] - side["lat1"]) + side["lon1"]
    return F.when((side["lat1"] > lat) != (side["lat2"] > lat), lon < at).otherwise(False)


def _inside(sides: Column, lat: Column, lon: Column) -> Column:
    return F.exists(sides, lambda s: _on(s, lat, lon)) | (F.size(F.filter(sides, lambda s: _crosses(s, lat, lon))) % 2 == 1)


def covered(polygons: DataFrame, level: int = LEVEL) -> DataFrame:
    """(id, row, col, sides) of the cells that a polygon (id, rings: array of arrays of lat, lon) meets; ``sides`` is null for inner cells."""
    size = _cells(level)
    corners = polygons.select("id", F.explode("rings").alias("ring")).where(F.expr("size(ring) >= 3 and not exists(ring, p -> p is null or p.lat is null or p.lon is null)"))
    sided = corners.select("id", F.posexplode("ring").alias("i", "p"), F.col("ring")).select("id", F.col("p.lat").alias("lat1"), F.col("p.lon").alias("lon1"), F.expr("ring[(i + 1) % size(ring)]").alias("q"))
    sided = sided.select("id", "lat1", "lon1", F.col("q.lat").alias("lat2"), F.col("q.lon").alias("lon2"))
    cell = lambda c, low: F.floor((c - low) / size).cast("long")
    bands = sided.withColumn("row", F.explode(F.sequence(cell(F.least("lat1", "lat2"), -90), cell(F.greatest("lat1", "lat2"), -90))))
    south, north = F.col("row") * size - 90, (F.col("row") + 1) * size - 90
    at = lambda lat: F.when(F.col("lat1") == F.col("lat2"), F.col("lon1")).otherwise(F.col("lon1") + (F.greatest(F.least(lat, F.greatest("lat1", "lat2")), F.least("lat1", "lat2")) - F.col("lat1")) * (F.col("lon2") - F.col("lon1")) / (F.col("lat2") - F.col("lat1")))
    level_side = F.col("lat1") == F.col("lat2")
    ends = [F.when(level_side, F.col("lon1")).otherwise(at(south)), F.when(level_side, F.col("lon2")).otherwise(at(north))]
    slack = size * 1e-9  # of rounding: a cell more does no harm
    bands = bands.withColumns({"west": cell(F.least(*ends) - slack, -180), "east": cell(F.greatest(*ends) + slack, -180)})
    per = bands.groupBy("id", "row").agg(F.collect_list(F.struct("lat1", "lon1", "lat2", "lon2")).alias("sides"), F.collect_list(F.struct("west", "east")).alias("spans"), F.min("west").alias("west"), F.max("east").alias("east"))  # the sides of one polygon in one band
    cells = per.withColumn("col", F.explode(F.sequence("west", "east"))).withColumn("border", F.exists("spans", lambda s: F.col("col").between(s["west"], s["east"])))
    inner = _inside(F.col("sides"), (F.col("row") + 0.5) * size - 90, (F.col("col") + 0.5) * size - 180)
    return cells.where(F.col("border") | inner).select("id", "row", "col", F.when(F.col("border"), F.col("sides")).alias("sides"))


def within(points: DataFrame, polygons: DataFrame, level: int = LEVEL) -> DataFrame:
    """``points`` (with lat, lon) and polygon_id, a row for each polygon that a point lies in; points in none, or without coordinates, have no row."""
    size = _cells(level)
    cells = covered(polygons, level).select(F.col("row").alias("_row"), F.col("col").alias("_col"), F.col("id").alias("polygon_id"), "sides").withColumnRenamed("sides", "_sides")
    placed = points.where("lat is not null and lon is not null").withColumns({"_row": F.floor((F.col("lat") + 90) / size).cast("long"), "_col": F.floor((F.col("lon") + 180) / size).cast("long")})
    met = skew.dealt_join(placed, cells, ["_row", "_col"], skew.hot_keys(placed, ["_row", "_col"]), F.xxhash64("lat", "lon"))
    return met.where(F.col("_sides").isNull() | _inside(F.col("_sides"), F.col("lat"), F.col("lon"))).select(*points.columns, "polygon_id")
