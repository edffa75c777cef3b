"""Locations: the top-level one, the nearest one, and one per grid cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar
from ..sources import scratch
from . import quadtree

FEW_PLACES = 10_000
FINEST = 9


def top_level(locations: DataFrame) -> DataFrame:
    """(location_id): the id with the highest level; a missing level is 0, ties go to the smaller id order of ``pos``."""
    return locations.agg(F.max_by("id", F.struct(F.coalesce("level", F.lit(0)), -F.col("pos"))).alias("location_id"))


def with_top_level(signals: DataFrame, locations: DataFrame) -> DataFrame:
    return signals.join(F.broadcast(top_level(locations)))  # one row


def _cell(lat: Column, lon: Column, level: int) -> tuple[Column, Column]:
    """Row and column in a grid of 2**level rows from pole to pole and twice as many columns around."""
    rows = 1 << level
    row = F.least(F.greatest(F.floor((lat + 90) / (180 / rows)), F.lit(0)), F.lit(rows - 1))
    return row.cast("long"), F.pmod(F.floor((lon + 180) / (180 / rows)), F.lit(2 * rows)).cast("long")


def _key(row: Column, column: Column, level: int) -> Column:
    return row * (2 << level) + column


def _around(places: DataFrame, level: int) -> DataFrame:
    """(_cell, _places): the places in each cell and in the eight around it."""
    rows, columns = 1 << level, 2 << level
    row, column = _cell(F.col("lat"), F.col("lon"), level)
    near = [F.when((row + dy >= 0) & (row + dy < rows), _key(row + dy, F.pmod(column + dx, F.lit(columns)), level)) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]
    spread = places.select("id", "lat", "lon", F.cos(F.radians("lat")).alias("cos"), F.explode(F.array_distinct(F.array_compact(F.array(*near)))).alias("_cell"))
    return spread.groupBy("_cell").agg(F.collect_list(F.struct("id", "lat", "lon", "cos")).alias("_places"))


def _sure_within(level: int) -> Column:
    """The haversine below which nothing outside the nine cells around a point can be nearer.

    Such a place is a cell's height away in latitude, or a cell's width in longitude, whose meridian
    is asin(cos(lat) * sin(width)) away at least.
    """
    size = F.radians(F.lit(180 / (1 << level)))
    apart = F.least(size, F.asin(F.col("_cos") * F.sin(F.least(size, F.radians(F.lit(90.0))))))
    return F.pow(F.sin(apart / 2), 2) * (1 - 1e-9)


def start_level(n_places: int) -> int:
    """A grid in which a cell has about a place or two, if they are spread evenly."""
    level = 0
    while level < FINEST and 2 << (2 * (level + 1)) <= n_places:
        level += 1
    return level


def nearest(signals: DataFrame, locations: DataFrame, few: int = FEW_PLACES, level: int | None = None, leaf: int = quadtree.LEAF) -> DataFrame:
    """Adds location_id and distance_km of the nearest location, ties to the smaller id; null without coordinates.

    Up to ``few`` locations lie in grids that are broadcast, see ``_by_grids``; more of them in a tree with leaves of at most
    ``leaf``, see ``quadtree``. The result is the same.
    """
    places = locations.where("lat between -90 and 90 and lon is not null").select("id", "lat", "lon")
    n = places.limit(few + 1).count()
    if n <= few:
        return _by_grids(signals, places, start_level(n) if level is None else level)
    rows = scratch.written(signals.withColumn("_sid", F.monotonically_increasing_id()), "signals")
    points = rows.where("lat is not null and lon is not null and not isnan(lat) and not isnan(lon)")
    best = quadtree.nearest(points.select("_sid", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon")), places, leaf)
    return rows.join(best, "_sid", "left").withColumns({"location_id": F.col("_best.id"), "distance_km": scalar.arc_km(F.col("_best.d"))}).drop("_best", "_sid")


def _by_grids(signals: DataFrame, places: DataFrame, first: int) -> DataFrame:
    """Signals are joined with the places of their own grid cell and the eight around it, by an equality of
    cells. Where the nearest of these is near enough that no place outside can be nearer, it is the answer.
    The other signals, and only they, go on to a grid with cells four times as wide, and in the end to one
    whose nine cells are the whole globe. The grids are broadcast: there are few places.
    """
    levels = sorted({0, *range(first, 0, -2)}, reverse=True)
    out = signals.withColumns({"_best": F.lit(None).cast("struct<d: double, id: string>"), "_cos": F.cos(F.radians("lat")), "_open": F.col("lat").isNotNull() & F.col("lon").isNotNull()})
    for at in levels:
        cells = _around(places, at)
        here = _key(*_cell(F.col("lat"), F.col("lon"), at), at)
        out = out.withColumn("_at", F.when(F.col("_open"), here).otherwise(F.lit(-1)))  # matches no cell
        found = F.array_min(F.transform("_places", lambda p: F.struct(scalar.haversine(F.col("lat"), F.col("lon"), F.col("_cos"), p["lat"], p["lon"], p["cos"]).alias("d"), p["id"].alias("id"))))
        out = out.join(F.broadcast(cells), F.col("_at") == F.col("_cell"), "left")
        out = out.withColumn("_best", F.when(F.col("_open"), found).otherwise(F.col("_best"))).drop("_places", "_cell", "_at")
        out = out.withColumn("_open", F.col("_open") & ((F.col("lat") < -90) | (F.col("lat") > 90) | F.col("_best").isNull() | (F.col("_best.d") >= _sure_within(at))))
    return out.withColumns({"location_id": F.col("_best.id"), "distance_km": scalar.arc_km(F.col("_best.d"))}).drop("_best", "_cos", "_open")


def cell_representatives(signals: DataFrame, order: list[str]) -> DataFrame:
    """(cell_lat, cell_lon, lat, lon): the first point of each 0.1 degree cell decides for the cell."""
    cells = signals.where("lat is not null and lon is not null").withColumns({"cell_lat": scalar.grid_cell(F.col("lat")), "cell_lon": scalar.grid_cell(F.col("lon"))})
    return cells.groupBy("cell_lat", "cell_lon").agg(F.min_by(F.struct("lat", "lon"), F.struct(*order)).alias("p")).select("cell_lat", "cell_lon", "p.*")


def resolve_cells(signals: DataFrame, locations: DataFrame, memo: DataFrame, now: Column, order: list[str], hours: int = 6) -> tuple[DataFrame, DataFrame]:
    """(signals with location_id, new memo rows): the first point of a cell decides for all its points, for ``hours``.

    ``memo`` has (cell_lat, cell_lon, location_id, resolved_at). An answer younger than ``hours`` is taken as it is,
    a null location_id too: it says that nothing was found. Other cells get the location nearest to their
    first point. Without any locations nothing is remembered, so the next run asks again.
    """
    young = memo.where(F.col("resolved_at") > now - F.expr(f"interval {hours} hours"))
    known = young.groupBy("cell_lat", "cell_lon").agg(F.max_by(F.struct("location_id"), "resolved_at").alias("_known"))
    asked = cell_representatives(signals, order).join(known, ["cell_lat", "cell_lon"], "left_anti")
    some = locations.where("lat is not null and lon is not null").limit(1).withColumn("_some", F.lit(1)).select("_some")
    fresh = nearest(asked, locations).join(F.broadcast(some)).select("cell_lat", "cell_lon", "location_id", now.alias("resolved_at"))  # one row at most
    answers = known.select("cell_lat", "cell_lon", F.col("_known.location_id").alias("location_id")).unionByName(fresh.drop("resolved_at"))
    placed = signals.withColumns({"cell_lat": scalar.grid_cell(F.col("lat")), "cell_lon": scalar.grid_cell(F.col("lon"))})
    return placed.join(answers, ["cell_lat", "cell_lon"], "left").drop("cell_lat", "cell_lon"), fresh


def in_box(lat: str, lon: str, south: float, north: float, west: float, east: float):  # noqa: ANN201
    return F.col(lat).between(south, north) & F.col(lon).between(west, east)
