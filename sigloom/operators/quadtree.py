"""The nearest of very many places, by a quadtree whose leaves are bounded.

Places are counted in cells of the globe, each step of the tree a quarter as high and wide as the one before. A cell with more
than ``leaf`` places is divided, so the tree is deep in a city and shallow over the sea, and no row holds more than
``leaf`` places, wherever they are. Every cell has the box around its places and one of them.

Signals go down the tree together, a step at a time. A signal holds the cells where its nearest place may be: the distance to a
cell's own place is an upper bound, the distance to a box a lower one, and cells whose lower bound is above
the least upper bound are let go. What is left in the end are leaves, whose places are looked at one by one.

Where a step's cells are at most ``BROADCAST_NODES`` they go to all tasks, and a signal's cells stay in the task that has the
signal; deeper steps are joined by cell, and signals of a hot cell are dealt to many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalar
from ..sources import scratch
from . import skew

LEAF = 64
#: Halvings per step, and the last level: its cells are about a metre high.
STEP, DEEPEST = 2, 24
BROADCAST_NODES = 100_000
_BOX = ["south", "north", "west", "east"]


def _cell(level: int) -> Column:
    """The cell of (lat, lon) in 2**level rows and twice as many columns, as one number."""
    rows = 1 << level
    row = F.least(F.greatest(F.floor((F.col("lat") + 90) / (180 / rows)), F.lit(0)), F.lit(rows - 1))
    return (row.cast("long") * (2 * rows) + F.pmod(F.floor((F.col("lon") + 180) / (180 / rows)), F.lit(2 * rows)).cast("long")).alias("cell")


def _above(cell: Column, level: int, steps: int = STEP) -> Column:
    """The cell of a higher level around a cell."""
    columns = 2 << level
    return F.shiftright(F.floor(cell / columns).cast("long"), steps) * (columns >> steps) + F.shiftright(cell % columns, steps)


def _off_middle(level: int) -> Column:
    """How far a cell's own place is off the middle of the cell, in cells."""
    off = lambda c: F.pow(F.pmod((F.col(c) + 180) / (180 / (1 << level)), F.lit(1.0)) - 0.5, 2)
    return off("own.lat") + off("own.x")


class Tree:
    """Cells of places by level, from the first that is divided to the deepest."""

    def __init__(self, places: DataFrame, leaf: int = LEAF):
        """``places``: id, lat, lon, none of them null, lat from -90 to 90. Of places at one point only the smallest id counts."""
        self.leaf = leaf
        lon = F.when(F.col("lon").between(-180, 180), F.col("lon")).otherwise(F.pmod(F.col("lon") + 180, F.lit(360.0)) - 180)
        points = places.groupBy("lat", "lon").agg(F.min("id").alias("id")).withColumn("x", lon)
        self.points = scratch.written(points.withColumn("cell", _cell(DEEPEST)), "places")
        summed = [F.sum("n").alias("n"), *(F.min(c).alias(c) for c in ("south", "west")), *(F.max(c).alias(c) for c in ("north", "east"))]
        single = self.points.select("cell", F.lit(1).cast("long").alias("n"), F.col("lat").alias("south"), F.col("lat").alias("north"), F.col("x").alias("west"), F.col("x").alias("east"), F.struct("lat", "lon", "x").alias("own"))
        middle = lambda level: F.min_by("own", _off_middle(level)).alias("own")
        self.levels = {DEEPEST: scratch.written(single.groupBy("cell").agg(*summed, middle(DEEPEST)), f"cells-{DEEPEST}")}
        for level in range(DEEPEST - STEP, -1, -STEP):
            below = self.levels[level + STEP].withColumn("cell", _above(F.col("cell"), level + STEP))
            self.levels[level] = scratch.written(below.groupBy("cell").agg(*summed, middle(level)), f"cells-{level}")
            if self.levels[level].count() <= 2:
                break
        self.top = min(self.levels)

    def opened(self, level: int) -> DataFrame:
        """The cells of ``level`` below cells that are divided: parent, cell, box, own place, and whether they are divided too."""
        cells = self.levels[level].withColumn("divided", (F.col("n") > self.leaf) & F.lit(level < DEEPEST)).drop("n")
        if level == self.top:
            return cells.withColumn("parent", F.lit(-1).cast("long"))
        cells = cells.withColumn("parent", _above(F.col("cell"), level))
        divided = self.levels[level - STEP].where(F.col("n") > self.leaf).select(F.col("cell").alias("parent"))
        return cells.join(divided, "parent")

    def leaves(self) -> DataFrame:
        """(level, cell, places): the places of undivided cells, ``leaf`` in a row at most; of the deepest level there may be several rows to a cell."""
        found = []
        for level in sorted(self.levels):
            cells = self.opened(level).where("not divided").select(F.col("cell").alias("at"))
            inside = self.points.withColumn("at", _above(F.col("cell"), DEEPEST, DEEPEST - level)).join(cells, "at")
            part = F.floor((F.row_number().over(Window.partitionBy("at").orderBy("id")) - 1) / self.leaf) if level == DEEPEST else F.lit(0)
            grouped = inside.withColumn("part", part).groupBy("at", "part").agg(F.collect_list(F.struct("id", "lat", "lon", F.cos(F.radians("lat")).alias("cos"))).alias("places"))
            found.append(grouped.select(F.lit(level).alias("level"), F.col("at").alias("cell"), "places"))
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return scratch.written(out, "leaves")

    def drop(self) -> None:
        scratch.drop(self.points, *self.levels.values())


def _angle(a: Column) -> Column:
    return 2 * F.asin(F.least(F.sqrt(F.greatest(a, F.lit(0.0))), F.lit(1.0)))


def _at_least() -> Column:
    """The angle between the signal's point (_y, _x: normalised degrees) and the nearest point of the box.

    At one latitude the nearest longitude is the point's own or that of the nearer side; on a meridian the cosine of the angle is
    a cosine of the latitude, so the nearest latitude is the one at its top, or the end of the box next to that.
    """
    turn = F.when(F.col("_x").between(F.col("west"), F.col("east")), F.lit(0.0)).otherwise(F.least(F.pmod(F.col("west") - F.col("_x"), F.lit(360.0)), F.pmod(F.col("_x") - F.col("east"), F.lit(360.0))))
    y, turn = F.radians("_y"), F.radians(turn)
    top = F.degrees(F.atan2(F.sin(y), F.cos(y) * F.cos(turn)))
    at = F.radians(F.greatest(F.col("south"), F.least(F.col("north"), top)))
    return _angle(F.pow(F.sin((at - y) / 2), 2) + F.cos(y) * F.cos(at) * F.pow(F.sin(turn / 2), 2))


def nearest(points: DataFrame, places: DataFrame, leaf: int = LEAF, broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """(_sid, _best: struct of d, the haversine of the angle, and id) for ``points``: _sid, a unique long, and lat, lon, not null."""
    tree = Tree(places, leaf)
    turned = F.cos(F.radians("lat")) < 0  # a latitude beyond a pole is a point on the other side
    x = F.when(turned, F.col("lon") + 180).otherwise(F.col("lon"))
    held = points.select("_sid", "lat", "lon", F.cos(F.radians("lat")).alias("_cos"), F.degrees(F.asin(F.sin(F.radians("lat")))).alias("_y"), (F.pmod(x + 180, F.lit(360.0)) - 180).alias("_x"))
    own = scalar.haversine(F.col("lat"), F.col("lon"), F.col("_cos"), F.col("own.lat"), F.col("own.lon"), F.cos(F.radians("own.lat")))
    cells = {level: scratch.written(tree.opened(level), f"opened-{level}") for level in sorted(tree.levels)}
    signal = ["_sid", "lat", "lon", "_cos", "_y", "_x"]
    front = held.select(*signal, F.lit(-1).cast("long").alias("parent"), F.lit(4.0).alias("_most")).repartition("_sid")
    done, made = [], []
    for level, opened in cells.items():
        if opened.count() <= broadcast_nodes:
            rows = front.join(F.broadcast(opened), "parent")
        else:
            rows = skew.dealt_join(front, opened, ["parent"], skew.hot_keys(front, ["parent"]), F.col("_sid"))
        rows = rows.withColumns({"_lo": _at_least(), "_hi": _angle(own)})
        rows = rows.withColumn("_most", F.least("_most", F.min("_hi").over(Window.partitionBy("_sid")))).where(F.col("_lo") <= F.col("_most") * (1 + 1e-9) + 1e-12)
        step = scratch.written(rows.select(*signal, "_lo", "_most", F.lit(level).alias("level"), "cell", "divided"), f"front-{level}")
        made.append(step)
        done.append(step.where("not divided").drop("divided"))
        front = step.where("divided").select(*signal, F.col("cell").alias("parent"), "_most")
        if front.isEmpty():
            break
    last = done[0]
    for more in done[1:]:
        last = last.unionByName(more)
    least = F.min("_most").over(Window.partitionBy("_sid"))
    last = last.withColumn("_most", least).where(F.col("_lo") <= F.col("_most") * (1 + 1e-9) + 1e-12)
    leaves = tree.leaves()
    on = ["level", "cell"]
    near = F.array_min(F.transform("places", lambda p: F.struct(scalar.haversine(F.col("lat"), F.col("lon"), F.col("_cos"), p["lat"], p["lon"], p["cos"]).alias("d"), p["id"].alias("id"))))
    looked = skew.dealt_join(last.select(*signal, *on), leaves, on, skew.hot_keys(last, on), F.col("_sid")).select("_sid", near.alias("_best"))
    best = scratch.written(looked.groupBy("_sid").agg(F.min("_best").alias("_best")), "nearest")
    tree.drop()
    scratch.drop(leaves, *cells.values(), *made)
    return best
