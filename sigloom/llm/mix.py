"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations alone.

Each source's documents are put into a hash order. A copy of a document gets a
virtual finish time: the words of its source up to and including it, divided by the
source's target. Copies of all sources are range-sorted by that time, and the order
is cut where the total budget, the words of all documents, is used up. A source
whose target exceeds its size goes through its documents again, three times at most.

Running totals are kept distributed. Within a source the hash order is divided into
ranges of the hash, so many that one has about ``BUCKET_ROWS`` rows if all are of one source:
totals per range give each range its offset, and the window inside one range stays small
whatever the input and its sources. ``mix`` range-sorts the copies; ``taken`` needs only the
place of the cut in that order, which is where the running total of the sorted copies passes
the budget: two histograms of the finish time (4,097 rows each at most, whatever the input)
and a window over the one narrow bin where the budget runs out find the same place. The weights
go round the sources in one window over a row per source, fit for millions of sources.

Targets: the sources in code point order, null last, weigh 5, 2, 1, repeating, and
share the total; no target exceeds 3 times its source's size, the excess is shared
again by weight. The limit of that process has a closed form: every target is
min(3 * size, level * weight) for one level, found with a window over the sources.

Defined results: a null text or one without words has size 0 and is taken 0 times;
repeated rows count as separate documents; an empty table gives an empty result;
other columns are ignored by ``taken`` and carried by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import stage

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BUCKET_ROWS = 100_000
WORD = "[^\\x20\\x09-\\x0D]+"
_KEY_BITS = 60
_COARSE, _FINE, _LAST = 1024, 4096, 4096


def _sized(docs: DataFrame, carry: list[Column]) -> DataFrame:
    """Size and place in the hash order, a number of ``_KEY_BITS`` bits; ``carry`` are the other columns to keep."""
    whole = F.concat_ws("\n", *(F.coalesce(c, F.lit("")) for c in (F.col("doc_id").cast("string"), F.col("source").cast("string"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))))
    key = F.conv(F.substring(F.md5(whole), 1, _KEY_BITS // 4), 16, 10).cast("long")
    return docs.select(*carry, F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("_size"), key.alias("_key"))


def _bucket(bits: int) -> Column:
    """The range of the hash, of 2 ** bits."""
    return F.shiftright("_key", _KEY_BITS - bits).cast("int")


def _totals(sized: DataFrame, bits: int) -> DataFrame:
    """Words before each bucket of each source."""
    per = sized.groupBy("_source", _bucket(bits).alias("_bucket")).agg(F.sum("_size").alias("words"))
    w = Window.partitionBy("_source").orderBy("_bucket")
    return per.select("_source", "_bucket", "words", (F.sum("words").over(w) - F.col("words")).alias("before"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """(_source, source_size, target) from (_source, source_size); one small row per source."""
    in_order = Window.orderBy(F.col("_source").asc_nulls_last())
    by_cap = Window.orderBy("cap", F.col("_source").asc_nulls_last())
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int")).cast("double")
    weighed = sizes.withColumn("w", weight).withColumn("cap", repeats * F.col("source_size") / F.col("w"))
    # level if exactly the sources before this one, in order of cap, are capped
    upto = by_cap.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    leveled = weighed.withColumn("rest_w", F.sum("w").over(everything) - F.sum("w").over(upto) + F.col("w")).withColumn(
        "level", (F.sum("source_size").over(everything) - repeats * (F.sum("source_size").over(upto) - F.col("source_size"))) / F.col("rest_w")
    )
    level = F.min(F.when(F.col("level") <= F.col("cap"), F.struct("cap", "level"))).over(everything)["level"]
    return leveled.withColumn("at", level).select(
        "_source", "source_size", F.coalesce(F.least(repeats * F.col("source_size").cast("double"), F.col("at") * F.col("w")), F.lit(0.0)).alias("target")
    )


def _timed(sized: DataFrame, totals: DataFrame, goals: DataFrame, bits: int) -> DataFrame:
    """``sized`` with source_size, target and the source's words up to and including the row."""
    sized = sized.withColumn("_bucket", _bucket(bits))
    t = totals.select(F.col("_source").alias("s1"), F.col("_bucket").alias("b1"), "before")
    g = goals.select(F.col("_source").alias("s2"), "source_size", "target")
    w = Window.partitionBy("_source", "_bucket").orderBy("_key", "_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = sized.withColumn("_inside", F.sum("_size").over(w))
    placed = inside.join(t, F.col("_source").eqNullSafe(F.col("s1")) & (F.col("_bucket") == F.col("b1"))).join(F.broadcast(g) if _few(goals) else g, F.col("_source").eqNullSafe(F.col("s2")))
    return placed.withColumn("_cum", F.col("_inside") + F.col("before")).drop("s1", "b1", "s2", "_inside", "before")


def _few(goals: DataFrame, most: int = 100_000) -> bool:
    """Sources few enough to broadcast."""
    return goals.limit(most + 1).count() <= most


def _finish(copy: int | Column) -> Column:
    """Virtual finish time of a copy (0, 1, 2) of a row."""
    return (F.col("source_size") * copy + F.col("_cum")) / F.col("target")


def _cut(timed: DataFrame, budget: int, repeats: int) -> tuple | None:
    """(finish time, key, id, copy) of the last copy inside the budget; None if there is none."""
    live = timed.where((F.col("target") > 0) & (F.col("_size") > 0))
    copies = live.select("_size", "_key", "_id", F.explode(F.array(*(F.struct(_finish(e).alias("at"), F.lit(e).alias("copy")) for e in range(repeats)))).alias("c")).select("_size", "_key", "_id", "c.at", "c.copy")
    copies = copies.withColumn("b0", F.least(F.floor(F.col("at") * _COARSE), F.lit(_LAST)).cast("int"))

    def crossing(rows: list, used: int) -> tuple[int | None, int]:
        for b, words in sorted((r[0], r[1]) for r in rows):
            if used + words > budget:
                return b, used
            used += words
        return None, used

    b0, used = crossing(copies.groupBy("b0").agg(F.sum("_size")).collect(), 0)  # _LAST + 1 rows at most
    if b0 is None:  # all of it fits
        return (float("inf"), 0, 0, 0)
    within = copies.where(F.col("b0") == b0).withColumn("b1", F.least(F.floor((F.col("at") * _COARSE - b0) * _FINE), F.lit(_FINE)).cast("int"))
    b1, used = crossing(within.groupBy("b1").agg(F.sum("_size")).collect(), used)  # _FINE + 1 rows at most
    order = Window.orderBy("at", "_key", "_id", "copy").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    narrow = within.where(F.col("b1") == b1).withColumn("total", F.sum("_size").over(order) + used)
    last = narrow.where(F.col("total") <= budget).agg(F.max(F.struct("at", "_key", "_id", "copy")).alias("m")).first()["m"]
    if last is None:  # the bin's first copy is too long: everything before the bin
        return ((b0 + b1 / _FINE) / _COARSE, -1, None, -1)
    return tuple(last)


def _copies(cut: tuple, id_type: str, repeats: int) -> Column:
    """How many copies of a row lie at or before the cut."""
    at, key, doc, copy = cut
    inside = lambda e: F.struct(_finish(e), F.col("_key"), F.col("_id"), F.lit(e)) <= F.struct(F.lit(float(at)), F.lit(key).cast("long"), F.lit(doc).cast(id_type), F.lit(copy))
    return sum((F.when((F.col("target") > 0) & (F.col("_size") > 0) & inside(e), 1).otherwise(0) for e in range(repeats)), F.lit(0))


def _plan(docs: DataFrame, weights: tuple[int, ...], repeats: int) -> tuple[DataFrame, DataFrame, DataFrame, int, tuple]:
    mark = stage.tables_made()
    sized = stage.written(_sized(docs, []), "mix-sizes")
    bits = min(24, max(10, (sized.count() // BUCKET_ROWS).bit_length()))
    totals = stage.written(_totals(sized, bits), "mix-totals")
    goals = stage.written(targets(totals.groupBy("_source").agg(F.sum("words").alias("source_size")), weights, repeats), "mix-targets")
    timed = stage.written(_timed(sized, totals, goals, bits), "mix-times")
    budget = goals.agg(F.sum("source_size")).first()[0] or 0
    cut = _cut(timed, int(budget), repeats)
    stage.discard_since(mark, totals, goals, timed)
    return totals, goals, timed, bits, cut


def taken(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken (words, repeats counted), copies."""
    _, _, timed, _, cut = _plan(docs, weights, repeats)
    n = _copies(cut, dict(docs.dtypes)["doc_id"], repeats)
    return timed.withColumn("copies", n).select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * F.col("copies")).cast("long").alias("taken"), "copies")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """The mix itself: the columns of ``docs``, a row per copy, range-sorted by virtual finish time."""
    totals, goals, timed, bits, cut = _plan(docs, weights, repeats)
    stage.discard(timed)
    rows = _timed(_sized(docs, [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")]), totals, goals, bits)
    rows = rows.withColumn("_n", _copies(cut, dict(docs.dtypes)["doc_id"], repeats)).where("_n > 0")
    copies = rows.select("_row", "_key", F.col("source_size"), "target", "_cum", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_copy"))
    timed = copies.select("_row", "_key", "_copy", _finish(F.col("_copy")).alias("_at"))
    return timed.orderBy("_at", "_key", "_copy").select("_row.*")
