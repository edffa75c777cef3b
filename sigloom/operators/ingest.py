"""From delivered pages to stored signals: parse, flatten, bound, deduplicate, map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalar
from ..settings import DEFAULTS


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """``rows`` with a column that is worked out once a row: through a generator, or the optimizer repeats its expression wherever it is used."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def parse_pages(pages: DataFrame, schema: str, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(parsed pages, quarantined pages). A page that isn't valid JSON, or has no alerts array, is quarantined, never lost.

    Parsed pages have ``alerts``, the modelled records, and ``payloads``, the source text of each with every field.
    """
    read = lambda ddl: F.from_json(body, ddl, {"mode": "PERMISSIVE"})
    parsed = once(pages, "_b", F.struct(read(schema).alias("_p"), read("alerts ARRAY<STRING>").alias("_s"))).select("*", "_b.*").drop("_b")
    bad = F.col("_p").isNull() | F.col("_p.alerts").isNull()
    good = parsed.where(~bad).withColumns({"alerts": F.col("_p.alerts"), "nextPage": F.col("_p.nextPage"), "payloads": F.col("_s.alerts")})
    return good.drop("_p", "_s"), parsed.where(bad).drop("_p", "_s")


def flatten(pages: DataFrame, page: str = "page") -> DataFrame:
    """One row per signal in delivery order: (page, pos), the signal's fields, and its ``payload`` where pages have ``payloads``."""
    if "payloads" not in pages.columns:
        return pages.select(page, F.posexplode("alerts").alias("pos", "s")).select(page, "pos", "s.*")
    both = pages.select(page, F.posexplode(F.arrays_zip("alerts", "payloads")).alias("pos", "s"))
    return both.select(page, "pos", "s.alerts.*", F.col("s.payloads").alias("payload"))


def page_cap(signals: DataFrame, cap: int = DEFAULTS.max_pages_per_poll, page: str = "page") -> DataFrame:
    return signals.where(F.col(page) <= cap)


def with_timestamp(signals: DataFrame, text: str = "alertTimestamp") -> DataFrame:
    """Adds ``ts``; records whose timestamp doesn't parse are skipped."""
    return signals.withColumn("ts", scalar.parse_timestamp(F.col(text))).where("ts is not null")


def _stop(signals: DataFrame, since: Column, order: list[str]) -> DataFrame:
    """One row: the place of the first record older than ``since`` (null: none)."""
    return signals.where(F.col("ts") < since).agg(F.min(F.struct(*order)).alias("_stop"))


def take_while(signals: DataFrame, since: Column, order: list[str] | None = None) -> DataFrame:
    """Records before the first, in delivery order, that is older than ``since``.

    The stopping place is one pre-aggregated minimum, so nothing is sorted and no
    partition holds all rows, unlike a running window.
    """
    order = order or ["page", "pos"]
    stop = F.broadcast(_stop(signals, since, order))  # one row
    return signals.join(stop, F.col("_stop").isNull() | (F.struct(*order) < F.col("_stop")), "inner").drop("_stop")


def high_water(signals: DataFrame, since: Column, order: list[str] | None = None) -> DataFrame:
    """(latest): the newest timestamp seen, the record that stops the scan included."""
    order = order or ["page", "pos"]
    stop = F.broadcast(_stop(signals, since, order))
    return signals.join(stop, F.col("_stop").isNull() | (F.struct(*order) <= F.col("_stop"))).agg(F.max("ts").alias("latest"))


def first_seen(signals: DataFrame, key: str = "alertId", order: list[str] | None = None) -> DataFrame:
    """The first record of each key in delivery order.

    A pre-aggregated minimum per key, not a window: a key with a third of all rows leaves
    one row per task before the shuffle.
    """
    order = order or ["page", "pos"]
    rest = [c for c in signals.columns if c != key]
    picked = signals.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return picked.select(key, "_r.*").select(*signals.columns)


def unseen(signals: DataFrame, seen: DataFrame, key: str = "alertId") -> DataFrame:
    return signals.join(seen.select(key).distinct(), key, "left_anti")


def sync_start(last_synced: Column, latest_stored: Column, now: Column, lookback_days: int = DEFAULTS.initial_lookback_days) -> Column:
    return F.coalesce(last_synced, latest_stored, now - F.expr(f"interval {lookback_days} days"))


def map_signals(signals: DataFrame, source_id: Column, origin_id: Column | None = None) -> DataFrame:
    """The stored signal. rawData is the modelled record with explicit nulls, payload its source text where there is one."""
    modelled = [c for c in signals.columns if c not in ("page", "pos", "ts", "payload")]
    return signals.select(
        F.col("alertId"),
        source_id.alias("sourceId"),
        F.to_json(F.struct(*modelled), {"ignoreNullFields": "false"}).alias("rawData"),
        F.col("alertTimestamp").alias("publishedAt"),
        scalar.none_if_empty(F.col("publicPost.href")).alias("url"),
        F.col("headline").alias("title"),
        scalar.description().alias("description"),
        (F.lit(None).cast("string") if origin_id is None else origin_id).alias("originId"),
        scalar.coordinate(F.col("estimatedEventLocation.coordinates"), 0).alias("lat"),
        scalar.coordinate(F.col("estimatedEventLocation.coordinates"), 1).alias("lon"),
        *(["payload"] if "payload" in signals.columns else []),
    )


def source_id(sources: DataFrame, name: str) -> DataFrame:
    """(sourceId) of the source with that name, the first by id; fails when it is read if there is none."""
    found = sources.where(F.col("name") == name).agg(F.min("id").alias("sourceId"))
    return found.select(F.coalesce("sourceId", F.raise_error(F.lit(f"no data source named {name}")).cast("string")).alias("sourceId"))


def from_legacy(signals: DataFrame) -> DataFrame:
    """The earlier payload under today's names: epoch milliseconds, a location array, five renames."""
    return signals.select(
        scalar.iso_format(F.timestamp_millis("eventTime")).alias("alertTimestamp"),
        F.col("firstAlertURL").alias("alertUrl"),
        F.struct(F.col("publicPost.link").alias("href")).alias("publicPost"),
        F.col("alertLists").alias("listsMatched"),
        F.transform("linkedAlerts", lambda x: F.struct(x["parentId"].alias("parentAlertId"))).alias("linkedAlerts"),
        F.struct(
            F.get("estimatedEventLocation", F.lit(0)).alias("name"),
            F.when(F.size("estimatedEventLocation") >= 3, F.array(F.get("estimatedEventLocation", F.lit(1)).cast("double"), F.get("estimatedEventLocation", F.lit(2)).cast("double"))).alias("coordinates"),
            F.get("estimatedEventLocation", F.lit(3)).cast("double").alias("probabilityRadius"),
            F.get("estimatedEventLocation", F.lit(4)).alias("MGRS"),
        ).alias("estimatedEventLocation"),
    )


def running_take_while(signals: DataFrame, since: Column, order: list[str] | None = None) -> DataFrame:
    """The same as ``take_while`` as a running window, per key where one is given first; for comparison in tests."""
    w = Window.orderBy(*(order or ["page", "pos"])).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return signals.withColumn("_s", F.max(F.when(F.col("ts") < since, 1).otherwise(0)).over(w)).where("_s = 0").drop("_s")
