"""Test signals derived from the given tables, once in Spark and once in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import table

SINCE = "2024-01-05 00:00:00"

#: events as delivered: newest first, 100 per page, every seventh twice
DELIVERED_SQL = """
  with top as (select max(event_id) as m from events),
  one as (select *, (select m from top) - event_id as r from events),
  delivered as (
    select 'a' || event_id as alertId, event_id, ts, user_id, event_type, value, r // 100 + 1 as page, (r % 100) * 2 as pos from one
    union all
    select 'a' || event_id, event_id, ts, user_id, event_type, value, r // 100 + 1, (r % 100) * 2 + 1 from one where event_id % 7 = 0
  )
"""


def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    top = F.broadcast(events.agg(F.max("event_id").alias("m")))
    one = events.join(top).withColumn("r", F.col("m") - F.col("event_id"))
    place = lambda dup: [F.concat(F.lit("a"), F.col("event_id")).alias("alertId"), "event_id", "ts", "user_id", "event_type", "value", (F.floor(F.col("r") / 100) + 1).cast("long").alias("page"), (F.col("r") % 100 * 2 + dup).cast("long").alias("pos")]
    return one.select(*place(0)).unionByName(one.where("event_id % 7 = 0").select(*place(1)))


#: the rule scores of a signal
SCORED = {"relevance": "least(value / 50.0, 1.0)", "severity": "cast(least(5, 1 + floor(value / 40)) as int)"}


def scored(signals: DataFrame) -> DataFrame:
    return signals.withColumns({k: F.expr(v) for k, v in SCORED.items()})


def stamp(column: str) -> str:
    """SQL (DuckDB) text of a timestamp; ``stamped`` is its Spark form."""
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def stamped(column: str):  # noqa: ANN201
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested signals made from the whole texts of documents, with every kind of missing part."""
    d = table(spark, sf_dir, "documents")
    columns = [
        "doc_id",
        "concat('a', doc_id) as alertId",
        "case when doc_id % 11 = 0 then 'not a time' when doc_id % 7 = 0 then concat('2024-03-', lpad(cast(doc_id % 28 + 1 as string), 2, '0'), 'T10:20:30+02:00') else concat('2024-03-', lpad(cast(doc_id % 28 + 1 as string), 2, '0'), 'T10:20:30.250Z') end as alertTimestamp",
        "if(doc_id % 13 = 0, null, text) as headline",
        "named_struct('title', case doc_id % 4 when 0 then null when 1 then '' else lang end, 'subHeadlines', case doc_id % 3 when 0 then null when 1 then '' else source end) as subHeadline",
        "named_struct('href', case doc_id % 5 when 0 then '' when 1 then null else concat('https://n.example/', doc_id) end, 'text', if(doc_id % 7 = 0, null, text), 'translatedText', if(doc_id % 2 = 0, null, text), 'media', cast(null as array<string>)) as publicPost",
        "named_struct('name', if(doc_id % 6 = 0, '', lang), 'coordinates', slice(array((doc_id * 37 % 1700) / 10.0D - 85, (doc_id * 91 % 3500) / 10.0D - 175, 0.0D), 1, cast(doc_id % 4 as int)), 'probabilityRadius', cast(null as double), 'MGRS', cast(null as string)) as estimatedEventLocation",
        "if(doc_id % 3 = 2, null, array(named_struct('summary', array(named_struct('title', 't', 'content', if(doc_id % 3 = 0, array(text, 'second'), cast(array() as array<string>))))))) as intelAgents",
        "if(doc_id % 5 = 2, named_struct('summary', array(named_struct('content', source), named_struct('content', ''))), null) as eventCorroboration",
        "if(doc_id % 4 = 3, array(named_struct('summary', lang), named_struct('summary', cast(null as string))), cast(array() as array<struct<summary: string>>)) as liveBrief",
    ]
    return d.selectExpr(*columns)


#: the parts of ``signals`` as plain columns
SIGNALS_SQL = """
  with sig as (
    select doc_id, 'a' || doc_id as alertId,
      case when doc_id % 11 = 0 then 'not a time' when doc_id % 7 = 0 then '2024-03-' || lpad(cast(doc_id % 28 + 1 as varchar), 2, '0') || 'T10:20:30+02:00' else '2024-03-' || lpad(cast(doc_id % 28 + 1 as varchar), 2, '0') || 'T10:20:30.250Z' end as alertTimestamp,
      case when doc_id % 13 = 0 then null else text end as headline,
      case doc_id % 4 when 0 then null when 1 then '' else lang end as sub_title,
      case doc_id % 3 when 0 then null when 1 then '' else source end as sub_text,
      case doc_id % 5 when 0 then '' when 1 then null else 'https://n.example/' || doc_id end as href,
      case when doc_id % 7 = 0 then null else text end as post,
      case when doc_id % 2 = 0 then null else text end as translated,
      case when doc_id % 6 = 0 then '' else lang end as place,
      case when doc_id % 4 >= 2 then cast(doc_id * 37 % 1700 as double) / 10.0 - 85 end as lat,
      case when doc_id % 4 >= 2 then cast(doc_id * 91 % 3500 as double) / 10.0 - 175 end as lon,
      case when doc_id % 3 = 0 then text end as intel,
      case when doc_id % 5 = 2 then source end as corroboration,
      case when doc_id % 4 = 3 then lang end as brief
    from documents
  )
"""
#: the labels of the lines are fixed values
RAW_CONTEXT_SQL = "coalesce(nullif(concat_ws(chr(10), 'Post text: ' || nullif(post, ''), 'Translated: ' || nullif(translated, ''), 'Intel: ' || intel, 'Corroboration: ' || nullif(corroboration, ''), 'Brief: ' || nullif(brief, '')), ''), '(no additional context)')"


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations (level 1) and regions (level 0) with made-up coordinates."""
    nations = table(spark, sf_dir, "nation").selectExpr("concat('n', lpad(cast(n_nationkey as string), 3, '0')) as id", "n_name as name", "1 as level", "cast(n_nationkey as long) as pos", "cast(n_nationkey * 17 % 160 as double) - 79.5 as lat", "cast(n_nationkey * 29 % 340 as double) - 169.75 as lon")
    regions = table(spark, sf_dir, "region").selectExpr("concat('r', lpad(cast(r_regionkey as string), 3, '0')) as id", "r_name as name", "0 as level", "cast(100 + r_regionkey as long) as pos", "cast(r_regionkey * 31 % 160 as double) - 70.5 as lat", "cast(r_regionkey * 67 % 340 as double) - 160.25 as lon")
    return nations.unionByName(regions)


LOCATIONS_SQL = """
  loc as (
    select 'n' || lpad(cast(n_nationkey as varchar), 3, '0') as id, n_name as name, 1 as level, n_nationkey as pos, cast(n_nationkey * 17 % 160 as double) - 79.5 as lat, cast(n_nationkey * 29 % 340 as double) - 169.75 as lon from nation
    union all
    select 'r' || lpad(cast(r_regionkey as varchar), 3, '0'), r_name, 0, 100 + r_regionkey, cast(r_regionkey * 31 % 160 as double) - 70.5, cast(r_regionkey * 67 % 340 as double) - 160.25 from region
  )
"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id", "event_type", "ts", "cast(event_id * 7919 % 17000 as double) / 100.0 - 85 as lat", "cast(event_id * 104729 % 35000 as double) / 100.0 - 175 as lon")


POINTS_SQL = "pts as (select event_id, event_type, ts, cast(event_id * 7919 % 17000 as double) / 100.0 - 85 as lat, cast(event_id * 104729 % 35000 as double) / 100.0 - 175 as lon from events)"


def types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five disaster types, one per event type."""
    return table(spark, sf_dir, "events").select("event_type").distinct().select(F.upper(F.substring("event_type", 1, 2)).alias("glideNumber"), F.col("event_type").alias("disasterType"), F.when(F.length("event_type") % 2 == 0, "natural").alias("disasterClass"))


TYPES_SQL = "(select distinct upper(substring(event_type, 1, 2)) as code, event_type as name, case when length(event_type) % 2 = 0 then 'natural' end as class from events)"
