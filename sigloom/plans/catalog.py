"""The engine's queries, named by the operators they exercise."""

from __future__ import annotations

import contextlib
import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import prompts, scalar
from ..operators import events as ev
from ..operators import geo, ingest, memo, model, phrases, polygons, store, validate
from ..settings import DEFAULTS
from ..sources import tables
from ..sources.scratch import new_folder as scratch
from ..sources.versions import VersionedTable
from ..streaming import chain
from ..streaming import events as stream_events
from ..streaming import ingest as stream
from . import signals as S
from .registry import ORACLES, QUERIES, query, table

KEPT_SQL = f"""{S.DELIVERED_SQL}, stopped as (select min(page * 1000000 + pos) as stop from delivered where ts < timestamp '{S.SINCE}'),
  kept as (select delivered.* from delivered, stopped where stop is null or page * 1000000 + pos < stop)"""


def since() -> Column:
    return F.lit(S.SINCE).cast("timestamp_ntz")


# --- sources and sinks -----------------------------------------------------------------------


@query("s1_s13_page_files", S.DELIVERED_SQL + "select page, pos, alertId from (select page, row_number() over (partition by page order by pos) - 1 as pos, alertId from delivered)")
def s1(spark: SparkSession, sf: str) -> DataFrame:
    """Pages written as JSON and read by the page source, flattened to rows in delivery order."""
    path = scratch(spark, "pages")
    alerts = S.delivered(spark, sf).groupBy("page").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "alertId"))), lambda x: F.struct(x["alertId"].alias("alertId"))).alias("alerts"))
    alerts.write.json(path)
    pages = spark.read.schema("page LONG, alerts ARRAY<STRUCT<alertId: STRING>>").json(path)
    return ingest.flatten(pages).select("page", F.col("pos").cast("long").alias("pos"), "alertId")


@query("s4_latest_signal", "select max(strftime(ts, '%Y-%m-%dT%H:%M:%SZ')) as latest_text, strftime(max(date_trunc('second', ts)), '%Y-%m-%d %H:%M:%S.%f') as latest from events")
def s4(spark: SparkSession, sf: str) -> DataFrame:
    stored = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"))
    return tables.latest_published(stored).select("latest_text", S.stamped("latest").alias("latest"))


@query("s6_locations_scan", "with " + S.LOCATIONS_SQL + "select id, name, level, lat, lon from loc")
def s6(spark: SparkSession, sf: str) -> DataFrame:
    return S.locations(spark, sf).drop("pos")


@query("s5_events_scan", f"""
  select 'e' || o_orderkey as id, nullif(o_orderstatus, 'F') as title, o_orderpriority as types, {S.stamp('o_orderdate')} as validFrom,
    coalesce(case when o_orderkey % 3 = 0 then c.c_name end, case when o_orderkey % 2 = 0 then n.n_name end, r.r_name) as shown,
    'c' || c_custkey as origin_id, case when o_orderkey % 2 = 0 then 'n' || n_nationkey end as destination_id
  from orders join customer c on o_custkey = c_custkey join nation n on c_nationkey = n_nationkey join region r on n_regionkey = r_regionkey""")
def s5(spark: SparkSession, sf: str) -> DataFrame:
    """Events stored with their three locations and read back whole: every event is active, as it was meant."""
    path = scratch(spark, "events")
    place = lambda i, name: F.struct(i.cast("string").alias("id"), name.alias("name"))
    joined = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    stored = joined.select(
        F.concat(F.lit("e"), "o_orderkey").alias("id"), F.array().cast("array<string>").alias("signalIds"), F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("title"), F.col("o_orderdate").cast("timestamp").alias("validFrom"), F.array("o_orderpriority").alias("types"),
        place(F.concat(F.lit("c"), "c_custkey"), F.when(F.col("o_orderkey") % 3 == 0, F.col("c_name"))).alias("originLocation"),
        F.when(F.col("o_orderkey") % 2 == 0, place(F.concat(F.lit("n"), "n_nationkey"), F.col("n_name"))).alias("destinationLocation"),
        place(F.concat(F.lit("r"), "r_regionkey"), F.col("r_name")).alias("generalLocation"),
    )
    stored.write.parquet(path)
    events = tables.read_or_empty(spark, path, schemas.EVENT)
    shown = scalar.first_name(F.col("originLocation.name"), F.col("destinationLocation.name"), F.col("generalLocation.name"))
    return events.select("id", "title", F.array_join("types", ",").alias("types"), S.stamped("validFrom").alias("validFrom"), shown.alias("shown"), F.col("originLocation.id").alias("origin_id"), F.col("destinationLocation.id").alias("destination_id"))


@query("s7_f7_source_lookup", "select min('s' || s_suppkey) as sourceId from supplier where s_name = (select min(s_name) from supplier)")
def s7(spark: SparkSession, sf: str) -> DataFrame:
    sources = table(spark, sf, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("id"), F.col("s_name").alias("name"))
    return ingest.source_id(sources, sources.agg(F.min("name")).first()[0])


@query("s8_disaster_types", f"select code as glideNumber, name as disasterType, class as disasterClass from {S.TYPES_SQL}")
def s8(spark: SparkSession, sf: str) -> DataFrame:
    return S.types(spark, sf)


@query("s9_signal_sink_replay", "select count(*) as n, count(distinct event_id) as n_ids from events")
def s9(spark: SparkSession, sf: str) -> DataFrame:
    """Two micro-batches, the second sent twice, and an append of rows already there."""
    path, rows = scratch(spark, "signals"), table(spark, sf, "events").select("event_id", "ts")
    tables.append_once(rows.where("event_id % 2 = 0"), path, 0)
    tables.append_once(rows.where("event_id % 2 = 1"), path, 1)
    tables.append_once(rows.where("event_id % 2 = 1"), path, 1)
    other = scratch(spark, "signals")
    tables.append_new(spark.read.parquet(path).select("event_id", "ts"), other, "event_id")
    tables.append_new(rows, other, "event_id")
    return spark.read.parquet(other).agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("n_ids"))


@query("s10_s11_event_updates", "select o_orderkey as id, case when o_orderkey % 3 = 0 then 'late' else o_orderstatus end as title, o_totalprice as rank from orders")
def s11(spark: SparkSession, sf: str) -> DataFrame:
    """Events inserted, then some partly updated; the view takes each column's newest value."""
    path, orders = scratch(spark, "events"), table(spark, sf, "orders")
    tables.append_version(orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("title"), F.col("o_totalprice").alias("rank")), path, 1)
    tables.append_version(orders.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("id"), F.lit("late").alias("title"), F.lit(None).cast("double").alias("rank")), path, 2)
    return tables.latest(spark, path, "id").select("id", "title", "rank")


@query("s11_versioned_events", "select o_orderkey as id, case when o_orderkey % 7 = 6 then 'late' when o_orderkey % 2 = 0 then o_orderstatus end as title, case when o_orderkey % 7 in (2, 5) then -1.0 else o_totalprice end as rank from orders")
def s11_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Events inserted, then updated in part in many versions, one of them twice; merged on the way."""
    orders, events = table(spark, sf, "orders"), VersionedTable(spark, scratch(spark, "versions"), "id", most=3)
    events.update(orders.select(F.col("o_orderkey").alias("id"), F.expr("if(o_orderkey % 2 = 0, o_orderstatus, null)").alias("title"), F.col("o_totalprice").alias("rank")), 0)
    for version in (1, 2, 3, 3, 4, 5, 2, 6):
        some = orders.where(F.col("o_orderkey") % 7 == version)
        events.update(some.select(F.col("o_orderkey").alias("id"), F.lit("late" if version == 6 else None).cast("string").alias("title"), F.lit(-1.0 if version in (2, 5) else None).cast("double").alias("rank")), version)
    return events.read().select("id", "title", "rank")


@query("s12_alert_sink", S.DELIVERED_SQL + "select 'e' || event_id as event_id, 'draft' as status from delivered where least(5, 1 + floor(value / 40)) >= 4 group by event_id")
def s12(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "alerts")
    severe = ev.severe(S.scored(S.delivered(spark, sf)).withColumn("event_id", F.concat(F.lit("e"), F.col("event_id"))))
    tables.append_new(ev.alerts(severe), path, "event_id")
    return spark.read.parquet(path)


# --- projections ------------------------------------------------------------------------------


@query("p1_p2_parse_flatten", "select doc_id // 50 as page, doc_id % 50 as pos, 'a' || doc_id as alertId, case when doc_id % 13 = 0 then null else text end as headline from documents")
def p1(spark: SparkSession, sf: str) -> DataFrame:
    return _flattened(S.signals(spark, sf))


def _flattened(signals: DataFrame) -> DataFrame:
    spark = signals.sparkSession
    rows = signals.withColumn("page", F.floor(F.col("doc_id") / 50))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("doc_id", F.struct("alertId", "alertTimestamp", "headline", "publicPost").alias("s")))), lambda x: x["s"])
    pages = rows.groupBy("page").agg(F.to_json(F.struct(ordered.alias("alerts"), F.lit("x").alias("nextPage"))).alias("body"))
    good, _ = ingest.parse_pages(pages.unionByName(spark.sql("select cast(-1 as bigint) as page, '{broken' as body")), schemas.page_ddl("alertUrl"))
    return ingest.flatten(good).select(F.col("page").cast("long").alias("page"), F.col("pos").cast("long").alias("pos"), "alertId", "headline")


#: doc_id modulo 10 -> a part of the record's JSON, and what is wrong with it
FAULTS = {
    0: ('"headline": {"t": 1}', "type headline"), 1: ('"headline": 5', "type headline"), 2: ('"estimatedEventLocation": {"coordinates": ["1.5", "x"]}', "type estimatedEventLocation.coordinates[]"),
    3: ('"estimatedEventLocation": {"coordinates": ["1.5", 2]}', None), 4: ('"alertId": null', "missing alertId"), 5: ('"linkedAlerts": [{"count": 2.5}]', "type linkedAlerts[].count"), 6: ('"publicPost": "p"', "type publicPost"),
}


@query("p1_x10_record_faults", "with r as (select doc_id // 50 as page, case doc_id % 10 " + " ".join(f"when {k} then '{v or 'good'}'" for k, (_, v) in FAULTS.items()) + " else 'good' end as reason, case when doc_id % 10 = 3 then 1.5 end as lat from documents) select page, reason, count(*) as n, sum(lat) as lat from r group by page, reason")
def p1_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with faults of each kind in some records: the others are delivered, the faults are counted by reason."""
    rows = table(spark, sf, "documents").withColumn("page", F.floor(F.col("doc_id") / 50))
    part = F.lit("")
    for k, (text, _) in FAULTS.items():
        part = F.when(F.col("doc_id") % 10 == k, F.lit(", " + text)).otherwise(part)
    whole = F.to_json(F.struct(F.when(F.col("doc_id") % 10 != 4, F.concat(F.lit("a"), "doc_id")).alias("alertId"), F.lit("2024-01-01T00:00:00Z").alias("alertTimestamp"), F.when(F.col("doc_id") % 10 > 1, F.col("text")).alias("headline")))
    record = F.concat(F.rtrim(whole, F.lit("}")), part, F.lit("}"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("doc_id", record.alias("s")))), lambda x: x["s"])
    pages = rows.groupBy("page").agg(F.concat(F.lit('{"alerts": ['), F.array_join(ordered, ","), F.lit("]}")).alias("body"))
    good, rejected, _ = validate.records(pages, schemas.page_ddl("alertUrl"))
    counts = good.select("page", F.lit("good").alias("reason"), scalar.coordinate(F.col("estimatedEventLocation.coordinates"), 0).alias("lat")).unionByName(rejected.select("page", F.explode("reasons").alias("reason"), F.lit(None).cast("double").alias("lat")))
    return counts.groupBy(F.col("page").cast("long").alias("page"), "reason").agg(F.count("*").alias("n"), F.sum("lat").alias("lat"))


_MAPPED_SQL = "select alertId, 'src' as sourceId, alertTimestamp as publishedAt, nullif(href, '') as url, headline as title, nullif(concat_ws(' — ', nullif(sub_title, ''), nullif(sub_text, '')), '') as description, headline as raw_headline, lat, lon from sig"


@query("p3_p4_p5_p6_p7_signal_mapping", S.SIGNALS_SQL + _MAPPED_SQL)
def p3(spark: SparkSession, sf: str) -> DataFrame:
    return _mapped(S.signals(spark, sf))


def _mapped(signals: DataFrame) -> DataFrame:
    mapped = ingest.map_signals(signals.drop("doc_id"), F.lit("src"))
    return mapped.select("alertId", "sourceId", "publishedAt", "url", "title", "description", F.get_json_object("rawData", "$.headline").alias("raw_headline"), "lat", "lon")


@query("p6_payload", "select doc_id // 50 as page, doc_id % 50 as pos, 'a' || doc_id as alertId, 'https://own.example/' || doc_id as own_link, cast(null as varchar) as other_link, lang as extra, text as headline, text as payload_headline from documents")
def p6(spark: SparkSession, sf: str) -> DataFrame:
    """Stored signals keep every field of the source text, and the alert's own link under the name it has there."""
    rows = table(spark, sf, "documents").withColumn("page", F.floor(F.col("doc_id") / 50))
    record = F.struct(F.concat(F.lit("a"), "doc_id").alias("alertId"), F.concat(F.lit("https://own.example/"), "doc_id").alias("ownLink"), F.col("lang").alias("notModelled"), F.col("text").alias("headline"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("doc_id", record.alias("s")))), lambda x: x["s"])
    pages = rows.groupBy("page").agg(F.to_json(F.struct(ordered.alias("alerts"))).alias("body"))
    found = {}
    for link in ("ownLink", "otherLink"):
        good, _ = ingest.parse_pages(pages, schemas.page_ddl(link))
        found[link] = ingest.flatten(good)
    own = found["ownLink"]
    mapped = ingest.map_signals(own.drop("page", "pos"), F.lit("src")).select("alertId", "rawData", "payload")
    other = found["otherLink"].select("alertId", "otherLink")
    joined = own.select(F.col("page").cast("long").alias("page"), F.col("pos").cast("long").alias("pos"), "alertId", "headline").join(mapped, "alertId").join(other, "alertId")
    return joined.select("page", "pos", "alertId", F.get_json_object("rawData", "$.ownLink").alias("own_link"), F.col("otherLink").alias("other_link"), F.get_json_object("payload", "$.notModelled").alias("extra"), "headline", F.get_json_object("payload", "$.headline").alias("payload_headline"))


@query("p8_o3_o4_raw_context", S.SIGNALS_SQL + f"select alertId, substring({S.RAW_CONTEXT_SQL}, 1, 2000) as raw_context from sig")
def p8(spark: SparkSession, sf: str) -> DataFrame:
    return S.signals(spark, sf).select("alertId", scalar.raw_context(limit=DEFAULTS.raw_context_chars).alias("raw_context"))


@query("p9_p10_location_names", "select doc_id, nullif(case when doc_id % 6 = 0 then '' else lang end, '') as name, coalesce(case when doc_id % 3 = 0 then lang end, nullif(case when doc_id % 2 = 0 then '' else source end, ''), case when doc_id % 5 = 0 then 'general' end, '(unknown)') as shown from documents")
def p10(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    origin, destination, general = F.expr("if(doc_id % 3 = 0, lang, null)"), F.expr("if(doc_id % 2 = 0, '', source)"), F.expr("if(doc_id % 5 = 0, 'general', null)")
    return d.select("doc_id", scalar.none_if_empty(F.expr("if(doc_id % 6 = 0, '', lang)")).alias("name"), scalar.first_name(origin, destination, general, default="(unknown)").alias("shown"))


@query("p11_w3_x3_x4_new_events", f"select sha256('event/a' || event_id) as event_id, 'a' || event_id as signal_id, event_type as title, {S.stamp('ts')} as validFrom, {S.stamp('ts + interval 7 days')} as validTo, case when event_id % 3 = 0 then 'm' else event_type end as types, cast(least(5, 1 + floor(value / 40)) as int) / 5.0 as rank from events")
def p11(spark: SparkSession, sf: str) -> DataFrame:
    rows = S.scored(table(spark, sf, "events")).select(F.concat(F.lit("a"), F.col("event_id")).alias("signal_id"), F.col("event_type").alias("title"), "ts", "severity", F.expr("if(event_id % 3 = 0, array('m'), array())").cast("array<string>").alias("event_types"), F.array("event_type").alias("disaster_types"))
    out = ev.new_events(rows)
    return out.select("event_id", F.col("signalIds")[0].alias("signal_id"), "title", S.stamped("validFrom").alias("validFrom"), S.stamped("validTo").alias("validTo"), F.array_join("types", ",").alias("types"), "rank")


def _request_sql(task: str, slots: dict[str, str]) -> str:
    """SQL of a request's text; ``slots`` are SQL expressions."""
    constant = prompts.head(task).replace("'", "''")
    return f"'{constant}' || cast(to_json(struct_pack({', '.join(f'{k} := {v}' for k, v in slots.items())})) as varchar) || '}}'"


def _or_sql(value: str, default: str) -> str:
    return f"coalesce(nullif({value}, ''), '{default}')"


_CLASSIFY_SQL = _request_sql("classify", {
    "title": _or_sql("headline", prompts.NO_TITLE), "description": _or_sql("headline", prompts.NO_DESCRIPTION), "location": _or_sql("place", prompts.NO_LOCATION), "url": _or_sql("href", prompts.NO_URL), "time": "alertTimestamp",
    "context": f"substring({S.RAW_CONTEXT_SQL}, 1, 2000)", "types": f"(select list(struct_pack(code := code, name := name, class := class) order by code, name) from {S.TYPES_SQL})",
})


@query("p12_j6_classify_prompt", S.SIGNALS_SQL + f"select alertId, sha256({_CLASSIFY_SQL}) as prompt_sha from sig")
def p12(spark: SparkSession, sf: str) -> DataFrame:
    signals = S.signals(spark, sf)
    dims = F.broadcast(S.types(spark, sf).agg(F.sort_array(F.collect_list(F.struct("glideNumber", "disasterType", "disasterClass"))).alias("types")))  # the dimension of types: tens of rows
    text = prompts.classify(F.col("headline"), F.col("headline"), F.col("estimatedEventLocation.name"), F.col("publicPost.href"), F.col("alertTimestamp"), scalar.raw_context(), F.col("types"))
    return signals.join(dims).select("alertId", F.sha2(text, 256).alias("prompt_sha"))


_ASSESS_SQL = _request_sql("assess", {
    "title": "lang", "description": f"'{prompts.NO_DESCRIPTION}'", "types": "'FL'", "location": "source", "signals": "cast(1 as bigint)", "severity": "doc_id % 5 + 1", '"from"': "'a'", "\"to\"": "'b'",
    "summaries": "case when doc_id % 4 = 0 then cast([] as varchar[]) else ['one', text] end",
})


@query("p14_assess_prompt", f"select doc_id, sha256({_ASSESS_SQL}) as prompt_sha from documents")
def p14(spark: SparkSession, sf: str) -> DataFrame:
    summaries = F.expr("if(doc_id % 4 = 0, array(), array('one', text))").cast("array<string>")
    text = prompts.assess(F.col("lang"), F.lit(None).cast("string"), F.array(F.lit("FL")), F.col("source"), F.lit(1), F.col("doc_id") % 5 + 1, F.lit("a"), F.lit("b"), summaries)
    return table(spark, sf, "documents").select("doc_id", F.sha2(text, 256).alias("prompt_sha"))


@query("p15_results", S.DELIVERED_SQL + ", each as (select distinct event_id, value from delivered), sc as (select 'a' || event_id as signal_id, event_id, least(value / 50.0, 1.0) as relevance, cast(least(5, 1 + floor(value / 40)) as int) as severity from each) select signal_id, relevance, severity, case when relevance >= 0.5 then 'e' || event_id end as event_id, case when relevance >= 0.5 and severity >= 4 then 'x' || event_id end as alert_id from sc")
def p15(spark: SparkSession, sf: str) -> DataFrame:
    scored = S.scored(table(spark, sf, "events")).select(F.concat(F.lit("a"), F.col("event_id")).alias("signal_id"), F.col("event_id").alias("i"), "relevance", "severity")
    grouped = ev.relevant(scored).withColumn("event_id", F.concat(F.lit("e"), F.col("i")))
    made = ev.severe(grouped).select("event_id", F.concat(F.lit("x"), F.col("i")).alias("alert_id"))
    return ev.results(scored, grouped, made)


@query("p16_x11_next_url", "select page_id, case when page_id % 5 = 0 then null when page_id % 5 = 1 then url when page_id % 5 = 2 then 'https://api.example/feed/v1/alerts?c=' || page_id when page_id % 5 = 3 then 'https://api.example/feed/v2?c=' || page_id else 'https://api.example/feed/alerts?nextPage=c' || page_id end as next_url from pages")
def p16(spark: SparkSession, sf: str) -> DataFrame:
    given = F.expr("case page_id % 5 when 0 then null when 1 then url when 2 then concat('/v1/alerts?c=', page_id) when 3 then concat('/feed/v2?c=', page_id) else concat('c', page_id) end")
    return table(spark, sf, "pages").select("page_id", scalar.next_url(given, "https://api.example", "/feed", "https://api.example/feed/alerts").alias("next_url"))


# --- filters ----------------------------------------------------------------------------------


@query("f1_x1_parse_time", S.SIGNALS_SQL + f"select alertId, {S.stamp('cast(alertTimestamp as timestamptz) at time zone ' + chr(39) + 'UTC' + chr(39))} as ts from sig where alertTimestamp <> 'not a time'")
def f1(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.with_timestamp(S.signals(spark, sf)).select("alertId", S.stamped("ts").alias("ts"))


_FORMS = ("yyyyMMdd'T'HHmmss'Z'", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss,SSS")


@query("x1_timestamp_forms", f"""with t as (select event_id, date_trunc('millisecond', ts) as ts, event_id % 8 as k from events)
  select event_id, case k when 0 then strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') when 1 then strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S.%f') when 2 then strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S.%f')
    when 3 then {S.stamp('ts')} when 4 then strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S.%f') when 5 then strftime(date_trunc('second', ts) - interval 5 hours - interval 30 minutes, '%Y-%m-%d %H:%M:%S.%f') when 6 then strftime(date_trunc('day', ts) - interval 12 hours, '%Y-%m-%d %H:%M:%S.%f') end as ts from t""")
def x1(spark: SparkSession, sf: str) -> DataFrame:
    """The same instants in basic, shortened, week and offset forms, and one that is none."""
    k, day = F.col("event_id") % 8, F.expr("extract(dayofweek_iso from ts)")
    week = F.concat(F.expr("extract(yearofweek from ts)"), F.lit("-W"), F.lpad(F.expr("extract(week from ts)").cast("string"), 2, "0"), F.lit("-"), day)
    form = F.when(k == 4, week).when(k == 5, F.concat(F.date_format("ts", "yyyyMMdd'T'HHmmss"), F.lit("+0530"))).when(k == 6, F.concat(week, F.lit("T00+12"))).when(k == 7, F.date_format("ts", "yyyy-MM"))
    for i, java in enumerate(_FORMS):
        form = F.when(k == i, F.date_format("ts", java)).otherwise(form)
    return table(spark, sf, "events").select("event_id", S.stamped(scalar.parse_timestamp(form)).alias("ts"))


@query("f2_o1_take_while", KEPT_SQL + "select page, pos, alertId from kept")
def f2(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.take_while(S.delivered(spark, sf), since()).select("page", "pos", "alertId")


@query("f3_page_cap", S.DELIVERED_SQL + "select page, count(*) as n from delivered where page <= 50 group by page")
def f3(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.page_cap(S.delivered(spark, sf)).groupBy("page").agg(F.count("*").alias("n"))


@query("f4_relevance_gate", "select event_id, least(value / 50.0, 1.0) as relevance from events where least(value / 50.0, 1.0) >= 0.5")
def f4(spark: SparkSession, sf: str) -> DataFrame:
    return ev.relevant(S.scored(table(spark, sf, "events"))).select("event_id", "relevance")


@query("f5_severity_gate", "select 'e' || event_id as event_id, cast(least(5, 1 + floor(value / 40)) as int) as severity from events where event_id % 5 <> 0 and least(5, 1 + floor(value / 40)) >= 4")
def f5(spark: SparkSession, sf: str) -> DataFrame:
    rows = S.scored(table(spark, sf, "events")).withColumn("event_id", F.expr("if(event_id % 5 = 0, null, concat('e', event_id))"))
    return ev.severe(rows).select("event_id", "severity")


@query("f6_u3_alert_gate", "select user_id, event_type, count(*) as n_signals, max(cast(least(5, 1 + floor(value / 40)) as int)) as max_severity, 'draft' as status from events group by all having max(least(5, 1 + floor(value / 40))) >= 4 and count(*) >= 3")
def f6(spark: SparkSession, sf: str) -> DataFrame:
    grouped = S.scored(table(spark, sf, "events")).groupBy("user_id", "event_type").agg(F.count("*").alias("n_signals"), F.max("severity").alias("max_severity"))
    return ev.assess(grouped, min_signals=3).where("should_alert").drop("should_alert")


@query("f8_action_routing", "select event_id, case when event_id % 4 in (0, 1) then case when event_id % 4 = 0 and event_id % 3 <> 0 then 'update' else 'reject' end when event_id % 4 = 2 then 'insert' else 'reject' end as route from events")
def f8(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").selectExpr("event_id as i", "case event_id % 4 when 0 then 'add_to_existing' when 1 then 'add_to_existing' when 2 then 'create_new' else 'other' end as action", "case when event_id % 4 = 1 or event_id % 3 = 0 then '' else cast(event_id as string) end as event_id")
    return ev.route(rows).select(F.col("i").alias("event_id"), "route")


# --- joins ------------------------------------------------------------------------------------


@query("j1_unseen", S.DELIVERED_SQL + "select alertId, page, pos from delivered where event_id % 10 <> 3")
def j1(spark: SparkSession, sf: str) -> DataFrame:
    seen = table(spark, sf, "events").where("event_id % 10 = 3").select(F.concat(F.lit("a"), F.col("event_id")).alias("alertId"))
    return ingest.unseen(S.delivered(spark, sf), seen).select("alertId", "page", "pos")


@query("j2_source_of_signals", "select event_id, (select min('s' || s_suppkey) from supplier where s_name = (select min(s_name) from supplier)) as sourceId from events")
def j2(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id").join(F.broadcast(s7(spark, sf)))


@query("j3_o2_top_level", "with " + S.LOCATIONS_SQL + "select event_id, (select id from loc order by level desc, pos limit 1) as location_id from events")
def j3(spark: SparkSession, sf: str) -> DataFrame:
    return geo.with_top_level(table(spark, sf, "events").select("event_id"), S.locations(spark, sf))


HAVERSINE_SQL = "6371.0 * 2 * atan2(sqrt(a), sqrt(1 - a))"


@query("j3d_d1_nearest", "with " + S.LOCATIONS_SQL + "," + S.POINTS_SQL + f", d as (select event_id, id, round({HAVERSINE_SQL}, 6) as km from (select event_id, id, pow(sin(radians(loc.lat - pts.lat) / 2), 2) + cos(radians(pts.lat)) * cos(radians(loc.lat)) * pow(sin(radians(loc.lon - pts.lon) / 2), 2) as a from pts, loc)) select event_id, arg_min(id, (km, id)) as location_id, min(km) as km from d group by event_id")
def j3d(spark: SparkSession, sf: str) -> DataFrame:
    return geo.nearest(S.points(spark, sf), S.locations(spark, sf)).select("event_id", "location_id", F.round("distance_km", 6).alias("km"))


@query("j4_a5_a6_event_updates", f"select e.o_custkey as event_id, {S.stamp('arg_max(u.o_orderdate, u.o_orderkey)')} as last_arrived, {S.stamp('max(u.o_orderdate)')} as latest, count(distinct u.o_orderkey) + 1 as n_signal_ids from orders u join (select distinct o_custkey from orders where o_custkey % 2 = 0) e on u.o_custkey = e.o_custkey group by 1")
def j4(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    known = orders.where("o_custkey % 2 = 0").select(F.col("o_custkey").alias("event_id")).distinct().select("event_id", F.array(F.lit("first")).alias("signalIds"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz").alias("lastSignalCreatedAt"))
    updates = orders.select(F.col("o_custkey").alias("event_id"), F.col("o_orderkey").cast("string").alias("signal_id"), F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("arrival"))
    out, _ = ev.apply_updates(known, updates, ["arrival"])
    return out.select("event_id", S.stamped("lastSignalCreatedAt").alias("last_arrived"), S.stamped("latest").alias("latest"), F.size("signalIds").cast("long").alias("n_signal_ids"))


@query("j4_unknown_event_updates", "select o_orderkey from orders where o_custkey % 2 = 1")
def j4u(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("event_id"), F.col("o_orderkey").alias("signal_id"), F.col("o_orderdate").alias("ts"))
    known = orders.where("event_id % 2 = 0").select("event_id").distinct().select("event_id", F.array().cast("array<string>").alias("signalIds"), F.lit(None).cast("timestamp_ntz").alias("lastSignalCreatedAt"))
    _, unknown = ev.apply_updates(known, orders.withColumn("signal_id", F.col("signal_id").cast("string")), ["signal_id"])
    return unknown.select(F.col("signal_id").cast("long").alias("o_orderkey"))


def _located(spark: SparkSession, sf: str, rows: DataFrame) -> DataFrame:
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("nation"))
    return rows.join(customers, "user_id")


#: signals by type and nation, and the events that they form, open for seven days
GROUPED_SQL = f"""
  with located as (select 'a' || event_id as signal_id, event_type as type, c_nationkey as location, ts, cast(least(5, 1 + floor(value / 40)) as int) as severity from events join customer on user_id = c_custkey),
  marked as (select *, case when ts > lag(ts) over (partition by type, location order by ts, signal_id) + interval 6 hours then 1 else 0 end as fresh from located),
  numbered as (select *, sum(fresh) over (partition by type, location order by ts, signal_id rows unbounded preceding) as session from marked),
  begun as (select type, location, min(ts) as valid_from from numbered group by type, location, session),
  known as (select type || '/' || location || '/' || {S.stamp('valid_from')} as event_id, type, location, valid_from, valid_from + interval 7 days as valid_to from begun),
  pairs as (select signal_id, k.* from located s join known k on s.type = k.type and s.location = k.location and k.valid_from < s.ts and s.ts <= k.valid_to)
"""


def _signals_and_events(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = S.scored(_located(spark, sf, table(spark, sf, "events")))
    signals = rows.select(F.concat(F.lit("a"), F.col("event_id")).alias("signal_id"), F.col("event_type").alias("type"), F.col("nation").alias("location"), "ts", "severity")
    begun = ev.sessions(signals, ["type", "location"], 6).withColumn("validFrom", F.col("first_ts"))
    known = begun.select(F.concat_ws("/", "type", "location", S.stamped("validFrom")).alias("event_id"), "type", "location", "validFrom", (F.col("validFrom") + F.expr("interval 7 days")).alias("validTo"))
    return signals, known


@query("j5_candidates", GROUPED_SQL + "select signal_id, event_id from pairs")
def j5_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Signals and the open events of their type and place."""
    signals, known = _signals_and_events(spark, sf)
    return ev.candidates(signals, known, ["type", "location"]).select("signal_id", "event_id")


_GROUP_SQL = _request_sql("group", {
    "title": "type", "description": f"'{prompts.NO_DESCRIPTION}'", "location": "cast(location as varchar)", "types": "type", "severity": "severity", "summary": "type", "time": S.stamp("ts"),
    "events": "coalesce(known, cast([] as struct(id varchar, title varchar, types varchar[], location varchar, \"from\" varchar, \"to\" varchar)[]))",
})


@query("p13_j5_group_prompt", GROUPED_SQL + f""", blocks as (
    select signal_id, list(struct_pack(id := event_id, title := type, types := [type], location := cast(location as varchar), "from" := {S.stamp('valid_from')}, "to" := {S.stamp('valid_to')}) order by event_id) as known from pairs group by signal_id)
  select signal_id, sha256({_GROUP_SQL}) as prompt_sha from located left join blocks using (signal_id)""")
def p13_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Every signal's prompt with its own candidates."""
    return _grouping_requests(*_signals_and_events(spark, sf)).select("signal_id", F.sha2("request", 256).alias("prompt_sha"))


def _grouping_requests(signals: DataFrame, known: DataFrame) -> DataFrame:
    block = F.struct(F.col("event_id").alias("id"), F.col("type").alias("title"), F.array("type").alias("types"), F.col("location").cast("string").alias("location"), S.stamped("validFrom").alias("validFrom"), S.stamped("validTo").alias("validTo"))
    own = ev.candidates(signals, known, ["type", "location"]).groupBy("signal_id").agg(F.sort_array(F.collect_list(block)).alias("active"))
    text = prompts.group(F.col("type"), F.lit(""), F.col("location").cast("string"), F.array("type"), F.col("severity"), F.col("type"), S.stamped("ts"), F.col("active"))
    return signals.join(own, "signal_id", "left").select("signal_id", text.alias("request"))


@query("j7_alerts_per_signal", "select 'u' || user_id as event_id, 'draft' as status from events where least(5, 1 + floor(value / 40)) >= 4")
def j7(spark: SparkSession, sf: str) -> DataFrame:
    return ev.alerts(ev.severe(S.scored(table(spark, sf, "events")).withColumn("event_id", F.concat(F.lit("u"), F.col("user_id")))))


@query("j7_alerts_per_event", "select distinct 'u' || user_id as event_id, 'draft' as status from events where least(5, 1 + floor(value / 40)) >= 4")
def j7i(spark: SparkSession, sf: str) -> DataFrame:
    return ev.alerts(ev.severe(S.scored(table(spark, sf, "events")).withColumn("event_id", F.concat(F.lit("u"), F.col("user_id")))), mode="intended")


# --- aggregates -------------------------------------------------------------------------------


@query("a1_latest_mixed_offsets", "select max(t) as latest_text, strftime(max(cast(t as timestamptz) at time zone 'UTC'), '%Y-%m-%d %H:%M:%S.%f') as latest from (select case when event_id % 2 = 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') else strftime(ts + interval 3 hours, '%Y-%m-%dT%H:%M:%S+03:00') end as t from events)")
def a1(spark: SparkSession, sf: str) -> DataFrame:
    text = F.expr("if(event_id % 2 = 0, date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'+00:00'\"), date_format(ts + interval 3 hours, \"yyyy-MM-dd'T'HH:mm:ss'+03:00'\"))")
    return tables.latest_published(table(spark, sf, "events").select(text.alias("publishedAt"))).select("latest_text", S.stamped("latest").alias("latest"))


@query("a2_high_water", S.DELIVERED_SQL + f", stopped as (select min(page * 1000000 + pos) as stop from delivered where ts < timestamp '{S.SINCE}') select {S.stamp('max(ts)')} as latest from delivered, stopped where stop is null or page * 1000000 + pos <= stop")
def a2(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.high_water(S.delivered(spark, sf), since()).select(S.stamped("latest").alias("latest"))


@query("a3_new_signals", KEPT_SQL + "select count(distinct alertId) as n from kept where event_id % 10 <> 3")
def a3(spark: SparkSession, sf: str) -> DataFrame:
    seen = table(spark, sf, "events").where("event_id % 10 = 3").select(F.concat(F.lit("a"), F.col("event_id")).alias("alertId"))
    return ingest.unseen(ingest.first_seen(ingest.take_while(S.delivered(spark, sf), since())), seen).agg(F.count("*").alias("n"))


@query("a4_evidence_reference", "select 'u' || user_id as event_id, 'a' || event_id as signal_id, cast(1 as bigint) as n_signals, cast(least(5, 1 + floor(value / 40)) as int) as max_severity, event_type as summaries from events")
def a4(spark: SparkSession, sf: str) -> DataFrame:
    return ev.evidence(_evidence(spark, sf), "reference").withColumn("summaries", F.array_join("summaries", ",")).select("event_id", "signal_id", "n_signals", "max_severity", "summaries")


def _evidence(spark: SparkSession, sf: str) -> DataFrame:
    return S.scored(table(spark, sf, "events")).select(F.concat(F.lit("u"), F.col("user_id")).alias("event_id"), F.concat(F.lit("a"), F.col("event_id")).alias("signal_id"), "ts", "severity", F.col("event_type").alias("summary"))


@query("a4d_d8_evidence_intended", "select 'u' || user_id as event_id, count(*) as n_signals, max(cast(least(5, 1 + floor(value / 40)) as int)) as max_severity, string_agg(event_type, ',' order by ts, 'a' || event_id) as summaries from events group by user_id")
def a4d(spark: SparkSession, sf: str) -> DataFrame:
    return ev.evidence(_evidence(spark, sf)).withColumn("summaries", F.array_join("summaries", ","))


# --- state and windows ------------------------------------------------------------------------


@query("w1_first_seen", S.DELIVERED_SQL + "select alertId, arg_min(page, page * 1000000 + pos) as page, min(pos) as pos from delivered group by alertId")
def w1(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.first_seen(S.delivered(spark, sf)).select("alertId", "page", "pos")


@query("w2_sync_start", "select event_id, strftime(coalesce(case when event_id % 3 = 0 then ts end, case when event_id % 3 = 1 then ts - interval 1 hour end, timestamp '2024-02-01' - interval 7 days), '%Y-%m-%d %H:%M:%S.%f') as since from events")
def w2(spark: SparkSession, sf: str) -> DataFrame:
    start = ingest.sync_start(F.expr("if(event_id % 3 = 0, ts, null)"), F.expr("if(event_id % 3 = 1, ts - interval 1 hour, null)"), F.lit("2024-02-01").cast("timestamp_ntz"))
    return table(spark, sf, "events").withColumn("since", start).select("event_id", S.stamped("since").alias("since"))


def _sessions_sql(gap: int) -> str:
    return f"""with s as (select event_type, c_nationkey as nation, ts, event_id, cast(least(5, 1 + floor(value / 40)) as int) as severity from events join customer on user_id = c_custkey),
  m as (select *, case when ts > lag(ts) over (partition by event_type, nation order by ts, event_id) + interval {gap} hours then 1 else 0 end as fresh from s),
  g as (select *, sum(fresh) over (partition by event_type, nation order by ts, event_id) as session from m)
  select event_type, nation, count(*) as n_signals, max(severity) as max_severity, {S.stamp("min(ts)")} as first_ts, {S.stamp("max(ts)")} as last_ts from g group by event_type, nation, session"""


def _sessions(spark: SparkSession, sf: str, gap: int) -> DataFrame:
    rows = _located(spark, sf, S.scored(table(spark, sf, "events")))
    return ev.sessions(rows, ["event_type", "nation"], gap).select("event_type", "nation", "n_signals", "max_severity", S.stamped("first_ts").alias("first_ts"), S.stamped("last_ts").alias("last_ts"))


@query("w4_u2_sessions_48h", _sessions_sql(48))
def w4(spark: SparkSession, sf: str) -> DataFrame:
    return _sessions(spark, sf, 48)


@query("w4_u2_sessions_6h", _sessions_sql(6))
def w4s(spark: SparkSession, sf: str) -> DataFrame:
    return _sessions(spark, sf, 6)


@query("w5_event_state", f"select event_type, c_nationkey as nation, session, count(*) as n from (select *, cast(sum(fresh) over (partition by event_type, c_nationkey order by ts, event_id) as bigint) as session from (select event_type, c_nationkey, ts, event_id, case when ts > lag(ts) over (partition by event_type, c_nationkey order by ts, event_id) + interval 6 hours then 1 else 0 end as fresh from events join customer on user_id = c_custkey)) group by all")
def w5(spark: SparkSession, sf: str) -> DataFrame:
    rows = ev.numbered_sessions(_located(spark, sf, table(spark, sf, "events")), ["event_type", "nation"], 6)
    return rows.groupBy("event_type", "nation", "session").agg(F.count("*").alias("n"))


#: the fold of a key's hours, one after the other
_STORE_SQL = f"""
  with recursive located as (
    select event_type as type, c_nationkey as location, ts, 'a' || event_id as signal_id, cast(least(5, 1 + floor(value / 40)) as int) as severity from events join customer on user_id = c_custkey
  ), hours as (
    select type, location, cast(epoch_us(ts) // 3600000000 as bigint) as slice, min(epoch_us(ts)) as first_us, max(epoch_us(ts)) as last_us, count(*) as n_signals, max(severity) as max_severity from located group by all
  ), numbered as materialized (
    select *, row_number() over (partition by type, location order by slice) as i from hours
  ), folded as (
    select type, location, slice, i, slice as began, last_us, 'create_new' as action from numbered where i = 1
    union all
    select n.type, n.location, n.slice, n.i, case when n.first_us > f.last_us + 48 * 3600000000 or n.slice >= f.began + 168 then n.slice else f.began end, n.last_us,
           case when n.first_us > f.last_us + 48 * 3600000000 or n.slice >= f.began + 168 then 'create_new' else 'add_to_existing' end
    from folded f join numbered n on n.type = f.type and n.location = f.location and n.i = f.i + 1
  ), decided as materialized (
    select f.type, f.location, f.slice, f.began, f.action, n.n_signals, n.max_severity, n.first_us, n.last_us from folded f join numbered n using (type, location, i)
  )"""
_EVENT_ID_SQL = "sha256('event/' || type || '/' || location || '/' || began)"


@contextlib.contextmanager
def _state_settings(spark: SparkSession) -> Iterator[None]:
    """The settings that streams with state need, for a while."""
    before = {k: spark.conf.get(k, None) for k in stream.STATE_CONF}
    for k, v in stream.STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _thirds(rows: DataFrame) -> list[DataFrame]:
    """Three parts by event_id, one after the other."""
    a, b = rows.agg(F.percentile_approx("event_id", [0.33, 0.66])).first()[0]
    return [rows.where(F.col("event_id") <= a), rows.where((F.col("event_id") > a) & (F.col("event_id") <= b)), rows.where(F.col("event_id") > b)]


@query("w5_event_store", _STORE_SQL + f"select {_EVENT_ID_SQL} as event_id, type, location, {S.stamp('make_timestamp(min(first_us))')} as validFrom, {S.stamp('make_timestamp(min(first_us)) + interval 7 days')} as validTo, {S.stamp('make_timestamp(max(last_us))')} as lastSignalCreatedAt, cast(sum(n_signals) as bigint) as n_signals, max(max_severity) as max_severity from decided group by type, location, began")
def w5_store(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches of signals through the store of open events as a stream's state, with a restart before each but the first."""
    rows = S.scored(_located(spark, sf, table(spark, sf, "events"))).select(F.col("event_type").alias("type"), F.col("nation").alias("location"), "ts", "severity", "event_id")
    folder, out, checkpoint, keys = scratch(spark, "signals"), scratch(spark, "decisions"), scratch(spark, "checkpoint"), ["type", "location"]
    with _state_settings(spark):
        for part in _thirds(rows):
            part.drop("event_id").write.mode("append").parquet(folder)
            signals = spark.readStream.schema(rows.drop("event_id").schema).parquet(folder)
            stream.run_once(stream_events.event_store(signals, keys), out, checkpoint)
    found = store.event_rows(spark.read.parquet(out), keys)
    return found.select("event_id", *keys, *(S.stamped(c).alias(c) for c in ("validFrom", "validTo", "lastSignalCreatedAt")), "n_signals", "max_severity")


@query("w5_event_decisions", _STORE_SQL + "select type, location, slice, began, action, n_signals, max_severity, first_us, last_us from decided")
def w5_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """What the store decides for each type, place and hour."""
    return store.decisions(_signals_and_events(spark, sf)[0], ["type", "location"])


@query("w5_signal_events", _STORE_SQL + f"select signal_id, {_EVENT_ID_SQL} as event_id from located l join decided d on l.type = d.type and l.location = d.location and cast(epoch_us(ts) // 3600000000 as bigint) = d.slice".replace("'event/' || type || '/' || location", "'event/' || d.type || '/' || d.location"))
def w5_signals(spark: SparkSession, sf: str) -> DataFrame:
    """Every signal and the event that the store put it to."""
    signals, _ = _signals_and_events(spark, sf)
    keys = ["type", "location"]
    return store.signal_events(signals, store.decisions(signals, keys), keys).select("signal_id", "event_id")


def _grouping_model(request: str) -> str:
    """Stands in for a model: adds to the first event that the request names, else creates one; some answers are of no use."""
    given = json.loads(request)["input"]
    if given["severity"] == 5:
        return '{"action": "wait"}'
    if given["events"]:
        return "```json\n" + json.dumps({"action": "add_to_existing", "event_id": given["events"][0]["id"]}) + "\n```"
    return json.dumps({"action": "create_new", "title": given["title"] + "!", "types": given["types"].split(", ")})


@query("u2_f8_j4_grouping_answers", GROUPED_SQL + f""", chosen as (
    select l.signal_id, l.ts, l.type, case when severity = 5 then 'reject' when min(p.event_id) is null then 'insert' else 'update' end as route, min(p.event_id) as event_id
    from located l left join pairs p on l.signal_id = p.signal_id group by l.signal_id, l.ts, l.type, severity)
  select k.event_id, k.type as title, 1 + count(c.signal_id) as n_signal_ids, {S.stamp('coalesce(arg_max(c.ts, c.signal_id), k.valid_from)')} as last from known k left join chosen c on c.event_id = k.event_id and route = 'update' group by k.event_id, k.type, k.valid_from
  union all select sha256('event/' || signal_id), type || '!', 1, {S.stamp('ts')} from chosen where route = 'insert'
  union all select signal_id, 'rejected', 0, null from chosen where route = 'reject'""")
def u2(spark: SparkSession, sf: str) -> DataFrame:
    """Each signal's request with its own candidates, a model's answer to it, and the events after all answers."""
    signals, known = _signals_and_events(spark, sf)
    requests = _grouping_requests(signals, known)
    answers = model.answers(requests, lambda: _grouping_model, schemas.GROUPING)
    events = known.select(
        "event_id", F.array(F.lit("first")).alias("signalIds"), F.col("type").alias("title"), "validFrom", "validTo", F.col("validFrom").alias("firstSignalCreatedAt"), F.col("validFrom").alias("lastSignalCreatedAt"),
        F.array("type").alias("types"), F.lit(0.2).alias("rank"),
    )
    rows = signals.withColumnRenamed("type", "title").withColumn("disaster_types", F.array("title"))
    after, rejected = store.apply_grouping(rows, answers, events, ["signal_id"])
    held = after.select("event_id", "title", F.size("signalIds").cast("long").alias("n_signal_ids"), S.stamped("lastSignalCreatedAt").alias("last"))
    return held.unionByName(rejected.select(F.col("signal_id").alias("event_id"), F.lit("rejected").alias("title"), F.lit(0).cast("long").alias("n_signal_ids"), F.lit(None).cast("string").alias("last")))


@query("process_chain", _STORE_SQL.replace("from events join customer on user_id = c_custkey", "from events join customer on user_id = c_custkey where least(value / 50.0, 1.0) >= 0.5") + f"select {_EVENT_ID_SQL} as event_id, type, location, {S.stamp('make_timestamp(min(first_us))')} as validFrom, {S.stamp('make_timestamp(max(last_us))')} as lastSignalCreatedAt, cast(sum(n_signals) as bigint) as n_signals, max(max_severity) as max_severity, case when max(max_severity) >= 4 then 'draft' end as status from decided group by type, location, began")
def process_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Three deliveries with repeated records, each stored, scored, gated, grouped and escalated by streams that start anew."""
    folder, root = scratch(spark, "delivered"), scratch(spark, "chain")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("location"))
    rows = S.delivered(spark, sf)
    schema = rows.schema

    def score(stored: DataFrame) -> DataFrame:
        return S.scored(stored).withColumn("type", F.col("event_type")).join(customers, "user_id")

    run = chain.Chain(spark, root, schema, score)
    with _state_settings(spark):
        for part in _thirds(rows):
            part.write.mode("append").parquet(folder)
            run.ingest(spark.readStream.schema(schema).parquet(folder))
            run.process()
    alerts = spark.read.parquet(run.path("alerts")).select(F.col("event_id").alias("_of"), "status")
    found = run.events().join(alerts, F.col("event_id") == F.col("_of"), "left")
    return found.select("event_id", "type", "location", S.stamped("validFrom").alias("validFrom"), S.stamped("lastSignalCreatedAt").alias("lastSignalCreatedAt"), "n_signals", "max_severity", "status")


@query("w6_memo", "select event_id, cast(least(5, 1 + floor(case when event_id % 4 = 0 then 0 else value end / 40)) as int) as severity from events")
def w6(spark: SparkSession, sf: str) -> DataFrame:
    """Scores kept from before win; only the other signals are scored."""
    path, rows = scratch(spark, "memo"), table(spark, sf, "events")
    S.scored(rows.where("event_id % 4 = 0").withColumn("value", F.lit(0.0))).select("event_id", "severity").write.parquet(path)
    memo = spark.read.parquet(path)
    return S.scored(rows.join(memo, "event_id", "left_anti")).select("event_id", "severity").unionByName(memo)


@query("w6_memo_life", "select 'a' || event_id as signal_id, cast(least(5, 1 + floor(case when event_id % 4 = 0 then 0 when event_id % 4 = 2 then 200 else value end / 40)) as int) as severity, event_id % 5 as turn from events union all select 'a' || event_id, cast(least(5, 1 + floor(case when event_id % 4 = 0 then 0 when event_id % 4 = 2 then 200 else value end / 40)) as int), 9 from events where event_id % 3 = 0")
def w6_life(spark: SparkSession, sf: str) -> DataFrame:
    """Some signals requested twice; answers of an hour and of just under a day ago stand, those of a day ago are asked for again."""
    rows = table(spark, sf, "events").select(F.concat(F.lit("a"), "event_id").alias("signal_id"), "value", F.col("event_id") % 5, "event_id").toDF("signal_id", "value", "turn", "i")
    requests = rows.drop("i").unionByName(rows.where("i % 3 = 0").select("signal_id", "value", F.lit(9).cast("long").alias("turn")))
    now = F.lit("2024-06-01 12:00:00").cast("timestamp")
    age = F.when(F.col("i") % 4 == 0, F.expr("interval 1 hour")).when(F.col("i") % 4 == 2, F.expr("interval 86399 seconds")).otherwise(F.expr("interval 24 hours"))
    kept = rows.where("i % 4 < 3").select("signal_id", F.when(F.col("i") % 4 == 0, 1).when(F.col("i") % 4 == 2, 5).otherwise(-1).cast("int").alias("severity"), (now - age).alias("answered_at"))
    answers, _ = memo.answered(requests, kept, lambda asked: S.scored(asked).select("signal_id", "severity"), now)
    return answers.select("signal_id", "severity", "turn")


@query("w7_x7_cells", "with " + S.POINTS_SQL + "select cell_lat, cell_lon, arg_min(lat, event_id) as lat, arg_min(lon, event_id) as lon from (select *, printf('%.1f', lat) as cell_lat, printf('%.1f', lon) as cell_lon from pts) group by cell_lat, cell_lon")
def w7(spark: SparkSession, sf: str) -> DataFrame:
    return geo.cell_representatives(S.points(spark, sf), ["event_id"])


@query("w7_cell_answers", "with " + S.LOCATIONS_SQL + "," + S.POINTS_SQL + """,
  cells as (select *, printf('%.1f', lat) as cell_lat, printf('%.1f', lon) as cell_lon from pts),
  firsts as (select cell_lat, cell_lon, min(event_id) as first_id, arg_min(lat, event_id) as lat, arg_min(lon, event_id) as lon from cells group by cell_lat, cell_lon),
  d as (select cell_lat, cell_lon, first_id, id, pow(sin(radians(loc.lat - firsts.lat) / 2), 2) + cos(radians(firsts.lat)) * cos(radians(loc.lat)) * pow(sin(radians(loc.lon - firsts.lon) / 2), 2) as a from firsts, loc),
  near as (select cell_lat, cell_lon, any_value(first_id) as first_id, arg_min(id, (a, id)) as id from d group by cell_lat, cell_lon)
  select event_id, case when first_id % 5 = 0 then 'kept' when first_id % 5 = 1 then null else id end as location_id from cells join near using (cell_lat, cell_lon)""")
def w7_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Some cells remembered, some of those without a location, some too long ago; the others asked once each."""
    points = S.points(spark, sf)
    cells = geo.cell_representatives(points.withColumn("first", F.col("event_id")), ["event_id"])
    firsts = points.withColumns({"cell_lat": scalar.grid_cell(F.col("lat")), "cell_lon": scalar.grid_cell(F.col("lon"))}).groupBy("cell_lat", "cell_lon").agg(F.min("event_id").alias("first_id"))
    now = F.lit("2024-06-01 12:00:00").cast("timestamp")
    age = F.when(F.col("first_id") % 5 < 2, F.expr("interval 1 hour")).otherwise(F.expr("interval 7 hours"))
    memo = cells.join(firsts, ["cell_lat", "cell_lon"]).where("first_id % 5 < 3").select("cell_lat", "cell_lon", F.when(F.col("first_id") % 5 == 0, "kept").when(F.col("first_id") % 5 == 2, "old").alias("location_id"), (now - age).alias("resolved_at"))
    placed, _ = geo.resolve_cells(points, S.locations(spark, sf), memo, now, ["event_id"])
    return placed.select("event_id", "location_id")


# --- scalar functions -------------------------------------------------------------------------


@query("x2_iso_format", "select event_id, strftime(t, '%Y-%m-%dT%H:%M:%S') || case when event_id % 2 = 0 then '' else '.000250' end || '+00:00' as iso from (select event_id, date_trunc('second', ts) as t from events)")
def x2(spark: SparkSession, sf: str) -> DataFrame:
    t = F.expr("cast(date_trunc('second', ts) as timestamp) + if(event_id % 2 = 0, interval 0 microseconds, interval 250 microseconds)")
    return table(spark, sf, "events").select("event_id", scalar.iso_format(t).alias("iso"))


@query("x5_x6_x12_defaults", "select doc_id, coalesce(nullif(concat_ws(', ', case when doc_id % 2 = 0 then lang end, case when doc_id % 3 = 0 then source end), ''), '(none)') as joined, coalesce(nullif(case when doc_id % 4 = 0 then '' else lang end, ''), '(unknown)') as given, coalesce(case when doc_id % 5 = 0 then null else lang end, '?') as default_if_missing from documents")
def x6(spark: SparkSession, sf: str) -> DataFrame:
    parts = F.array(F.expr("if(doc_id % 2 = 0, lang, null)"), F.expr("if(doc_id % 3 = 0, source, null)"))
    return table(spark, sf, "documents").select("doc_id", scalar.join_or(parts, ", ", "(none)").alias("joined"), scalar.or_default(F.expr("if(doc_id % 4 = 0, '', lang)"), "(unknown)").alias("given"), F.coalesce(F.expr("if(doc_id % 5 = 0, null, lang)"), F.lit("?")).alias("default_if_missing"))


@query("x8_haversine", "with " + S.POINTS_SQL + f"select event_id, round({HAVERSINE_SQL}, 6) as km from (select event_id, pow(sin(radians(15.5 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(15.5)) * pow(sin(radians(32.5 - lon) / 2), 2) as a from pts)")
def x8(spark: SparkSession, sf: str) -> DataFrame:
    return S.points(spark, sf).select("event_id", F.round(scalar.haversine_km(F.col("lat"), F.col("lon"), F.lit(15.5), F.lit(32.5)), 6).alias("km"))


@query("x9_x10_model_answer", "select event_id, case when event_id % 5 = 0 then -1 else event_id % 6 end as severity, case when event_id % 5 = 0 then '(broken)' else event_type end as summary from events")
def x9(spark: SparkSession, sf: str) -> DataFrame:
    """Answers with and without a Markdown fence, some of them broken: parsed, or marked."""
    body = F.concat(F.lit('{"severity": '), F.col("event_id") % 6, F.lit(', "summary": "'), F.col("event_type"), F.when(F.col("event_id") % 5 == 0, "").otherwise('"}'))
    text = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("  ```json\n"), body, F.lit("\n```\n"))).otherwise(body)
    answer = F.from_json(scalar.strip_fence(text), "severity LONG, summary STRING, _corrupt_record STRING", {"columnNameOfCorruptRecord": "_corrupt_record"})
    rows = table(spark, sf, "events").withColumn("a", answer)
    good = F.col("a._corrupt_record").isNull()
    return rows.select("event_id", F.when(good, F.col("a.severity")).otherwise(F.lit(-1)).alias("severity"), F.when(good, F.col("a.summary")).otherwise("(broken)").alias("summary"))


# --- scorer, documented extras, flagship ------------------------------------------------------


def _hits_sql(words: tuple[str, ...]) -> str:
    return f"len(regexp_extract_all(lower(text), '\\b({'|'.join(words)})\\b'))"


TEST_LEXICON = {"AA": ("the", "der", "de"), "BB": ("idiot", "moron", "scum"), "CC": ("license", "version")}


@query("u1_d3_rule_scorer", f"""with h as (select doc_id, {', '.join(f'{_hits_sql(w)} as h{c}' for c, w in TEST_LEXICON.items())} from documents)
  select doc_id, concat_ws(',', {', '.join(f"case when h{c} > 0 then '{c}' end" for c in TEST_LEXICON)}) as types, least((hAA + hBB + hCC) / 4.0, 1.0) as relevance, cast(least(5, 1 + hAA + hBB + hCC) as int) as severity from h""")
def u1(spark: SparkSession, sf: str) -> DataFrame:
    scored = ev.classify(table(spark, sf, "documents").select("doc_id", "text"), title="text", lexicon=TEST_LEXICON)
    return scored.select("doc_id", F.array_join("disaster_types", ",").alias("types"), "relevance", "severity")


@query("d2_geofence", "with " + S.POINTS_SQL + "select event_id, lat, lon from pts where lat between 3.5 and 23.2 and lon between 21.8 and 38.6")
def d2(spark: SparkSession, sf: str) -> DataFrame:
    return S.points(spark, sf).where(geo.in_box("lat", "lon", 3.5, 23.2, 21.8, 38.6)).select("event_id", "lat", "lon")


#: a polygon with a hole around each nation: eight corners at two distances by turns, and a square inside
_CORNERS = [(8, 0), (3, 3), (0, 9), (-4, 4), (-7, 0), (-3, -5), (0, -8), (5, -5)]
_HOLE = [(1, 1), (1, -1), (-1, -1), (-1, 1)]
_SIDES_SQL = " union all ".join(f"select id, lat + {a[0]} as lat1, lon + {a[1]} as lon1, lat + {b[0]} as lat2, lon + {b[1]} as lon2 from loc where level = 1" for ring in (_CORNERS, _HOLE) for a, b in zip(ring, ring[1:] + ring[:1], strict=True))


@query("d2_polygons", "with " + S.LOCATIONS_SQL + "," + S.POINTS_SQL + f", sides as ({_SIDES_SQL}), met as (select event_id, id, count(*) filter (where (lat1 > lat) <> (lat2 > lat) and lon < (lon2 - lon1) * (lat - lat1) / (lat2 - lat1) + lon1) % 2 = 1 or bool_or((lon2 - lon1) * (lat - lat1) - (lat2 - lat1) * (lon - lon1) = 0 and lat between least(lat1, lat2) and greatest(lat1, lat2) and lon between least(lon1, lon2) and greatest(lon1, lon2)) as inside from pts, sides group by event_id, id) select event_id, id as polygon_id from met where inside")
def d2_polygons(spark: SparkSession, sf: str) -> DataFrame:
    """Points and the polygons, with holes, that they lie in."""
    ring = lambda corners: F.array(*(F.struct((F.col("lat") + a).alias("lat"), (F.col("lon") + b).alias("lon")) for a, b in corners))
    shapes = S.locations(spark, sf).where("level = 1").select("id", F.array(ring(_CORNERS), ring(_HOLE)).alias("rings"))
    return polygons.within(S.points(spark, sf), shapes).select("event_id", "polygon_id")


_WORDS_SQL = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+'), lambda w: w <> '')"


@query("d3_phrases", f"""with w as (select doc_id, coalesce({_WORDS_SQL}, []) as w from documents),
  lex as (select distinct array_to_string(w[1:1 + doc_id % 4], ' ') as phrase, 'C' || doc_id % 6 as code, least(len(w), 1 + doc_id % 4) as size from w where len(w) > 0),
  runs as (select doc_id, array_to_string(w[i:i + size - 1], ' ') as phrase, size from w, (select distinct size from lex), unnest(range(1, len(w) - size + 2)) u(i))
  select doc_id, code, count(*) as n from runs join lex using (phrase, size) group by doc_id, code""")
def d3_phrases(spark: SparkSession, sf: str) -> DataFrame:
    """A lexicon of the first one to four words of every document, looked up in all documents."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    own = docs.select(F.array_join(F.slice(phrases.words(F.col("text")), F.lit(1), (F.col("doc_id") % 4 + 1).cast("int")), " ").alias("phrase"), F.concat(F.lit("C"), F.col("doc_id") % 6).alias("code")).where("phrase <> ''")
    return phrases.matches(docs, own)


@query("d6_collected_at", "select event_id, true as collected from events")
def d6(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id").withColumn("collectedAt", F.current_timestamp()).select("event_id", F.col("collectedAt").isNotNull().alias("collected"))


@query("d7_legacy_payload", "select event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') || '+00:00' as alertTimestamp, 'u' || event_id as alertUrl, 'h' as href, event_type as place, 1.5 as lat, -2.25 as lon from events")
def d7(spark: SparkSession, sf: str) -> DataFrame:
    legacy = table(spark, sf, "events").select(
        F.expr("unix_seconds(cast(ts as timestamp)) * 1000").alias("eventTime"), F.concat(F.lit("u"), F.col("event_id")).alias("firstAlertURL"), F.struct(F.lit("h").alias("link")).alias("publicPost"),
        F.array(F.struct(F.lit("l").alias("name"))).alias("alertLists"), F.array(F.struct(F.lit("p").alias("parentId"))).alias("linkedAlerts"), F.array(F.col("event_type"), F.lit("1.5"), F.lit("-2.25"), F.lit("0.1"), F.lit("M")).alias("estimatedEventLocation"),
    )
    out = ingest.from_legacy(legacy)
    return out.select(F.expr("cast(substring(alertUrl, 2) as bigint)").alias("event_id"), "alertTimestamp", "alertUrl", F.col("publicPost.href").alias("href"), F.col("estimatedEventLocation.name").alias("place"), F.col("estimatedEventLocation.coordinates")[0].alias("lat"), F.col("estimatedEventLocation.coordinates")[1].alias("lon"))


@query("d12_signal_events", "select 'a' || event_id as signal_id, 'u' || user_id as event_id from events")
def d12(spark: SparkSession, sf: str) -> DataFrame:
    """The bridge table of signals and events, from events that hold arrays of signal ids."""
    held = _evidence(spark, sf).groupBy("event_id").agg(F.collect_set("signal_id").alias("signalIds"))
    return held.select(F.explode("signalIds").alias("signal_id"), "event_id")


FLAGSHIP_SQL = KEPT_SQL + f""",
  uniq as (select alertId, any_value(event_id) as event_id, any_value(ts) as ts, any_value(user_id) as user_id, any_value(event_type) as event_type, any_value(value) as value from kept group by alertId),
  s as (select event_type, c_nationkey as nation, ts, event_id, cast(least(5, 1 + floor(value / 40)) as int) as severity from uniq join customer on user_id = c_custkey where least(value / 50.0, 1.0) >= 0.5),
  m as (select *, case when ts > lag(ts) over (partition by event_type, nation order by ts, event_id) + interval 48 hours then 1 else 0 end as fresh from s),
  g as (select *, sum(fresh) over (partition by event_type, nation order by ts, event_id) as session from m)
  select event_type, nation, count(*) as n_signals, max(severity) as max_severity, {S.stamp("min(ts)")} as first_ts, {S.stamp("max(ts)")} as last_ts, max(severity) / 5.0 as rank, 'draft' as status
  from g group by event_type, nation, session having max(severity) >= 4"""


@query("flagship", FLAGSHIP_SQL)
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Delivery -> take-while -> first seen -> score -> relevance gate -> events -> severity gate -> draft alerts."""
    fresh = ingest.first_seen(ingest.take_while(S.delivered(spark, sf), since()))
    scored = ev.relevant(S.scored(_located(spark, sf, fresh)))
    found = ev.assess(ev.sessions(scored, ["event_type", "nation"], 48)).where("should_alert")
    return found.select("event_type", "nation", "n_signals", "max_severity", S.stamped("first_ts").alias("first_ts"), S.stamped("last_ts").alias("last_ts"), (F.col("max_severity") / F.lit(5.0)).alias("rank"), "status")


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
