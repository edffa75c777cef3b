"""Scalar functions as Column expressions; all run inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


#: The forms of a timestamp, for the engine and for the source reader: calendar or week date, extended or basic, one
#: separator, a time down to any number of decimals, an offset. ``Z`` stands for ``+00:00`` and is replaced before.
TIMESTAMP = (
    r"^([0-9]{4})(?:-([0-9]{2})-([0-9]{2})|([0-9]{2})([0-9]{2})|-W([0-9]{2})(?:-([0-9]))?|W([0-9]{2})([0-9])?)"
    r"(?:[^0-9](?:([0-9]{2})(?::([0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]+))?)?)?|([0-9]{2})([0-9]{2})(?:([0-9]{2})(?:[.,]([0-9]+))?)?)"
    r"(?:([+-])(?:([0-9]{2})(?::([0-9]{2})(?::([0-9]{2}))?)?|([0-9]{2})([0-9]{2})([0-9]{2})?))?)?$"
)
_USUAL = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-5][0-9]([.][0-9]{1,6})?[+-][01][0-7]:[0-5][0-9]$"


def parse_timestamp(text: Column) -> Column:
    """ISO-8601 -> TIMESTAMP; null if it doesn't parse, see ``TIMESTAMP``. Without offset it is in UTC. The usual form is parsed by Spark's own cast."""
    text = F.replace(text, F.lit("Z"), F.lit("+00:00"))
    part = lambda *groups: F.coalesce(*(F.nullif(F.regexp_extract(text, TIMESTAMP, g), F.lit("")) for g in groups), F.lit(None).cast("string"))
    number = lambda *groups: part(*groups).cast("int")
    year, week, day = number(1), number(6, 8), F.coalesce(number(7, 9), F.lit(1))
    first = F.make_date(year, F.lit(1), F.lit(4))  # lies in the first week
    of_week = F.date_add(first, (week - 1) * 7 + day - 1 - F.weekday(first))
    in_weeks = week.between(1, 53) & day.between(1, 7) & (F.extract(F.lit("YEAROFWEEK"), of_week) == year)
    month, of_month = (F.when(week.isNull(), number(*g)).when(in_weeks, f(of_week)) for g, f in (((2, 4), F.month), ((3, 5), F.day)))
    zero = lambda *groups: F.coalesce(number(*groups), F.lit(0))
    second = F.concat(F.coalesce(part(12, 16), F.lit("0")), F.lit("."), F.substring(F.concat(F.coalesce(part(13, 17), F.lit("")), F.lit("000000")), 1, 6)).cast("decimal(8,6)")
    local = F.try_make_timestamp(F.when(F.extract(F.lit("YEAROFWEEK"), of_week).isNotNull() & week.isNotNull(), F.year(of_week)).otherwise(year), month, of_month, zero(10, 14), zero(11, 15), F.when(second < 60, second), F.lit("UTC"))
    offset = zero(19, 22) * 3600 + zero(20, 23) * 60 + zero(21, 24)
    shift = F.when(part(18) == "-", -offset).otherwise(offset)
    other = F.when((year > 0) & (offset < 86_400), F.timestamp_micros(F.unix_micros(local) - shift.cast("long") * 1_000_000))
    return F.when(text.rlike(_USUAL) & ~text.startswith("0000"), F.try_to_timestamp(text)).when(text.rlike(TIMESTAMP), other)


def iso_format(ts: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS[.ffffff]+00:00``; microseconds only if there are any."""
    micros = F.when(F.unix_micros(ts) % 1_000_000 == 0, F.lit("")).otherwise(F.date_format(ts, ".SSSSSS"))
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), micros, F.lit("+00:00"))


def none_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def or_default(text: Column, default: str) -> Column:
    """The default for null and for the empty string."""
    return F.coalesce(none_if_empty(text), F.lit(default))


def join_or(parts: Column, separator: str, default: str) -> Column:
    """Array joined, or the default if there is nothing in it."""
    return F.coalesce(none_if_empty(F.array_join(parts, separator)), F.lit(default))


def join_present(separator: str, *parts: Column) -> Column:
    """Parts that are neither null nor empty, joined; null if there are none."""
    kept = F.filter(F.array(*parts), lambda x: x.isNotNull() & (x != ""))
    return F.nullif(F.array_join(kept, separator), F.lit(""))


def description(sub_headline: str = "subHeadline") -> Column:
    return join_present(" — ", F.col(f"{sub_headline}.title"), F.col(f"{sub_headline}.subHeadlines"))


def coordinate(coordinates: Column, index: int) -> Column:
    """lat (0) or lon (1); null unless there are two elements at least."""
    return F.when(F.size(coordinates) >= 2, F.get(coordinates, F.lit(index)))


def first_name(*names: Column, default: str | None = None) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*map(none_if_empty, names), F.lit(default))


def raw_context(post: str = "publicPost", agents: str = "intelAgents", corroboration: str = "eventCorroboration", brief: str = "liveBrief", limit: int | None = None) -> Column:
    """Labelled lines: post, translation, first content of each intel summary, corroborations, briefs. The labels are fixed values."""
    text = F.expr(
        f"""array_join(filter(concat(
              array(concat('Post text: ', nullif({post}.text, '')), concat('Translated: ', nullif({post}.translatedText, ''))),
              coalesce(transform(flatten(transform({agents}, a -> coalesce(a.summary, array()))), s -> concat('Intel: ', get(s.content, 0))), array()),
              coalesce(transform({corroboration}.summary, s -> concat('Corroboration: ', nullif(s.content, ''))), array()),
              coalesce(transform({brief}, b -> concat('Brief: ', nullif(b.summary, ''))), array())), x -> x is not null), '\\n')"""
    )
    whole = F.coalesce(none_if_empty(text), F.lit("(no additional context)"))
    return whole if limit is None else F.substring(whole, 1, limit)


def grid_cell(degrees: Column) -> Column:
    """One decimal, rounded half to even on the exact binary value, ``-0.0`` kept."""
    return F.regexp_replace(F.format_number(degrees, 1), ",", "")


def haversine(lat1: Column, lon1: Column, cos1: Column, lat2: Column, lon2: Column, cos2: Column) -> Column:
    """The haversine of the angle between two points, given the cosines of their latitudes."""
    dlat, dlon = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    return dlat * dlat + cos1 * cos2 * (dlon * dlon)


def arc_km(a: Column) -> Column:
    return F.lit(EARTH_KM) * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return arc_km(haversine(lat1, lon1, F.cos(F.radians(lat1)), lat2, lon2, F.cos(F.radians(lat2))))


def strip_fence(text: Column) -> Column:
    """Without the Markdown fence lines, if the trimmed text begins with one."""
    trimmed = F.regexp_replace(text, r"^\s+|\s+$", "")
    lines = F.filter(F.split(trimmed, "\n"), lambda x: ~F.regexp_replace(x, r"^\s+", "").startswith("```"))
    return F.when(trimmed.startswith("```"), F.array_join(lines, "\n")).otherwise(trimmed)


def next_url(next_page: Column, host: str, prefix: str, base: str) -> Column:
    """Absolute link as it is; a path gets the prefix, unless it has it, and the host; else a cursor parameter."""
    path = F.when(next_page.startswith(prefix), next_page).otherwise(F.concat(F.lit(prefix), next_page))
    return (
        F.when(next_page.isNull() | (next_page == ""), F.lit(None).cast("string"))
        .when(next_page.startswith("http"), next_page)
        .when(next_page.startswith("/"), F.concat(F.lit(host), path))
        .otherwise(F.concat(F.lit(base + "?nextPage="), next_page))
    )
