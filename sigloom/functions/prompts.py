"""Requests to a model-backed scorer: JSON texts of a task, its rules, the answer's schema and the input.

The task's rules and the answer's fields are constants of this module and of ``schemas``; the input is a
struct of columns. Nothing here is read by the default rule scorer.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas
from .scalar import join_or, or_default

#: What stands for a missing part, as the original pipeline has it.
NO_TITLE, NO_DESCRIPTION, NO_LOCATION, NO_URL, UNTITLED, NONE, UNKNOWN, OPEN = "(no title)", "(no description)", "(unknown location)", "(no URL)", "(untitled event)", "(none)", "(unknown)", "?"

#: task -> (rules, fields of the answer)
TASKS: dict[str, tuple[tuple[str, ...], str]] = {
    "classify": (
        ("relevance is 0 (no humanitarian concern) to 1 (certain)", "severity is 1 (slight) to 5 (extreme)", "disaster_types are codes out of input.types, or none", "summary is one sentence"),
        schemas.CLASSIFICATION,
    ),
    "group": (
        ("action is add_to_existing if one of input.events is the same occurrence, with its id as event_id", "otherwise action is create_new, with a title, a description and types", "same occurrence: type and place agree and the times are near"),
        schemas.GROUPING,
    ),
    "assess": (("should_alert if people have to act on what input.summaries say", "status is draft"), schemas.ASSESSMENT),
}


def head(task: str) -> str:
    """The request up to its input; the input's JSON and a closing brace follow."""
    rules, answer = TASKS[task]
    constant = json.dumps({"task": task, "rules": rules, "answer": answer}, ensure_ascii=False, separators=(",", ":"))
    return constant[:-1] + ',"input":'


def request(task: str, slots: dict[str, Column]) -> Column:
    body = F.to_json(F.struct(*(c.alias(name) for name, c in slots.items())), {"ignoreNullFields": "false"})
    return F.concat(F.lit(head(task)), body, F.lit("}"))


def classify(title: Column, description: Column, location: Column, url: Column, timestamp: Column, raw_context: Column, types: Column, limit: int = 2000) -> Column:
    """``types``: array of (glideNumber, disasterType, disasterClass)."""
    codes = F.transform(types, lambda t: F.struct(t["glideNumber"].alias("code"), t["disasterType"].alias("name"), F.nullif(t["disasterClass"], F.lit("")).alias("class")))
    return request("classify", {
        "title": or_default(title, NO_TITLE), "description": or_default(description, NO_DESCRIPTION), "location": or_default(location, NO_LOCATION),
        "url": or_default(url, NO_URL), "time": timestamp, "context": F.substring(raw_context, 1, limit), "types": codes,
    })


def group(title: Column, description: Column, location: Column, types: Column, severity: Column, summary: Column, timestamp: Column, events: Column) -> Column:
    """``events``: array of (id, title, types, location, validFrom, validTo), strings; null is none."""
    known = F.transform(events, lambda e: F.struct(
        e["id"].alias("id"), F.coalesce(e["title"], F.lit(UNTITLED)).alias("title"), e["types"].alias("types"), or_default(e["location"], UNKNOWN).alias("location"),
        F.coalesce(e["validFrom"], F.lit(OPEN)).alias("from"), F.coalesce(e["validTo"], F.lit(OPEN)).alias("to"),
    ))
    return request("group", {
        "title": or_default(title, NO_TITLE), "description": or_default(description, NO_DESCRIPTION), "location": or_default(location, UNKNOWN), "types": join_or(types, ", ", NONE),
        "severity": severity.cast("int"), "summary": summary, "time": timestamp, "events": F.when(events.isNull(), F.array().cast("array<struct<id: string, title: string, types: array<string>, location: string, from: string, to: string>>")).otherwise(known),
    })


def assess(title: Column, description: Column, types: Column, location: Column, count: Column, severity: Column, valid_from: Column, valid_to: Column, summaries: Column) -> Column:
    return request("assess", {
        "title": or_default(title, UNTITLED), "description": or_default(description, NO_DESCRIPTION), "types": join_or(types, ", ", NONE), "location": or_default(location, UNKNOWN),
        "signals": count.cast("long"), "severity": severity.cast("int"), "from": valid_from, "to": valid_to, "summaries": F.coalesce(summaries, F.array().cast("array<string>")),
    })
