"""Schemas of signals, dimensions, events and alerts, as DDL strings."""

from __future__ import annotations

def signal_ddl(link_field: str) -> str:
    """One signal as the alert API delivers it; ``link_field`` is the vendor's name of the alert's own link."""
    return (
        "alertId STRING, alertTimestamp STRING, "
        "estimatedEventLocation STRUCT<name: STRING, coordinates: ARRAY<DOUBLE>, probabilityRadius: DOUBLE, MGRS: STRING>, "
        "alertType STRUCT<name: STRING>, headline STRING, subHeadline STRUCT<title: STRING, subHeadlines: STRING>, "
        "publicPost STRUCT<href: STRING, text: STRING, translatedText: STRING, media: ARRAY<STRING>>, "
        f"`{link_field}` STRING, listsMatched ARRAY<STRUCT<id: STRING, name: STRING, topicIds: ARRAY<STRING>>>, "
        "alertTopics ARRAY<STRUCT<name: STRING, id: STRING>>, linkedAlerts ARRAY<STRUCT<parentAlertId: STRING, count: BIGINT>>, "
        "termsOfUse STRING, intelAgents ARRAY<STRUCT<summary: ARRAY<STRUCT<title: STRING, content: ARRAY<STRING>>>>>, "
        "eventCorroboration STRUCT<summary: ARRAY<STRUCT<content: STRING>>>, liveBrief ARRAY<STRUCT<summary: STRING>>"
    )


def page_ddl(link_field: str) -> str:
    return f"alerts ARRAY<STRUCT<{signal_ddl(link_field)}>>, nextPage STRING"


_PLACE = "STRUCT<id: STRING, name: STRING>"
LOCATION = f"id STRING, name STRING, level INT, parent {_PLACE}, lat DOUBLE, lon DOUBLE"
DATA_SOURCE = "id STRING, name STRING"
DISASTER_TYPE = "id STRING, disasterType STRING, disasterClass STRING, glideNumber STRING"
STORED_SIGNAL = "sourceId STRING, rawData STRING, publishedAt STRING, url STRING, title STRING, description STRING, originId STRING, collectedAt TIMESTAMP, destinationId STRING, locationId STRING"
EVENT = f"id STRING, signalIds ARRAY<STRING>, title STRING, description STRING, validFrom TIMESTAMP, validTo TIMESTAMP, firstSignalCreatedAt TIMESTAMP, lastSignalCreatedAt TIMESTAMP, types ARRAY<STRING>, rank DOUBLE, originId STRING, originLocation {_PLACE}, destinationLocation {_PLACE}, generalLocation {_PLACE}"
ALERT = "eventId STRING, status STRING"
CLASSIFICATION = "disaster_types ARRAY<STRING>, relevance DOUBLE, severity INT, summary STRING"
GROUPING = "action STRING, event_id STRING, title STRING, description STRING, types ARRAY<STRING>"
ASSESSMENT = "should_alert BOOLEAN, status STRING"
LEGACY_SIGNAL = "eventTime BIGINT, firstAlertURL STRING, publicPost STRUCT<link: STRING>, alertLists ARRAY<STRUCT<name: STRING>>, linkedAlerts ARRAY<STRUCT<parentId: STRING>>, estimatedEventLocation ARRAY<STRING>"
