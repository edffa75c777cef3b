"""Records of a page one by one: what doesn't fit the model is named and set aside, and the rest of the page goes on.

A record is its JSON text. Every place of the model is checked against what the text holds there, as a
variant: text has to be text; a number may come as a number or as text that is one; a struct is an object, an array an
array, whose elements are checked in turn. Nulls and missing parts are allowed but where they are required. Fields
that the model doesn't have are kept in the text and don't matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, NumericType, StringType, StructField, StructType, _parse_datatype_string

from . import ingest

REQUIRED = ("alertId", "alertTimestamp")
_NUMBER = r"^\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _said(path: str, fault: str) -> Column:
    return F.array(F.lit(f"{fault} {path}"))


def faults(value: Column, kind: DataType, path: str = "", required: Sequence[str] = ()) -> Column:
    """An array of what doesn't fit: ``missing path`` or ``type path``; ``value`` is a variant."""
    name = F.schema_of_variant(value)
    absent = value.isNull() | F.is_variant_null(value)
    none = F.array().cast("array<string>")
    if isinstance(kind, StructType):
        inside = F.concat(*(faults(F.try_variant_get(value, f"$.{f.name}", "variant"), f.dataType, f"{path}.{f.name}" if path else f.name, required) for f in kind.fields))
        checked = F.when(name.startswith("OBJECT"), inside).otherwise(_said(path or "record", "type"))
    elif isinstance(kind, ArrayType):
        inside = F.flatten(F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda v: faults(v, kind.elementType, f"{path}[]", required)))
        checked = F.when(name.startswith("ARRAY"), F.array_distinct(inside)).otherwise(_said(path, "type"))
    elif isinstance(kind, NumericType):
        text = F.try_variant_get(value, "$", "string")
        whole = F.lit(True) if kind.typeName() in ("double", "float") else F.coalesce(text.try_cast("double") % 1 == 0, F.lit(False))
        number = name.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$") | ((name == "STRING") & text.rlike(_NUMBER))
        checked = F.when((number & whole) | (name == "BOOLEAN"), none).otherwise(_said(path, "type"))
    elif isinstance(kind, StringType):
        checked = F.when(name == "STRING", none).otherwise(_said(path, "type"))
    else:
        raise ValueError(f"{path}: {kind.simpleString()} has no rule")
    return F.when(absent, _said(path or "record", "missing") if path in required or not path else none).otherwise(checked)


def _as_text(kind: DataType) -> DataType:
    """The model with text for numbers, so that a number in quotes is read too."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(_as_text(kind.elementType))
    return StringType() if isinstance(kind, NumericType) else kind


def _typed(value: Column, kind: DataType) -> Column:
    """Back to the model's numbers."""
    if isinstance(kind, StructType):
        return F.when(value.isNotNull(), F.struct(*(_typed(value[f.name], f.dataType).alias(f.name) for f in kind.fields)))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda v: _typed(v, kind.elementType))
    if isinstance(kind, NumericType):
        plain = F.when(value == "true", F.lit("1")).when(value == "false", F.lit("0")).otherwise(F.trim(value))
        return plain.try_cast("double").cast(kind)
    return value


def records(pages: DataFrame, schema: str, body: str = "body", page: str = "page", required: Sequence[str] = REQUIRED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signals in delivery order, rejected records, quarantined pages) of (page, body); nothing is in none of them. A poll's ``poll`` and ``stop`` are kept.

    ``schema`` is a page's, with ``alerts``. Signals have ``page``, ``pos``, the model's fields and ``payload``, the record's text; rejected
    records have ``page``, ``pos``, ``payload`` and ``reasons``.
    """
    good, broken = ingest.parse_pages(pages, "alerts ARRAY<STRING>, nextPage STRING", body)
    model = next(f.dataType.elementType for f in _parse_datatype_string(schema).fields if f.name == "alerts")
    place = [*(c for c in ("poll", "stop") if c in pages.columns), page, "pos"]
    each = good.select(*place[:-1], F.posexplode("payloads").alias("pos", "payload"))
    parsed = ingest.once(each, "_v", F.try_parse_json("payload"))
    checked = ingest.once(parsed, "reasons", F.when(F.col("payload").isNull(), _said("record", "missing")).when(F.col("_v").isNull(), _said("record", "type")).otherwise(faults(F.col("_v"), model, required=required))).drop("_v")
    read = checked.where(F.size("reasons") == 0).withColumn("s", _typed(F.from_json("payload", _as_text(model).simpleString()), model))
    return read.select(*place, "s.*", "payload"), checked.where(F.size("reasons") > 0).select(*place, "payload", "reasons"), broken
