"""A join that deals the rows of hot keys to many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot if more than one in ``SHARE`` of all rows, and more than ``FEW``, have it; there are fewer than ``SHARE`` such keys.
SHARE, FEW, MOST_SALTS = 1000, 1000, 256


def hot_keys(rows: DataFrame, keys: Sequence[str], share: int = SHARE, few: int = FEW) -> DataFrame:
    """(keys, _salts) of the hot keys, fewer than ``share``; their rows are dealt to ``_salts`` tasks."""
    total = rows.count()
    least = max(few, total // share)
    counted = rows.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > least)
    return counted.select(*keys, F.least(F.lit(MOST_SALTS), F.ceil(F.col("_rows") / least)).cast("int").alias("_salts"))


def dealt_join(rows: DataFrame, few: DataFrame, keys: Sequence[str], hot: DataFrame, deal: Column) -> DataFrame:
    """``rows`` joined with ``few`` on ``keys``, whose other columns differ in name; a null key matches nothing.

    Rows of ``hot`` keys go to one of their salts by ``deal``; the rows of ``few`` with such a key are repeated
    for each. The list of hot keys is broadcast, which is bounded by ``hot_keys``.
    """
    listed = F.broadcast(hot.withColumnsRenamed({k: f"_hot_{k}" for k in keys}))
    named = [F.col(k) == F.col(f"_hot_{k}") for k in keys]
    drop = ["_salts", *(f"_hot_{k}" for k in keys)]
    dealt = rows.join(listed, named, "left").withColumn("_salt", F.coalesce(F.pmod(deal, F.col("_salts")).cast("int"), F.lit(0))).drop(*drop)
    spread = few.join(listed, named, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop(*drop)
    return dealt.join(spread, [*keys, "_salt"]).drop("_salt")
