"""Answers that are asked for once and remembered for a while."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import scratch
from . import skew

#: Fixed value: how long an answer is taken as it is.
HOURS = 24


def answered(requests: DataFrame, memo: DataFrame, ask: Callable[[DataFrame], DataFrame], now: Column, hours: float = HOURS, key: str = "signal_id", failure: str = "failure") -> tuple[DataFrame, DataFrame]:
    """(``requests`` with the answers' columns, memo rows to be added).

    ``memo`` has ``key``, the columns of an answer and ``answered_at``; its newest row of a key counts, if it is younger than
    ``hours``. ``ask`` gets the other requests, each key once however often it was requested, the first by its other columns, and gives a row each: ``key``, the
    answer's columns and, maybe, ``failure``. Failed answers are given, but not remembered, so they are asked for again. What was
    asked is written before it is read twice, so no request is made again for that. A null key is not a request; it has no row.
    """
    columns = [c for c in memo.columns if c not in (key, "answered_at")]
    young = memo.where(F.col("answered_at") > now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(hours * 3600).cast("decimal(18,6)")))
    known = young.groupBy(key).agg(F.max_by(F.struct(*columns), "answered_at").alias("_a")).select(key, *(F.col(f"_a.{c}").alias(c) for c in columns))
    rest = [c for c in requests.columns if c != key]
    once = requests.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest) if rest else F.lit(0)).alias("_r"))
    once = once.select(key, *(F.col(f"_r.{c}").alias(c) for c in rest))
    fresh = scratch.written(ask(once.join(known.select(key), key, "left_anti")), "answers")
    failed = F.col(failure).isNotNull() if failure in fresh.columns else F.lit(False)
    more = [failure] if failure in fresh.columns else []
    every = fresh.select(key, *columns, *more).unionByName(known.select(key, *columns, *(F.lit(None).cast("string").alias(c) for c in more)))
    named = every.withColumnsRenamed({c: f"_answer_{c}" for c in [*columns, *more]})
    found = skew.dealt_join(requests, named, [key], skew.hot_keys(requests, [key]), F.xxhash64(*rest) if rest else F.monotonically_increasing_id())
    answers = found.select(*(c for c in requests.columns if c not in (*columns, *more)), *(F.col(f"_answer_{c}").alias(c) for c in [*columns, *more]))
    return answers, fresh.where(~failed).select(key, *columns, now.alias("answered_at"))
