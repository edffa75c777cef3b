"""Joins for large tables: a cheap filter before a join, and a join that deals hot keys to many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 22
HOT_SHARE, FEW, SALTS = 2000, 256, 64


def maybe_in(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """``rows`` without most of those whose ``column`` isn't in ``keys``, so that the join behind moves few rows.

    A bit map of hashed keys goes to all tasks, as at most 2**16 words of 64 bits whatever the
    number of keys. On a corpus that fills the map it lets rows through, and the join decides.
    Rows with a null in ``column`` are dropped, as the join would.
    """
    bit = lambda: F.pmod(F.xxhash64(F.col(column)), F.lit(1 << BITS))
    word, place = F.shiftright(bit(), 6), F.expr(f"cast(pmod(xxhash64(`{column}`), {1 << BITS}) & 63 as int)")
    known = keys.select(word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), place).alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    found = rows.where(F.col(column).isNotNull()).withColumn("_at", word).join(F.broadcast(known), F.col("_at") == F.col("_word"))
    return found.where(F.call_function("shiftrightunsigned", F.col("_bits"), place).bitwiseAND(F.lit(1).cast("long")) == 1).drop("_at", "_word", "_bits")


def split_join(rows: DataFrame, small: DataFrame, key: str, count: str, total: int, deal: Column) -> DataFrame:
    """``rows`` joined with ``small`` (one row per ``key``, with the number of ``rows`` in ``count``), without ``count``.

    A key that more than one in ``HOT_SHARE`` of all rows, and more than ``FEW``, have is hot; there are fewer than
    ``HOT_SHARE`` of them, so their list is broadcast. Rows of hot keys are dealt to ``SALTS``
    tasks by ``deal``, and the hot rows of ``small`` are repeated for each.
    """
    hot = F.col(count) > max(FEW, total // HOT_SHARE)
    listed = F.broadcast(small.where(hot).select(F.col(key).alias("_hot")))
    dealt = rows.join(listed, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.when(F.col("_hot").isNotNull(), F.pmod(deal, F.lit(SALTS)).cast("int")).otherwise(0)).drop("_hot")
    salts = F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(small.withColumn("_salt", F.explode(salts)).drop(count), [key, "_salt"]).drop("_salt")
