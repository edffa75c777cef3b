"""Phrases of a lexicon in texts, for lexicons of any size.

A text's runs of one to so many words as the lexicon's phrases have are hashed, and those that aren't in a bit map of fixed
size, of the lexicon's hashes, are dropped where the text is read, once, whatever the lexicon's size. What is left is counted per text and
joined with the lexicon by the phrase itself: with its shorter phrases, up to ``PART`` of them, by
broadcast, with the others by shuffle. Words are runs of letters, digits and underscores, in lower case.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..llm import words as scanned
from ..sources import scratch
from . import skew

PART, LONGEST = 200_000, 8
#: Bits of the map of hashes, two of which a phrase sets, and how far from each other they are taken out of its hash.
BITS, APART = 26, 32


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"), lambda w: w != "")


def lexicon(phrases: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(phrase, code, size) of (phrase, code): normalised, once each. Phrases of no word or of more than ``longest`` are refused when this is read."""
    named = phrases.select(words(F.col("phrase")).alias("w"), "code").withColumn("size", F.size("w"))
    checked = F.when(F.col("size").between(1, longest), F.array_join("w", " ")).otherwise(F.raise_error(F.concat(F.lit("not a phrase: "), F.array_join("w", " "))))
    return named.select(checked.alias("phrase"), "code", "size").distinct()


def _spaced(text: Column) -> Column:
    """The words of a text with one space between."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_]+", " ")


def _bit_map(known: DataFrame, sizes: list[int]) -> np.ndarray:
    """The bits of the lexicon's phrases, in words of 64."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scanned.scan(batch.column(0), scanned.SPACED)
            many = np.diff(found.first)
            for size in sizes:
                hashes, at = found.windows(size)
                hashes = hashes[many[np.searchsorted(found.first, at, "right") - 1] == size]  # whole phrases
                for shift in (0, APART):
                    bit = (hashes >> np.uint64(shift)) & np.uint64((1 << BITS) - 1)
                    yield pa.RecordBatch.from_arrays([pa.array((bit >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (bit & np.uint64(63))).view(np.int64))], ["place", "bit"])

    per = known.select("phrase").mapInArrow(bits, "place long, bit long").groupBy("place").agg(F.bit_or("bit").alias("bits")).toArrow()  # 2 ** (BITS - 6) rows at most
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[per.column("place").to_numpy()] = per.column("bits").to_numpy().view(np.uint64)
    return out


def _pieces(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Strings out of UTF-8 bytes."""
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=offsets[1:])
    picked = data[np.repeat(start - offsets[:-1], end - start) + np.arange(offsets[-1])]
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(picked)).cast(pa.string())


def _counted(texts: DataFrame, known: DataFrame, sizes: list[int], key: str, text: str) -> DataFrame:
    """(_key, phrase, size, n): the runs of every text that may be phrases, and how often they stand in it."""
    have = texts.sparkSession.sparkContext.broadcast(_bit_map(known, sizes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = have.value
        for part in (p for batch in batches for p in scanned.slices(batch, "_text")):
            found = scanned.scan(part.column(1), scanned.SPACED)
            for size in sizes:
                hashes, at = found.windows(size)
                for shift in (0, APART):
                    bit = (hashes >> np.uint64(shift)) & np.uint64((1 << BITS) - 1)
                    may = np.flatnonzero((table[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1))
                    hashes, at = hashes[may], at[may]
                if not len(at):
                    continue
                of = np.searchsorted(found.first, at, "right") - 1
                order = np.lexsort((hashes, of))
                of, hashes, at = of[order], hashes[order], at[order]
                first = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])])
                n = np.diff(np.r_[first, len(of)])
                of, at = of[first], at[first]
                phrases = _pieces(found.raw, found.start[at], found.end[at + size - 1])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(of)), phrases, pa.array(np.full(len(n), size, np.int32)), pa.array(n.astype(np.int64))], ["_key", "phrase", "size", "n"])

    kind = texts.schema[key].dataType.simpleString()
    return texts.select(F.col(key).alias("_key"), _spaced(F.col(text)).alias("_text")).mapInArrow(count, f"_key {kind}, phrase string, size int, n long")


def matches(texts: DataFrame, phrases: DataFrame, key: str = "doc_id", text: str = "text", part: int = PART) -> DataFrame:
    """(key, code, n): how many places of a text (unique ``key``) hold a phrase (phrase, code); a phrase of two codes counts for both."""
    known = scratch.written(lexicon(phrases), "lexicon")
    per = {r["size"]: r["count"] for r in known.groupBy("size").count().collect()}  # LONGEST at most
    sizes = sorted(per)
    short = max((size for size in sizes if sum(per[s] for s in sizes if s <= size) <= part), default=0)
    runs = _counted(texts, known, sizes, key, text)
    rest = bool(sizes) and short < sizes[-1]
    if rest:
        runs = scratch.written(runs, "runs")  # read three times
    table = known.select("phrase", "code", "size")
    found = runs.where(F.col("size") <= short).join(F.broadcast(table.where(F.col("size") <= short).drop("size")), "phrase").groupBy("_key", "code").agg(F.sum("n").alias("n"))
    if rest:
        longer = runs.where(F.col("size") > short).drop("size")
        met = skew.dealt_join(longer, table.where(F.col("size") > short).drop("size"), ["phrase"], skew.hot_keys(longer, ["phrase"]), F.xxhash64("_key"))
        found = found.unionByName(met.groupBy("_key", "code").agg(F.sum("n").alias("n"))).groupBy("_key", "code").agg(F.sum("n").alias("n"))
    return found.withColumnRenamed("_key", key)


def classify(signals: DataFrame, phrases: DataFrame, key: str = "signal_id", text: str = "text", title: str = "title") -> DataFrame:
    """``events.classify`` with a lexicon of phrases: adds disaster_types, relevance, severity and summary."""
    per = matches(signals, phrases, key, text).groupBy(key).agg(F.array_sort(F.collect_set("code")).alias("_types"), F.sum("n").alias("_total"))
    total = F.coalesce("_total", F.lit(0))
    return signals.join(per, key, "left").withColumns({
        "disaster_types": F.coalesce("_types", F.array().cast("array<string>")), "relevance": F.least(total / F.lit(4.0), F.lit(1.0)), "severity": F.least(F.lit(5), F.lit(1) + total).cast("int"),
        "summary": F.coalesce(F.col(title), F.lit("")),
    }).drop("_types", "_total")
