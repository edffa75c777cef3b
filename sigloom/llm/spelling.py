"""Spelling variants: words of a corpus that one edit tells apart, and the frequent form behind a rare one.

Two words are near if exactly one inserted, deleted or replaced code point tells them apart. One edit leaves
a half of a word intact. So there is a forward dictionary, sorted by the first halves, and a
reversed one, sorted by the ends read backwards: near words stand in one block of a dictionary, which
shares that half. Both are one range-sorted table, scanned once; a block's words are compared with each other.

A block of more than ``BLOCK`` words is not compared but subdivided: the edit lies in the first or in the
second half of what its words don't share, so each word goes on to two blocks that share more. Where a
single place is left, all words of one length in a block are near by construction, and a block has at most
as many of them as there are letters. The range sort is by block and word, so a skewed block is spread over as many
partitions as it fills. What is cut by the edge of a partition can't be compared in full there and is subdivided too.

``variants`` takes words by a rule that fits its data: runs of letters, lower-cased, some
with a letter deleted by a rule of its own (``dropped``), which are then the misspellings to be found.

Defined results: a null text has no words; a null doc_id counts as an empty one; repeated rows count again; an empty
table, or one without words, gives no rows; ties for a form go to the smallest in code point order; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import stage

#: Fixed values of the word rule.
LETTERS, LEAST_LETTERS, LEAST_TIMES, DROPS = r"[A-Za-zÀ-ÿ]", 7, 2, 31
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A word's form is so many times as frequent.
TIMES = 10

#: Words of a block that are compared; code points of a word that are compared in one go with others.
BLOCK, WIDE = 40, 64

_SCANNED = "pair boolean, word string, n long, other string, m long, s int, lo int, hi int"


def dropped(word: Column, doc_id: Column) -> Column:
    """``word`` without a letter, if ``DROPS`` divides the crc32 of ``<doc_id>:<word>``; the crc32 also says which."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (h % F.char_length(word)).cast("int")
    return F.when(h % DROPS == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))).otherwise(word)


def words(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_times: int = LEAST_TIMES, misspell: bool = True) -> DataFrame:
    """(word, n): the words of all whole texts, of at least so many letters and occurrences."""
    runs = F.regexp_extract_all("text", F.lit(LETTERS + "{" + str(least_letters) + ",}"), F.lit(0))  # a run only gets shorter by a drop
    each = docs.select(F.col("doc_id"), F.explode(runs).alias("word")).withColumn("word", F.translate("word", _UPPER, _LOWER))
    each = each.select(dropped(F.col("word"), F.col("doc_id")).alias("word")) if misspell else each.select("word")
    return each.where(F.char_length("word") >= least_letters).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_times)


def _matrix(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points, a row per text, and lengths."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    width = int(lengths.max()) + 1
    points = np.array(texts, dtype=f"<U{width}").view(np.uint32).reshape(len(texts), width)
    return (points.astype(np.uint8) if points.max() < 256 else points), lengths


def _near(points: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of rows are one edit apart; those of ``a`` are as long as their partners or one shorter."""
    ok = np.zeros(len(a), bool)
    same = lengths[a] == lengths[b]
    i = np.flatnonzero(same)
    ok[i] = (points[a[i]] != points[b[i]]).sum(axis=1) == 1
    i = np.flatnonzero(~same)
    if len(i):
        p, q = points[a[i]], points[b[i]]
        split = np.argmax(p != q, axis=1)  # the shorter one ends in a zero, so there is a difference
        behind = (p[:, :-1] != q[:, 1:]) & (np.arange(p.shape[1] - 1) >= split[:, None])
        ok[i] = ~behind.any(axis=1)
    return ok


def _one_edit(a: str, b: str) -> bool:
    """The same for two long words."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    lo, hi = 0, len(a)  # the length of the common prefix, by halving
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return a[lo + (len(a) == len(b)) :] == b[lo + 1 :]


class _Scan:
    """Goes through one partition of the sorted dictionary and keeps less than a block of rows between batches."""

    def __init__(self, block: int):
        self.block = block
        self.kept: pa.RecordBatch | None = None
        self.passed: str | None = None  # the block whose rows are passed on, whatever comes
        self.begun = False

    def batch(self, batch: pa.RecordBatch, last: bool = False) -> Iterator[pa.RecordBatch]:
        if self.kept is not None:
            batch = pa.Table.from_batches([self.kept, batch]).combine_chunks().to_batches()[0] if batch.num_rows else self.kept
            self.kept = None
        if not batch.num_rows:
            return
        keys = batch.column("key").to_pylist()
        starts = np.flatnonzero([True, *(x != y for x, y in zip(keys, keys[1:], strict=False))])
        sizes = np.diff([*starts, len(keys)])
        single = (batch.column("hi").to_numpy() - batch.column("lo").to_numpy() <= 1)[starts]
        if not self.begun:  # may have begun in the partition before
            self.begun, self.passed = True, keys[0]
        on = sizes > self.block
        on[0] |= keys[0] == self.passed
        self.passed = None
        if last:
            on[-1] = True  # may go on in the next partition
        on &= ~single
        end = len(keys)
        if not last:
            if on[-1]:
                self.passed = keys[-1]
            else:
                end = int(starts[-1])
                self.kept = batch.slice(end)
                starts, sizes, on = starts[:-1], sizes[:-1], on[:-1]
        if end == 0:
            return
        batch = batch.slice(0, end)
        each = np.repeat(on, sizes)
        if each.any():
            rows = batch.filter(pa.array(each))
            none = lambda kind: pa.nulls(rows.num_rows, kind)
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(rows.num_rows, bool)), rows.column("word"), rows.column("n"), none(pa.string()), none(pa.int64()), rows.column("s"), rows.column("lo"), rows.column("hi")], names=_NAMES)
        yield from self._pairs(batch, starts[~on & (sizes > 1)], sizes[~on & (sizes > 1)])

    def _pairs(self, batch: pa.RecordBatch, starts: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Near pairs inside blocks."""
        if not len(starts):
            return
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)  # in the block
        rows, left = np.repeat(starts, sizes) + place, np.repeat(sizes, sizes) - 1 - place
        texts, counts, s = np.array(batch.column("word").to_pylist(), object)[rows], batch.column("n").to_numpy()[rows], batch.column("s").to_numpy()[rows]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        narrow = lengths <= WIDE
        points = np.zeros((len(texts), 1), np.uint8)
        if narrow.any():
            points, _ = _matrix([t if ok else "" for t, ok in zip(texts, narrow, strict=True)])
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for d in range(1, int(sizes.max())):
            a = np.flatnonzero(left >= d)
            b = a + d
            use = (lengths[a] == s[a]) | (lengths[b] == s[b])  # two of the longer words are a matter of another block
            a, b = a[use], b[use]
            turn = lengths[a] > lengths[b]
            a, b = np.where(turn, b, a), np.where(turn, a, b)
            wide = ~narrow[a] | ~narrow[b]
            ok = np.zeros(len(a), bool)
            ok[~wide] = _near(points, lengths, a[~wide], b[~wide])
            for i in np.flatnonzero(wide):
                ok[i] = _one_edit(texts[a[i]], texts[b[i]])
            found.append((a[ok], b[ok]))
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        if len(a):
            none = pa.nulls(len(a), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(a), bool)), pa.array(texts[a].tolist(), pa.string()), pa.array(counts[a]), pa.array(texts[b].tolist(), pa.string()), pa.array(counts[b]), none, none, none], names=_NAMES)


_NAMES = [f.split()[0] for f in _SCANNED.split(", ")]


def _scanned(rows: DataFrame, block: int) -> DataFrame:
    """One pass over the dictionaries: near pairs, and rows of blocks to be subdivided."""
    intact = F.concat_ws("/", "s", "lo", "hi", F.substring("word", F.lit(1), F.col("lo")), F.substring(F.reverse("word"), F.lit(1), F.col("s") - F.col("hi")))
    keyed = rows.withColumn("key", intact).withColumn("spread", F.when(F.col("hi") - F.col("lo") > 1, F.col("word")).otherwise(""))
    placed = keyed.repartitionByRange("key", "spread").sortWithinPartitions("key", "spread").drop("spread")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, schema = _Scan(block), None
        for batch in batches:
            schema = batch.schema
            yield from state.batch(batch)
        if schema is not None:
            yield from state.batch(pa.RecordBatch.from_pylist([], schema), last=True)

    return placed.mapInArrow(scan, _SCANNED)


def _halved(rows: DataFrame) -> DataFrame:
    """Each row in the two blocks whose edit lies in the first or the second half of lo..hi."""
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    return rows.select("word", "n", "s", F.explode(F.array(F.struct(F.col("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), F.col("hi")))).alias("h")).select("word", "n", "s", "h.lo", "h.hi")


def near(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n, other, m): all pairs of near words of (word, n), in both directions, once each.

    A word takes part as one of its own length, and as the longer of two whose shorter has ``s`` code points.
    """
    size = F.char_length("word")
    rows = vocabulary.where(size > 1).select("word", "n", F.explode(F.array(size, size - 1)).alias("s")).select("word", "n", "s", F.lit(0).alias("lo"), F.col("s").alias("hi"))
    short = vocabulary.where(size == 1).select("word", "n", F.lit(1).alias("s"), F.lit(0).alias("lo"), F.lit(1).alias("hi"))
    rows = _halved(rows.where("s > 1")).unionByName(rows.where("s = 1")).unionByName(short)
    found, level = [], 0
    while True:
        table = stage.written(_scanned(rows, block), f"spelling-{level}")
        found.append(table.where("pair").select("word", "n", "other", "m"))
        rows = _halved(table.where("not pair").select("word", "n", "s", "lo", "hi"))
        if table.where("not pair").isEmpty():
            break
        level += 1
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("m").alias("n"), F.col("word").alias("other"), F.col("n").alias("m"))).distinct()


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form), a forest: from each word along the forms to the last, by doubling the steps."""
    held = stage.written(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = held.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        moved = stage.written(held.join(on, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "spelling-roots")
        stage.discard(held)
        held = moved.select("word", "root")
        held._written_at = moved._written_at
        if moved.where("moved").isEmpty():
            return held


def forms(vocabulary: DataFrame, times: int = TIMES, block: int = BLOCK) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of (word, n); see ``variants``."""
    mark = stage.tables_made()
    vocabulary = stage.written(vocabulary.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    alone = vocabulary.withColumns({"other": F.lit(None).cast("string"), "m": F.lit(None).cast("long")})
    first = F.min(F.when(F.col("other").isNotNull(), F.struct((-F.col("m")).alias("m"), "other")))
    per = alone.unionByName(near(vocabulary, block)).groupBy("word").agg(F.max("n").alias("n"), F.count("other").alias("n_near"), first.alias("_top"))
    much = -F.col("_top.m") >= times * F.col("n")
    per = stage.written(per.select("word", "n", "n_near", F.when(much, F.col("_top.other")).alias("form"), F.when(much, -F.col("_top.m")).alias("form_n")), "spelling-forms")
    ends = roots(per.where("form is not null"))
    stage.discard_since(mark, per, ends)
    return per.join(ends.withColumnRenamed("word", "_of"), F.col("word") == F.col("_of"), "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def variants(docs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root: every word of the corpus, its near words, and the form it is a variant of.

    A word's form is its near word of largest n, the smallest of several, if that is ``TIMES`` as frequent as the word; root is the last of the
    forms that follow from it, or the word itself.
    """
    return forms(words(docs))
