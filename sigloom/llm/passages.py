"""Substring dedup: content-defined chunks by a gear rolling hash, deduplicated by digest.

Words are runs of anything but U+0020 and U+0009-U+000D, A-Z lower-cased. The gear hash
h = (h << 1) + g(word) is tested on its bits 1 and 3, which depend on the last four words
alone. A chunk ends after a word that passes the test unless the word before passed too,
or after ``MAX_CHUNK`` words. Cuts depend on nothing but the words around them, so an
insertion moves no cut beyond a few words, and equal passages are cut alike in all texts.

The digest covers a chunk together with the next one. Digests that occur under two or
more doc_ids are repeated; runs of overlapping repeated pairs are passages. A shared passage
begins and ends inside chunks that aren't shared, so a run of fewer than ``MIN_WORDS`` words
that may belong to a passage of as many is decided on the text: the windows of ``MIN_WORDS``
words around it, and around the same pairs in other documents, are compared by hash. A passage of
one word or a short cycle of words has hardly a cut, so no pair need be shared: the windows with
fewer than three cuts by their own words are compared by hash wherever they are. The
document with the smallest doc_id keeps its copy.

Moving digests costs two shuffles of one narrow row per chunk. The first is
pre-aggregated; the second is a join that deals the rows of a digest that many rows
share to many tasks. Only repeated chunks go on to be grouped, by document, and only the texts of
documents with a doubtful run are read again.

Defined results: rows with a null doc_id are not compared (``remove`` keeps them as they are); null,
empty and short texts have no chunks; rows of one doc_id are one document, whose different texts
follow one another in the order of their hash, each beginning ``GAP`` words and as many as the text
before has characters after that one; an empty table gives an empty result; other columns, whatever
their names, are ignored by ``find`` and kept by ``remove``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import stage, words
from .semijoin import maybe_in, split_join

MIN_WORDS = 50
MAX_CHUNK = 64
_TEST = np.uint64(0b1010)
_WINDOW = 4
GAP = 64  # words between two texts of a document
_FAR = 255  # this many words or more, in a packed place


def _cuts(found: words.Words) -> np.ndarray:
    """For every word, whether the words around it decide that a chunk ends after it."""
    n = len(found.hash)
    h = found.hash
    for shift in (1, 2):
        older = np.zeros_like(h)
        older[shift:] = h[:-shift] << np.uint64(shift)
        h = h + older
    passed = (h & _TEST) == 0
    text = np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))
    inside = np.arange(n) - found.first[text]
    passed &= inside >= _WINDOW - 1  # else the window holds words of the text before
    ends = passed.copy()
    ends[1:] &= ~(passed[:-1] & (inside[1:] > 0))
    return ends


def chunk_ends(found: words.Words, cuts: np.ndarray) -> np.ndarray:
    """For every word, whether a chunk ends after it."""
    ends = cuts.copy()
    last = found.first[1:][np.diff(found.first) > 0] - 1
    ends[last] = True
    at = np.flatnonzero(ends)
    sizes = np.diff(np.concatenate(([-1], at)))
    for i in np.flatnonzero(sizes > MAX_CHUNK).tolist():
        ends[at[i] - sizes[i] + MAX_CHUNK : at[i] : MAX_CHUNK] = True
    return ends


def _few_cuts(cuts: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Whether the windows that begin ``at`` have fewer than three cuts that their own words decide.

    Three of them bound two chunks that every copy of the window has; with fewer it may lack a pair.
    """
    before = np.concatenate(([0], np.cumsum(cuts)))
    return before[at + size] - before[np.minimum(at + _WINDOW, at + size)] < 3


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """digest of two chunks in a row; place: start, words of the pair, back to the last cut by words before the chunk before it, of the chunk after it, of its first chunk."""
    for batch in batches:
        for part in words.slices(batch):
            found = words.scan(part.column("text"), words.SPACED)
            n = len(found.hash)
            if not n:
                continue
            cuts = _cuts(found)
            end = np.flatnonzero(chunk_ends(found, cuts)) + 1
            start = np.concatenate(([0], end[:-1]))
            text = np.searchsorted(found.first, start, side="right") - 1
            decided = cuts[start - 1] | (start == found.first[text])  # not after MAX_CHUNK words
            back = np.maximum.accumulate(np.where(decided, start, 0))
            size = end - start
            pair = np.flatnonzero(text[1:] == text[:-1])
            if not len(pair):
                continue
            a, b = start[pair], end[pair + 1]
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(found.hash * words.powers(words._STEP, n), out=sums[1:])
            digest = words.mix((sums[b] - sums[a]) * words.powers(words._STEP_INVERSE, n + 1)[a] + (b - a).astype(np.uint64))
            before = np.where((pair > 0) & (text[pair - 1] == text[pair]), np.minimum(a - back[pair - 1], _FAR), 0)
            two = np.minimum(pair + 2, len(size) - 1)
            after = np.where((pair + 2 < len(size)) & (text[two] == text[pair]), size[two], 0)
            place = a - found.first[text[pair]] + part.column("base").to_numpy()[text[pair]]
            for value in (b - a, before, after, size[pair]):
                place = (place << 8) | value
            yield pa.RecordBatch.from_arrays([pa.array(digest.view(np.int64)), part.column("doc_id").take(pa.array(text[pair])), pa.array(place)], names=["digest", "doc_id", "place"])


def _union(spans: list[tuple[int, int]]) -> list[int]:
    """[a0, b0, a1, b1, ...] of the union of [a, b) ranges."""
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += (a, b)
    return out


def runs(places: list[tuple], min_words: int) -> list[dict]:
    """Runs of repeated pairs of one document that may belong to a passage of ``min_words``.

    ``places``: (packed place, smallest doc_id of the digest, digest), sorted. A run has start and
    end, lo and hi (as far as a shared passage around it can reach) and its pairs. A passage's
    first chunk may be cut off by a cut that depends on words before the passage, so lo goes
    ``_WINDOW`` words beyond the chunk before; a cut after ``MAX_CHUNK`` words depends on all words since
    the last other cut, so lo goes back to that.
    """
    out: list[dict] = []
    chunk_end = -1
    for packed, keeper, digest in places:
        size, before, after, head = (packed >> shift & 255 for shift in (24, 16, 8, 0))
        start = packed >> 32
        if start > chunk_end:  # else its first chunk is the second of the pair before
            out.append({"start": start, "lo": max(0, start - before - _WINDOW) if before < _FAR else 0, "pairs": []})
        out[-1] |= {"end": start + size, "hi": start + size + after}
        out[-1]["pairs"].append((start, size, keeper, digest))
        chunk_end = start + head
    return [r for r in out if r["hi"] - r["lo"] >= min_words]


def find(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per repeated passage of a document; documents without one don't occur.

    doc_id, first_doc_id (smallest doc_id that holds any of it), word_start, word_end, n_words,
    n_removed and removed (its words that a document with a smaller doc_id keeps: their number,
    and [start, end, ...]).
    """
    spark = docs.sparkSession
    doc_type = dict(docs.dtypes)["doc_id"]
    mark = stage.tables_made()
    rows = _based(docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.col("text").cast("string").alias("text")))
    chunks = stage.written(rows.mapInArrow(_chunks, f"digest long, doc_id {doc_type}, place long"), "chunks")
    grouped = _among_repeated(chunks, "digest")[0].groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("place", "first_doc_id", "digest"))).alias("places"))

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for run in runs([tuple(p.values()) for p in places], min_words):
                    sure = run["end"] - run["start"] >= min_words
                    removed = _union([(a, a + size) for a, size, keeper, _ in run["pairs"] if keeper != doc])
                    out.append((doc, min(p[2] for p in run["pairs"]), run["start"], run["end"], removed, [] if sure else [p[3] for p in run["pairs"]]))
            yield _batch(out, [*_types(batch), pa.list_(pa.int64())], [*_NAMES, "digests"])

    found = stage.written(grouped.mapInArrow(passages, f"{_ddl(doc_type)}, digests array<long>"), "runs")
    stage.release(spark)
    sure = found.where("size(digests) = 0").drop("digests")
    doubtful = stage.written(found.select(F.explode("digests").alias("digest")).distinct(), "doubtful")
    exact, tables = _windows(rows, maybe_in(chunks, doubtful, "digest").join(doubtful, "digest").select("doc_id", "place"), doc_type, min_words)
    stage.discard_since(mark, found, *tables)
    merged = sure.unionByName(exact).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("word_start", "word_end", "first_doc_id", "removed"))).alias("spans"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = []
            for doc, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for s in spans:
                    if out and out[-1][0] == doc and s["word_start"] < out[-1][3]:
                        last = out[-1]
                        ranges = [*zip(last[4][::2], last[4][1::2], strict=True), *zip(s["removed"][::2], s["removed"][1::2], strict=True)]
                        last[1], last[3], last[4] = min(last[1], s["first_doc_id"]), max(last[3], s["word_end"]), _union(ranges)
                    else:
                        out.append([doc, s["first_doc_id"], s["word_start"], s["word_end"], s["removed"]])
            yield _batch(out, _types(batch), _NAMES)

    lengths = "word_end - word_start as n_words", "cast(aggregate(transform(removed, (x, i) -> if(i % 2 = 1, x, -x)), 0L, (a, x) -> a + x) as long) as n_removed"
    return merged.mapInArrow(merge, _ddl(doc_type)).selectExpr("doc_id", "first_doc_id", "word_start", "word_end", *lengths, "removed")


_NAMES = ["doc_id", "first_doc_id", "word_start", "word_end", "removed"]


def _ddl(doc_type: str) -> str:
    return f"doc_id {doc_type}, first_doc_id {doc_type}, word_start long, word_end long, removed array<long>"


def _types(batch: pa.RecordBatch) -> list[pa.DataType]:
    return [batch.schema.field(0).type] * 2 + [pa.int64(), pa.int64(), pa.list_(pa.int64())]


def _batch(rows: list, types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _based(rows: DataFrame, doc: str = "doc_id", text: str = "text", base: str = "base") -> DataFrame:
    """``rows`` with the place ``base`` of their first word in their document: 0 unless its doc_id has several texts."""
    own, part_of, start = stage.fresh([*rows.columns, base], "_doc", "_part", "_base")
    part = F.xxhash64(text)
    several = rows.groupBy(doc).agg(F.min(part).alias("least"), F.max(part).alias("most")).where("least <> most").select(F.col(doc).alias(own))
    several = stage.written(several, "several")
    if not several.limit(1).count():
        return rows.withColumn(base, F.lit(0).cast("long"))
    texts = rows.select(F.col(doc).alias(own), part.alias(part_of), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("size")).join(several, own, "left_semi").distinct()
    upto = Window.partitionBy(own).orderBy(part_of).rowsBetween(Window.unboundedPreceding, -1)
    bases = stage.written(texts.select(own, part_of, F.coalesce(F.sum(F.col("size") + GAP).over(upto), F.lit(0)).alias(start)), "bases")
    placed = rows.join(bases, (F.col(doc) == F.col(own)) & (F.xxhash64(F.col(text)) == F.col(part_of)), "left")
    return placed.withColumn(base, F.coalesce(start, F.lit(0).cast("long"))).drop(own, part_of, start)


def _among_repeated(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The written ``rows`` whose ``key`` two or more doc_ids have, with first_doc_id, the smallest of them; and the table of these keys."""
    found = rows.groupBy(key).agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last"), F.count("*").alias("times")).where("first_doc_id <> last")
    repeated = stage.written(found.select(key, "first_doc_id", "times"), "repeated")
    return split_join(rows, repeated, key, "times", rows.count(), F.xxhash64("doc_id")), repeated


def _window_rows(h: np.ndarray, at: np.ndarray, found: words.Words, part: pa.RecordBatch) -> pa.RecordBatch:
    text = np.searchsorted(found.first, at, side="right") - 1
    place = at - found.first[text] + part.column("base").to_numpy()[text]
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), part.column("doc_id").take(pa.array(text)), pa.array(place)], names=["window", "doc_id", "at"])


def _windows(rows: DataFrame, spots: DataFrame, doc_type: str, size: int) -> tuple[DataFrame, tuple[DataFrame, ...]]:
    """The passages around ``spots`` (doc_id, place) and those with few cuts, by the exact ``size``-word windows that two documents share; and the tables they are read from."""
    wanted = stage.written(spots.groupBy("doc_id").agg(F.collect_set("place").alias("places")), "spots")
    texts = maybe_in(rows, wanted, "doc_id").join(wanted, "doc_id")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch):
                found = words.scan(part.column("text"), words.SPACED)
                h, at = found.windows(size)
                ranges = []
                for i, (places, base) in enumerate(zip(part.column("places").to_pylist(), part.column("base").to_pylist(), strict=True)):
                    first, last = int(found.first[i]), int(found.first[i + 1]) - 1
                    for packed in places:
                        start = first + (packed >> 32) - base
                        if not first <= start <= last:  # in another text of the document
                            continue
                        end = start + (packed >> 24 & 255)  # windows that hold the pair, or that the pair holds
                        ranges.append((max(first, min(start, end - size)), min(last, max(start, end - size)) + 1))
                near = np.zeros(len(found.hash) + 1, np.int64)
                for a, b in ranges:
                    near[a] += 1
                    near[b] -= 1
                pick = (np.cumsum(near)[at] > 0) & ~_few_cuts(_cuts(found), at, size)
                yield _window_rows(h[pick], at[pick], found, part)

    def uncut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch):
                found = words.scan(part.column("text"), words.SPACED)
                h, at = found.windows(size)
                pick = _few_cuts(_cuts(found), at, size)
                yield _window_rows(h[pick], at[pick], found, part)

    schema = f"window long, doc_id {doc_type}, at long"
    emitted = stage.written(texts.mapInArrow(windows, schema).unionByName(rows.mapInArrow(uncut, schema)), "windows")
    shared, repeated = _among_repeated(emitted, "window")
    grouped = shared.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("at", "first_doc_id"))).alias("at"))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, windows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                cover = _union([(w["at"], w["at"] + size) for w in windows])
                for a, b in zip(cover[::2], cover[1::2], strict=True):
                    own = [w for w in windows if a <= w["at"] < b]
                    out.append((doc, min(w["first_doc_id"] for w in own), a, b, _union([(w["at"], w["at"] + size) for w in own if w["first_doc_id"] != doc])))
            yield _batch(out, _types(batch), _NAMES)

    return grouped.mapInArrow(spans, _ddl(doc_type)), (emitted, repeated)


def remove(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the passages that a document with a smaller doc_id keeps; columns as they were."""
    names = docs.columns
    doc, cuts, base = stage.fresh(names, "_cut_doc", "_cuts", "_base_word")
    found = find(docs, min_words).where("n_removed > 0").select(F.col("doc_id").alias(doc), F.posexplode("removed").alias("i", "at")).groupBy(doc).agg(F.sort_array(F.collect_list("at")).alias(cuts))
    joined = _based(docs, base=base).join(found, F.col("doc_id") == F.col(doc), "left").select(*(F.col(f"`{c}`") for c in names), base, cuts)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, (places, first) in enumerate(zip(batch.column(cuts).to_pylist(), batch.column(base).to_pylist(), strict=True)):
                if places and texts[i]:
                    spaced = words.scan(pa.array([texts[i]]), words.SPACED)
                    n = len(spaced.start)
                    raw, out, at = texts[i].encode(), [], 0
                    for a, b in zip(places[::2], places[1::2], strict=True):
                        a, b = max(0, a - first), min(n, b - first)
                        if a < b:  # else in another text of the document
                            out.append(raw[at : spaced.start[a]])
                            at = int(spaced.end[b - 1])
                    texts[i] = b"".join([*out, raw[at:]]).decode()
            kept = batch.select(names)
            at = names.index("text")
            yield kept.set_column(at, kept.schema.field(at), pa.array(texts, kept.schema.field(at).type))

    return joined.mapInArrow(cut, docs.schema)
