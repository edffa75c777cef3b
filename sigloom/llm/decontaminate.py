"""Benchmark decontamination: a broadcast hash set of benchmark n-grams, scanned over token windows.

Words are runs of 0-9, a-z (A-Z lower-cased first) and characters from U+0080 on.
Every ``size`` consecutive words of a benchmark item are a window; an item with
fewer words, but not none, is one window. A document word inside any occurrence
of a window is hit; hash hits are verified on the words themselves.

Defined results: null or empty texts have no words and no hits; null or repeated
benchmark items behave as one item per distinct id; repeated document rows give
repeated result rows; an empty benchmark hits nothing; other columns are carried
by ``decontaminate`` and ignored by ``scan_documents``. A null item id counts as
an item and is written as an empty string.

The broadcast is bounded: items are cut into pieces of overlapping words, and benchmarks of
more than ``max_windows`` windows are dealt by hash to blocks of about that many. Windows travel
as arrays of hashes and of places in the pieces' text, about 30 bytes and the text for each.
With several blocks each finds its hits by row, and these alone meet at the end.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import stage, words

SIZE = 13
MAX_WINDOWS = 1_000_000
_MAP_BITS = 22


class WindowSet:
    """Distinct windows by length: sorted hashes with a bit map before them, where the words of each stand, and the items that have it."""

    def __init__(self, rows: list[tuple[str, str]], size: int):
        found = words.scan(pa.array([text for _, text in rows], pa.string()), words.ALNUM)
        self.items = [item for item, _ in rows]
        self.data, self.start, self.end = found.data, found.start, found.end
        self.known: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        n = np.diff(found.first)
        for k in sorted({min(size, x) for x in n.tolist() if x}):
            h, at = found.windows(k)
            owner = np.searchsorted(found.first, at, side="right") - 1
            mine = np.minimum(n[owner], size) == k
            h, at, owner = h[mine], at[mine], owner[mine].astype(np.int32)
            order = np.lexsort((owner, h))
            h, at, owner = h[order], at[order], owner[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            sizes = np.diff([*first, len(h)])
            split = [i for i in np.flatnonzero(sizes > 1).tolist() if len({self._words(x, x + k) for x in at[first[i] : first[i] + sizes[i]].tolist()}) > 1]
            if split:  # other words with one hash: windows of their own
                group = np.repeat(np.arange(len(first)), sizes)
                of = np.zeros(len(h), np.int64)
                for i in split:
                    here = slice(first[i], first[i] + sizes[i])
                    texts = [self._words(x, x + k) for x in at[here].tolist()]
                    of[here] = [sorted(set(texts)).index(t) for t in texts]
                order = np.lexsort((owner, of, group))
                h, at, owner, of, group = h[order], at[order], owner[order], of[order], group[order]
                first = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (of[1:] != of[:-1])]))
            seen = np.zeros(1 << _MAP_BITS, bool)
            seen[h >> np.uint64(64 - _MAP_BITS)] = True
            self.known[k] = h[first], at[first], np.append(first, len(h)), owner, seen

    def _words(self, a: int, b: int) -> bytes:
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.start[a:b], self.end[a:b], strict=True))

    def hits(self, found: words.Words) -> tuple[np.ndarray, dict[int, set[str]]]:
        """Which words are hit, and the items that occur in each text."""
        n = len(found.hash)
        edges = np.zeros(n + 1, np.int32)
        occurring: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for k, (known, places, _, _, seen) in self.known.items():
            h, at = found.windows(k)
            maybe = np.flatnonzero(seen[h >> np.uint64(64 - _MAP_BITS)])
            lo, hi = (np.searchsorted(known, h[maybe], side) for side in ("left", "right"))
            some = np.flatnonzero(lo < hi)
            at, lo, hi = at[maybe[some]], lo[some], hi[some]
            docs = np.searchsorted(found.first, at, side="right") - 1
            for a, doc, x, y in zip(at.tolist(), docs.tolist(), lo.tolist(), hi.tolist(), strict=True):
                text = found.text(a, a + k)
                for j in range(x, y):  # one, but for windows that share a hash
                    if self._words(places[j], places[j] + k) == text:
                        occurring[doc].add((k, j))
                        edges[a] += 1
                        edges[a + k] -= 1
                        break
        return np.cumsum(edges[:-1]) > 0, {doc: self._items_of(windows) for doc, windows in occurring.items()}

    def _items_of(self, windows: set[tuple[int, int]]) -> set[str]:
        """The items of distinct windows; those of windows with the same items are looked up once."""
        owners = [self.known[k][3][self.known[k][2][j] : self.known[k][2][j + 1]] for k, j in windows]
        return {self.items[i] for i in np.unique(np.concatenate(owners)).tolist()}


def _pieces(benchmark: DataFrame, size: int, most: int) -> DataFrame:
    """(item, piece, windows): the words of the items, in pieces of at most ``most`` windows; every window is in one piece."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch):
                found = words.scan(part.column("text"), words.ALNUM)
                items, pieces, windows = [], [], []
                for item, a, b in zip(part.column("item").to_pylist(), found.first.tolist(), found.first[1:].tolist(), strict=False):
                    for first in range(a, max(a + 1, b - size + 1), most):
                        last = min(b, first + most + size - 1)
                        if last > first:
                            items.append(item)
                            pieces.append(found.text(first, last).decode())
                            windows.append(max(1, last - first - size + 1))
                yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(pieces, pa.string()), pa.array(windows, pa.int64())], names=["item", "piece", "windows"])

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, "item string, piece string, windows long")


def _blocks(benchmark: DataFrame, size: int, max_windows: int) -> Iterator[WindowSet]:
    """Window sets of about ``max_windows`` windows at most, one at a time."""
    pieces = stage.written(_pieces(benchmark, size, max(1, max_windows // 8)).distinct(), "pieces")
    count = pieces.agg(F.coalesce(F.sum("windows"), F.lit(0))).first()[0]
    blocks = max(1, -(-int(count) // max_windows))
    for b in range(blocks):
        part = pieces if blocks == 1 else pieces.where(F.pmod(F.xxhash64("item", "piece"), F.lit(blocks)) == b)
        yield WindowSet([(r.item, r.piece) for r in part.select("item", "piece").collect()], size)  # about max_windows windows


Make = Callable[[pa.RecordBatch, words.Words, np.ndarray, dict[int, set[str]]], pa.RecordBatch]


def _runs(hit: np.ndarray) -> np.ndarray:
    """[a0, b0, a1, b1, ...] of the runs of True."""
    return np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))


def _scanned(docs: DataFrame, windows: WindowSet, text: str, make: Make, schema: T.StructType) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, text):
                found = words.scan(part.column(text), words.ALNUM)
                yield make(part, found, *sent.value.hits(found))

    return docs.mapInArrow(run, schema)


def _through(docs: DataFrame, benchmark: DataFrame, size: int, max_windows: int, make: Make, schema: T.StructType) -> DataFrame:
    """``make`` of all rows with the hits of all blocks. Its batches have the columns of ``docs`` first."""
    stage.small_batches(docs.sparkSession)
    text, row, spans, items = stage.fresh(docs.columns, "_text", "_row", "_spans", "_items")
    cast = docs.withColumn(text, F.col("text").cast("string"))
    blocks = _blocks(benchmark, size, max_windows)
    windows, following = next(blocks), next(blocks, None)
    if following is None:
        return _scanned(cast, windows, text, make, schema)

    def hits(part: pa.RecordBatch, found: words.Words, hit: np.ndarray, names: dict[int, set[str]]) -> pa.RecordBatch:
        some = sorted(names)
        runs = [_runs(hit[found.first[i] : found.first[i + 1]]).tolist() for i in some]
        return pa.RecordBatch.from_arrays([part.column(row).take(pa.array(some, pa.int64())), pa.array(runs, pa.list_(pa.int64())), pa.array([sorted(names[i]) for i in some], pa.list_(pa.string()))], names=[row, spans, items])

    keyed = stage.written(cast.withColumn(row, F.monotonically_increasing_id()), "decontaminate")
    found_type = T.StructType([T.StructField(row, T.LongType()), T.StructField(spans, T.ArrayType(T.LongType())), T.StructField(items, T.ArrayType(T.StringType()))])
    tables = []
    while windows is not None:
        tables.append(stage.written(_scanned(keyed.select(row, text), windows, text, hits, found_type), "hits"))
        windows, following = following, next(blocks, None)
    every = tables[0]
    for more in tables[1:]:
        every = every.unionByName(more)
    per_row = every.groupBy(row).agg(F.flatten(F.collect_list(spans)).alias(spans), F.array_distinct(F.flatten(F.collect_list(items))).alias(items))  # a row's hits, one list per block

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, text):
                found = words.scan(part.column(text), words.ALNUM)
                hit = np.zeros(len(found.hash), bool)
                names = {}
                for i, (runs, own) in enumerate(zip(part.column(spans).to_pylist(), part.column(items).to_pylist(), strict=True)):
                    for a, b in zip((runs or [])[::2], (runs or [])[1::2], strict=True):
                        hit[found.first[i] + a : found.first[i] + b] = True
                    if own:
                        names[i] = set(own)
                yield make(part, found, hit, names)

    return keyed.join(per_row, row, "left").select(*(F.col(f"`{c}`") for c in [*docs.columns, text, spans, items])).mapInArrow(merged, schema)


def _report(part: pa.RecordBatch, found: words.Words, hit: np.ndarray, items: dict[int, set[str]]) -> pa.RecordBatch:
    sums = np.concatenate(([0], np.cumsum(hit)))
    n_words = np.diff(found.first).astype(np.int64)
    n_hit = (sums[found.first[1:]] - sums[found.first[:-1]]).astype(np.int64)
    names = [",".join(sorted(items.get(i, ()))) for i in range(part.num_rows)]
    return pa.RecordBatch.from_arrays(
        [
            part.column("doc_id"),
            pa.array(n_words),
            pa.array(n_hit),
            pa.array([len(items.get(i, ())) for i in range(part.num_rows)], pa.int64()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in names], pa.string()),
            pa.array((n_hit > 0) & (20 * n_hit >= n_words)),
            pa.array(names, pa.string()),
        ],
        names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items"],
    )


def scan_documents(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items.

    ``contaminated``: some word is hit, and hit words are a twentieth of all at least.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType()), T.StructField("items", T.StringType())])
    return _through(docs, benchmark, size, max_windows, _report, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, action: str = "documents", size: int = SIZE, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """The documents without contaminated ones (``documents``), or with hit words cut out (``spans``).

    Columns and their order are those of ``docs``. With ``spans`` every hit run is
    removed from its first to its last byte; text around it stays as it is.
    """
    if action not in ("documents", "spans"):
        raise ValueError(f"action must be documents or spans, not {action!r}")

    keep = docs.columns

    def make(part: pa.RecordBatch, found: words.Words, hit: np.ndarray, items: dict[int, set[str]]) -> pa.RecordBatch:
        part = part.select(list(range(len(keep))))
        sums = np.concatenate(([0], np.cumsum(hit)))
        n_hit = sums[found.first[1:]] - sums[found.first[:-1]]
        if action == "documents":
            return part.filter(pa.array(~((n_hit > 0) & (20 * n_hit >= np.diff(found.first)))))
        texts = part.column("text").to_pylist()
        base = 0
        for i, text in enumerate(texts):
            size_of = len(text.encode()) if text is not None else 0
            if n_hit[i]:
                a = int(found.first[i])
                raw, out, at = text.encode(), [], 0
                for s, e in _runs(hit[a : int(found.first[i + 1])]).reshape(-1, 2).tolist():
                    out.append(raw[at : int(found.start[a + s]) - base])
                    at = int(found.end[a + e - 1]) - base
                texts[i] = b"".join([*out, raw[at:]]).decode()
            base += size_of
        at = keep.index("text")
        return part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))

    return _through(docs, benchmark, size, max_windows, make, docs.schema)
