"""Document probabilities by a lattice of subwords: every segmentation counts, weighted by unigram scores.

A text is its words, lower-cased, then an end. A word, with a mark in front, can be cut into pieces of an
existing vocabulary in many ways. The probability of a way is the product of its pieces'
probabilities, and that of the word the sum over all ways: a forward recursion over its code points in
log space. The probability of a text is the product over its words and the end. Characters that no piece
has are spelled in the vocabulary's bytes.

The pieces' probabilities start from the scores in the vocabulary's file. If these are ranks of merges and not logarithms, rank r
stands for 1 / (r + 1). They weight the segmentations of all training words; the pieces that these are expected to hold,
smoothed by ``PRIOR`` pieces as the file's scores have them, are the probabilities (``rounds`` times; 0 takes the file's alone). The vocabulary
itself is never trained.

At scale: a word's probability doesn't hang on the text that it stands in, so it is worked out once per distinct word, in
a table of all distinct words with their training counts, which grows with the corpus. Texts meet the table in two
ways. Words that more than one in ``HOT`` of all pairs of text and word have are fewer than ``HOT``: they go to all tasks, at most
24 MB, and make up most of any text. The other words are joined; none of them has more than that share of the rows.

Defined results: a null text or one without words is the end alone; a null doc_id is in the training part; repeated rows count and are scored
each; without training texts every count is 0 and the pieces' probabilities are the file's; an empty table gives an empty result; other columns
are ignored. Words are as in ``words.SPACED``; equality of words in the join is equality of 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import stage, words

HOT = 1 << 20
PRIOR = 10_000.0
HELD_OUT, PARTS = 1, 5

#: Code points of a word that is worked on together with others of its length; rows in one go; bytes of text in one go.
WIDE, ROWS, SLICE = 64, 2048, 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MARK = 0x2581  # what begins a word in the vocabulary
_UNSCORED = -1e8
_LN10 = math.log(10)


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, and where each begins, the end of the last too."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum(sizes)])


def _hashes(points: np.ndarray) -> np.ndarray:
    """Hashes of all beginnings of each row of code points: one column more."""
    out = np.zeros((points.shape[0], points.shape[1] + 1), np.uint64)
    for j in range(points.shape[1]):
        out[:, j + 1] = out[:, j] * _BASE + words.mix(points[:, j].astype(np.uint64) + np.uint64(1))
    return out


@dataclass
class Pieces:
    """A vocabulary: its pieces by length, the bytes, the end, and the logarithm of each one's probability."""

    tables: list[tuple[np.ndarray, np.ndarray]]  # for each length from 1: sorted hashes, and ids
    bytes: np.ndarray  # id of each byte
    end: int
    logs: np.ndarray

    def find(self, k: int, hashes: np.ndarray) -> np.ndarray:
        """Ids of pieces of k code points; -1 for none."""
        known, ids = self.tables[k - 1]
        if not len(known):
            return np.full(hashes.shape, -1, np.int32)
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        return np.where(known[at] == hashes, ids[at], -1).astype(np.int32)

    def spelled(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Distinct code points that no piece has: (points, log probabilities, ids of their bytes)."""
        distinct = np.unique(points)
        rest = distinct[self.find(1, _hashes(distinct[:, None])[:, 1]) < 0]
        ids = [self.bytes[list(chr(int(p)).encode("utf-8", "surrogatepass"))] for p in rest]
        return rest, np.array([self.logs[x].sum() for x in ids]), ids


def load(path: str) -> Pieces:
    """A vocabulary file of the sentencepiece library."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    scores = np.array([model.get_score(i) for i in range(len(names))])
    plain = [i for i in range(len(names)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) and scores[i] > _UNSCORED]
    spelling = [i for i in range(len(names)) if model.is_byte(i)]
    if len(spelling) != 256 or model.eos_id() < 0:
        raise ValueError("the vocabulary has to have 256 bytes and an end")
    ranks = len(set(scores[plain])) == len(plain) and bool((scores[plain] == np.round(scores[plain])).all())
    logs = np.full(len(names), -np.inf)
    logs[plain] = -np.log(scores[plain].max() - scores[plain] + 1) if ranks else scores[plain]
    logs[[*spelling, model.eos_id()]] = logs[plain].min()
    logs -= np.log(np.exp(logs[np.isfinite(logs)]).sum())
    tables = []
    for k in range(1, max(len(names[i]) for i in plain) + 1):
        ids = np.array([i for i in plain if len(names[i]) == k], np.int32)
        points = np.array([[ord(c) for c in names[i]] for i in ids], np.uint32).reshape(len(ids), k)
        hashes = _hashes(points)[:, k]
        order = np.argsort(hashes)
        tables.append((hashes[order], ids[order]))
    return Pieces(tables, np.array(spelling, np.int32), model.eos_id(), logs)


def _sum(terms: np.ndarray) -> np.ndarray:
    """log(sum(exp)) over the first axis; there is a finite term in each."""
    top = terms.max(axis=0)
    return top + np.log(np.exp(terms - top).sum(axis=0))


def _ids(pieces: Pieces, hashes: np.ndarray, a: int, b: int, points: np.ndarray, rest: np.ndarray) -> list[np.ndarray]:
    """For each length, ids of the pieces that begin at a..b-1; a code point that is spelled has an id behind all pieces."""
    n = hashes.shape[1] - 1
    out = []
    for k in range(1, len(pieces.tables) + 1):
        stop = min(b, n - k + 1)
        if stop <= a:
            break
        power = np.uint64(pow(int(_BASE), k, 1 << 64))
        found = pieces.find(k, hashes[:, a + k : stop + k] - hashes[:, a:stop] * power)
        if k == 1 and len(rest):
            at = np.minimum(np.searchsorted(rest, points[:, a:stop]), len(rest) - 1)
            found = np.where(rest[at] == points[:, a:stop], len(pieces.logs) + at, found).astype(np.int32)
        out.append(found)
    return out


def _together(pieces: Pieces, points: np.ndarray, times: np.ndarray | None, counts: np.ndarray | None) -> np.ndarray:
    """Log probabilities of words of one length; ``counts`` gets the expected pieces of ``times`` each."""
    rest, weights, spelled = pieces.spelled(points)
    logs = np.concatenate([pieces.logs, weights, [-np.inf]])
    ids = _ids(pieces, _hashes(points), 0, points.shape[1], points, rest)
    n, size = points.shape
    scores = [logs[x] for x in ids]  # of the piece of k + 1 code points that begins at i: [k][:, i]
    ahead = np.zeros((size + 1, n))
    for j in range(1, size + 1):
        ahead[j] = _sum(np.stack([ahead[j - k] + scores[k - 1][:, j - k] for k in range(1, min(j, len(scores)) + 1)]))
    if counts is not None:
        behind = np.zeros((size + 1, n))
        for i in range(size - 1, -1, -1):
            behind[i] = _sum(np.stack([behind[i + k] + scores[k - 1][:, i] for k in range(1, min(size - i, len(scores)) + 1)]))
        total = np.zeros(len(logs))
        for k, (found, score) in enumerate(zip(ids, scores, strict=True), 1):
            share = np.exp(ahead[: size - k + 1].T + score + behind[k:].T - ahead[size][:, None]) * times[:, None]
            there = found >= 0
            total += np.bincount(found[there], share[there], len(logs))
        _credit(counts, total, spelled)
    return ahead[size]


def _credit(counts: np.ndarray, total: np.ndarray, spelled: list[np.ndarray]) -> None:
    """Adds up expected pieces; a spelled code point counts for its bytes."""
    counts += total[: len(counts)]
    for x, ids in zip(total[len(counts) :], spelled, strict=False):
        np.add.at(counts, ids, x)


def _along(pieces: Pieces, points: np.ndarray, times: float, counts: np.ndarray | None, chunk: int = 1 << 16) -> float:
    """The same for one long word, in memory of a few numbers per code point: products are kept small by a scale."""
    rest, weights, spelled = pieces.spelled(points)
    logs = np.concatenate([pieces.logs, weights, [-np.inf]])
    points = points[None, :]
    hashes, size, longest = _prefixes(points), points.shape[1], len(pieces.tables)

    def matches(a: int, b: int) -> tuple[list[int], list[int], list[float]]:
        found = _ids(pieces, hashes, a, b, points, rest)
        at, k, x = (np.concatenate(part) for part in zip(*((np.flatnonzero(f[0] >= 0) + a, np.full((f[0] >= 0).sum(), i + 1), f[0][f[0] >= 0]) for i, f in enumerate(found)), strict=True))
        order = np.argsort(at, kind="stable")
        return at[order].tolist(), k[order].tolist(), x[order]

    def run(forward: bool) -> np.ndarray:
        out = np.zeros(size + 1)
        ring, scale = [0.0] * (longest + 1), 0.0
        ring[0 if forward else size % (longest + 1)] = 1.0
        for a in range(0, size, chunk) if forward else range((size - 1) // chunk * chunk, -1, -chunk):
            at, ks, ids = matches(a, min(a + chunk, size))
            chances = np.exp(logs[ids]).tolist()
            bounds = np.searchsorted(at, np.arange(a, min(a + chunk, size) + 1)).tolist()
            here = range(a, min(a + chunk, size))
            for i in here if forward else reversed(here):
                lo, hi = bounds[i - a], bounds[i - a + 1]
                place = i % (longest + 1)
                if forward:
                    x = ring[place]
                    ring[place] = 0.0
                    out[i] = math.log(x) + scale
                    for e in range(lo, hi):
                        ring[(i + ks[e]) % (longest + 1)] += x * chances[e]
                else:
                    x = 0.0
                    for e in range(lo, hi):
                        x += ring[(i + ks[e]) % (longest + 1)] * chances[e]
                    ring[place] = x
                    out[i] = math.log(x) + scale
                if x < 1e-100:
                    ring = [v * 1e100 for v in ring]
                    scale -= 100 * _LN10
        if forward:
            out[size] = math.log(ring[size % (longest + 1)]) + scale
        return out

    ahead = run(True)
    if counts is not None:
        behind = run(False)
        for a in range(0, size, chunk):
            at, ks, ids = matches(a, min(a + chunk, size))
            share = np.exp(ahead[at] + logs[ids] + behind[np.add(at, ks)] - ahead[size]) * times
            _credit(counts, np.bincount(ids, share, len(logs)), spelled)
    return float(ahead[size])


def _prefixes(points: np.ndarray) -> np.ndarray:
    """``_hashes`` of one long row."""
    h, out = 0, np.zeros((1, points.shape[1] + 1), np.uint64)
    mixed = words.mix(points[0].astype(np.uint64) + np.uint64(1)).tolist()
    base, mask = int(_BASE), (1 << 64) - 1
    for j, x in enumerate(mixed, 1):
        h = (h * base + x) & mask
        out[0, j] = h
    return out


def chances(pieces: Pieces, texts: list[str], times: np.ndarray | None = None, counts: np.ndarray | None = None) -> np.ndarray:
    """Natural logarithms of the words' probabilities, each with the mark in front; ``counts`` gets the expected pieces of ``times`` words each."""
    points, first = _points(texts)
    sizes, out = np.diff(first), np.zeros(len(texts))
    with np.errstate(over="ignore", divide="ignore"):
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            if size > WIDE:
                for i in rows:
                    one = np.concatenate([[_MARK], points[first[i] : first[i + 1]]]).astype(np.uint32)
                    out[i] = _along(pieces, one, 0.0 if times is None else float(times[i]), counts)
                continue
            for some in np.array_split(rows, -(-len(rows) // ROWS)):
                block = np.full((len(some), size + 1), _MARK, np.uint32)
                block[:, 1:] = points[first[some][:, None] + np.arange(size)]
                out[some] = _together(pieces, block, None if times is None else times[some], counts)
    return out


def _texts(w: words.Words, at: np.ndarray) -> pa.Array:
    """Words as an Arrow array; what stands for NUL is NUL again."""
    sizes = (w.end - w.start)[at]
    ends = np.cumsum(sizes)
    offsets = np.concatenate([[0], ends])
    data = w.data[np.repeat(w.start[at] - offsets[:-1], sizes) + np.arange(offsets[-1])]
    data[data == 0x0B] = 0
    return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.string())


def _distinct(w: words.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of text and word, by word and text: hash, text, occurrences, place of the first."""
    doc = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    order = np.argsort(w.hash, kind="stable")
    h, d = w.hash[order], doc[order]
    new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])) if len(h) else np.zeros(0, np.int64)
    return h[new], d[new], np.diff([*new, len(h)]), order[new]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, word, c, r): each slice's words, their occurrences in training texts, and the texts that hold them."""
    for batch in batches:
        for part in words.slices(batch, limit=SLICE):
            w = words.scan(part.column("text"), words.SPACED)
            h, d, n, at = _distinct(w)
            if not len(h):
                continue
            learn = part.column("learn").to_numpy(zero_copy_only=False)
            new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            c, r = np.add.reduceat(n * learn[d], new), np.diff([*new, len(h)])
            yield pa.RecordBatch.from_arrays([pa.array(h[new].view(np.int64)), _texts(w, at[new]), pa.array(c.astype(np.int64)), pa.array(r.astype(np.int64))], names=["h", "word", "c", "r"])


def _split(docs: DataFrame) -> Column:
    """Whether a row is held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % PARTS == HELD_OUT, F.lit(False))


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, word, c, r) of every distinct word: its hash, occurrences in training texts, and the number of texts with it."""
    each = docs.select("text", (~_split(docs)).alias("learn")).mapInArrow(_counted, "h long, word string, c long, r long")
    return each.groupBy("h", "word").agg(F.sum("c").alias("c"), F.sum("r").alias("r"))


def learned(vocabulary: DataFrame, pieces: Pieces, ends: int, prior: float = PRIOR) -> Pieces:
    """``pieces`` with probabilities from the pieces that the training words are expected to hold, and ``ends`` ends."""

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(pieces.logs))
        for batch in batches:
            for part in words.slices(batch, "word"):
                chances(pieces, part.column("word").to_pylist(), part.column("c").to_numpy(), counts)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["id", "x"])

    found = vocabulary.where("c > 0").select("word", "c").mapInArrow(expect, "id int, x double").groupBy("id").agg(F.sum("x").alias("x")).collect()  # a row per piece
    counts = np.zeros(len(pieces.logs))
    counts[[r.id for r in found]] = [r.x for r in found]
    counts[pieces.end] = ends
    with np.errstate(divide="ignore"):
        logs = np.log((counts + prior * np.exp(pieces.logs)) / (counts.sum() + prior))
    return Pieces(pieces.tables, pieces.bytes, pieces.end, logs)


def scored_words(vocabulary: DataFrame, pieces: Pieces) -> DataFrame:
    """(h, c, r, log_p) of every distinct word."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "word"):
                logs = chances(pieces, part.column("word").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("h"), part.column("c"), part.column("r"), pa.array(logs)], names=["h", "c", "r", "log_p"])

    return vocabulary.mapInArrow(score, "h long, c long, r long, log_p double")


def _begun(docs: DataFrame, known: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """A row per text with the sums over hot words, and its other words."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, logs = shared.value
        for batch in batches:
            for part in words.slices(batch, limit=SLICE):
                w = words.scan(part.column("text"), words.SPACED)
                h, d, n, _ = _distinct(w)
                at = np.minimum(np.searchsorted(hashes, h), max(len(hashes) - 1, 0))
                hot = hashes[at] == h if len(hashes) else np.zeros(len(h), bool)
                c, rows, nh, dh = counts[at[hot]], part.num_rows, n[hot], d[hot]
                total = lambda x: np.bincount(dh, x, rows).astype(float)  # noqa: B023, E731
                order = np.argsort(d[~hot], kind="stable")
                offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(d[~hot], minlength=rows))]).astype(np.int32))
                rest = pa.StructArray.from_arrays([pa.array(h[~hot][order].view(np.int64)), pa.array(n[~hot][order].astype(np.int32))], names=["h", "n"])
                yield pa.RecordBatch.from_arrays(
                    [part.column("_row"), part.column("doc_id"), part.column("held_out"), pa.array(np.diff(w.first).astype(np.int64)), pa.array(total(nh * (c > 0)).astype(np.int64)), pa.array(total(nh * np.log10(c + 0.5))), pa.array(total(nh * logs[at[hot]])), pa.ListArray.from_arrays(offsets, rest)],
                    names=["_row", "doc_id", "held_out", "n", "known", "base", "logs", "rest"],
                )

    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", _split(docs).alias("held_out"), "text")
    return rows.mapInArrow(scan, f"_row long, doc_id {kind}, held_out boolean, n long, known long, base double, logs double, rest array<struct<h: long, n: int>>")


def score(docs: DataFrame, path: str, rounds: int = 1) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``score`` is the log10 probability of the text by the lattice; ``base_score`` that by smoothed counts of whole tokens.
    """
    spark, mark = docs.sparkSession, stage.tables_made()
    stage.small_batches(spark)
    vocabulary = stage.written(word_counts(docs), "lm-words")
    ends = docs.where(~_split(docs)).count()
    n, v, pairs = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.coalesce(F.sum("r"), F.lit(0))).first()
    n, v = n + ends, v + (ends > 0)
    pieces = load(path)
    for _ in range(rounds if ends else 0):
        pieces = learned(vocabulary, pieces, ends)
    table = stage.written(scored_words(vocabulary, pieces), "lm-chances")
    hot = table.where(F.col("r") > pairs // HOT).orderBy("h").toPandas()  # fewer than HOT rows
    order = np.argsort(hot["h"].to_numpy(np.int64).view(np.uint64))
    known = (hot["h"].to_numpy(np.int64).view(np.uint64)[order], hot["c"].to_numpy(np.int64)[order], hot["log_p"].to_numpy(float)[order])
    begun = stage.written(_begun(docs, known), "lm-texts")
    stage.discard_since(mark, table, begun)
    cold = table.where(F.col("r") <= pairs // HOT).select("h", "c", "log_p")
    rest = begun.select("_row", F.explode("rest").alias("x")).select("_row", "x.h", "x.n").join(cold, "h")
    sums = rest.groupBy("_row").agg(F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known_"), F.sum(F.col("n") * F.log10(F.col("c") + 0.5)).alias("base_"), F.sum(F.col("n") * F.col("log_p")).alias("logs_"))
    whole = begun.drop("rest").join(sums, "_row", "left")
    plus = lambda name: F.col(name) + F.coalesce(f"{name}_", F.lit(0))
    tokens = F.col("n") + 1
    return whole.select(
        "doc_id", "held_out", tokens.alias("n_tokens"), (plus("known") + F.lit(int(ends > 0))).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (plus("base") + F.lit(math.log10(ends + 0.5)) - tokens * F.lit(math.log10(n + 0.5 * (v + 1)))).alias("base_score"), ((plus("logs") + F.lit(float(pieces.logs[pieces.end]))) / F.lit(_LN10)).alias("score"),
    )
