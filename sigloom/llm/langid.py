"""Language identification by prediction by partial matching over bytes.

Each language has a variable-order byte context tree (contexts of up to ``ORDER`` bytes)
with escape probabilities by method C and exclusion, so every context gives a proper
distribution over all 256 bytes. The statistics are frozen after training, which makes a
byte's code length a function of the bytes before it alone: the probabilities of every
kept context are worked out once, and a text is scored by table lookups over the whole
text. The language with the shortest code wins; ties go to the smaller name.

Training reads a bounded sample of every language: the ``SAMPLE_DOCS`` documents with the
smallest hash of their id, fewer once they have ``SAMPLE_CHARS`` characters, in lower case; a text of
more than that counts with its first ``SAMPLE_CHARS``. A context is kept if it occurs ``MIN_COUNT`` times in the sample of some language;
otherwise its longest kept suffix takes its place. All languages have the same contexts; their
code lengths are worked out, sent and looked up in blocks of languages, which change no result.

Defined results: ``und`` with score 0 for a null text, one without a letter, or where no
language could be learned; repeated rows are scored as often as they occur; an empty
table gives an empty result; a null doc_id counts as held out; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import stage, words

ORDER = 3
SAMPLE_DOCS, SAMPLE_CHARS = 200, 2_000_000
BLOCK_LANGUAGES, BLOCK_BYTES = 32, 64_000_000  # of one block; one language at least
MIN_COUNT = 3
MOST_CODES = 1 << 25  # of contexts, 4 bytes each; any text's bytes fit for 3 bytes, an alphabet's for 4
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def _bytes(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def _pad(order: int) -> bytes:
    """What stands before a text."""
    return b"\n" * order


@dataclass
class Model:
    """Code lengths in bits: ``cost[state * symbols + symbol]`` has one column per language."""

    order: int
    languages: list[str]
    symbol: np.ndarray  # byte -> symbol; the last symbol stands for bytes that no sample has
    symbols: int
    state: np.ndarray  # code of the last ORDER symbols -> longest kept context
    cost: np.ndarray

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language."""
        order, pad = self.order, _pad(self.order)
        data = np.frombuffer(pad + pad.join(texts), np.uint8)
        sym = self.symbol[data]
        n = len(sym) - order
        code = np.zeros(n, np.int64 if self.symbols**order > 2**31 else np.int32)
        for back in range(order, 0, -1):
            code *= self.symbols
            code += sym[order - back : order - back + n]
        at = self.state[code].astype(np.int64) * self.symbols + sym[order:]
        lengths = np.array([len(t) for t in texts], np.int64)
        starts = np.concatenate(([0], np.cumsum(lengths + order)))[:-1]
        bits = np.zeros((len(texts), len(self.languages)))
        some = np.flatnonzero(lengths)
        if len(some):
            edges = np.stack((starts[some], starts[some] + lengths[some]), axis=1).ravel()
            rows = self.cost[at]
            if edges[-1] == len(rows):
                edges = edges[:-1]
            bits[some] = np.add.reduceat(rows, edges, axis=0, dtype=np.float64)[::2]
        return bits


def train(samples: dict[str, list[str]], order: int = ORDER, min_count: int = MIN_COUNT) -> Model | None:
    """The model of some texts by language, in one block."""
    return next(blocks(samples, order, min_count, len(samples), None), None)


def blocks(samples: dict[str, list[str]], order: int = ORDER, min_count: int = MIN_COUNT, width: int = BLOCK_LANGUAGES, size: int | None = BLOCK_BYTES) -> Iterator[Model]:
    """The model of some texts by language, in blocks of ``width`` languages at most, fewer where their costs have more than ``size`` bytes."""
    languages = sorted(samples)
    if not languages:
        return
    pad = _pad(order)
    data = {name: np.frombuffer(pad + pad.join(map(_bytes, samples[name])) + pad, np.uint8) for name in languages}
    seen = np.flatnonzero(np.sum([np.bincount(d, minlength=256) for d in data.values()], axis=0))
    symbol = np.full(256, len(seen), np.uint8)
    symbol[seen] = np.arange(len(seen))
    s = len(seen) + 1
    if s**order > MOST_CODES:
        raise ValueError(f"contexts of {order} bytes need a table of {s}**{order} codes; at most {MOST_CODES} are looked up directly")

    def grams(name: str, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Contexts of k symbols and what follows; a context's code is that of its symbols, oldest first."""
        x = symbol[data[name]].astype(np.int64)
        n = len(x) - order
        code = np.zeros(n, np.int64)
        for back in range(k, 0, -1):
            code = code * s + x[order - back : order - back + n]
        return code, x[order:]

    # contexts by order
    state = np.zeros(1, np.int32)
    parents: list[np.ndarray] = []
    numbers: list[np.ndarray] = []
    first = [0]
    for k in range(order + 1):
        total = np.zeros(s**k, np.int64)
        for name in languages:
            total = np.maximum(total, np.bincount(grams(name, k)[0], minlength=s**k))
        kept = np.flatnonzero(total >= (min_count if k else 0))
        number = np.full(s**k, -1, np.int32)
        number[kept] = np.arange(len(kept))
        numbers.append(number)
        parents.append(state[kept % s ** (k - 1)] if k else np.zeros(1, np.int32))
        # a context that isn't kept takes the place of its longest kept suffix
        state = np.where(number >= 0, number + first[-1], np.tile(state, s) if k else 0).astype(np.int32)
        first.append(first[-1] + len(kept))

    base = np.full(s, 1 / 256)
    base[-1] = (257 - s) / 256

    def column(name: str) -> np.ndarray:
        """Code lengths of one language."""
        p = np.empty((first[-1], s))
        for k in range(order + 1):
            code, following = grams(name, k)
            row = numbers[k][code]
            ok = row >= 0
            n = first[k + 1] - first[k]
            c = np.bincount(row[ok].astype(np.int64) * s + following[ok], minlength=n * s).reshape(n, s).astype(float)
            below = p[parents[k]] if k else base[None, :]
            total, distinct = c.sum(axis=1, keepdims=True), (c > 0).sum(axis=1, keepdims=True)
            unseen = np.where(c > 0, 0.0, below)
            mass = unseen.sum(axis=1, keepdims=True)
            escape = np.where(mass > 0, distinct, 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                mixed = np.where(c > 0, c, escape * unseen / mass) / (total + escape)
            p[first[k] : first[k + 1]] = np.where(total > 0, mixed, below)
        bits = -np.log2(np.maximum(p, 1e-300))
        bits[:, -1] += np.log2(max(1, 257 - s))  # one of the bytes that the last symbol stands for
        return bits

    if size is not None:
        width = max(1, min(width, size // (4 * first[-1] * s)))
    for at in range(0, len(languages), width):
        names = languages[at : at + width]
        cost = np.empty((first[-1], s, len(names)), np.float32)
        for j, name in enumerate(names):
            cost[:, :, j] = column(name)
        yield Model(order, names, symbol, s, state, cost.reshape(-1, len(names)))


def held_out():  # noqa: ANN201
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)) % 5 == 0


def sample(docs: DataFrame, per_language: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> dict[str, list[str]]:
    """Texts to learn from, by language: at most ``per_language`` different rows each, and none that begins after ``chars``.

    The rows are chosen by hashes of doc_id and text, so rows under one doc_id are told apart, and repeated rows are one.
    """
    learn = docs.select("doc_id", "lang", F.col("text").cast("string").alias("text")).where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    learn = learn.withColumn("h", F.struct(F.xxhash64(F.col("doc_id").cast("string")).alias("d"), F.xxhash64("text").alias("t")))
    order = Window.partitionBy("lang").orderBy("h")
    learn = learn.withColumn("text", F.substring("text", 1, chars))  # one text doesn't exceed the bound either
    ranked = learn.select("lang", "h", F.length("text").alias("size")).distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language)
    within = ranked.withColumn("before", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")).where(F.col("before") < chars)
    limits = within.groupBy("lang").agg(F.max("h").alias("most"))  # a row per language
    chosen = learn.join(F.broadcast(limits), "lang").where(F.col("h") <= F.col("most")).groupBy("lang", "h").agg(F.first("text").alias("text"))
    out: dict[str, list[str]] = {}
    for r in sorted(chosen.select("lang", "text").collect()):
        out.setdefault(r.lang, []).append(r.text)
    return out


def predict(docs: DataFrame, models: Iterable[Model]) -> DataFrame:
    """Per row: doc_id, lang_pred, score (the winner's posterior under equal priors); ``models``: blocks of languages, in order."""
    stage.small_batches(docs.sparkSession)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    languages, sent = [], []
    for model in models:  # one at a time in the driver
        languages += model.languages
        sent.append(docs.sparkSession.sparkContext.broadcast(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = list(words.slices(batch))
            texts = [part.column("text").to_pylist() for part in parts]
            live = [[i for i, t in enumerate(ts) if languages and t and _LETTER.search(t)] for ts in texts]
            bits: list[list[np.ndarray]] = [[] for _ in parts]
            for one in sent:
                for ts, some, found in zip(texts, live, bits, strict=True):
                    if some:
                        found.append(one.value.code_lengths([_bytes(ts[i]) for i in some]))
                if len(sent) > 1 and getattr(one, "_path", None):
                    vars(one).pop("_value", None)  # else a worker would keep all blocks; it is read again from its file
            for part, ts, some, found in zip(parts, texts, live, bits, strict=True):
                names, scores = [UNKNOWN] * len(ts), [0.0] * len(ts)
                if some:
                    every = np.concatenate(found, axis=1)
                    best = every.argmin(axis=1)
                    odds = np.exp2(-np.minimum(every - every.min(axis=1, keepdims=True), 1000)).sum(axis=1)
                    for i, b, o in zip(some, best.tolist(), odds.tolist(), strict=True):
                        names[i], scores[i] = languages[b], 1 / o
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double")


def identify(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row, learned from the rows that aren't held out; ``order``: bytes of the longest context."""
    return predict(docs, blocks(sample(docs), order)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
