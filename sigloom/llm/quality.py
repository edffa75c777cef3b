"""Quality rules by weak supervision: rules vote or abstain, EM estimates their accuracies.

Each rule looks at one statistic of a whole text and votes good, votes bad or abstains;
rules whose quiet state says nothing vote bad or abstain. The votes of the documents that
the base rules pass are counted by pattern; there are at most ``3 ** len(RULES)`` patterns
whatever the corpus, so these counts, and nothing else, go to the driver. There
expectation-maximisation fits two classes of documents: how often each rule votes good,
bad or abstains on good documents and on bad ones. The posterior of a document's own
pattern is its quality, so a bad vote of a rule that often errs doesn't reject a document
and several faint faults may.

EM starts from the majority of each pattern's votes. Every vote has the weight ``PRIOR`` of
documents in advance, whatever the size of the corpus. A rule that comes out worse than
chance (bad votes oftener on good documents, or good votes on bad ones) has no say in that vote.

Words and lines are told apart by 64-bit hashes, within one text.

Defined results: a null or empty text has no words, fails the base rule and is
not kept; repeated rows are counted and returned as often as they occur; an empty
table gives an empty result; other columns are ignored by ``scores`` and carried by
``keep``, whatever their names. Toxicity is not a quality rule here. The result depends
only on the counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import stage, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
ROUNDS = 500
PRIOR = 1.0

#: statistic, good at or below (None: it never votes good), bad above; between them the rule abstains.
RULES: tuple[tuple[str, float | None, float], ...] = (
    ("symbols", 0.02, 0.10),  # symbols for each word
    ("letterless", 0.07, 0.20),  # share of characters in words that aren't letters
    ("open_lines", 0.05, 0.30),  # share of lines that don't end like a sentence
    ("repeats", None, 0.20),  # share of words in repeated 3-word windows
    ("dup_lines", None, 0.10),  # share of lines equal to an earlier one
    ("no_letter_words", None, 0.10),  # share of words without a letter
    ("top_word", None, 0.25),  # share of the most frequent word, of texts with more than 20 words
    ("shouting", None, 0.30),  # share of words in capitals, or exclamation marks for each word
)

_BYTES = np.arange(256)
_SYMBOL = np.isin(_BYTES, list(SYMBOLS.encode()))
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LOWER = (_BYTES >= 97) & (_BYTES <= 122)
_STARTS = (_BYTES & 0xC0) != 0x80  # the first byte of a character
_LETTER = _UPPER | _LOWER | (_BYTES >= 0xC0)
_LAST = np.isin(_BYTES, list(b".!?:;\"')]"))
#: the UTF-8 bytes of other characters that end a sentence
_LAST_WIDE = np.array([int.from_bytes(c.encode(), "big") for c in "…”’。！？।"])
_LAST_PAIR = np.array([int.from_bytes(c.encode(), "big") for c in "»؟"])
_FIELDS = [("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()), ("n_dup_lines", T.LongType()), ("n_repeat_words", T.LongType()), ("pattern", T.IntegerType())]


def _per(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of ``flags`` are set between one bound and the next."""
    sums = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=sums[1:])
    return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(np.int64)


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that puts equal keys together, where each group begins in it, and the size of each."""
    order = np.argsort(keys)
    ordered = keys[order]
    begins = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return order, begins, np.diff(np.append(begins, len(keys)))


def _of_text(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    return words.mix(h + words.mix(text.astype(np.uint64) + np.uint64(1)))


def _lines(found: words.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text the lines with a word, how many of them equal an earlier one, and how many end like a sentence."""
    raw, offset, n = found.raw, found.offset, len(found.offset) - 1
    breaks = np.flatnonzero(raw == 10)
    start = np.unique(np.concatenate((offset[:-1], breaks + 1)))
    start = start[start < len(raw)]
    text = np.searchsorted(offset, start, side="right") - 1
    end = np.minimum(np.append(breaks, len(raw))[np.searchsorted(breaks, start)], offset[text + 1])
    upto = np.searchsorted(found.start, end)
    some = np.flatnonzero(upto > np.searchsorted(found.start, start))
    start, end, text, last = start[some], end[some], text[some], found.end[upto[some] - 1]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(words._VALUE[raw] * words.powers(words._BASE, len(raw)), out=sums[1:])
    h = (sums[end] - sums[start]) * words.powers(words._INVERSE, len(raw) + 1)[start]
    order, begins, _ = _groups(_of_text(words.mix(h) + (end - start).astype(np.uint64), text))
    lines = np.bincount(text, minlength=n)
    dup = lines - np.bincount(text[order[begins]], minlength=n)
    tail = [raw[np.maximum(last - back, 0)].astype(np.int64) for back in (1, 2, 3)]
    pair = tail[1] << 8 | tail[0]
    closed = _LAST[tail[0]] | np.isin(pair, _LAST_PAIR) | np.isin(tail[2] << 16 | pair, _LAST_WIDE)
    return lines, dup, np.bincount(text[closed], minlength=n)


def statistics(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A row per text: (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), and the statistics of RULES."""
    found = words.scan(texts, words.CASED)
    raw, offset, first = found.raw, found.offset, found.first
    n = np.diff(first).astype(np.int64)
    some = np.maximum(n, 1)
    text = np.repeat(np.arange(len(n)), n)
    chars = _per(_STARTS[raw] & (found.data != 0), offset)
    symbols = _per(_SYMBOL[raw], offset)
    letters = _per(_LETTER[raw], offset)
    lines, dup, closed = _lines(found)

    inside = np.column_stack((found.start, found.end)).ravel()  # the counts between words are left out below
    of_words = lambda flags: _per(flags, inside)[::2] if len(inside) else np.zeros(0, np.int64)
    upper, lower, high = of_words(_UPPER[raw]), of_words(_LOWER[raw]), of_words(raw >= 0x80)
    no_letter = _per((upper == 0) & (lower == 0) & (high == 0), first)
    capitals = _per((upper > 0) & (lower == 0) & (found.end - found.start > 1), first)
    order, begins, sizes = _groups(_of_text(found.hash, text))
    top = np.zeros(len(n), np.int64)
    np.maximum.at(top, text[order[begins]], sizes)

    h, at = found.windows(3)
    order, begins, sizes = _groups(_of_text(h, text[at]))
    again = at[order[np.repeat(sizes, sizes) > 1]]
    edges = np.zeros(len(text) + 1, np.int32)
    np.add.at(edges, again, 1)
    np.add.at(edges, again + 3, -1)
    repeats = _per(np.cumsum(edges[:-1]) > 0, first)

    base = np.column_stack((n, chars, symbols, dup, repeats))
    rates = np.column_stack((
        symbols / some,
        1 - letters / np.maximum(chars, 1),
        1 - closed / np.maximum(lines, 1),
        repeats / some,
        dup / np.maximum(lines, 1),
        no_letter / some,
        np.where(n > 20, top / some, 0),
        np.maximum(capitals, _per(raw == 33, offset)) / some,
    ))
    return base, np.where(n[:, None] > 0, rates, 0)


def votes(rates: np.ndarray) -> np.ndarray:
    """Of each row one base-3 digit per rule: 0 abstains, 1 good, 2 bad."""
    out = np.zeros(len(rates), np.int32)
    for j, (_, good, bad) in enumerate(RULES):
        x = rates[:, j]
        out += np.where(x > bad, 2, 0 if good is None else (x <= good).astype(int)).astype(np.int32) * 3**j
    return out


def failed(base: np.ndarray) -> np.ndarray:
    """The base rule, on rows of the counts that ``statistics`` gives."""
    return (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > 50 * base[:, 0])


def fit(counts: dict[int, int], rounds: int = ROUNDS, prior: float = PRIOR) -> tuple[dict[int, float], np.ndarray]:
    """EM over pattern counts: the posterior of being good of each pattern, and how often each rule (first axis) abstains,
    votes good and votes bad (last axis) on bad and on good documents (second axis)."""
    patterns = sorted(counts)
    share = np.full((len(RULES), 2, 3), 1 / 3)
    if not patterns:
        return {}, share
    weight = np.array([counts[p] for p in patterns], float)
    vote = np.array([[p // 3**j % 3 for j in range(len(RULES))] for p in patterns])
    good, bad = (vote == 1).sum(axis=1), (vote == 2).sum(axis=1)
    post = (good + 1) / (good + bad + 2)
    for _ in range(rounds):
        held = np.stack((weight * (1 - post), weight * post))
        size = held.sum(axis=1)
        odds = np.full(len(patterns), np.log((size[1] + prior) / (size[0] + prior)))
        for j in range(len(RULES)):
            for v in range(3):
                share[j, :, v] = (held[:, vote[:, j] == v].sum(axis=1) + prior) / (size + 3 * prior)
            ratio = np.log(share[j, 1] / share[j, 0])
            ratio[1], ratio[2] = max(ratio[1], 0.0), min(ratio[2], 0.0)
            odds += ratio[vote[:, j]]
        new = 1 / (1 + np.exp(-np.clip(odds, -60, 60)))
        done = np.abs(new - post).max() < 1e-9
        post = new
        if done:
            break
    return dict(zip(patterns, post.tolist(), strict=True)), share


def _measured(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for part in words.slices(batch, text):
            base, rates = statistics(part.column(text))
            yield part, base, votes(rates)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, base, pattern in _measured(batches, "text"):
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, base.T), pa.array(pattern)], names=["doc_id", *(n for n, _ in _FIELDS)])


def _counts(found: DataFrame, pattern: str, passed) -> dict[int, int]:  # noqa: ANN001
    """Documents by pattern, of those that the base rules pass: 3 ** len(RULES) rows at most."""
    return {r[0]: r[1] for r in found.where(passed).groupBy(pattern).agg(F.count("*")).collect()}


def scores(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, posterior (null if base_failed)."""
    taken = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = stage.written(taken.mapInArrow(_scan, T.StructType([taken.schema["doc_id"], *(T.StructField(n, t) for n, t in _FIELDS)])), "quality")
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    posteriors, _ = fit(_counts(found, "pattern", ~base_failed))
    model = found.sparkSession.createDataFrame(sorted(posteriors.items()) or [(-1, 0.0)], "pattern int, posterior double")
    judged = found.join(F.broadcast(model), "pattern", "left").withColumn("base_failed", base_failed)
    kept = ~F.col("base_failed") & (F.col("posterior") >= threshold)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.coalesce(kept, F.lit(False)).alias("kept"), F.when(~F.col("base_failed"), F.col("posterior")).alias("posterior"))


def keep(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the base rules pass and the model finds good, with the same columns.

    The votes are computed once, next to the row they judge, so no join by id is
    needed and repeated or null ids cannot mix rows up.
    """
    text, pattern = stage.fresh(docs.columns, "_text", "_pattern")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, base, found in _measured(batches, text):
            live = pa.array(~failed(base))
            rows = pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found)], names=[*part.schema.names[:-1], pattern])
            yield rows.filter(live)

    marked = docs.withColumn(text, F.col("text").cast("string")).mapInArrow(mark, T.StructType([*docs.schema, T.StructField(pattern, T.IntegerType())]))
    found = stage.written(marked, "quality")
    posteriors, _ = fit(_counts(found, pattern, F.lit(True)))
    return found.where(F.col(pattern).isin([p for p, x in posteriors.items() if x >= threshold])).drop(pattern)
