"""The lattice likelihood against enumeration of all segmentations and plain counting."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sigloom.llm import catalog, likelihood


@pytest.fixture(scope="module")
def pieces():
    return likelihood.load(catalog.PIECES)


@pytest.fixture(scope="module")
def model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=catalog.PIECES)


def by_name(pieces, model):
    names = {model.id_to_piece(i): i for i in range(model.get_piece_size())}
    return {n: pieces.logs[i] for n, i in names.items() if np.isfinite(pieces.logs[i]) and not model.is_byte(i) and not model.is_control(i)}, {int(model.id_to_piece(i)[3:5], 16): i for i in range(len(names)) if model.is_byte(i)}


def lattice(word, known, spelled, logs):
    """Every segmentation of a marked word, by recursion: (log probability, expected pieces)."""
    text = "▁" + word

    def ways(at):
        if at == len(text):
            yield 0.0, ()
            return
        for end in range(at + 1, len(text) + 1):
            name = text[at:end]
            if name in known:
                first = known[name], (name,)
            elif end == at + 1:
                ids = [spelled[b] for b in name.encode()]
                first = sum(logs[i] for i in ids), tuple(ids)
            else:
                continue
            for x, rest in ways(end):
                yield first[0] + x, first[1] + rest

    every = list(ways(0))
    total = math.log(sum(math.exp(x) for x, _ in every))
    expected = defaultdict(float)
    for x, names in every:
        for name in names:
            expected[name] += math.exp(x - total)
    return total, expected


WORDS = ["the", "a", "unhappily", "ß", "naïveté", "日本", "ж", "\U0001f600x", "▁", "aaaaaaa", "\x00z", "ꙮ", "", "thethe"]


def test_probabilities_are_a_distribution(pieces):
    assert math.isclose(np.exp(pieces.logs[np.isfinite(pieces.logs)]).sum(), 1.0)


def test_against_all_segmentations(pieces, model):
    known, spelled = by_name(pieces, model)
    counts = np.zeros(len(pieces.logs))
    times = np.arange(1, len(WORDS) + 1)
    got = likelihood.chances(pieces, WORDS, times, counts)
    want = np.zeros(len(pieces.logs))
    for word, n, x in zip(WORDS, times, got, strict=True):
        total, expected = lattice(word, known, spelled, pieces.logs)
        assert math.isclose(x, total, rel_tol=1e-12)
        for name, e in expected.items():
            want[name if isinstance(name, (int, np.integer)) else model.piece_to_id(name)] += n * e
    assert np.allclose(counts, want, rtol=1e-9, atol=1e-12)
    assert likelihood.chances(pieces, WORDS, None, None).tolist() == got.tolist()


def test_long_words_are_worked_on_alike(pieces, monkeypatch):
    rng = random.Random(1)
    some = ["".join(rng.choice("abcdeé日ꙮ the") for _ in range(rng.randint(1, 60))) for _ in range(40)]
    counts = [np.zeros(len(pieces.logs)) for _ in range(3)]
    times = np.arange(1, 41)
    want = likelihood.chances(pieces, some, times, counts[0])
    monkeypatch.setattr(likelihood, "WIDE", 0)
    assert np.allclose(likelihood.chances(pieces, some, times, counts[1]), want, rtol=1e-12)
    chunked = likelihood._along
    monkeypatch.setattr(likelihood, "_along", lambda p, x, t, c: chunked(p, x, t, c, chunk=7))
    assert np.allclose(likelihood.chances(pieces, some, times, counts[2]), want, rtol=1e-12)
    assert np.allclose(counts[0], counts[1]) and np.allclose(counts[0], counts[2])


def test_a_very_long_word(pieces):
    text = "abcdefghij" * 50_000
    short, twice = likelihood.chances(pieces, [text[:1000], text])
    assert math.isfinite(twice) and math.isclose(twice / short, 500, rel_tol=0.01)


def plain(rows):
    tokens = [(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), i is not None and zlib.crc32(str(i).encode()) % 5 == 1) for i, t in rows]
    counts = Counter(w for ws, held in tokens if not held for w in [*ws, None])
    n, v = sum(counts.values()), len(counts)
    return [(held, len(ws) + 1, sum(counts[w] > 0 for w in [*ws, None]), n, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*ws, None])) for ws, held in tokens]


@pytest.mark.parametrize("hot", [likelihood.HOT, 20, 1])
def test_scores(spark, documents, pieces, monkeypatch, hot):
    """With all words joined, some hot, and none joined."""
    monkeypatch.setattr(likelihood, "HOT", hot)
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["The", "the", "cat", "\x00", "naïve", "x" * rng.randint(1, 90), str(rng.randint(0, 50))]) for _ in range(rng.randint(0, 60))) for _ in range(60)] + [None, "", " \n", "word " * 5000, "y" * 200_000]
    ids = [*range(63), None, 5]
    rows = list(zip(ids, texts, strict=True))
    got = likelihood.score(documents(texts, ids), catalog.PIECES).collect()
    key = lambda r: (-1 if r[0] is None else r[0], *r[1:4], round(r[5], 6))
    want = sorted(((i, *x) for (i, _), x in zip(rows, plain(rows), strict=True)), key=key)
    for g, w in zip(sorted(got, key=key), want, strict=True):
        assert tuple(g[:5]) == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9)
        assert math.isfinite(g.score) and g.score < 0


def test_learning_helps_on_what_was_held_out(spark, documents, sentences):
    """The pieces' learned probabilities give held-out prose a higher chance than the file's; scores add up over words."""
    texts = [sentences(s % 7, 120) for s in range(50)]
    mean = lambda rounds: np.mean([r.score for r in likelihood.score(documents(texts), catalog.PIECES, rounds).where("held_out").collect()])
    assert mean(1) > mean(0)
    assert mean(2) > mean(1)
    docs = documents(["cat", "dog", "cat dog dog", ""], [0, 2, 3, 4])  # 0, 3 ... whichever are held out
    a, b, ab, end = (r.score for r in sorted(likelihood.score(docs, catalog.PIECES, 0).collect(), key=lambda r: r.doc_id))
    assert math.isclose(ab, a + 2 * b - 2 * end, rel_tol=1e-9)


def test_edges(spark, documents):
    empty = likelihood.score(documents(["x"]).where("false"), catalog.PIECES)
    assert empty.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"] and empty.count() == 0
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1]
    rows = likelihood.score(documents(["no training text"] * len(held), held), catalog.PIECES).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows} == {(4, 0, 0, 0.0)}
    named = spark.createDataFrame([("d1", "a b", 5, 6, 7, 8, 9)], "doc_id string, text string, h int, n int, c int, _row int, score int")
    assert likelihood.score(named, catalog.PIECES).first().doc_id == "d1"
