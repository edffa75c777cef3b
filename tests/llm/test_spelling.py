"""Near words and their forms against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sigloom.llm import spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, times=10):
    out = {}
    for w, n in counts.items():
        close = [v for v in counts if one_edit(w, v)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= times * n else None
        out[w] = (n, len(close), form, counts[form] if form else None)
    def root(w):
        return root(out[w][2]) if out[w][2] else w
    return {(w, *x, root(w)) for w, x in out.items()}


def table(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def found(spark, counts, **more):
    rows = [tuple(r) for r in spelling.forms(table(spark, counts), **more).collect()]
    assert len(rows) == len(set(rows)) == len(counts)
    return set(rows)


@pytest.mark.parametrize(("block", "letters", "longest"), [(40, "abc", 9), (3, "ab", 8), (2, "aé", 5), (5, "abcdefgh", 12)])
def test_against_brute_force(spark, block, letters, longest):
    """Few letters, so blocks are crowded and repeated letters make an edit's place ambiguous; small blocks are subdivided to the end."""
    rng = random.Random(block)
    counts = {"".join(rng.choice(letters) for _ in range(rng.randint(1, longest))): rng.choice([1, 2, 15, 200, 3000]) for _ in range(220)}
    assert found(spark, counts, block=block) == brute(counts)


def test_skewed_blocks(spark):
    """A third of all words share a beginning, a third an end; more partitions than blocks."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    counts = {w: rng.randint(2, 60) for w in [f"common{word(4)}" for _ in range(200)] + [f"{word(4)}common" for _ in range(200)] + [word(8) for _ in range(200)]}
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(spark, counts, block=8) == brute(counts)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_long_words(spark):
    long = "abcdefghij" * 20_000
    counts = {long: 500, long[:77] + long[78:]: 20, long[:77] + "x" + long[78:]: 3, long[1:]: 2, "a" * 70: 9, "a" * 71: 90, "a" * 72: 900, "b" * 64: 5, "b" * 65: 7}
    assert found(spark, counts) == brute(counts)
    assert spelling._one_edit("ab", "ab") is False and spelling._one_edit("", "a") is True


def test_roots_of_chains(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(13)] + [("x", "w12"), ("y", "z")]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert got == {**{f"w{i}": "w13" for i in range(13)}, "x": "w13", "y": "z"}
    assert spelling.roots(spark.createDataFrame([], "word string, form string")).count() == 0


def test_words_of_texts(spark, documents):
    rng = random.Random(3)
    vocabulary = ["Überprüfung", "licence", "LICENCE", "short", "naïvement", "aaaaaaaa", "ÀÉÎÕÜÝß", "multiply×divide"]
    texts = [" ".join(rng.choice(vocabulary) + rng.choice(["", ",", "1", "ж", "\n"]) for _ in range(60)) for _ in range(40)] + [None, "", "7 8 9", "licence" * 100_000]
    ids = [*range(-5, 38), None]
    want = Counter()
    for i, t in zip(ids, texts, strict=True):
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                want[run] += 1
    want = {w: n for w, n in want.items() if n >= 2}
    docs = documents(texts, ids)
    assert {r.word: r.n for r in spelling.words(docs).collect()} == want
    assert {tuple(r) for r in spelling.variants(docs).collect()} == brute(want)
    assert any(x[2] for x in brute(want))
    assert spelling.variants(docs.where("false")).count() == 0
    assert spelling.variants(docs.where(F.col("text").isNull())).count() == 0
