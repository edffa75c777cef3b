"""Repeated rows, shared windows and repetitive texts: bounds hold, results stay, time grows in proportion."""

import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sigloom.llm import decontaminate, langid, licences, words


@pytest.mark.parametrize("distinct", [True, False])
def test_sample_of_rows_under_one_id(spark, distinct):
    """10,000 rows under one doc_id, repeated or not, and others: no more than the bound comes to the driver, and again the same."""
    text = "concat('text of row ', id)" if distinct else "'one text'"
    many = spark.range(10_000).selectExpr("cast(7 as bigint) as doc_id", f"{text} as text", "'en' as lang")
    others = spark.range(2_000).selectExpr("id + 100 as doc_id", "concat('other text ', id) as text", "if(id % 2 = 0, 'en', 'de') as lang")
    for docs in (many.unionByName(others), many):
        found = langid.sample(docs, per_language=200)
        assert all(len(x) <= 200 and len(set(x)) == len(x) for x in found.values())
        assert langid.sample(docs.repartition(3, "text"), per_language=200) == found
    assert len(found.get("en", [])) in ({200, 0} if distinct else {1, 0})


def test_windows_with_one_hash(monkeypatch):
    """Windows of different words that share a hash are told apart, with the items of each."""
    rows = [("a", "one two three"), ("b", "one two three"), ("c", "one two four"), ("d", "five one two four")]
    text = pa.array(["x one two three y one two four z five one two"])
    real = words.Words.windows
    want = decontaminate.WindowSet(rows, 3).hits(words.scan(text, words.ALNUM))
    monkeypatch.setattr(words.Words, "windows", lambda self, k: (np.full(len(real(self, k)[0]), 9, np.uint64), real(self, k)[1]))
    got = decontaminate.WindowSet(rows, 3).hits(words.scan(text, words.ALNUM))
    assert got[0].tolist() == want[0].tolist() and got[1] == want[1] == {0: {"a", "b", "c", "d"}}


def test_shared_opening_of_many_items():
    """A text that holds an opening of thousands of items many times."""
    opening = "please read the following question with care and choose the one right answer"
    took = {}
    for n in (500, 8000):
        windows = decontaminate.WindowSet([(str(i), f"{opening} item{i}") for i in range(n)], 13)
        found = words.scan(pa.array([f"{opening} x " * 100]), words.ALNUM)
        began = time.perf_counter()
        hit, items = windows.hits(found)
        took[n] = time.perf_counter() - began
        assert len(items[0]) == n and hit.sum() == 1300
    assert took[8000] < 10 * took[500] + 0.2


def test_repetitive_licence_texts():
    """Twice the notices take about twice the time, and each is found."""
    scan = licences.scanner(licences.BASE, licences.TEMPLATES, licences.MIN_MATCH, licences.MAX_GAP, licences.COVERAGE)
    took = []
    for n in (2_000, 8_000):
        began = time.perf_counter()
        ((_, found, first, last, *_),) = scan.rows(words.scan(pa.array(["under the mit license " * n]), words.ALNUM))
        took.append(time.perf_counter() - began)
        assert (found, first, last) == (n, 0, 4 * (n - 1))
    assert took[1] < 8 * took[0] + 0.5


def test_spans_of_one_template_do_not_overlap():
    sequence = " ".join(licences.TEMPLATES[0][1].replace("[", "").replace("]", "").split())
    scan = licences.scanner(licences.BASE, licences.TEMPLATES, licences.MIN_MATCH, licences.MAX_GAP, licences.COVERAGE)
    ((*_, spans),) = scan.rows(words.scan(pa.array([f"{sequence} some other words between the notices stand here today {sequence}"]), words.ALNUM))
    label = licences.TEMPLATES[0][0]
    own = [tuple(map(int, s.split(":")[1].split("-"))) for s in spans.split(";") if s.startswith(f"{label}:")]
    assert len(own) == 2 and own[0][1] <= own[1][0]


def test_no_language_to_learn(spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("the same").alias("text"), F.lit(None).cast("string").alias("lang"))
    assert langid.sample(docs) == {}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_other_vocabularies(name):
    """What the library gives, whatever rule the file has."""
    import public_tokenizers

    from sigloom.llm import bpe

    encoder = bpe.Encoder(public_tokenizers.path(name))
    texts = ["The cat's  sat\n on IT", "naïve ÉTÉ 123 4567", "日本 x", "", "a" * 300, "<|endoftext|> b", None, "Café  z"]
    want = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in encoder.encode(pa.array(texts))] == want


def test_files_of_other_libraries_are_refused():
    import public_tokenizers

    from sigloom.llm import bpe

    for name in ("piece_bpe_32k.model", "byte_bpe_50k.tiktoken"):
        with pytest.raises(Exception):  # noqa: B017, PT011  the library's own error
            bpe.Encoder(public_tokenizers.path(name))
