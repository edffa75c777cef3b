import pytest


@pytest.fixture
def documents(spark):
    """Makes a documents table; extra columns with clashing names come with it."""

    def make(texts, ids=None, langs=None, sources=None):
        n = len(texts)
        ids = list(range(n)) if ids is None else ids
        rows = [(i, t, (langs or [None] * n)[k], (sources or ["s"] * n)[k], 7, 1, "x") for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n long, cls string")

    return make


@pytest.fixture(scope="session")
def sentences():
    """Reproducible prose: sentences(seed, words)."""
    import random

    def make(seed, n):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8))) for _ in range(n))

    return make
