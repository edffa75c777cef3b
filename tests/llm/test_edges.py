"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names: every operator and the pipeline."""

import oracle
import pytest
from pyspark.sql import functions as F

from sigloom.llm import catalog, chat, decontaminate, jaccard, langid, licences, mix, pages, passages, pipeline, quality, semijoin, stage, tokenstore

#: names that operators use inside
NAMES = (
    "_text _pattern _row _spans _items _hit _cuts _cut_doc _base_word _kept _class _clash _own _id _source _size _key _bucket _votes _failed _doc _part _base "
    "_n _copy _at _cum _c _hot _salt _word _bits cls n data blk root kind key start digest place window at base words before rows least score labels posterior kept hit row text_"
).split()


def word(i):
    return "".join("abcdefghijklmnoprstu"[i // 20**p % 20] for p in range(5))


LONG = ". ".join(" ".join(word(i) for i in range(j, j + 10)) for j in range(0, 850_000, 10)) + "."  # 5 MB
SHARED = " ".join(word(i) for i in range(3_000_000, 3_000_120)) + "."
PROSE = "The cat sat on the mat and looked at the dog, which was not amused at all by any of this."
ROWS = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, LONG, "en", "b"), (5, PROSE, "en", "b"), (6, PROSE, "de", "b"),
    (5, PROSE, "en", "b"), (5, PROSE, "en", "b"), (7, PROSE.upper(), "en", None), (None, PROSE, None, "a"), (None, None, None, "a"), (8, "other words under one id", "en", "a"),
    (8, SHARED + " " + PROSE, "en", "a"), (9, SHARED, "fr", "a"),
]


@pytest.fixture(scope="module", params=["long", "string"])
def table(spark, request):
    texts = [r if r[1] is not LONG or request.param == "long" else (*r[:1], LONG[:300_000], *r[2:]) for r in ROWS]
    rows = [(None if i is None else i if request.param == "long" else f"d{i}", *rest, *range(len(NAMES))) for i, *rest in texts]
    return spark.createDataFrame(rows, f"doc_id {request.param}, text string, lang string, source string, {', '.join(f'{n} int' for n in NAMES)}")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, PROSE, 3), (2, None, 3), (None, "", 3), (3, LONG, 3)], "item_id int, text string, n int")


REPORTS = {
    "quality": lambda d, b: quality.scores(d),
    "tokens": lambda d, b: tokenstore.encoded(d, catalog.VOCABULARY),
    "mix": lambda d, b: mix.taken(d),
    "language": lambda d, b: langid.identify(d),
    "contamination": decontaminate.scan_documents,
    "contamination in blocks": lambda d, b: decontaminate.scan_documents(d, b, max_windows=300_000),
    "jaccard": lambda d, b: jaccard.components(d),
    "licences": lambda d, b: licences.scan_licences(d),
}


@pytest.mark.parametrize("name", REPORTS)
def test_a_row_for_each_row(table, benchmark, name):
    out = REPORTS[name](table, benchmark)
    rows = out.collect()
    assert sorted((r.doc_id for r in rows), key=str) == sorted((r.doc_id for r in table.select("doc_id").collect()), key=str)
    groups = {}
    for r in rows:  # repeated rows have repeated results, but for their place in the order
        groups.setdefault(r.doc_id, set()).add(tuple(x for c, x in r.asDict().items() if c not in ("start", "taken", "copies")))
    assert len(groups[next(d for d in groups if str(d).endswith("5"))]) == 1
    empty = REPORTS[name](table.where("false"), benchmark)
    assert empty.columns == out.columns and empty.count() == 0


FILTERS = {
    "quality": (lambda d, b: quality.keep(d), {4, 8, 9}),
    "jaccard": (lambda d, b: jaccard.deduplicate(d), {1, 2, 3, 4, 5, 8}),
    "contamination": (decontaminate.decontaminate, {1, 2, 3, 8, 9}),
    "contamination in blocks": (lambda d, b: decontaminate.decontaminate(d, b, max_windows=300_000), {1, 2, 3, 8, 9}),
    "contaminated spans": (lambda d, b: decontaminate.decontaminate(d, b, "spans"), set(range(1, 10))),
    "passages": (lambda d, b: passages.remove(d), set(range(1, 10))),
    "mix": (lambda d, b: mix.mix(d), None),
}


@pytest.mark.parametrize("name", FILTERS)
def test_columns_are_carried(table, benchmark, name):
    f, ids = FILTERS[name]
    out = f(table, benchmark)
    assert out.columns == table.columns and out.dtypes == table.dtypes
    rows = out.collect()
    if ids is not None:
        assert {int(str(r.doc_id).lstrip("d")) for r in rows if r.doc_id is not None} == ids
    assert all(tuple(r[n] for n in NAMES) == tuple(range(len(NAMES))) for r in rows)
    empty = f(table.where("false"), benchmark)
    assert empty.columns == table.columns and empty.count() == 0


def test_passages_of_clashing_ids(table):
    found = passages.find(table).collect()
    assert {int(str(r.doc_id).lstrip("d")) for r in found} == {8, 9}
    text = {int(str(r.doc_id).lstrip("d")): r.text for r in passages.remove(table).where("text <> 'other words under one id'").collect() if r.doc_id is not None}
    assert len(text[9].split()) < 5 and text[8] == SHARED + " " + PROSE and text[4].startswith(LONG[:300_000])
    assert passages.find(table.where("false")).count() == 0


def test_pipeline_of_edges(spark, table, sf):
    rows = pipeline.applied(spark, table, sf).collect()
    assert {int(str(r.doc_id).lstrip("d")) for r in rows} <= {4, 8, 9} and len(rows) > 0
    assert pipeline.applied(spark, table.where("false"), sf).count() == 0
    assert pipeline.applied(spark, table.where("text is null"), sf).count() == 0


def test_chat_of_edges(spark):
    rows = [(1, 0, "user", LONG), (1, 1, "assistant", LONG), (1, 1, "assistant", LONG), (2, None, None, None), (None, 0, "user", ""), (2, 5, "assistant", "")]
    names = [n for n in NAMES if n != "data"]
    for kind, as_id in (("long", lambda i: i), ("string", lambda i: None if i is None else f"c{i}")):
        turns = spark.createDataFrame([(as_id(i), *rest, *range(len(names))) for i, *rest in rows], f"conv_id {kind}, turn long, role string, text string, {', '.join(f'{n} int' for n in names)}")
        got = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.digests(chat.format_conversations(turns)).collect()}
        assert got == {as_id(1): (3, 2 * len(LONG)), as_id(2): (2, 0), None: (1, 0)}


def test_pages_of_edges(spark):
    long = "<article><p>" + PROSE + "</p>" + "<p>one more line of text here.</p>" * 100_000
    rows = [(1, "u", None), (None, None, "x"), (2, "u", ""), (3, "u", long), (4, "u", "<div>" * 20_000 + PROSE), (5, "u", "<![CDATA[" * 20_000), (5, "u", "<p>" * 20_000)]
    table = spark.createDataFrame([(*r, *range(len(NAMES))) for r in rows], f"page_id long, url string, html string, {', '.join(f'{n} int' for n in NAMES)}")
    got = pages.extract(table, 200).collect()
    assert sorted(r.page_id or 0 for r in got) == [0, 1, 2, 3, 4, 5, 5]
    assert next(r.text for r in got if r.page_id == 3).count("one more line") == 100_000
    assert pages.extract(table.where("false"), 200).count() == 0


def test_split_join(spark, monkeypatch):
    monkeypatch.setattr(semijoin, "FEW", 100)
    rows = spark.range(1000).selectExpr("if(id % 3 = 0, 7, id) as key", "id as doc_id")
    small = stage.written(rows.groupBy("key").count().withColumnRenamed("count", "times").where("key % 2 = 1").selectExpr("key", "times", "key * 10 as value"), "small")
    got = semijoin.split_join(rows, small, "key", "times", 1000, rows["doc_id"])
    want = rows.join(small.drop("times"), "key")
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert semijoin.split_join(rows, small.where("false"), "key", "times", 1000, rows["doc_id"]).count() == 0


def test_maybe_in(spark):
    rows = spark.range(50_000).selectExpr("nullif(id, 3) as doc_id", "id as x")
    keys = spark.range(0, 50_000, 97).selectExpr("id as doc_id")
    got = semijoin.maybe_in(rows, keys, "doc_id")
    assert got.columns == rows.columns
    kept = {r.doc_id for r in got.collect()}
    assert kept >= set(range(0, 50_000, 97)) and len(kept) < 1000 and None not in kept


def test_shared_folder_of_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)  # noqa: N815

    class Session:
        sparkContext = Context  # noqa: N815
        conf = type("Conf", (), {"get": staticmethod(lambda *a: None)})

    with pytest.raises(ValueError, match="checkpoint"):
        stage.shared_dir(Session)


def test_batches_are_lowered_only(spark):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    try:
        for given, want in (("64m", str(stage.BATCH_BYTES)), ("1m", "1m"), ("500000", "500000")):
            spark.conf.set(setting, given)
            stage.small_batches(spark)
            assert spark.conf.get(setting).rstrip("b") in (want, str(1 << 20) if want == "1m" else want)
    finally:
        spark.conf.set(setting, before)


def test_steps_are_deleted_when_they_are_read(spark, tmp_path):
    docs = spark.createDataFrame([(i, "some words of a text that is here " * 12 + str(i // 2)) for i in range(40)], "doc_id long, text string").withColumn("source", F.lit("a"))
    for made, most in ((lambda: jaccard.deduplicate(docs), 2), (lambda: mix.taken(docs), 3), (lambda: passages.find(docs), 3)):
        mark = stage.tables_made()
        result = made()
        assert len(stage.tables_made() - mark) <= most
        result.collect()  # nothing that it reads is gone


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_sql(spark, sf, name):
    oracle.same(catalog.queries()[name](spark, sf), oracle.connect(sf), catalog.oracle_sql()[name])
