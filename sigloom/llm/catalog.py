"""The queries of this subpackage and their SQL, for ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, jaccard, langid, licences, likelihood, mix, pages, passages, pipeline, quality, snapshots, spelling, sql, tokenstore

#: The vocabulary file of op3; a parameter of the operator, never copied here.
VOCABULARY = pipeline.VOCABULARY

#: The vocabulary of subwords of op12; a parameter as well.
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(chat.format_conversations(chat.with_tricky(table(spark, sf_dir, "conversations"))))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenstore.encoded(table(spark, sf_dir, "documents"), VOCABULARY)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.taken(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.scan_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.find(table(spark, sf_dir, "documents"))


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


def op11_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.differences(table(spark, sf_dir, "documents"))


def op12_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return likelihood.score(table(spark, sf_dir, "documents"), PIECES)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def base_of_op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op2 that its contract fixes, for SQL."""
    return op2_quality_rules(spark, sf_dir).drop("kept", "posterior")


def base_of_op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op10 that its contract fixes, for SQL."""
    return op10_licence_scan(spark, sf_dir).drop("labels", "score", "spans")


def base_of_op12_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op12 that its contract fixes, for SQL; the sum of logarithms to 6 places."""
    return op12_lattice_likelihood(spark, sf_dir).drop("score").withColumn("base_score", F.round("base_score", 6))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op")}
    found = dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0]))) | {"pipeline": pipeline.run}
    return found | {f.__name__: f for f in (base_of_op2_quality_rules, base_of_op10_licence_scan, base_of_op12_lattice_likelihood)}


def oracle_sql() -> dict[str, str]:
    """SQL of the queries whose whole result SQL can express; the others are held against plain Python in tests."""
    return {"op1_chat_format": chat.ORACLE} | sql.ORACLES
