"""A corpus from raw documents to token files: filter, deduplicate, decontaminate, mix, encode.

``run(spark, sf_dir)`` applies the stages of ``STAGES`` to ``documents``. Each stage gets the
whole table its predecessor kept, written as Parquet in the folder that
``spark.checkpoint.dir`` names and read again, and all but the last return the columns of
``documents``. The last returns, read back from the token files, a row per document of the mix.

Defined results, of all stages: an empty table gives an empty table. Null and empty texts fail the
base rule of the first stage and go there. Repeated rows, and different texts under one doc_id, are
judged row by row; of equal and near-equal texts the near-duplicate stage keeps the one row of the
smallest doc_id. Rows with a null doc_id are never near duplicates of others; a null source is a
source. Ties are decided by hashes of the rows, so reruns agree. Further columns, whatever their
names, are carried up to the last stage. Texts of any length are read whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, jaccard, mix, quality, stage, tokenstore

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules pass and the weakly supervised model finds good."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or more over 5-word shingles."""
    return jaccard.deduplicate(docs, k=5, num=80, den=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that the benchmark contaminates."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents, so that each source has its target share of all words."""
    return mix.mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in the content-addressed token store: doc_id, start, n_tokens, ids_crc32, n_chunks."""
    return tokenstore.encoded(docs, VOCABULARY)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_files", token_files),
]

#: None: expectation-maximisation and byte-pair merges can't be put into SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def applied(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on any table with the columns of ``documents``."""
    for name, function in STAGES[:-1]:
        docs = stage.written(function(spark, docs, sf_dir), f"pipeline-{name}")
        stage.release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applied(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
