"""Tables of signals, events and alerts as Parquet: append sinks that ignore replays, and versioned updates."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import iso_format
from ..operators.ingest import sync_start
from ..settings import DEFAULTS


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:  # noqa: ANN001
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def append_once(rows: DataFrame, path: str, batch_id: int) -> None:
    """Appends a micro-batch in a folder of its own, so writing it again replaces it and adds nothing."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def append_new(rows: DataFrame, path: str, key: str, batch_id: int | None = None) -> None:
    """Appends the rows whose key the table doesn't hold yet.

    With ``batch_id`` they go to a folder of their own, which is replaced if the batch comes again: what a
    broken attempt left there is neither kept nor taken for held. Reads the keys of the whole table, so this is for
    tables of events and alerts; signals, which are many, are kept apart by the first-seen state and
    written by ``append_once``.
    """
    spark = rows.sparkSession
    rows = rows.dropDuplicates([key])
    if exists(spark, path):
        held = spark.read.parquet(path)
        if batch_id is not None:
            held = held.where(F.col("batch") != batch_id)
        rows = rows.join(held.select(key), key, "left_anti")
    if batch_id is None:
        rows.write.mode("append").parquet(path)
    else:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def append_version(rows: DataFrame, path: str, version: int) -> None:
    """Partial updates by id: null means unchanged. Plain Parquet has no MERGE, so versions are appended."""
    rows.withColumn("version", F.lit(version).cast("long")).write.mode("overwrite").parquet(f"{path}/v={version}")


def latest(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The read view: of each column the newest value that isn't null, by pre-aggregated max_by."""
    rows = spark.read.option("mergeSchema", "true").parquet(path).drop("v", "batch")
    columns = [c for c in rows.columns if c not in (key, "version")]
    return rows.groupBy(key).agg(*(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("version"))).alias(c) for c in columns))


def resume_since(spark: SparkSession, path: str, lookback_days: int = DEFAULTS.initial_lookback_days) -> str:
    """From when to ask a source: the newest publishedAt of the stored signals, else ``lookback_days`` ago."""
    stored = read_or_empty(spark, path, "publishedAt STRING").agg(F.max(F.try_to_timestamp("publishedAt")).alias("latest"))
    start = sync_start(F.lit(None).cast("timestamp"), F.col("latest"), F.current_timestamp(), lookback_days)
    return stored.select(iso_format(start).alias("since")).first()["since"]


def latest_published(signals: DataFrame) -> DataFrame:
    """(latest_text, latest): the string maximum of the original, and the latest instant."""
    return signals.agg(F.max("publishedAt").alias("latest_text"), F.max(F.try_to_timestamp("publishedAt")).alias("latest"))
