"""Folders for tables between steps: below the shared folder that the session names, deleted when the driver ends."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: dict[str, SparkSession] = {}


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; a temporary one only for a local session without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="sigloom-")
    path = f"{base.rstrip('/')}/sigloom/{name}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_drop_all)
    _made[path] = spark
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table: its lineage is cut, and it outlives executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written_at = path
    return table


def drop(*tables: DataFrame) -> None:
    """Deletes written tables that nothing reads any more."""
    for table in tables:
        _delete(_made.pop(table._written_at), table._written_at)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _drop_all() -> None:
    for path, spark in _made.items():
        try:
            _delete(spark, path)
        except Exception:  # the JVM may have ended already; the folder is scratch space
            return
    _made.clear()
