"""Tables written between the steps of an operator.

A step whose result is read more than once, or whose recomputation would repeat
expensive work after an executor is lost, is written as Parquet in the folder that
``spark.checkpoint.dir`` names. That folder is shared by the driver and all
executors. Where it is unset one is made here, but only for a local master: on a
cluster a folder of the driver's machine would not be shared.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

#: Bytes of text in a batch that goes to a Python worker, whatever the length of the rows (one row at least).
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_made: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder; sets ``spark.checkpoint.dir`` only if a local session has none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="sigloom-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's limit of bytes in an Arrow batch, so that workers hold a few MB at a time."""
    have = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH_SETTING))
    if have <= 0 or have > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/sigloom/{name}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(drop_all)
    _made[path] = spark
    return path


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` as a written table: cuts its lineage and survives the loss of executors."""
    spark = df.sparkSession
    small_batches(spark)
    path = new_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_at = path
    return table


def fresh(columns: Iterable[str], *names: str) -> list[str]:
    """``names``, lengthened until none is among ``columns``."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of frames that are no longer referenced."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(*tables: DataFrame) -> None:
    """Deletes written tables that nothing reads any more."""
    for table in tables:
        path = table._written_at
        drop(table.sparkSession, path)
        _made.pop(path, None)


def tables_made() -> set[str]:
    """A mark for ``discard_since``."""
    return set(_made)


def discard_since(mark: set[str], *keep: DataFrame) -> None:
    """Deletes the tables written since the mark but for those in ``keep``: the steps behind a result that is written itself."""
    kept = mark | {table._written_at for table in keep}
    for path in [p for p in _made if p not in kept]:
        drop(_made.pop(path), path)


def drop(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def drop_all() -> None:
    """At the end of the driver: the tables this session wrote."""
    for path, spark in _made.items():
        try:
            drop(spark, path)
        except Exception:  # the JVM may have ended already; the folder is scratch space
            return
    _made.clear()
